"""Keyed upsert sink: the last write per key wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.session import fresh_path


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row of every key; partial aggregation keeps hot keys cheap."""
    payload = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*payload), F.struct(*order)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(
        *keys, *[F.col("_newest")[c].alias(c) for c in payload]
    )


class KeyedTable:
    """Parquet runs of changes in levels; reading them yields one row per key.

    A batch is a run of level 0 that holds its own newest rows, so a replayed batch replaces
    itself. ``FOLD`` runs of a level are folded into one of the next, which covers their
    batches: a row is rewritten once a level, so what a batch costs grows with the logarithm
    of their number and not with the table, and a read opens fewer than ``FOLD`` runs a
    level. A run counts when its writer has left its mark of success, the last file it
    writes; until then, and if it never does, the runs below are read. ``schema`` lets a
    table that nothing was written to be read as empty.
    """

    FOLD = 20
    DONE = "_SUCCESS"

    def __init__(
        self, spark: SparkSession, keys: list[str], order: list[str], path: str | None = None,
        schema: T.StructType | None = None,
    ):
        self.spark = spark
        self.keys = keys
        self.order = order
        self.path = path or fresh_path(spark, "keyed")
        self.schema = schema

    def _folder(self, level: int, run: int) -> str:
        return f"{self.path}/level={level}/run={run}"

    def _newest(self, changes: DataFrame) -> DataFrame:
        return latest_per_key(changes, self.keys, [*self.order, "_batch"])

    def _read(self, runs: list[tuple[int, int]]) -> DataFrame:
        return self.spark.read.parquet(*[self._folder(*run) for run in runs])

    def upsert_batch(self, rows: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` target; without an order a batch holds one row per key."""
        newest = latest_per_key(rows, self.keys, self.order) if self.order else rows
        newest = newest.withColumn("_batch", F.lit(batch_id).cast("long"))
        newest.write.mode("overwrite").parquet(self._folder(0, batch_id))
        level, end = 1, batch_id + 1
        while end % self.FOLD**level == 0:
            run = end // self.FOLD**level - 1
            below = [(level - 1, run * self.FOLD + i) for i in range(self.FOLD)]
            self._newest(self._read(below)).write.mode("overwrite").parquet(self._folder(level, run))
            level += 1

    def _done(self) -> set[tuple[int, int]]:
        """(level, run) of every run that was written to its end."""
        of = self.spark._jvm.org.apache.hadoop.fs.Path
        system = of(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        marks = system.globStatus(of(f"{self.path}/level=*/run=*/{self.DONE}")) or []
        folders = [mark.getPath().getParent() for mark in marks]
        return {
            (int(f.getParent().getName().split("=")[1]), int(f.getName().split("=")[1])) for f in folders
        }

    def cover(self) -> list[tuple[int, int]]:
        """The highest runs that together hold every batch once."""
        done = self._done()
        levels = sorted({level for level, _ in done}, reverse=True)
        last = max(((run + 1) * self.FOLD**level for level, run in done), default=0)
        found, batch = [], 0
        while batch < last:
            wide = next(
                (
                    level for level in levels
                    if batch % self.FOLD**level == 0 and (level, batch // self.FOLD**level) in done
                ),
                None,
            )
            if wide is not None:
                found.append((wide, batch // self.FOLD**wide))
            batch += self.FOLD ** (wide or 0)
        return found

    def read(self) -> DataFrame:
        runs = self.cover()
        if not runs:
            if self.schema is None:
                raise ValueError(f"nothing was written to {self.path} and no schema was given")
            return self.spark.createDataFrame([], self.schema)
        return self._newest(self._read(runs)).drop("_batch")
