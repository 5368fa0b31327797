"""Results of a stream, stretch by stretch of the time that its watermark has passed.

A keyed stage of the engine pays for each key and state call, whatever the rows. Where a
result needs no answer before the watermark anyway, the rows wait in files instead: a
micro-batch writes its rows to a folder of its own, and those between the watermark before
and the watermark now, a *stretch*, are handed as one table to an operator of the batch side,
which cuts hot keys as it always does. What a stretch has to know of the time before it comes
as rows, too: as the rows of the last ``reach`` of time, or as what :meth:`Stage.carry` kept.

Rows behind the watermark raise ``LateRowsDropped``; rows without a time take no part. All a
batch leaves is in folders named after its number, so a replayed batch replaces itself, and a
restart goes on from the mark of the batch before. Times are epoch microseconds.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.durations import epoch_micros, micros
from tidemark.session import fresh_path
from tidemark.streaming.drain import End, LateRowsDropped, drain_batches


@dataclass(frozen=True)
class Stretch:
    """Event time after ``before``, up to and including ``now``; the first one has no ``before``."""

    before: int | None
    now: int

    def has(self, at: Column) -> Column:
        return at <= self.now if self.before is None else (at > self.before) & (at <= self.now)


class Stage:
    """What is done with the rows of a stretch.

    ``results`` is written once for each stretch. What the next one is to know is picked out of
    that by ``kept``, or made by ``carry`` and written too. ``final`` picks the results out of
    all that was written. ``reach`` is the time before a stretch whose rows it sees again.
    """

    reach = 0

    def results(self, rows: DataFrame, carry: DataFrame | None, stretch: Stretch) -> DataFrame:
        raise NotImplementedError

    def kept(self, written: DataFrame) -> DataFrame | None:
        return None

    def carry(self, rows: DataFrame, written: DataFrame, carry: DataFrame | None) -> DataFrame | None:
        return None

    def final(self, written: DataFrame) -> DataFrame:
        return written


@dataclass
class Mark:
    """Where a micro-batch left off: the watermark, the rows that came behind it, the folders
    (by batch, with their latest time) whose rows are still needed, and the batch that last
    settled a stretch."""

    now: int | None = None
    dropped: int = 0
    folders: list[tuple[int, int]] = field(default_factory=list)
    settled: int | None = None


class Settled:
    """``foreachBatch`` target that hands stretches to a stage."""

    def __init__(self, spark: SparkSession, stage: Stage, ts: str, delay: str, path: str):
        self.spark, self.stage, self.ts, self.path = spark, stage, ts, path
        self.delay = micros(delay)

    def _folder(self, kind: str, batch_id: int) -> str:
        return f"{self.path}/{kind}/{batch_id}"

    def _mark(self, batch_id: int) -> Mark:
        if batch_id < 0:
            return Mark()
        text = self.spark.read.text(self._folder("mark", batch_id)).first()[0]
        return Mark(**json.loads(text))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        known = self._mark(batch_id - 1)
        batch.where(F.col(self.ts).isNotNull()).write.mode("overwrite").parquet(self._folder("rows", batch_id))
        at = epoch_micros(self.ts)
        late = F.lit(False) if known.now is None else at <= known.now
        top, dropped = (
            self.spark.read.schema(batch.schema).parquet(self._folder("rows", batch_id))
            .agg(F.max(at), F.count(F.when(late, 1))).first()
        )
        mark = Mark(known.now, known.dropped + dropped, [tuple(f) for f in known.folders], known.settled)
        if top is not None:
            mark.folders.append((batch_id, top))
            mark.now = top - self.delay if known.now is None else max(known.now, top - self.delay)
        if mark.now != known.now:
            self._settle(batch, batch_id, Stretch(known.now, mark.now), mark)
        self.spark.createDataFrame([(json.dumps(asdict(mark)),)], "mark string").coalesce(1).write.mode(
            "overwrite"
        ).text(self._folder("mark", batch_id))

    def _settle(self, batch: DataFrame, batch_id: int, stretch: Stretch, mark: Mark) -> None:
        folders = [self._folder("rows", nth) for nth, _ in mark.folders]
        rows = self.spark.read.schema(batch.schema).parquet(*folders)
        # Against the column itself, which the files can skip by.
        rows = rows.where(F.col(self.ts) <= _instant(stretch.now))
        if stretch.before is not None:
            rows = rows.where(F.col(self.ts) > _instant(stretch.before - self.stage.reach))
        carry = None if mark.settled is None else self._carried(mark.settled)
        out = self._folder("out", batch_id)
        self.stage.results(rows, carry, stretch).write.mode("overwrite").parquet(out)
        made = self.stage.carry(rows, self.spark.read.parquet(out), carry)
        if made is not None:
            made.write.mode("overwrite").parquet(self._folder("carry", batch_id))
        mark.settled = batch_id
        mark.folders = [f for f in mark.folders if f[1] > stretch.now - self.stage.reach]

    def _carried(self, batch_id: int) -> DataFrame | None:
        kept = self.stage.kept(self.spark.read.parquet(self._folder("out", batch_id)))
        if kept is None and batch_id in self._numbers("carry"):
            return self.spark.read.parquet(self._folder("carry", batch_id))
        return kept

    def read(self, rows: DataFrame) -> DataFrame:
        """The results so far; ``rows`` tells the columns of the input."""
        marks = self._numbers("mark")
        dropped = self._mark(max(marks)).dropped if marks else 0
        if dropped:
            raise LateRowsDropped(
                f"{dropped} rows came behind the watermark: give the source's disorder as delay, or route late rows"
            )
        outs = [self._folder("out", nth) for nth in sorted(self._numbers("out")) if nth in marks]
        if not outs:
            empty = self.spark.createDataFrame([], rows.schema)
            return self.stage.final(self.stage.results(empty, None, Stretch(None, 0)))
        return self.stage.final(self.spark.read.parquet(*outs))

    def _numbers(self, kind: str) -> set[int]:
        """Batches that have written a folder of that kind to its end."""
        of = self.spark._jvm.org.apache.hadoop.fs.Path
        system = of(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = system.globStatus(of(f"{self.path}/{kind}/*/_SUCCESS")) or []
        return {int(f.getPath().getParent().getName()) for f in found}


def _instant(at: int) -> Column:
    return F.timestamp_micros(F.lit(at))


def drain_settled(
    stream: DataFrame, spark: SparkSession, stage: Stage, ts: str, delay: str, label: str,
    end: End | None = None, path: str | None = None, checkpoint: str | None = None,
) -> DataFrame:
    """Run ``stage`` over everything available now; ``spark`` is the session its tables are read in.

    Rows come up to ``delay`` out of order. With ``end`` the last stretch comes out too.
    """
    settled = Settled(spark, stage, ts, delay, path or fresh_path(spark, label))
    drain_batches(stream, settled, label, checkpoint=checkpoint, end=end)
    return settled.read(stream)
