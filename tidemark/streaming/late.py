"""Late rows to an output of their own.

The engine drops rows behind the watermark, so the split happens before any windowed
aggregate: a row is late when its window, allowance included, had closed by the largest
event time of *earlier* micro-batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.durations import epoch_micros, micros
from tidemark.session import fresh_path
from tidemark.streaming.drain import drain_batches


class LateRouter:
    """``foreachBatch`` target with an on-time and a late output.

    Each batch leaves the largest event time up to and including it in a folder named
    after its number, from that of the batch before; a replayed batch reads the same
    folder, so it decides as it did before. Batch numbers follow each other.
    """

    def __init__(self, ts: str, size: str, delay: str, allowed: str, path: str):
        self.ts, self.size = ts, size
        self.delay, self.allowed = micros(delay), micros(allowed)
        self.path = path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        top = None
        if batch_id > 0:
            top = spark.read.parquet(f"{self.path}/progress/{batch_id - 1}").first()["top"]
        batch = batch.persist()  # written, and asked for its largest time
        try:
            now = batch.agg(F.max(epoch_micros(self.ts)).alias("top"))
            now.select(F.greatest("top", F.lit(top).cast("long")).alias("top")).write.mode("overwrite").parquet(
                f"{self.path}/progress/{batch_id}"
            )
            end = epoch_micros(F.window(self.ts, self.size)["end"])
            late = F.lit(False) if top is None else end + self.allowed <= top - self.delay
            batch.withColumn("late", F.coalesce(late, F.lit(False))).write.mode("overwrite").partitionBy(
                "late"
            ).parquet(f"{self.path}/rows/batch={batch_id}")
        finally:
            batch.unpersist()

    def rows(self, spark: SparkSession) -> DataFrame:
        """Every row with ``late``; filter on it for either output (a folder each)."""
        rows = spark.read.parquet(f"{self.path}/rows").drop("batch")
        return rows.withColumn("late", F.col("late").cast("boolean"))


def route_late(
    stream: DataFrame, ts: str, size: str, delay: str, allowed: str, label: str
) -> DataFrame:
    spark = stream.sparkSession
    router = LateRouter(ts, size, delay, allowed, fresh_path(spark, label))
    drain_batches(stream, router, label)
    return router.rows(spark)
