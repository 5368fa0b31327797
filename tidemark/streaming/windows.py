"""Windowed streaming aggregates and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.durations import micros
from tidemark.operators.topn import top_n
from tidemark.session import fresh_path
from tidemark.streaming.drain import End, drain_batches


def tolerant(df: DataFrame, ts: str, out_of_order: str, lateness: str = "0 seconds") -> DataFrame:
    """Watermark for rows up to ``out_of_order`` behind, plus ``lateness`` for corrections.

    In update mode early results come out and are corrected until the allowance ends.
    """
    delay = micros(out_of_order) + micros(lateness)
    return df.withWatermark(ts, f"{delay // 1000} milliseconds")


def session_counts(
    df: DataFrame, keys: list[str], ts: str, gap: str, **aggregates: Column
) -> DataFrame:
    return (
        df.groupBy(*keys, F.session_window(ts, gap).alias("_w"))
        .agg(*[agg.alias(name) for name, agg in aggregates.items()])
        .select(
            *keys,
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            *aggregates,
        )
    )


def sliding_counts(df: DataFrame, keys: list[str], ts: str, size: str, slide: str) -> DataFrame:
    """Sliding counts from panes: state and copies grow with panes, not with rows."""
    panes = (
        df.groupBy(*keys, F.window(ts, slide).alias("_pane"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_at", F.window_time("_pane"))
    )
    return (
        panes.groupBy(*keys, F.window("_at", size, slide).alias("_w"))
        .agg(F.sum("_rows").alias("cnt"))
        .select(*keys, F.col("_w.end").alias("window_end"), "cnt")
    )


def distinct_per(df: DataFrame, columns: list[str], ts: str, size: str) -> DataFrame:
    """Distinct values of ``columns`` in every window of time, with its start.

    A value is held until its window closes, so state does not grow with the stream; ``df``
    needs a watermark. Values come out when they are first seen.
    """
    windowed = df.withColumn("_w", F.window(ts, size)).dropDuplicates([*columns, "_w"])
    return windowed.select(*columns, F.col("_w.start").alias("window_start"))


def ranked(
    counts: DataFrame, keys: list[str], n: int, label: str, end: End | None = None
) -> DataFrame:
    """Best ``n`` keys of every closed window.

    In append mode a window closes once, with all its keys in one micro-batch, so
    ranking inside the batch is exact.
    """
    spark = counts.sparkSession
    path = fresh_path(spark, label)

    def rank(batch: DataFrame, batch_id: int) -> None:
        top_n(batch, ["window_end"], "cnt", keys, n).write.mode("overwrite").parquet(
            f"{path}/batch={batch_id}"
        )

    drain_batches(counts, rank, label, end=end)
    return spark.read.parquet(path).drop("batch")
