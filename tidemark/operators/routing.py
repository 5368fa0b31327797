"""One input to several outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.durations import epoch_micros, micros
from tidemark.operators.running import Sequence, highest, running


def shuffle(df: DataFrame, partitions: int) -> DataFrame:
    """Even redistribution over ``partitions`` tasks; the rows stay the same."""
    return df.repartition(partitions)


def tagged(df: DataFrame, tags: Column, tag: str) -> DataFrame:
    """The rows routed to output ``tag``."""
    return df.where(F.array_contains(tags, tag))


def side_output(df: DataFrame, condition: Column, message: Column) -> tuple[DataFrame, DataFrame]:
    """Main output with every row, side output with a message per row that qualifies."""
    return df, df.where(condition).select(message.alias("message"))


def watermarks(df: DataFrame, arrival: Sequence, ts: str, delay: str, name: str) -> DataFrame:
    """The watermark (epoch micros) in force after each row, in order of arrival."""
    seen = running(df, [], arrival, **{name: highest(epoch_micros(ts))})
    return seen.withColumn(name, F.col(name) - micros(delay))


def lateness(
    df: DataFrame,
    arrival: Sequence,
    ts: str,
    size: str,
    delay: str,
    allowed: str = "0 seconds",
    name: str = "late",
) -> DataFrame:
    """Mark rows whose window had closed, allowance included, before they arrived."""
    seen = running(df, [], arrival, _max=highest(epoch_micros(ts), before=True))
    end = epoch_micros(F.window(ts, size)["end"])
    closed = end + micros(allowed) <= F.col("_max") - micros(delay)
    return seen.withColumn(name, F.coalesce(closed, F.lit(False))).drop("_max")
