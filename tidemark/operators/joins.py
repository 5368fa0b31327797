"""Joins on keys, pairs and time."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.durations import epoch_micros, micros, whole_part
from tidemark.operators.running import Sequence, running, tally


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(c).alias(prefix + c) for c in df.columns])


def left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left outer equi-join keeping every column of both sides (``l_``, ``r_``)."""
    return prefixed(left, "l_").join(
        prefixed(right, "r_"), F.col(f"l_{key}") == F.col(f"r_{key}"), "left"
    )


def reconcile(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_order: Sequence,
    right_order: Sequence,
    how: Literal["inner", "full"] = "inner",
) -> DataFrame:
    """Match rows one to one: the n-th row of a key meets the n-th of the other side.

    NULL keys never match. ``how="full"`` also reports what stays unmatched; rows without
    a key bypass the join, as they would all meet in one task.
    Pairing by ordinal makes the join key unique, so no key fans out.
    """

    def numbered(df: DataFrame, order: Sequence, prefix: str) -> DataFrame:
        keyed = running(df.where(F.col(key).isNotNull()), [key], order, _pair=tally())
        return prefixed(keyed, prefix)

    matched = (
        numbered(left, left_order, "l_")
        .join(
            numbered(right, right_order, "r_"),
            (F.col(f"l_{key}") == F.col(f"r_{key}")) & (F.col("l__pair") == F.col("r__pair")),
            how,
        )
        .drop("l__pair", "r__pair")
    )
    if how == "inner":
        return matched
    for side, prefix in ((left, "l_"), (right, "r_")):
        orphans = prefixed(side.where(F.col(key).isNull()), prefix)
        matched = matched.unionByName(orphans, allowMissingColumns=True)
    return matched


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    ts: str,
    earliest: str,
    latest: str,
) -> DataFrame:
    """Pairs of one key with ``right.ts`` in ``[left.ts - earliest, left.ts + latest]``.

    Both ends are inclusive. A time slot as wide as the interval joins the equi-key:
    a right row sits in its own slot, a left row visits the one or two slots its
    interval touches, so a hot key is spread over time and every pair meets once.
    """
    back, ahead = micros(earliest), micros(latest)
    width = max(back + ahead, 1)

    at = epoch_micros(ts)
    visits = F.sequence(whole_part(at - back, width), whole_part(at + ahead, width))
    l = prefixed(
        left.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).withColumn(
            "_slot", F.explode(visits)
        ),
        "l_",
    )
    r = prefixed(
        right.where(F.col(key).isNotNull()).withColumn("_slot", whole_part(at, width)), "r_"
    )
    apart = epoch_micros(f"r_{ts}") - epoch_micros(f"l_{ts}")
    return l.join(
        r,
        (F.col(f"l_{key}") == F.col(f"r_{key}"))
        & (F.col("l__slot") == F.col("r__slot"))
        & apart.between(-back, ahead),
    ).drop("l__slot", "r__slot")


def stream_interval_join(
    left: DataFrame, right: DataFrame, key: str, ts: str, earliest: str, latest: str, delay: str
) -> DataFrame:
    """The same join over two streams; watermarks bound the rows kept as state."""
    l = prefixed(left.withWatermark(ts, delay), "l_")
    r = prefixed(right.withWatermark(ts, delay), "r_")
    return l.join(
        r,
        F.expr(
            f"l_{key} = r_{key}"
            f" AND r_{ts} >= l_{ts} - INTERVAL {earliest}"
            f" AND r_{ts} <= l_{ts} + INTERVAL {latest}"
        ),
    )


def connect(
    left: DataFrame, right: DataFrame, left_value: Column, right_value: Column
) -> DataFrame:
    """Two differently typed inputs, one text projection each, in one output."""
    return left.select(
        F.lit("left").alias("src"), left_value.cast("string").alias("value")
    ).unionByName(
        right.select(F.lit("right").alias("src"), right_value.cast("string").alias("value"))
    )
