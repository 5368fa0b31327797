"""Time, session and count windows over bounded input."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.durations import bucket, epoch_micros, micros, whole_part
from tidemark.operators.running import (
    HOT_ROWS,
    Sequence,
    hot_keys,
    in_order,
    mark_hot,
    running,
    split_hot,
    tally,
)


@dataclass(frozen=True)
class Measure:
    """An aggregate that can be taken in parts: first over rows, then over parts."""

    over_rows: Column
    over_parts: Callable[[Column], Column]


def count_of(column: str | None = None) -> Measure:
    return Measure(F.count(F.lit(1) if column is None else F.col(column)), F.sum)


def sum_of(column: str | Column) -> Measure:
    return Measure(F.sum(column), F.sum)


def min_of(column: str | Column) -> Measure:
    return Measure(F.min(column), F.min)


def max_of(column: str | Column) -> Measure:
    return Measure(F.max(column), F.max)


def _of_rows(measures: dict[str, Measure]) -> list[Column]:
    return [m.over_rows.alias(name) for name, m in measures.items()]


def _of_parts(measures: dict[str, Measure]) -> list[Column]:
    return [m.over_parts(F.col(name)).alias(name) for name, m in measures.items()]


def tumbling(
    df: DataFrame, keys: list[str], ts: str, size: str, **measures: Measure
) -> DataFrame:
    """One row per key and epoch-aligned window ``[window_start, window_end)``.

    Without keys the window itself is the group; partial sums keep it parallel.
    Works on streams too.
    """
    return (
        df.groupBy(*keys, F.window(ts, size).alias("_w"))
        .agg(*_of_rows(measures))
        .select(
            *keys,
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            *measures,
        )
    )


def sliding(
    df: DataFrame, keys: list[str], ts: str, size: str, slide: str, **measures: Measure
) -> DataFrame:
    """Sliding windows from panes: rows are reduced to panes of width ``slide``, and the
    panes are copied into the ``size / slide`` windows that hold them.

    Panes are shuffled by key and a time slot as wide as a window, in which the windows
    start; a pane's windows start in two slots at most, so it travels twice at most and
    the copies are made where they are summed.
    """
    if micros(size) % micros(slide):
        raise ValueError(f"{size} is not a multiple of {slide}")
    step, back = F.expr(f"INTERVAL {slide}"), F.expr(f"INTERVAL {size}")
    width = micros(size)
    panes = tumbling(df, keys, ts, slide, **measures)
    first, last = F.col("window_end") - back, F.col("window_start")
    slots = F.sequence(bucket(first, size), bucket(last, size))
    dealt = panes.withColumn("_slot", F.explode(slots)).repartition(*[F.col(k) for k in keys], F.col("_slot"))
    lowest = F.timestamp_micros(F.col("_slot") * width)
    # The first start on the grid of slides that is not before the slot, and the last in it.
    from_here = F.greatest(first, lowest)
    to_here = F.least(last, F.timestamp_micros((F.col("_slot") + 1) * width - micros(slide)))
    return (
        dealt.withColumn("window_start", F.explode(F.sequence(from_here, to_here, step)))
        .groupBy(*keys, "_slot", "window_start")
        .agg(*_of_parts(measures))
        .select(
            *keys,
            "window_start",
            (F.col("window_start") + back).alias("window_end"),
            *measures,
        )
    )


def sessions(
    df: DataFrame,
    keys: list[str],
    ts: str,
    gap: str,
    width: str = "1 minute",
    hot_rows: int = HOT_ROWS,
    **measures: Measure,
) -> DataFrame:
    """Session windows ``[first, last + gap)``; rows at most ``gap`` apart belong together.

    Ordinary keys go through the built-in session window. Keys with more than
    ``hot_rows`` rows (all rows, without a key) are cut into time slots of ``width``.
    """
    if not keys:
        return _slotted_sessions(df, keys, ts, gap, width, measures)
    hot = hot_keys(df, keys, hot_rows)
    ordinary = (
        mark_hot(df, keys, hot, "left_anti")
        .groupBy(*keys, F.session_window(ts, gap).alias("_w"))
        .agg(*_of_rows(measures))
        .select(
            *keys,
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            *measures,
        )
    )
    crowded = mark_hot(df, keys, hot, "left_semi")
    return ordinary.unionByName(_slotted_sessions(crowded, keys, ts, gap, width, measures))


def _slotted_sessions(
    df: DataFrame, keys: list[str], ts: str, gap: str, width: str, measures: dict[str, Measure]
) -> DataFrame:
    """Sessions are built inside (key, time slot) first. Only the first and the last
    session of a slot can continue in a neighbour, so only those - at most two rows per
    slot - are merged along the key; the others keep a lane of their own.
    """
    allowed = micros(gap)
    slot = Window.partitionBy(*keys, "_slot").orderBy("_at")
    rows = df.where(F.col(ts).isNotNull()).select(
        "*", bucket(ts, width).alias("_slot"), epoch_micros(ts).alias("_at")
    )
    opens = F.when(F.col("_at") - F.lag("_at").over(slot) <= allowed, 0).otherwise(1)
    local = (
        rows.withColumn("_opens", opens)
        .withColumn("_nth", F.sum("_opens").over(slot.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_slot", "_nth")
        .agg(F.min("_at").alias("_from"), F.max("_at").alias("_to"), *_of_rows(measures))
    )
    last = F.max("_nth").over(Window.partitionBy(*keys, "_slot"))
    settled = (F.col("_nth") > 1) & (F.col("_nth") < F.col("_last"))
    laned = local.withColumn("_last", last).withColumn(
        "_lane", F.when(settled, F.struct("_slot", "_nth"))
    )
    lane = Window.partitionBy(*keys, "_lane").orderBy("_from")
    joins = F.when(F.col("_from") - F.lag("_to").over(lane) <= allowed, 0).otherwise(1)
    return (
        laned.withColumn("_opens", joins)
        .withColumn("_session", F.sum("_opens").over(lane.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_lane", "_session")
        .agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"), *_of_parts(measures))
        .select(
            *keys,
            F.timestamp_micros("_from").alias("window_start"),
            F.timestamp_micros(F.col("_to") + allowed).alias("window_end"),
            *measures,
        )
    )


def count_windows(
    df: DataFrame,
    keys: list[str],
    sequence: Sequence,
    size: int,
    slide: int | None = None,
    **aggregates: Column,
) -> DataFrame:
    """Windows of ``size`` rows per key, one after every ``slide`` rows.

    With ``slide`` equal to ``size`` (the default) windows do not overlap and an
    incomplete last one never fires; a smaller ``slide`` also fires early windows
    that hold fewer than ``size`` rows. ``window_no`` is the ordinal of the row that
    fires. Ordinary keys take one ordered window; rows of hot keys are numbered exactly
    and their windows spread over tasks.
    """
    step = slide or size
    ordinary, crowded = split_hot(df, keys, sequence)
    blocks = _counted_blocks(crowded, keys, sequence, size, step, aggregates)
    if ordinary is None:
        return blocks
    order = in_order(keys, sequence)
    frame = order.rowsBetween(-(size - 1), 0)
    plain = ordinary.select(
        *keys,
        F.row_number().over(order).cast("long").alias("window_no"),
        *[agg.over(frame).alias(name) for name, agg in aggregates.items()],
    ).where(F.col("window_no") % step == 0)
    return plain.unionByName(blocks)


def _counted_blocks(
    df: DataFrame, keys: list[str], sequence: Sequence, size: int, step: int, aggregates: dict[str, Column]
) -> DataFrame:
    numbered = running(df, keys, sequence, _nth=tally())
    nth = F.col("_nth")
    first = (F.ceil(nth / step) * step).cast("long")
    last = nth + (size - 1)
    fires = F.when(first <= last, F.sequence(first, last, F.lit(step).cast("long"))).otherwise(
        F.array().cast("array<bigint>")
    )
    return (
        numbered.withColumn("window_no", F.explode(fires))
        .groupBy(*keys, "window_no")
        .agg(F.max("_nth").alias("_top"), *[agg.alias(name) for name, agg in aggregates.items()])
        .where("_top = window_no")
        .drop("_top")
    )


def moving(
    df: DataFrame,
    keys: list[str],
    sequence: Sequence,
    rows_before: int,
    block: int = 100_000,
    **aggregates: Column,
) -> DataFrame:
    """Aggregates over the current and the ``rows_before`` preceding rows of a key.

    Ordinary keys take one ordered window. Rows of hot keys are numbered, cut into blocks
    of ``block`` rows, and the last rows of a block are copied into the next as lead-in.
    """
    ordinary, crowded = split_hot(df, keys, sequence)
    blocks = moving_blocks(crowded, keys, sequence, rows_before, block, aggregates)
    if ordinary is None:
        return blocks
    frame = in_order(keys, sequence).rowsBetween(-rows_before, 0)
    plain = ordinary.select("*", *[agg.over(frame).alias(name) for name, agg in aggregates.items()])
    return plain.unionByName(blocks)


def moving_blocks(
    df: DataFrame, keys: list[str], sequence: Sequence, rows_before: int, block: int = 100_000,
    aggregates: dict[str, Column] | None = None,
) -> DataFrame:
    """:func:`moving` for hot keys alone."""
    aggregates = aggregates or {}
    numbered = running(df, keys, sequence, _nth=tally())
    place = F.col("_nth") - 1
    own = whole_part(place, block)
    reach = whole_part(place + rows_before, block)
    blocks = numbered.withColumn("_own", own).withColumn("_block", F.explode(F.sequence(own, reach)))
    frame = (
        Window.partitionBy(*keys, "_block").orderBy("_nth").rowsBetween(-rows_before, 0)
    )
    return (
        blocks.select(
            *df.columns,
            "_own",
            "_block",
            *[agg.over(frame).alias(name) for name, agg in aggregates.items()],
        )
        .where("_own = _block")
        .drop("_own", "_block")
    )
