"""Running results per row that survive hot keys.

A plain ordered window puts every row of a key into one task, which stalls when a
key holds a large share of the table (and an un-keyed total puts *all* rows there).
So keys are counted first, and the order of the hot ones (all rows, without a key) is
cut into slices. One pass reduces each (hot key, slice) to a single row with map-side
aggregation; the reduced rows are accumulated along the key; each slice then starts
from a carry row that stands for everything before it. Ordinary keys stay in one piece.
All rows are shuffled once, by (key, slice).
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidemark.functions.durations import bucket, whole_part

SLICE = "_slice"
ROW = "_is_row"
HOT = "_is_hot"


@dataclass(frozen=True)
class Sequence:
    """A total order of rows and a slice number that never falls along it.

    ``slice`` builds the column when used, so a sequence can be a module constant. Keys
    with more than ``hot_rows`` rows are cut into slices.
    """

    order: tuple[str, ...]
    slice: Callable[[], Column]
    hot_rows: int
    descending: bool = False

    def reversed(self) -> Sequence:
        return replace(self, descending=not self.descending)

    def slice_number(self) -> Column:
        """Rows without a place come first, and last in the reversed order, as in a slice."""
        number = F.coalesce(self.slice().cast("long"), F.lit(-(2**62)).cast("long"))
        return -number if self.descending else number

    def sort_columns(self) -> list[Column]:
        return [
            F.col(c).desc_nulls_last() if self.descending else F.col(c).asc_nulls_first() for c in self.order
        ]

    def first_of(self, value: Column) -> Column:
        pick = F.max_by if self.descending else F.min_by
        return pick(value, self._rank_of(value))

    def last_of(self, value: Column) -> Column:
        pick = F.min_by if self.descending else F.max_by
        return pick(value, self._rank_of(value))

    def _rank_of(self, value: Column) -> Column:
        return F.when(value.isNotNull(), F.struct(*self.order))


# Rows of one key a task takes in its stride.
HOT_ROWS = 5_000_000


def by_time(
    ts: str, *ties: str, width: str = "1 minute", hot_rows: int = HOT_ROWS
) -> Sequence:
    """Order by event time; pick ``width`` so that one slice of a hot key fits a task."""
    return Sequence((ts, *ties), lambda: bucket(ts, width), hot_rows)


def by_number(number: str, rows: int = 1_000_000, hot_rows: int = HOT_ROWS) -> Sequence:
    """Order by a unique integer; a slice spans ``rows`` consecutive numbers."""
    return Sequence((number,), lambda: whole_part(F.col(number), rows), hot_rows)


@dataclass(frozen=True)
class Fold:
    """A running value: what a row contributes and how contributions combine."""

    lift: Column
    per_slice: Callable[[Sequence, Column], Column]
    along: Callable[[Column, WindowSpec], Column]
    finish: Callable[[Column], Column] = lambda c: c
    before: bool = False


def _merging(fn: Callable[[Column], Column], lift: Column, before: bool) -> Fold:
    return Fold(lift, lambda _, c: fn(c), lambda c, w: fn(c).over(w), before=before)


def total(value: Column, before: bool = False) -> Fold:
    """Sum so far; ``before`` leaves the row itself out."""
    return _merging(F.sum, value, before)


def tally(condition: Column | None = None, before: bool = False) -> Fold:
    """Number of rows so far, or of those that meet ``condition``."""
    one = F.lit(1).cast("long")
    lift = one if condition is None else F.when(condition, one).otherwise(F.lit(0).cast("long"))
    return replace(_merging(F.sum, lift, before), finish=lambda c: F.coalesce(c, F.lit(0)))


def highest(value: Column, before: bool = False) -> Fold:
    return _merging(F.max, value, before)


def lowest(value: Column, before: bool = False) -> Fold:
    return _merging(F.min, value, before)


def opening(value: Column) -> Fold:
    """The value of the key's first row, NULL included."""
    return Fold(
        F.struct(value.alias("v")),
        lambda seq, c: seq.first_of(c),
        lambda c, w: F.first(c, ignorenulls=True).over(w),
        lambda c: c["v"],
    )


def preceding(value: Column, condition: Column | None = None) -> Fold:
    """The value of the row before, or of the last earlier row meeting ``condition``."""
    wrapped = F.struct(value.alias("v"))
    return Fold(
        wrapped if condition is None else F.when(condition, wrapped),
        lambda seq, c: seq.last_of(c),
        lambda c, w: F.last(c, ignorenulls=True).over(w),
        lambda c: c["v"],
        before=True,
    )


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows: at most ``rows / hot_rows`` of them."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > hot_rows)
        .select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias(HOT))
    )


def mark_hot(df: DataFrame, keys: list[str], hot: DataFrame, how: str) -> DataFrame:
    """Join with the hot keys, NULL equal to NULL; their number is bounded, see above."""
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_hot_{key}"))
    return df.join(F.broadcast(hot), same, how)


def split_hot(
    df: DataFrame, keys: list[str], sequence: Sequence
) -> tuple[DataFrame | None, DataFrame]:
    """Rows of ordinary keys, whose order one plain window can handle, and all others."""
    if not keys:
        return None, df
    hot = hot_keys(df, keys, sequence.hot_rows)
    return mark_hot(df, keys, hot, "left_anti"), mark_hot(df, keys, hot, "left_semi")


def in_order(keys: list[str], sequence: Sequence) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*sequence.sort_columns())


#: Slices without a key whose carries one task accumulates.
FAN = 1_000


def _carried(reduced: DataFrame, group: list[str], at: str, folds: dict, lifts: dict) -> DataFrame:
    """What comes before each slice of a group, in the order of ``at``; nothing for the first."""
    along = Window.partitionBy(*group).orderBy(at)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = reduced.select(
        *group, at, F.row_number().over(along).alias("_nth"),
        *[fold.along(F.col(lifts[n]), earlier).alias(lifts[n]) for n, fold in folds.items()],
    )
    return carried.where("_nth > 1").drop("_nth")


def _carried_without_key(reduced: DataFrame, folds: dict, lifts: dict) -> DataFrame:
    """Two levels: slices are accumulated within groups of ``FAN``, and groups one by one.

    The one task at the top sees a row for every ``FAN`` slices.
    """
    by_slice = Sequence((SLICE,), lambda: F.col(SLICE), 0)
    grouped = reduced.withColumn("_group", whole_part(F.col(SLICE), FAN))
    groups = grouped.groupBy("_group").agg(
        *[fold.per_slice(by_slice, F.col(lifts[n])).alias(lifts[n]) for n, fold in folds.items()]
    )
    # The group's own carry stands before its slices.
    heads = _carried(groups, [], "_group", folds, lifts).withColumn(
        SLICE, F.col("_group") * FAN - 1
    )
    both = grouped.withColumn("_head", F.lit(False)).unionByName(heads.withColumn("_head", F.lit(True)))
    along = Window.partitionBy("_group").orderBy(SLICE)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    return (
        both.select(
            SLICE, "_head", F.row_number().over(along).alias("_nth"),
            *[fold.along(F.col(lifts[n]), earlier).alias(lifts[n]) for n, fold in folds.items()],
        )
        .where("NOT _head AND _nth > 1")
        .drop("_head", "_nth")
    )


def running(
    df: DataFrame,
    keys: list[str],
    sequence: Sequence,
    peers: bool = False,
    hot: DataFrame | None = None,
    **folds: Fold,
) -> DataFrame:
    """Add one running column per fold; every input row stays.

    ``peers`` counts rows that tie in the order as one step. NULL keys form a group.
    ``hot`` hands in known :func:`hot_keys`, which saves counting again.
    """
    lifts = {name: f"_lift_{name}" for name in folds}
    lifted_columns = [fold.lift.alias(lifts[name]) for name, fold in folds.items()]
    slice_number = sequence.slice_number()
    if keys:
        hot = hot_keys(df, keys, sequence.hot_rows) if hot is None else hot
        rows = mark_hot(df, keys, hot, "left").select(
            *df.columns,
            F.when(F.col(HOT), slice_number).otherwise(F.lit(0)).alias(SLICE),
            *lifted_columns,
        )
        sliced = mark_hot(df, keys, hot, "left_semi")
    else:
        rows = df.select("*", slice_number.alias(SLICE), *lifted_columns)
        sliced = df
    reduced = (
        sliced.select("*", slice_number.alias(SLICE), *lifted_columns)
        .groupBy(*keys, SLICE)
        .agg(
            *[fold.per_slice(sequence, F.col(lifts[n])).alias(lifts[n]) for n, fold in folds.items()]
        )
    )
    if keys:
        carries = _carried(reduced, keys, SLICE, folds, lifts)
    else:
        carries = _carried_without_key(reduced, folds, lifts)
    carries = carries.withColumn(ROW, F.lit(False))
    inside = Window.partitionBy(*keys, SLICE).orderBy(F.col(ROW), *sequence.sort_columns())
    upto = (inside.rangeBetween if peers else inside.rowsBetween)(
        Window.unboundedPreceding, Window.currentRow
    )
    strictly_before = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn(ROW, F.lit(True))
        .unionByName(carries, allowMissingColumns=True)
        .select(
            *df.columns,
            ROW,
            *[
                fold.finish(
                    fold.along(F.col(lifts[n]), strictly_before if fold.before else upto)
                ).alias(n)
                for n, fold in folds.items()
            ],
        )
        .where(ROW)
        .drop(ROW)
    )


def running_distinct(
    df: DataFrame, keys: list[str], value: str, sequence: Sequence, name: str
) -> DataFrame:
    """Number of different values of ``value`` seen so far, on every row.

    First sightings are found by aggregation and merged in as marker rows that sort
    just before the row they belong to, so no join on the row identity is needed.
    """
    order = list(sequence.order)
    markers = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(sequence.first_of(F.struct(*order)).alias("_first"))
        .select(*keys, *[F.col("_first")[c].alias(c) for c in order], F.lit(0).alias("_kind"))
    )
    both = df.withColumn("_kind", F.lit(1)).unionByName(markers, allowMissingColumns=True)
    with_kind = replace(sequence, order=(*order, "_kind"))
    counted = running(both, keys, with_kind, **{name: tally(F.col("_kind") == 0)})
    return counted.where("_kind = 1").select(*df.columns, name)


def changelog(df: DataFrame, keys: list[str], sequence: Sequence, **folds: Fold) -> DataFrame:
    """Retract/accumulate pairs of a running aggregate.

    Every input row withdraws the key's old result (``added`` false, absent for the
    key's first row) and adds the new one.
    """
    was = {f"_was_{name}": replace(fold, before=True) for name, fold in folds.items()}
    stepped = running(df, keys, sequence, _seen=tally(before=True), **folds, **was)
    old = F.struct(F.lit(False).alias("added"), *[F.col(f"_was_{n}").alias(n) for n in folds])
    new = F.struct(F.lit(True).alias("added"), *[F.col(n) for n in folds])
    return stepped.select(
        *keys,
        *sequence.order,
        F.explode(F.when(F.col("_seen") > 0, F.array(old, new)).otherwise(F.array(new))).alias("_c"),
    ).select(*keys, *sequence.order, "_c.*")
