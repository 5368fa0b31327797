"""Event patterns per key over bounded input.

Nothing is skipped: every row that meets the first step starts a match of its own.
A time bound is strict, last minus first ``< within``. Rows without a time take no part.
With a bound, rows are cut into time slots of twice the bound and a slot also sees the
rows that follow it within the bound; a task holds the rows of a key in three bounds of
time, which the caller's bound limits. Without one, the slices of ``running`` do that.
Matches carry the rows as structs ``first`` and ``second``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.durations import epoch_micros, micros, whole_part
from tidemark.operators.running import Sequence, in_order, preceding, running, split_hot, tally

AT, OWN, SLOT = "_at", "_own", "_slot"


def single(df: DataFrame, condition: Column) -> DataFrame:
    """One-step pattern: alternatives and conjunctions are one boolean column."""
    return df.where(condition)


def _slotted(df: DataFrame, ts: str, within: str) -> DataFrame:
    """Rows in their own slot plus copies in the slots that end within reach of them.

    The slot is two bounds wide: half the rows are copied, and no slot grows with a key.
    """
    reach = micros(within)
    width = 2 * reach
    at = epoch_micros(ts)
    return (
        df.where(F.col(ts).isNotNull())
        .withColumn(AT, at)
        .withColumn(OWN, whole_part(at, width))
        .withColumn(SLOT, F.explode(F.sequence(whole_part(at - reach, width), F.col(OWN))))
    )


def _row(df: DataFrame) -> Column:
    return F.struct(*df.columns)


def strict_next(
    df: DataFrame,
    keys: list[str],
    sequence: Sequence,
    first: Column,
    second: Column,
    within: str | None = None,
) -> DataFrame:
    """The row right after a ``first`` row must be a ``second`` row."""
    ts = sequence.order[0]
    step = F.struct(second.alias("ok"), _row(df).alias("row"))
    if within is None:
        timed = df.where(F.col(ts).isNotNull())
        stepped = running(timed, keys, sequence.reversed(), _next=preceding(step))
    else:
        slot = Window.partitionBy(*keys, SLOT).orderBy(AT, *sequence.order[1:])
        stepped = (
            _slotted(df, ts, within)
            .withColumn("_next", F.lead(step).over(slot))
            .where(F.col(OWN) == F.col(SLOT))
        )
    return _matches(df, keys, stepped.where(first & F.col("_next.ok")), "_next.row", ts, within)


def followed_by(
    df: DataFrame,
    keys: list[str],
    sequence: Sequence,
    first: Column,
    second: Column,
    within: str | None = None,
) -> DataFrame:
    """Each ``first`` row with the first later ``second`` row; others are passed over."""
    stepped = next_match(df, keys, sequence, first, second, within)
    return _matches(
        df, keys, stepped.where(F.col("_next").isNotNull()), "_next", sequence.order[0], within
    )


def timed_out(
    df: DataFrame,
    keys: list[str],
    sequence: Sequence,
    first: Column,
    second: Column,
    within: str,
) -> DataFrame:
    """The ``first`` rows no ``second`` row followed in time: partial matches."""
    ts = sequence.order[0]
    stepped = next_match(df, keys, sequence, first, second, within)
    met = F.col("_next").isNotNull() & (_gap(F.col("_next"), ts) < micros(within))
    return stepped.where(~met).select(*df.columns)


def next_match(
    df: DataFrame,
    keys: list[str],
    sequence: Sequence,
    first: Column,
    second: Column,
    within: str | None,
) -> DataFrame:
    """``first`` rows with the nearest later ``second`` row in reach as ``_next``.

    Only rows that can take part are shuffled.
    """
    part = df.where((first | second) & F.col(sequence.order[0]).isNotNull())
    if within is None:
        found = running(
            part, keys, sequence.reversed(), _next=preceding(_row(df), condition=second)
        )
        return found.where(first)
    # Walking backwards makes "the next match" the last one seen: one pass per slot.
    slot = (
        Window.partitionBy(*keys, SLOT)
        .orderBy(F.col(AT).desc(), *[F.col(c).desc() for c in sequence.order[1:]])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        _slotted(part, sequence.order[0], within)
        .withColumn("_next", F.last(F.when(second, _row(df)), ignorenulls=True).over(slot))
        .where((F.col(OWN) == F.col(SLOT)) & first)
    )


def followed_by_any(
    df: DataFrame,
    keys: list[str],
    sequence: Sequence,
    first: Column,
    second: Column,
    within: str,
) -> DataFrame:
    """Each ``first`` row with *every* later ``second`` row inside the bound.

    The bound is required: it is what keeps the result from growing with the square
    of a key. A pair meets in the slot of its first row, as an equi-join.
    """
    ts, ties = sequence.order[0], sequence.order[1:]
    slotted = _slotted(df.where(first | second), ts, within)
    starts = slotted.where(first & (F.col(OWN) == F.col(SLOT))).select(
        *[F.col(k).alias(f"_a_{k}") for k in keys],
        F.col(SLOT).alias("_a_slot"),
        F.col(AT).alias("_a_at"),
        F.struct(AT, *ties).alias("_a_order"),
        _row(df).alias("first"),
    )
    ends = slotted.where(second).select(
        *[F.col(k).alias(f"_b_{k}") for k in keys],
        F.col(SLOT).alias("_b_slot"),
        F.col(AT).alias("_b_at"),
        F.struct(AT, *ties).alias("_b_order"),
        _row(df).alias("second"),
    )
    same_key = F.lit(True)
    for k in keys:
        same_key = same_key & F.col(f"_a_{k}").eqNullSafe(F.col(f"_b_{k}"))
    return starts.join(
        ends,
        same_key
        & (F.col("_a_slot") == F.col("_b_slot"))
        & (F.col("_b_order") > F.col("_a_order"))
        & (F.col("_b_at") - F.col("_a_at") < micros(within)),
    ).select(*[F.col(f"_a_{k}").alias(k) for k in keys], "first", "second")


def times(
    df: DataFrame,
    keys: list[str],
    sequence: Sequence,
    condition: Column,
    least: int,
    most: int,
    within: str | None = None,
    block: int = 100_000,
) -> DataFrame:
    """``least`` to ``most`` matching rows of a key, every length in the range.

    Rows that do not match are passed over. One output row per match: its rows in
    order as array ``steps``. Ordinary keys take one ordered window; matching rows of hot
    keys are numbered and cut into blocks that also see the next ``most - 1`` rows.
    """
    ts = sequence.order[0]
    part = df.where(condition & F.col(ts).isNotNull())
    ordinary, crowded = split_hot(part, keys, sequence)
    numbered = running(crowded, keys, sequence, _nth=tally())
    place = F.col("_nth") - 1
    ahead = Window.partitionBy(*keys, "_block").orderBy("_nth").rowsBetween(0, most - 1)
    runs = (
        numbered.withColumn("_own", whole_part(place, block))
        .withColumn(
            "_block", F.explode(F.sequence(whole_part(place - (most - 1), block), F.col("_own")))
        )
        .withColumn("_run", F.collect_list(_row(df)).over(ahead))
        .where(F.col("_own") == F.col("_block"))
        .select(*keys, "_run")
    )
    if ordinary is not None:
        following = in_order(keys, sequence).rowsBetween(0, most - 1)
        runs = runs.unionByName(
            ordinary.select(*keys, F.collect_list(_row(df)).over(following).alias("_run"))
        )
    lengths = F.sequence(F.lit(least), F.least(F.lit(most), F.size("_run")))
    matches = (
        runs.where(F.size("_run") >= least)
        .withColumn("_length", F.explode(lengths))
        .select(*keys, F.slice("_run", F.lit(1), F.col("_length")).alias("steps"))
    )
    if within is None:
        return matches
    span = epoch_micros(F.element_at("steps", -1)[ts]) - epoch_micros(F.col("steps")[0][ts])
    return matches.where(span < micros(within))


def _gap(row: Column, ts: str) -> Column:
    return epoch_micros(row[ts]) - epoch_micros(ts)


def _matches(
    df: DataFrame, keys: list[str], stepped: DataFrame, partner: str, ts: str, within: str | None
) -> DataFrame:
    found = F.col(partner)
    if within is not None:
        stepped = stepped.where(_gap(found, ts) < micros(within))
    return stepped.select(*keys, _row(df).alias("first"), found.alias("second"))


#: How a step follows the one before: the very next row, the first later row that meets the
#: condition, or every one.
NEXT, LATER, ANY = "next", "later", "any"


@dataclass(frozen=True)
class Step:
    """One step of a pattern.

    ``condition`` gets the row and the rows of the earlier steps by name, and reads their
    columns by subscript: ``lambda row, seen: row["vc"] > seen["first"]["vc"]``. The same
    function serves columns here and values in ``streaming.stateful.Automaton``. A condition
    that is NULL is not met.
    """

    name: str
    condition: Callable[[Any, dict[str, Any]], Any]
    follows: str = LATER


def matched(
    df: DataFrame, keys: list[str], sequence: Sequence, steps: list[Step], within: str
) -> DataFrame:
    """Matches of any number of steps whose conditions may read the rows matched so far.

    A match is a row with a struct for each step. Every row that meets the first step starts
    one; with ``ANY`` a match so far goes on with each row that may follow, so it branches.
    Each step is an equi-join on the key and its time slot, so a task holds a key's rows of
    three bounds of time, and a hot slot is split by the engine.
    """
    if steps[0].follows == ANY or len({s.name for s in steps}) < len(steps):
        raise ValueError("the first step follows nothing, and names are unique")
    ties = sequence.order[1:]
    by = [F.col(k) for k in keys]
    placed = _slotted(df, sequence.order[0], within).withColumn("_order", F.struct(AT, *ties))
    rows = placed.select(
        *[c.alias(f"_k{i}") for i, c in enumerate(by)], F.col(SLOT).alias("_slot_of"), "_order",
        F.lag("_order").over(Window.partitionBy(*keys, SLOT).orderBy("_order")).alias("_before"),
        _row(df).alias("_row"),
    )
    first = steps[0]
    found = placed.where((F.col(OWN) == F.col(SLOT)) & first.condition(_row(df), {})).select(
        *[c.alias(f"_p{i}") for i, c in enumerate(by)], F.col(SLOT).alias("_slot_in"),
        F.array("_order").alias("_path"), _row(df).alias(first.name),
    )
    names = [first.name]
    for step in steps[1:]:
        same = F.col("_slot_of") == F.col("_slot_in")
        for i in range(len(keys)):
            same = same & F.col(f"_k{i}").eqNullSafe(F.col(f"_p{i}"))
        last = F.element_at("_path", -1)
        after = F.col("_before") == last if step.follows == NEXT else F.col("_order") > last
        in_time = F.col("_order")[AT] - F.col("_path")[0][AT] < micros(within)
        meets = step.condition(F.col("_row"), {name: F.col(name) for name in names})
        joined = found.join(rows, same & after & in_time & meets)
        own = [f"_p{i}" for i in range(len(keys))] + ["_slot_in"]
        if step.follows == LATER:
            joined = joined.groupBy(*own, "_path").agg(
                *[F.first(name).alias(name) for name in names], F.min("_order").alias("_order"),
                F.min_by("_row", "_order").alias("_row"),
            )
        found = joined.select(
            *own, F.concat("_path", F.array("_order")).alias("_path"), *names, F.col("_row").alias(step.name)
        )
        names.append(step.name)
    return found.select(*[F.col(f"_p{i}").alias(k) for i, k in enumerate(keys)], *names)
