"""What streams do with the stretches of ``streaming.settled``: the operators of the batch
side, and what one stretch tells the next.

The processors of the same names in ``streaming.sliced`` and ``streaming.stateful`` give the
same rows where keys are few and answers are wanted one by one.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.durations import epoch_micros, micros, whole_part
from tidemark.operators import patterns, windows
from tidemark.operators.joins import interval_join, reconcile
from tidemark.operators.running import Sequence, changelog, in_order, running, split_hot, total
from tidemark.plans.sensors import rising_alarms
from tidemark.sinks.keyed import latest_per_key
from tidemark.streaming.settled import Stage, Stretch

#: Whether a row came with the carry, and how many rows of its key it stands for.
OLD, STANDS = "_old", "_stands"


def with_carry(rows: DataFrame, carry: DataFrame | None) -> DataFrame:
    """The rows of a stretch and those that the one before left for it."""
    new = rows.withColumns({OLD: F.lit(False), STANDS: F.lit(1).cast("long")})
    return new if carry is None else carry.select(*new.columns).unionByName(new)


def numbered_moving(every: DataFrame, sequence: Sequence, rows_before: int, **aggregates: Column) -> DataFrame:
    """Aggregates over the last rows of an ``id`` and ``nth``, its number; rows that tie keep one order for both."""
    ordinary, crowded = split_hot(every, ["id"], sequence)
    order = in_order(["id"], sequence)
    frame = order.rowsBetween(-rows_before, 0)
    plain = ordinary.select(
        "*", F.sum(STANDS).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("nth"),
        *[agg.over(frame).alias(name) for name, agg in aggregates.items()],
    )
    numbered = running(crowded, ["id"], sequence, nth=total(F.col(STANDS)))
    along = replace(sequence, order=("nth",))
    return plain.unionByName(windows.moving_blocks(numbered, ["id"], along, rows_before, aggregates=aggregates))


class Moving(Stage):
    """Number and sum over the last ``span`` rows of a key, after every ``slide`` rows.

    Rows have ``id``, ``ts``, ``event_id`` and ``vc``. The last ``span - 1`` rows of a key are
    carried, the first of which stands for all rows up to it.
    """

    def __init__(self, sequence: Sequence, span: int = 3, slide: int = 1):
        self.sequence, self.span, self.slide = sequence, span, slide

    def results(self, rows: DataFrame, carry: DataFrame | None, stretch: Stretch) -> DataFrame:
        every = with_carry(rows.select("id", "ts", "event_id", "vc"), carry)
        return numbered_moving(every, self.sequence, self.span - 1, cnt=F.count(F.lit(1)), total=F.sum("vc"))

    def carry(self, rows: DataFrame, written: DataFrame, carry: DataFrame | None) -> DataFrame:
        back = F.row_number().over(Window.partitionBy("id").orderBy(F.col("nth").desc()))
        last = written.withColumn("_back", back).where(F.col("_back") < self.span)
        first = F.max("_back").over(Window.partitionBy("id")) == F.col("_back")
        return last.select(
            "id", "ts", "event_id", "vc", F.lit(True).alias(OLD),
            F.when(first, F.col("nth")).otherwise(F.lit(1)).cast("long").alias(STANDS),
        )

    def final(self, written: DataFrame) -> DataFrame:
        fires = ~F.col(OLD) & (F.col("nth") % self.slide == 0)
        return written.where(fires).select("id", "event_id", "nth", "cnt", "total")


class Changelog(Stage):
    """A running sum as retract and add rows: the old result goes, the new one comes.

    Rows have ``id``, ``ts``, ``event_id`` and ``vc``; a key carries one row with its sum.
    """

    def __init__(self, sequence: Sequence):
        self.sequence = sequence

    def _every(self, rows: DataFrame, carry: DataFrame | None) -> DataFrame:
        value = F.coalesce(F.col("vc").cast("long"), F.lit(0).cast("long")).alias("value")
        return with_carry(rows.select("id", "ts", "event_id", value), carry)

    def results(self, rows: DataFrame, carry: DataFrame | None, stretch: Stretch) -> DataFrame:
        along = replace(self.sequence, order=(*self.sequence.order, OLD))
        changes = changelog(self._every(rows, carry), ["id"], along, total=total(F.col("value")))
        return changes.where(~F.col(OLD)).select("id", "event_id", "added", "total")

    def carry(self, rows: DataFrame, written: DataFrame, carry: DataFrame | None) -> DataFrame:
        return (
            self._every(rows, carry).groupBy("id")
            .agg(F.max("ts").alias("ts"), F.sum("value").alias("value"), F.sum(STANDS).alias(STANDS))
            .select("id", "ts", F.lit(None).cast("long").alias("event_id"), "value", F.lit(True).alias(OLD), STANDS)
        )


def _after(stretch: Stretch, ts: str | Column) -> Column:
    """Not before the stretch; none of its rows is after it."""
    return stretch.has(epoch_micros(ts))


class StrictNext(Stage):
    """A ``first`` row and the row of its key right after it, if that is ``second`` and strictly in time.

    Rows have ``key``, ``ts``, ``event_id``, ``first`` and ``second``. Without ``within`` any
    time will do, and a key's last row is carried if it is a ``first`` one.
    """

    def __init__(self, sequence: Sequence, within: str | None = None):
        self.sequence, self.within = sequence, within
        self.reach = 0 if within is None else micros(within)

    def _every(self, rows: DataFrame, carry: DataFrame | None) -> DataFrame:
        own = rows.select("key", "ts", "event_id", "first", "second")
        return own if carry is None else carry.unionByName(own)

    def results(self, rows: DataFrame, carry: DataFrame | None, stretch: Stretch) -> DataFrame:
        pairs = patterns.strict_next(
            self._every(rows, carry), ["key"], self.sequence, F.col("first"), F.col("second"), self.within
        )
        return pairs.where(_after(stretch, "second.ts")).select(
            "key", F.col("first.event_id").alias("first_id"), F.col("second.event_id").alias("second_id")
        )

    def carry(self, rows: DataFrame, written: DataFrame, carry: DataFrame | None) -> DataFrame | None:
        if self.within is not None:
            return None
        last = F.max_by(F.struct("ts", "event_id", "first", "second"), F.struct("ts", "event_id")).alias("last")
        return self._every(rows, carry).groupBy("key").agg(last).where("last.first").select("key", "last.*")


class FollowedBy(Stage):
    """``first`` then the next ``second`` row of the key, strictly within ``within``.

    Rows have ``key``, ``ts``, ``event_id`` and ``step`` ("first", "second" or "both"). Starts
    that see no second row in time come out as ``timeout``. With ``every`` a start meets all
    second rows in time, not only the next one, and there are no timeouts.
    """

    def __init__(self, sequence: Sequence, within: str, every: bool = False):
        self.sequence, self.within, self.every = sequence, within, every
        self.reach = micros(within)

    def results(self, rows: DataFrame, carry: DataFrame | None, stretch: Stretch) -> DataFrame:
        own = rows.select("key", "ts", "event_id", "step")
        args = own, ["key"], self.sequence, F.col("step") != "second", F.col("step") != "first", self.within
        if self.every:
            found = patterns.followed_by_any(*args).select(
                F.lit("match").alias("kind"), "key", F.col("first.event_id").alias("first_id"),
                F.col("second.event_id").alias("second_id"), F.col("second.ts").alias("_at"),
            )
            return found.where(_after(stretch, "_at")).drop("_at")
        starts = patterns.next_match(*args)
        gap = epoch_micros("_next.ts") - epoch_micros("ts")
        in_time = F.coalesce(gap < self.reach, F.lit(False))
        at = F.when(in_time, epoch_micros("_next.ts")).otherwise(epoch_micros("ts") + self.reach)
        return starts.where(stretch.has(at)).select(
            F.when(in_time, "match").otherwise("timeout").alias("kind"), "key", F.col("event_id").alias("first_id"),
            F.when(in_time, F.col("_next.event_id")).alias("second_id"),
        )


class Matched(Stage):
    """Patterns of any number of steps, see ``operators.patterns.matched``.

    Rows have ``key``, ``ts``, ``event_id`` and what the steps read.
    """

    def __init__(self, sequence: Sequence, steps: list[patterns.Step], within: str):
        self.sequence, self.steps, self.within = sequence, steps, within
        self.reach = micros(within)

    def results(self, rows: DataFrame, carry: DataFrame | None, stretch: Stretch) -> DataFrame:
        found = patterns.matched(rows, ["key"], self.sequence, self.steps, self.within)
        names = [step.name for step in self.steps]
        return found.where(_after(stretch, F.col(names[-1])["ts"])).select(
            "key", F.array(*[F.col(name)["event_id"] for name in names]).alias("events")
        )


class IntervalJoin(Stage):
    """Pairs of one key with ``r_ts`` in ``[l_ts - earliest, l_ts + latest]``, both ends included.

    Rows have the key, ``ts`` and ``left``, whether they are of the left side.
    """

    def __init__(self, key: str, earliest: str, latest: str):
        self.key, self.earliest, self.latest = key, earliest, latest
        self.reach = max(micros(earliest), micros(latest)) + 1

    def results(self, rows: DataFrame, carry: DataFrame | None, stretch: Stretch) -> DataFrame:
        left, right = (rows.where(side).select(self.key, "ts") for side in ("left", "NOT left"))
        pairs = interval_join(left, right, self.key, "ts", self.earliest, self.latest)
        return pairs.where(_after(stretch, F.greatest("l_ts", "r_ts")))



class History(Stage):
    """Per row: the previous value, the sum of the last ``span`` values and how often the row's
    label occurred so far.

    Rows have ``id``, ``ts``, ``event_id``, ``vc`` and ``label``. A key carries its last rows,
    and for each label a row that stands for those so far.
    """

    def __init__(self, sequence: Sequence, span: int = 3):
        self.sequence, self.span = sequence, span

    def results(self, rows: DataFrame, carry: DataFrame | None, stretch: Stretch) -> DataFrame:
        own = rows.select("id", "ts", "event_id", "vc", "label")
        recent = with_carry(own, None if carry is None else carry.where("NOT counts"))
        lately = F.collect_list(F.struct("vc"))
        moved = numbered_moving(recent, self.sequence, max(1, self.span - 1), lately=lately).where(~F.col(OLD))
        every = moved if carry is None else moved.unionByName(
            carry.where("counts").select(
                "id", "ts", "event_id", "vc", "label", OLD, STANDS,
                *[F.lit(None).cast(moved.schema[c].dataType).alias(c) for c in ("nth", "lately")],
            )
        )
        along = replace(self.sequence, order=(*self.sequence.order, "nth"))
        return running(every, ["id", "label"], along, same_label=total(F.col(STANDS)))

    def carry(self, rows: DataFrame, written: DataFrame, carry: DataFrame | None) -> DataFrame:
        own = ["id", "ts", "event_id", "vc", "label"]
        recent = written.where(~F.col(OLD)).select(*own)
        if carry is not None:
            recent = carry.where("NOT counts").select(*own).unionByName(recent)
        back = F.row_number().over(in_order(["id"], self.sequence.reversed()))
        last = recent.withColumn("_back", back).where(F.col("_back") <= max(1, self.span - 1))
        seen = written.groupBy("id", "label").agg(F.max("ts").alias("ts"), F.max("same_label").alias(STANDS))
        none = [F.lit(None).cast(written.schema[c].dataType).alias(c) for c in ("event_id", "vc")]
        return last.select(
            *own, F.lit(1).cast("long").alias(STANDS), F.lit(True).alias(OLD), F.lit(False).alias("counts")
        ).unionByName(seen.select("id", "label", "ts", *none, STANDS, F.lit(True).alias(OLD), F.lit(True).alias("counts")))

    def final(self, written: DataFrame) -> DataFrame:
        lately = F.col("lately")
        before = F.when(F.size(lately) > 1, F.element_at(lately, -2)["vc"])
        values = F.filter(F.slice(lately["vc"].cast("array<bigint>"), -F.least(F.size(lately), F.lit(self.span)), self.span), lambda v: v.isNotNull())
        recent = F.when(F.size(values) > 0, F.aggregate(values, F.lit(0).cast("long"), lambda s, v: s + v))
        return written.where(~F.col(OLD)).select(
            "id", "event_id", before.alias("previous_vc"), recent.alias("recent"), "same_label"
        )


class OneShot(Stage):
    """One timer per key, ``wait`` after the key's first row. Rows have ``id`` and ``ts``."""

    def __init__(self, wait: str = "5 seconds"):
        self.wait = micros(wait)

    def results(self, rows: DataFrame, carry: DataFrame | None, stretch: Stretch) -> DataFrame:
        every = rows.select("id", epoch_micros("ts").alias("at"), F.lit(False).alias("done"))
        every = every if carry is None else carry.unionByName(every)
        first = every.groupBy("id").agg(F.min("at").alias("at"), F.max("done").alias("done"))
        return first.withColumn("fires", ~F.col("done") & (F.col("at") + self.wait <= stretch.now))

    def kept(self, written: DataFrame) -> DataFrame:
        return written.select("id", "at", (F.col("done") | F.col("fires")).alias("done"))

    def final(self, written: DataFrame) -> DataFrame:
        return written.where("fires").select("id", (F.col("at") + self.wait).alias("fired_at"))


class Rising(Stage):
    """Alarm when a level keeps rising for ``hold``; see ``plans.sensors.rising_alarms``.

    Rows have ``id``, ``ts``, ``event_id`` and ``vc``. What a key was at is carried as
    readings that lead to it: the same level twice, which arms nothing, or from just below
    it a rise at the time that is armed.
    """

    def __init__(self, sequence: Sequence, hold: str = "5 seconds"):
        self.sequence, self.hold = sequence, hold

    def _every(self, rows: DataFrame, carry: DataFrame | None) -> DataFrame:
        own = rows.select("id", "ts", "event_id", "vc")
        return own if carry is None else carry.unionByName(own)

    def results(self, rows: DataFrame, carry: DataFrame | None, stretch: Stretch) -> DataFrame:
        alarms = rising_alarms(self._every(rows, carry), self.sequence, self.hold)
        return alarms.select(
            "id", epoch_micros("armed_at").alias("armed_at"), epoch_micros("alarm_at").alias("alarm_at"),
            (epoch_micros("alarm_at") <= stretch.now).alias("due"),
        )

    def carry(self, rows: DataFrame, written: DataFrame, carry: DataFrame | None) -> DataFrame:
        last = F.max_by(F.struct("ts", "vc"), F.struct("ts", "event_id")).alias("last")
        level = self._every(rows, carry).groupBy("id").agg(last)
        armed = written.where("NOT due").select(F.col("id").alias("_id"), F.timestamp_micros("armed_at").alias("armed"))
        known = level.join(armed, F.expr("id <=> _id"), "left")
        at, vc = F.col("armed"), F.col("last.vc")
        top = F.coalesce(vc, F.lit(1))

        def reading(ts: Column, nth: int, value: Column) -> Column:
            return F.struct(ts.alias("ts"), F.lit(nth).cast("long").alias("event_id"), value.cast("int").alias("vc"))

        still = [reading(F.col("last.ts"), nth, vc) for nth in (1, 2)]
        rise = [reading(at, 1, top - 1), reading(at, 2, top - 1), reading(at, 3, top)]
        unknown = F.when(vc.isNull(), F.array(reading(F.col("last.ts"), 4, vc))).otherwise(F.slice(F.array(*rise), 1, 0))
        led = F.when(at.isNull(), F.array(*still)).otherwise(F.concat(F.array(*rise), unknown))
        return known.select("id", F.inline(led))

    def final(self, written: DataFrame) -> DataFrame:
        return written.where("due").drop("due")


class ClickLimit(Stage):
    """Pass the first ``limit`` clicks of a (user, ad) per UTC day, alarm once beyond.

    Rows have ``user_id``, ``ad_id``, ``ts`` and ``event_id``. A stretch sees the day before
    it again, so the day it begins in is whole.
    """

    reach = micros("1 day")

    def __init__(self, sequence: Sequence, limit: int = 100):
        self.sequence, self.limit = sequence, limit

    def results(self, rows: DataFrame, carry: DataFrame | None, stretch: Stretch) -> DataFrame:
        daily = rows.withColumn("at", epoch_micros("ts")).withColumn("day", whole_part(F.col("at"), self.reach))
        nth = F.row_number().over(in_order(["user_id", "ad_id", "day"], self.sequence))
        kind = F.when(F.col("nth") <= self.limit, "pass").otherwise("alarm").alias("kind")
        first = daily.withColumn("nth", nth).where(F.col("nth") <= self.limit + 1)
        return first.where(stretch.has(F.col("at"))).select(kind, "user_id", "ad_id", "event_id", "at")


class Payment(Stage):
    """Payment status of an order, whenever it changes; ``final`` tells the last one.

    Rows have ``order_id``, ``event_type`` and ``ts``. The earliest create and pay are carried,
    until ``keep`` after the later one. With only one of them the other is reported as
    missing ``limit`` later; a pay that still comes then corrects the status.
    """

    STATUS = ("unpaid", "missing_create", "paid", "paid_late")

    def __init__(self, limit: str = "15 minutes", keep: str = "365 days"):
        self.limit, self.keep = micros(limit), micros(keep)

    def results(self, rows: DataFrame, carry: DataFrame | None, stretch: Stretch) -> DataFrame:
        at, create = epoch_micros("ts"), F.col("event_type").eqNullSafe("create")
        every = rows.select(
            "order_id", F.when(create, at).alias("created"), F.when(~create, at).alias("paid"),
            F.lit(0).alias("known"), F.lit(0).alias("version"),
        )
        every = every if carry is None else carry.unionByName(every)
        orders = every.groupBy("order_id").agg(*[f(c).alias(c) for c, f in {
            "created": F.min, "paid": F.min, "known": F.max, "version": F.max,
        }.items()])
        created, paid = F.col("created"), F.col("paid")
        due = F.least(created, paid) + self.limit <= stretch.now
        # Places in STATUS, from 1; a number, so that groups are hashed and not sorted.
        status = (
            F.when(paid - created > self.limit, 4).when(created.isNotNull() & paid.isNotNull(), 3)
            .when(due & paid.isNull(), 1).when(due, 2).otherwise(F.col("known"))
        )
        told = orders.withColumn("status", status).withColumn("changed", F.col("status") != F.col("known"))
        forgotten = F.greatest(created, paid) + self.keep <= stretch.now
        return told.select(
            "order_id", "created", "paid", "status", "changed", forgotten.alias("forgotten"),
            (F.col("version") + F.col("changed").cast("int")).alias("version"), F.lit(stretch.now).alias("until"),
        )

    def kept(self, written: DataFrame) -> DataFrame:
        return written.where("NOT forgotten").select("order_id", "created", "paid", F.col("status").alias("known"), "version")

    def final(self, written: DataFrame) -> DataFrame:
        changes = written.where("changed").select("order_id", "status", "version", "until")
        names = F.array(*[F.lit(name) for name in self.STATUS])
        last = latest_per_key(changes, ["order_id"], ["version", "until"])
        return last.select("order_id", F.element_at(names, F.col("status")).alias("status"))


class Matcher(Stage):
    """One-to-one match of two sides of a key; whichever comes first waits.

    Rows have ``tx_id``, ``ts``, ``row_id`` and ``side`` ("left" / "right"). The n-th row of a
    side meets the n-th of the other; those that met nothing are carried, so they are first.
    """

    def __init__(self, sequence: Sequence):
        self.sequence = sequence

    def results(self, rows: DataFrame, carry: DataFrame | None, stretch: Stretch) -> DataFrame:
        left = F.col("side") == "left"
        every = rows.select("tx_id", "ts", "row_id", left.alias("left"))
        every = every if carry is None else carry.unionByName(every)
        ordinary, crowded = split_hot(every, ["tx_id"], self.sequence)
        # Numbered and paired where they are: one shuffle.
        numbered = ordinary.repartition("tx_id").withColumn(
            "_nth", F.row_number().over(in_order(["tx_id", "left"], self.sequence))
        )
        sides = {"l": F.col("left"), "r": ~F.col("left")}
        met = numbered.groupBy("tx_id", "_nth").agg(
            *[F.max(F.when(on, F.col(c))).alias(f"{side}_{c}") for side, on in sides.items() for c in ("ts", "row_id")],
            *[F.max(on).alias(f"{side}_here") for side, on in sides.items()],
        ).drop("_nth")
        hot = reconcile(
            *[crowded.where(on).select("tx_id", "ts", "row_id", F.lit(True).alias("here")) for on in sides.values()],
            "tx_id", self.sequence, self.sequence, "full",
        )
        here = [F.coalesce(F.col(f"{side}_here"), F.lit(False)).alias(f"{side}_here") for side in sides]
        return met.unionByName(
            hot.select(F.coalesce("l_tx_id", "r_tx_id").alias("tx_id"), "l_ts", "l_row_id", "r_ts", "r_row_id", *here)
        )

    def kept(self, written: DataFrame) -> DataFrame:
        alone = written.where("l_here <> r_here")
        return alone.select(
            "tx_id", F.when(F.col("l_here"), F.col("l_ts")).otherwise(F.col("r_ts")).alias("ts"),
            F.when(F.col("l_here"), F.col("l_row_id")).otherwise(F.col("r_row_id")).alias("row_id"), F.col("l_here").alias("left"),
        )

    def final(self, written: DataFrame) -> DataFrame:
        return written.where("l_here AND r_here").select(
            "tx_id", F.col("l_row_id").alias("left_id"), F.col("r_row_id").alias("right_id")
        )
