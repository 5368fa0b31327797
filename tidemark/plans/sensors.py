"""Water-level readings: previous value, threshold and rising alarms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.durations import epoch_micros, micros, whole_part
from tidemark.operators.routing import side_output
from tidemark.operators.running import Sequence, hot_keys, in_order, mark_hot, preceding, running, tally
from tidemark.session import staged


def with_previous(readings: DataFrame, sequence: Sequence) -> DataFrame:
    return running(readings, ["id"], sequence, previous_vc=preceding(F.col("vc")))


def threshold_alarms(readings: DataFrame, above: int = 5) -> tuple[DataFrame, DataFrame]:
    """Every reading on the main output; a message per reading above the threshold."""
    message = F.concat_ws(" ", F.lit("level"), "vc", F.lit("at sensor"), "id")
    return side_output(readings, F.col("vc") > above, message)


def _climbs(levels: DataFrame, sequence: Sequence) -> DataFrame:
    """(id, _at, _rises, _climb): whether a level rises, and the non-rises before it.

    Ordinary meters take one ordered window, hot ones go through slices.
    """
    hot = hot_keys(levels, ["id"], sequence.hot_rows)
    ordinary, crowded = mark_hot(levels, ["id"], hot, "left_anti"), mark_hot(levels, ["id"], hot, "left_semi")
    rises = F.col("vc") > F.coalesce("_previous", F.lit(0))
    order = in_order(["id"], sequence)
    falls = F.sum(F.when(~F.col("_rises"), 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, -1))
    plain = (
        ordinary.withColumn("_previous", F.lag("vc").over(order))
        .withColumn("_rises", rises)
        .withColumn("_climb", F.coalesce(falls, F.lit(0)).cast("long"))
    )
    stepped = running(crowded, ["id"], sequence, hot=hot, _previous=preceding(F.col("vc"))).withColumn("_rises", rises)
    sliced = running(stepped, ["id"], sequence, hot=hot, _climb=tally(~F.col("_rises"), before=True))
    kept = ["id", epoch_micros(sequence.order[0]).alias("_at"), "_rises", "_climb"]
    return plain.select(*kept).unionByName(sliced.select(*kept))


def _pointers(points: DataFrame, wait: int, hot_rows: int) -> DataFrame:
    """(id, climb, at, next): the first rise of the climb that is later than ``at + wait``."""
    asked = points.select("id", "climb", (F.col("at") + wait).alias("at"), F.lit(1).alias("asks"))
    both = points.withColumn("asks", F.lit(0)).unionByName(asked)
    # A slice holds a few waits of one climb.
    backwards = Sequence(("at", "asks"), lambda: whole_part(F.col("at"), max(1, 64 * wait)), hot_rows).reversed()
    stepped = running(both, ["id", "climb"], backwards, next=preceding(F.col("at"), F.col("asks") == 0))
    return stepped.where("asks = 1 AND next IS NOT NULL").select(
        "id", "climb", (F.col("at") - wait).alias("at"), "next"
    )


def _followed(pointers: DataFrame, starts: DataFrame, most: int) -> DataFrame:
    """All points that are up to ``most`` pointers away from a start, by doubling.

    Pointers of 1, 2, 4, ... steps are joined from each other; from the longest on, the
    points reached so far take each of them once, which reaches every number of steps.
    """

    def hop(places: DataFrame, jumps: DataFrame, at: str, *kept: Column) -> DataFrame:
        to = jumps.select(
            F.col("id").alias("_id"), F.col("climb").alias("_climb"), F.col("at").alias("_at"), F.col("next").alias("_next")
        )
        same = places["id"].eqNullSafe(to["_id"]) & (places["climb"] == to["_climb"]) & (places[at] == to["_at"])
        return places.join(to, same).select("id", "climb", *kept, "_next")

    jumps = [staged(pointers, "jumps")]
    while 2 ** len(jumps) <= most:
        last = jumps[-1]
        jumps.append(staged(hop(last, last, "next", F.col("at")).withColumnRenamed("_next", "next"), "jumps"))
    reached = starts
    for jump in reversed(jumps):
        farther = hop(reached, jump, "at").withColumnRenamed("_next", "at")
        reached = staged(reached.unionByName(farther), "reached")
    return reached


def rising_alarms(
    readings: DataFrame, sequence: Sequence, hold: str = "5 seconds"
) -> DataFrame:
    """An alarm ``hold`` after a rise, unless the level fails to rise in between.

    The first level counts as a rise when above 0. After an alarm the next rise
    later than it arms again. A reading that does not rise - up to and including the
    moment of the alarm - cancels it. Output: ``id``, ``armed_at``, ``alarm_at``.

    A non-rise forgets everything, so each climb (rises up to the next non-rise) can be
    judged alone. Its ends are aggregated, map-side first. A climb no longer than ``hold``
    has one possible alarm, known from its ends. In a longer one every rise points to the
    one that would arm next, and the pointers are followed by doubling, so a climb is never
    in one task, however many of the rows it holds.
    """
    wait = micros(hold)
    rows = _climbs(readings.select("id", "vc", *sequence.order), sequence)
    rises = F.when(F.col("_rises"), F.col("_at"))
    ends = (
        rows.groupBy("id", "_climb")
        .agg(
            F.min(rises).alias("_start"), F.max(rises).alias("_top"),
            F.min(F.when(~F.col("_rises"), F.col("_at"))).alias("_stop"),
        )
        .where("_start IS NOT NULL")
    )
    long_climb = F.col("_top") - F.col("_start") > wait
    alive = F.col("_stop").isNull() | (F.col("_stop") > F.col("_start") + wait)
    short = ends.where(~long_climb & alive).select("id", F.col("_start").alias("armed"))
    walked = staged(
        ends.where(long_climb).select(
            F.col("id").alias("_id"), F.col("_climb").alias("_own"), "_start", "_stop",
            F.ceil((F.col("_top") - F.col("_start")) / wait).cast("long").alias("_most"),
        ),
        "climbs",
    )
    most = walked.agg(F.max("_most")).first()[0]
    found = short
    if most is not None:
        climbs = rows.where("_rises").join(walked, F.expr("id <=> _id AND _climb = _own"))
        points = climbs.select("id", F.col("_climb").alias("climb"), F.col("_at").alias("at")).distinct()
        starts = walked.select(F.col("_id").alias("id"), F.col("_own").alias("climb"), F.col("_start").alias("at"))
        stops = walked.select(F.col("_id"), F.col("_own"), "_stop")
        armed = _followed(_pointers(points, wait, sequence.hot_rows), starts, most)
        alive = F.col("_stop").isNull() | (F.col("_stop") > F.col("at") + wait)
        long = armed.join(stops, F.expr("id <=> _id AND climb = _own")).where(alive)
        found = short.unionByName(long.select("id", F.col("at").alias("armed")))
    return found.select(
        "id",
        F.timestamp_micros("armed").alias("armed_at"),
        F.timestamp_micros(F.col("armed") + wait).alias("alarm_at"),
    )
