"""Registered queries: the streaming forms, run over the tables as file streams.

Where time matters the table is landed in order first, so the watermark trails by one slice
whatever the table spans, and state holds a slice or two. Where a stream settles only what
its watermark has passed, the end of the input lets the rest out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import schemas
from tidemark.functions.columns import severity
from tidemark.functions.durations import epoch_micros, whole_part
from tidemark.operators import distinct, windows
from tidemark.operators.running import by_time
from tidemark.plans.batch_analyses import (
    AFTER,
    BLOOM_UV,
    CLIMB_VIEWS,
    COUNTED,
    HOURLY,
    IN_TIME,
    NTH_CLICK,
    PAIRED,
    SO_FAR,
    STRICT,
    SWING,
    SWING_BOUND,
    SWINGS,
    VISITORS,
    hops,
    ranked as ranked_sql,
    slot,
)
from tidemark.plans.batch_rows import SENSOR_ROWS, exported, sensor_rows
from tidemark.plans.registry import DAY, FAILED, FAR, HOUR, MINUTE, SLICES, VIEW, Ended, Tables, query
from tidemark.session import fresh_path
from tidemark.sinks.keyed import KeyedTable
from tidemark.sources import lines
from tidemark.streaming import stages
from tidemark.streaming.drain import drain, drain_batches, drain_updates
from tidemark.streaming.late import LateRouter
from tidemark.streaming.settled import Stage, drain_settled
from tidemark.streaming.stateful import Visitors, stateful
from tidemark.streaming.windows import distinct_per, ranked, session_counts, sliding_counts, tolerant

EVENTS_LATE = SLICES["events"]
ORDERS_LATE = SLICES["orders"]
#: The steps of a click and an error after it.
CLICK_THEN_ERROR = "IF(event_type = 'click', 'first', 'second') AS step"


def sensor_stream(t: Tables, raw: DataFrame | None = None) -> DataFrame:
    return t.sensor(t.stream("events") if raw is None else raw)


def settled_sensor(t: Tables, stage: Stage, name: str, **added: Column) -> DataFrame:
    """What ``stage`` makes of the readings, stretch by stretch of their time."""
    events = t.ended_events(VIEW, "event_id", "ts", "user_id", "value")
    rows = sensor_stream(t, events.rows).withColumns(added)
    return drain_settled(rows, t.spark, stage, "ts", EVENTS_LATE, name, end=events.end)


def views(t: Tables, raw: DataFrame | None = None) -> DataFrame:
    return t.behavior(t.stream("events") if raw is None else raw).where(F.col("behavior") == VIEW)


@query("a5_line_stream", SENSOR_ROWS)
def _(t):
    path = exported(t, sensor_rows(t), "stream-lines")
    return drain(lines.parse_delimited(lines.line_stream(t.spark, path), schemas.SENSOR), "a5")


@query(
    "b4_keyed_upsert_stream",
    "SELECT id, max_by(vc, event_id) AS vc, max(event_id) AS event_id FROM sensor GROUP BY id",
)
def _(t):
    rows = sensor_stream(t).select("id", "vc", "event_id")
    table = KeyedTable(t.streams, ["id"], ["event_id"], schema=rows.schema)
    drain_batches(rows, table.upsert_batch, "b4")
    return table.read()


@query("e2_union_distinct_stream", "SELECT id, vc FROM sensor UNION SELECT user_id, k FROM ev")
def _(t):
    other = t.as_events(t.stream("events")).select(F.col("user_id").alias("id"), F.col("k").alias("vc"))
    both = sensor_stream(t).select("id", "vc").unionByName(other)
    return drain(both.dropDuplicates(), "e2")


@query(
    "e2_union_distinct_daily_stream",
    f"""SELECT id, vc, {slot(DAY)} AS window_start FROM sensor
        UNION SELECT user_id, k, {slot(DAY)} FROM ev""",
)
def _(t):
    """Distinct within a day: a value leaves the state when its day closes."""
    events = t.landed("events", "ts")
    other = t.as_events(events).select(F.col("user_id").alias("id"), F.col("k").alias("vc"), "ts")
    both = sensor_stream(t, events).select("id", "vc", "ts").unionByName(other).withWatermark("ts", EVENTS_LATE)
    return drain(distinct_per(both, ["id", "vc"], "ts", "1 day"), "e2")


@query(
    "f2_reconcile_stream",
    f"""SELECT l_tx_id AS tx_id, l_tx_id AS left_id,
          CAST(r_line AS BIGINT) * 1000000000 + r_part AS right_id
        FROM ({PAIRED.format(how='INNER')})""",
)
def _(t):
    left = t.table("orders").select(
        F.col("o_orderkey").alias("tx_id"),
        F.lit("left").alias("side"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_orderkey").alias("row_id"),
    )
    right = t.table("lineitem").select(
        F.col("l_orderkey").alias("tx_id"),
        F.lit("right").alias("side"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        (F.col("l_linenumber") * F.lit(1_000_000_000).cast("long") + F.col("l_partkey")).alias("row_id"),
    )
    both = Ended(
        t, left.unionByName(right).where("tx_id IS NOT NULL"), "ts", ORDERS_LATE,
        side=F.lit("left"), ts=F.lit(FAR),
    )
    stage = stages.Matcher(by_time("ts", "row_id", width="1 day"))
    return drain_settled(both.rows, t.spark, stage, "ts", ORDERS_LATE, "f2", end=both.end)


@query(
    "f3_interval_join_stream",
    f"""SELECT p.tx_id AS l_tx_id, p.us AS l_ts, r.tx_id AS r_tx_id, r.us AS r_ts
       FROM payments p JOIN receipts r
         ON p.tx_id = r.tx_id AND r.us BETWEEN p.us - {15 * DAY} AND p.us + {15 * DAY}""",
)
def _(t):
    left = t.table("orders").select(
        F.col("o_orderkey").alias("tx_id"), F.col("o_orderdate").cast("timestamp").alias("ts"), F.lit(True).alias("left")
    )
    right = t.table("lineitem").select(
        F.col("l_orderkey").alias("tx_id"), F.col("l_shipdate").cast("timestamp").alias("ts"), F.lit(False).alias("left")
    )
    both = Ended(t, left.unionByName(right), "ts", ORDERS_LATE, left=F.lit(True), ts=F.lit(FAR))
    stage = stages.IntervalJoin("tx_id", "15 days", "15 days")
    joined = drain_settled(both.rows, t.spark, stage, "ts", ORDERS_LATE, "f3", end=both.end)
    return joined.select("l_tx_id", "l_ts", "r_tx_id", "r_ts")


@query("g2_running_sum_stream", "SELECT id, CAST(sum(vc) AS BIGINT) AS total FROM sensor GROUP BY id")
def _(t):
    totals = sensor_stream(t).groupBy("id").agg(F.sum("vc").alias("total"))
    return drain_updates(totals, ["id"], "g2")


@query("g16_hourly_visitors_stream", HOURLY + "count(DISTINCT user_id) AS uv FROM pv GROUP BY 1, 2")
def _(t):
    events = t.ended_events(VIEW)
    watermarked = views(t, events.rows).withWatermark("ts", EVENTS_LATE)
    return drain(
        distinct.windowed_distinct_stream(watermarked, "ts", "1 hour", "user_id"), "g16", end=events.end
    )


@query("g17_hourly_visitors_approx_stream", BLOOM_UV)
def _(t):
    events = t.ended_events(VIEW)
    rows = views(t, events.rows).withWatermark("ts", EVENTS_LATE)
    return drain(distinct.windowed_bloom(rows, "ts", "1 hour", "user_id", VISITORS), "g17", end=events.end)


@query("g17_hourly_visitors_sketch_stream")
def _(t):
    """Estimates as they stand at the end; tests hold them against the exact numbers."""
    guesses = distinct.windowed_approx(
        views(t, t.landed("events", "ts")).withWatermark("ts", EVENTS_LATE), "ts", "1 hour", "user_id", 0.01
    )
    return drain_updates(guesses, ["window_start", "window_end"], "g17")


@query(
    "h1_tumbling_stream",
    f"""SELECT id, {slot(HOUR)} AS window_start, {slot(HOUR)} + {HOUR} AS window_end,
         CAST(sum(vc) AS BIGINT) AS total FROM sensor GROUP BY 1, 2, 3""",
)
def _(t):
    tumbled = windows.tumbling(
        sensor_stream(t, t.landed("events", "ts")).withWatermark("ts", EVENTS_LATE), ["id"], "ts", "1 hour",
        total=windows.sum_of("vc"),
    )
    return drain_updates(tumbled, ["id", "window_start"], "h1")


@query(
    "h2_sliding_stream",
    f"SELECT id, window_end, cnt FROM ({hops('sensor', 'id', HOUR, 5 * MINUTE, 'count(*) AS cnt')})",
)
def _(t):
    events = t.ended_events(VIEW)
    counts = sliding_counts(
        sensor_stream(t, events.rows).withWatermark("ts", EVENTS_LATE), ["id"], "ts", "1 hour", "5 minutes"
    )
    return drain(counts, "h2", end=events.end)


@query(
    "h3_session_stream",
    f"""SELECT id, min(us) AS window_start, max(us) + {2 * HOUR} AS window_end,
         count(*) AS cnt FROM (
         SELECT *, sum(opens) OVER (PARTITION BY id ORDER BY us ROWS UNBOUNDED PRECEDING) AS s
         FROM (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY id ORDER BY us) <= {2 * HOUR}
           THEN 0 ELSE 1 END AS opens FROM sensor)) GROUP BY id, s""",
)
def _(t):
    events = t.ended_events(VIEW)
    rows = sensor_stream(t, events.rows).withWatermark("ts", EVENTS_LATE)
    counts = session_counts(rows, ["id"], "ts", "2 hours", cnt=F.count(F.lit(1)))
    return drain(counts, "h3", end=events.end)


@query(
    "j1_hot_items_stream",
    ranked_sql("pv", "item_id", HOUR, 5 * MINUTE, 3),
)
def _(t):
    events = t.ended_events(VIEW)
    counts = sliding_counts(
        views(t, events.rows).withWatermark("ts", EVENTS_LATE), ["item_id"], "ts", "1 hour", "5 minutes"
    )
    return ranked(counts, ["item_id"], 3, "j1", end=events.end)


DAYS = f"""SELECT id, {slot(DAY)} AS window_start, {slot(DAY)} + {DAY} AS window_end,
  count(*) AS cnt FROM sensor GROUP BY 1, 2, 3"""


@query("k1_ascending_watermark_stream", DAYS)
def _(t):
    """Slices ascend and rows inside one do not: the watermark trails by one slice."""
    events = t.ended_events(VIEW)
    rows = sensor_stream(t, events.rows).withWatermark("ts", EVENTS_LATE)
    return drain(windows.tumbling(rows, ["id"], "ts", "1 day", cnt=windows.count_of()), "k1", end=events.end)


@query("k2_out_of_order_watermark_stream", DAYS)
def _(t):
    events = t.ended_events(VIEW)
    rows = tolerant(sensor_stream(t, events.rows), "ts", f"{EVENTS_LATE} 2 days")
    return drain(windows.tumbling(rows, ["id"], "ts", "1 day", cnt=windows.count_of()), "k2", end=events.end)


PART = 8 * DAY


@query(
    "k7_late_rows_stream",
    f"""SELECT event_id, coalesce({slot(3 * HOUR)} + {3 * HOUR} + {HOUR} <=
          (SELECT max(b.us) FROM arrived b WHERE b.part < a.part) - {HOUR}, false) AS late
        FROM arrived a""",
    arrived=f"""SELECT event_id, us,
      (us + CASE WHEN event_id % 7 = 3 THEN {2 * DAY} ELSE 0 END) // {PART} AS part FROM ev""",
)
def _(t):
    """Events land in parts by time of arrival; every seventh comes two days late.

    The stream stops after each part and is restarted from its checkpoint for the next.
    """
    delay = F.when(F.col("event_id") % 7 == 3, 2 * DAY).otherwise(0)
    arrived = t.events().select(
        "event_id", "ts", whole_part(epoch_micros("ts") + delay, PART).alias("part")
    )
    first, last = arrived.agg(F.min("part"), F.max("part")).first()
    inbox, state = fresh_path(t.spark, "k7-inbox"), fresh_path(t.spark, "k7-state")
    router = LateRouter("ts", "3 hours", "1 hour", "1 hour", fresh_path(t.spark, "k7"))
    for part in range(first, last + 1):
        arrived.where(F.col("part") == part).drop("part").write.mode("append").parquet(inbox)
        stream = t.spark.readStream.schema("event_id bigint, ts timestamp").parquet(inbox)
        drain_batches(stream, router, "k7", checkpoint=state)
    return router.rows(t.spark).select("event_id", "late")


@query(
    "k6_allowed_lateness_stream",
    f"SELECT id, {slot(DAY)} AS window_start, {slot(DAY)} + {DAY} AS window_end, count(*) AS cnt FROM sensor GROUP BY 1, 2, 3",
)
def _(t):
    rows = tolerant(sensor_stream(t, t.landed("events", "ts")), "ts", EVENTS_LATE, lateness="2 seconds")
    counts = windows.tumbling(rows, ["id"], "ts", "1 day", cnt=windows.count_of())
    return drain_updates(counts, ["id", "window_start"], "k6")


@query(
    "k9_keyed_state_stream",
    """SELECT id, event_id, lag(vc) OVER w AS previous_vc,
         CAST(sum(vc) OVER (PARTITION BY id ORDER BY us, event_id ROWS 2 PRECEDING) AS BIGINT) AS recent,
         count(*) OVER (PARTITION BY id, label ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS same_label
       FROM (SELECT *, CASE WHEN vc < 50 THEN 'normal' WHEN vc < 80 THEN 'warn' ELSE 'alarm' END
         AS label FROM sensor) WINDOW w AS (PARTITION BY id ORDER BY us, event_id)""",
)
def _(t):
    return settled_sensor(t, stages.History(IN_TIME), "k9", label=severity(F.col("vc")))


def timed(df: DataFrame, delay: str = EVENTS_LATE) -> DataFrame:
    return df.withColumn("at", epoch_micros("ts")).withWatermark("ts", delay)


@query(
    "k10_timer_stream",
    f"SELECT id, min(us) + {DAY} AS fired_at FROM sensor GROUP BY id",
)
def _(t):
    return settled_sensor(t, stages.OneShot("1 day"), "k10")


@query(
    "h12_per_row_visitors_stream",
    f"""SELECT event_id, w AS window_start, CAST(sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) OVER (
         PARTITION BY w ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS uv
       FROM (SELECT us, event_id, w, row_number() OVER (PARTITION BY w, user_id ORDER BY us, event_id)
         AS n FROM (SELECT *, {slot(DAY)} AS w FROM pv))""",
)
def _(t):
    events = t.ended_events(VIEW)
    rows = timed(views(t, events.rows)).withColumn("day", whole_part(F.col("at"), DAY) * DAY)
    return drain(stateful(rows, ["day"], Visitors("1 day"), Visitors.OUTPUT), "h12", end=events.end)


@query(
    "m1_rising_alarms_stream",
    f"""SELECT id, armed AS armed_at, armed + {12 * HOUR} AS alarm_at FROM chain c
        WHERE stop IS NULL OR stop > armed + {12 * HOUR}""",
    **CLIMB_VIEWS,
)
def _(t):
    return settled_sensor(t, stages.Rising(IN_TIME, "12 hours"), "m1")


@query(
    "m4_blacklist_stream",
    """SELECT CASE WHEN nth = 1 THEN 'pass' ELSE 'alarm' END AS kind, user_id, ad_id, event_id,
         us AS at FROM nth WHERE nth <= 2""",
    clicks="SELECT user_id, k AS ad_id, us, event_id FROM ev",
    nth=NTH_CLICK,
)
def _(t):
    events = t.ended_events(VIEW)
    clicks = t.as_events(events.rows).select("user_id", F.col("k").alias("ad_id"), "ts", "event_id")
    return drain_settled(clicks, t.spark, stages.ClickLimit(IN_TIME, 1), "ts", EVENTS_LATE, "m4", end=events.end)


@query(
    "m7_payment_status_stream",
    f"""SELECT order_id, CASE WHEN p.us IS NULL THEN 'unpaid'
          WHEN p.us - c.us > {60 * DAY} THEN 'paid_late' ELSE 'paid' END AS status
        FROM created c LEFT JOIN paid p USING (order_id)""",
)
def _(t):
    created = t.table("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.lit("create").alias("event_type"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
    )
    paid = t.table("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.lit("pay").alias("event_type"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
    )
    both = Ended(
        t, created.unionByName(paid), "ts", ORDERS_LATE, event_type=F.lit("create"), ts=F.lit(FAR)
    )
    # Lines of these tables ship up to years from their order.
    payment = stages.Payment("60 days", keep="3000 days")
    return drain_settled(both.rows, t.spark, payment, "ts", ORDERS_LATE, "m7", end=both.end)


@query(
    "l8_followed_by_or_timeout_stream",
    f"""SELECT kind, user_id AS key, first_id, CASE kind WHEN 'match' THEN second_id END AS second_id
        FROM (SELECT user_id, first_id, second_id, u1,
            CASE WHEN u2 - u1 < {12 * HOUR} THEN 'match' ELSE 'timeout' END AS kind, u2
          FROM (SELECT a.user_id, a.event_id AS first_id, a.us AS u1,
              arg_min(b.event_id, (b.us, b.event_id)) AS second_id, min(b.us) AS u2
            FROM logins a LEFT JOIN logins b
              ON b.user_id = a.user_id AND b.us > a.us AND b.event_type = 'error'
            WHERE a.event_type = 'click' GROUP BY 1, 2, 3))""",
)
def _(t):
    return settled_logins(t, stages.FollowedBy(IN_TIME, "12 hours"), "l8", ["click", FAILED], CLICK_THEN_ERROR)


@query("n6_append_stream", "SELECT id, us AS ts, vc FROM sensor WHERE id = 8")
def _(t):
    return drain(sensor_stream(t).where("id = 8").select("id", "ts", "vc"), "n6")


@query(
    "n7_changelog_stream",
    """SELECT id, event_id, true AS added, s AS total FROM so_far
       UNION ALL SELECT id, event_id, false, s - vc FROM so_far WHERE n > 1""",
    so_far=f"SELECT *, count(*) {SO_FAR} AS n, CAST(sum(vc) {SO_FAR} AS BIGINT) AS s FROM sensor",
)
def _(t):
    return settled_sensor(t, stages.Changelog(IN_TIME), "n7")


@query(
    "h5_sliding_count_window_stream",
    """SELECT id, n AS window_no, total FROM (SELECT id, n, CAST(sum(vc) OVER (
         PARTITION BY id ORDER BY n ROWS 2 PRECEDING) AS BIGINT) AS total FROM counted)
       WHERE n % 2 = 0""",
    counted=COUNTED,
)
def _(t):
    sums = settled_sensor(t, stages.Moving(IN_TIME, 3, slide=2), "h5")
    return sums.select("id", F.col("nth").alias("window_no"), "total")


@query(
    "i1_moving_count_stream",
    """SELECT id, event_id, count(id) OVER f AS cnt, CAST(sum(vc) OVER f AS BIGINT) AS total
       FROM sensor WINDOW f AS (PARTITION BY id ORDER BY us, event_id ROWS 2 PRECEDING)""",
)
def _(t):
    return settled_sensor(t, stages.Moving(IN_TIME, 3), "i1").select("id", "event_id", "cnt", "total")


def settled_logins(t: Tables, stage: Stage, label: str, types: list[str], *columns: str) -> DataFrame:
    """What ``stage`` makes of the logins of these types, all if there are none."""
    only = F.col("event_type").isin(types) if types else None
    events = t.ended_events(types[0] if types else VIEW, "event_id", "ts", "user_id", "event_type", only=only)
    rows = t.logins(events.rows).selectExpr("user_id AS key", "ts", "event_id", *columns)
    return drain_settled(rows, t.spark, stage, "ts", EVENTS_LATE, label, end=events.end)


def strict_pairs(
    t: Tables, label: str, types: list[str], first: str, second: str, within: str | None
) -> DataFrame:
    steps = f"event_type = '{first}' AS first", f"event_type = '{second}' AS second"
    found = settled_logins(t, stages.StrictNext(IN_TIME, within), label, types, *steps)
    return found.withColumnRenamed("key", "user_id")


@query("l2_strict_next_stream", STRICT.format(first="click", second="error"))
def _(t):
    return strict_pairs(t, "l2", [], "click", FAILED, None)


@query(
    "m6_consecutive_failures_stream",
    STRICT.format(first="error", second="error") + f" AND next_us - us < {2 * HOUR}",
)
def _(t):
    return strict_pairs(t, "m6", [], FAILED, FAILED, "2 hours")


@query(
    "m5_repeated_failures_stream",
    f"""SELECT user_id, first_id, second_id FROM (
          SELECT user_id, us, event_id AS second_id, lag(us) OVER w AS previous_us,
            lag(event_id) OVER w AS first_id
          FROM logins WHERE event_type = 'error' WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))
        WHERE us - previous_us <= {2 * HOUR}""",
)
def _(t):
    """Failures that follow each other, whatever lies between; two hours apart still count."""
    return strict_pairs(t, "m5", [FAILED], FAILED, FAILED, "2 hours 1 microsecond")


@query("o7_swings_stream", SWINGS.format(columns="id, first_id, second_id, third_id"))
def _(t):
    found = settled_sensor(t, stages.Matched(IN_TIME, SWING, SWING_BOUND), "o7", key=F.col("id"))
    return found.select(
        F.col("key").alias("id"), *[F.col("events")[i].alias(f"{s.name}_id") for i, s in enumerate(SWING)]
    )


@query(
    "l4_followed_by_any_stream",
    f"""SELECT a.user_id AS key, a.event_id AS first_id, b.event_id AS second_id
        FROM logins a JOIN logins b ON {AFTER} AND b.us - a.us < {12 * HOUR}
        WHERE a.event_type = 'click' AND b.event_type = 'error'""",
)
def _(t):
    stage = stages.FollowedBy(IN_TIME, "12 hours", every=True)
    return settled_logins(t, stage, "l4", ["click", FAILED], CLICK_THEN_ERROR).drop("kind")
