"""Registered queries: joins, aggregates, windows, rankings, patterns, detections."""

from __future__ import annotations

from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import tokens
from tidemark.functions.durations import epoch_micros
from tidemark.operators import distinct, joins, patterns, windows
from tidemark.operators.accumulate import accumulate, nth_value, ordered_window, process_window
from tidemark.operators.running import (
    by_number,
    by_time,
    changelog,
    highest,
    lowest,
    opening,
    running,
    tally,
    total,
)
from tidemark.operators.topn import top_n
from tidemark.plans import ads, logins, orders, sensors, traffic
from tidemark.plans.batch_rows import access_log
from tidemark.plans.registry import DAY, FAILED, HOUR, MINUTE, SECOND, VIEW, Tables, query

# Event time with the event number as tie-break.
IN_TIME = by_time("ts", "event_id")
# Order of arrival is the event number.
ARRIVAL = by_number("event_id", 100_000)

SO_FAR = "OVER (PARTITION BY id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING)"


# --- joins -----------------------------------------------------------------------------


@query(
    "f1_left_join",
    """SELECT p.tx_id AS l_tx_id, p.us AS l_ts, r.tx_id AS r_tx_id, r.us AS r_ts,
         r.line AS r_line, r.part AS r_part
       FROM payments p LEFT JOIN receipts r ON p.tx_id = r.tx_id""",
)
def _(t):
    return joins.left_join(t.payments(), t.receipts(), "tx_id")


PAIRED = """SELECT p.tx_id AS l_tx_id, p.us AS l_ts, r.tx_id AS r_tx_id, r.us AS r_ts,
    r.line AS r_line, r.part AS r_part
  FROM (SELECT *, row_number() OVER (PARTITION BY tx_id ORDER BY us) AS n FROM payments) p
  {how} JOIN (SELECT *, row_number() OVER (PARTITION BY tx_id ORDER BY us, line, part) AS n
    FROM receipts) r ON p.tx_id = r.tx_id AND p.n = r.n"""

PAYMENT_ORDER = by_time("ts", width="1 day")
RECEIPT_ORDER = by_time("ts", "line", "part", width="1 day")


@query("f2_reconcile", PAIRED.format(how="INNER"))
def _(t):
    return orders.reconciled(t.payments(), t.receipts(), PAYMENT_ORDER, RECEIPT_ORDER)


@query("m10_reconcile_unmatched", PAIRED.format(how="FULL"))
def _(t):
    return orders.reconciled(t.payments(), t.receipts(), PAYMENT_ORDER, RECEIPT_ORDER, "full")


@query(
    "f3_interval_join",
    f"""SELECT p.tx_id AS l_tx_id, p.us AS l_ts, r.tx_id AS r_tx_id, r.us AS r_ts,
         r.line AS r_line, r.part AS r_part
       FROM payments p JOIN receipts r
         ON p.tx_id = r.tx_id AND r.us BETWEEN p.us - {15 * DAY} AND p.us + {15 * DAY}""",
)
def _(t):
    return orders.reconciled_within(t.payments(), t.receipts(), "15 days")


# --- grouped and running aggregates ------------------------------------------------------


@query(
    "g1_word_count",
    """SELECT word, count(*) AS cnt FROM (
         SELECT unnest(CASE WHEN text <> '' AND rtrim(text, ' ') = '' THEN []
           ELSE string_split(rtrim(text, ' '), ' ') END) AS word FROM documents) GROUP BY word""",
)
def _(t):
    words = t.table("documents").select(F.explode(tokens(F.col("text"))).alias("word"))
    return words.groupBy("word").agg(F.sum(F.lit(1)).alias("cnt"))


@query(
    "g2_running_sum",
    f"SELECT id, event_id, CAST(sum(vc) {SO_FAR} AS BIGINT) AS total FROM sensor",
)
def _(t):
    readings = t.sensor().select("id", "event_id", "ts", "vc")
    return running(readings, ["id"], IN_TIME, total=total(F.col("vc"))).select(
        "id", "event_id", "total"
    )


@query(
    "g3_rolling_extremes",
    f"""SELECT id, event_id, first_value(us) {SO_FAR} AS first_ts, max(vc) {SO_FAR} AS max_vc,
         min(vc) {SO_FAR} AS min_vc FROM sensor""",
)
def _(t):
    rolled = running(
        t.sensor(),
        ["id"],
        IN_TIME,
        first_ts=opening(F.col("ts")),
        max_vc=highest(F.col("vc")),
        min_vc=lowest(F.col("vc")),
    )
    return rolled.select("id", "event_id", "first_ts", "max_vc", "min_vc")


@query(
    "g4_reduce",
    f"""SELECT id, event_id, CASE WHEN n = 1 THEN CAST(id AS VARCHAR) ELSE 'aaa' END AS f0,
         CASE WHEN n = 1 THEN us // 1000000 ELSE 123 END AS f1, s AS f2 FROM (
         SELECT *, count(*) {SO_FAR} AS n, CAST(sum(vc) {SO_FAR} AS BIGINT) AS s FROM sensor)""",
)
def _(t):
    folded = running(t.sensor(), ["id"], IN_TIME, n=tally(), f2=total(F.col("vc")))
    first = F.col("n") == 1
    return folded.select(
        "id",
        "event_id",
        F.when(first, F.col("id").cast("string")).otherwise("aaa").alias("f0"),
        F.when(first, F.unix_seconds("ts")).otherwise(123).alias("f1"),
        "f2",
    )


@query(
    "g5_running_count",
    "SELECT event_id, row_number() OVER (ORDER BY event_id) AS cnt FROM pv",
)
def _(t):
    return traffic.page_views_so_far(t.behavior(), ARRIVAL, view=VIEW).select("event_id", "cnt")


@query(
    "g6_running_visitors",
    """SELECT event_id, CAST(sum(CASE WHEN n = 1 THEN 1 ELSE 0 END)
         OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS uv
       FROM (SELECT event_id,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM pv)""",
)
def _(t):
    return traffic.visitors_so_far(t.behavior(), ARRIVAL, view=VIEW).select("event_id", "uv")


@query("g7_page_views", "SELECT 'pv' AS key, count(*) AS cnt FROM pv")
def _(t):
    return traffic.page_views(t.behavior(), view=VIEW)


@query("g8_count_by_key", "SELECT id, count(id) AS cnt FROM sensor GROUP BY id")
def _(t):
    return t.sensor().groupBy("id").agg(F.count("id").alias("cnt"))


@query(
    "g9_marketing_by_channel",
    "SELECT channel, behavior, count(*) AS cnt FROM marketing GROUP BY channel, behavior",
)
def _(t):
    return t.marketing().groupBy("channel", "behavior").agg(F.count(F.lit(1)).alias("cnt"))


@query(
    "g10_marketing_by_behavior",
    "SELECT behavior, count(*) AS cnt FROM marketing GROUP BY behavior",
)
def _(t):
    return t.marketing().groupBy("behavior").agg(F.count(F.lit(1)).alias("cnt"))


@query(
    "g11_clicks_by_province",
    """SELECT province || '_' || ad_id AS key, province, ad_id, count(*) AS cnt
       FROM clicks GROUP BY province, ad_id""",
)
def _(t):
    return ads.clicks_by_province(t.user_clicks(), t.people())


def slot(size: int, column: str = "us") -> str:
    return f"{column} // {size} * {size}"


@query(
    "g12_incremental_window",
    f"""SELECT id, {slot(DAY)} AS window_start, {slot(DAY)} + {DAY} AS window_end,
         count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS total, min(vc) AS low, max(vc) AS high
       FROM sensor GROUP BY 1, 2, 3""",
)
def _(t):
    return windows.tumbling(
        t.sensor(),
        ["id"],
        "ts",
        "1 day",
        cnt=windows.count_of(),
        total=windows.sum_of("vc"),
        low=windows.min_of("vc"),
        high=windows.max_of("vc"),
    )


@query(
    "g13_full_window_function",
    f"""SELECT event_type, {slot(DAY)} AS window_start, {slot(DAY)} + {DAY} AS window_end,
         count(*) AS cnt, bit_xor(event_id * 2654435761 % 4294967296) AS fold
       FROM ev GROUP BY 1, 2, 3""",
)
def _(t):
    """Rows of a window and an order-free fold over their ids that no built-in offers."""
    groups = ["event_type", "window_start", "window_end"]

    def folded(frame: pd.DataFrame, cnt: tuple, fold: pd.Series) -> pd.DataFrame:
        by = frame.assign(fold=fold).groupby(groups, as_index=False, dropna=False)
        return by.agg(cnt=cnt, fold=("fold", lambda ids: np.bitwise_xor.reduce(ids.to_numpy(np.int64))))

    def add(batch: pd.DataFrame) -> pd.DataFrame:
        return folded(batch, ("ts", "size"), batch["event_id"] * 2654435761 % 4294967296)

    def merge(states: pd.DataFrame) -> pd.DataFrame:
        return folded(states, ("cnt", "sum"), states["fold"])

    return process_window(
        t.events().select("event_type", "ts", "event_id"), ["event_type"], "ts", "1 day", add, merge,
        "cnt bigint, fold bigint",
    )


@query(
    "g14_window_tag",
    f"SELECT item_id, {slot(HOUR)} + {HOUR} AS window_end, count(*) AS cnt FROM pv GROUP BY 1, 2",
)
def _(t):
    views = t.behavior().where(F.col("behavior") == VIEW)
    return windows.tumbling(views, ["item_id"], "ts", "1 hour", cnt=windows.count_of()).drop(
        "window_start"
    )


HOURLY = f"SELECT {slot(HOUR)} AS window_start, {slot(HOUR)} + {HOUR} AS window_end, "


@query("g15_hourly_page_views", HOURLY + "count(*) AS cnt FROM pv GROUP BY 1, 2")
def _(t):
    return traffic.hourly_page_views(t.behavior(), view=VIEW)


@query(
    "g16_hourly_visitors", HOURLY + "count(DISTINCT user_id) AS uv FROM pv GROUP BY 1, 2"
)
def _(t):
    return distinct.windowed_distinct(
        t.behavior().where(F.col("behavior") == VIEW), "ts", "1 hour", "user_id"
    )


@query(
    "g13_window_median",
    f"""SELECT event_type, window_start, window_start + {DAY} AS window_end, vc AS median FROM (
          SELECT event_type, vc, window_start, count(*) OVER w AS n,
            row_number() OVER (PARTITION BY event_type, window_start ORDER BY vc, event_id) AS nth
          FROM (SELECT event_type, CAST(floor(value) AS INTEGER) AS vc, event_id, {slot(DAY)} AS window_start FROM ev)
          WINDOW w AS (PARTITION BY event_type, window_start)) WHERE nth = (n + 1) // 2""",
)
def _(t):
    """A function that does not merge: the lower median of all rows of a window."""
    rows = t.events().select("event_type", "ts", "event_id", F.col("value").cast("int").alias("vc"))
    middle = nth_value("vc", lambda rows: (rows - 1) // 2)
    return ordered_window(rows, ["event_type"], "ts", "1 day", ["vc", "event_id"], middle, "median int")


POSITION = """list_reduce(list_transform(string_split(CAST(user_id AS VARCHAR), ''),
  lambda c: CAST(ascii(c) AS BIGINT)), lambda h, c: (h * 61 + c) & 1073741823)"""
#: Some 20,000 visitors an hour, one in a hundred taken for another.
VISITORS = distinct.Bloom.sized(20_000, 0.01)
BLOOM_UV = f"""SELECT window_start, window_end, bits,
    CAST(floor(-({VISITORS.bits} / CAST({VISITORS.hashes} AS DOUBLE)) * ln(1 - bits / CAST({VISITORS.bits} AS DOUBLE)) + 0.5) AS BIGINT) AS uv,
    CAST(ceil(bits / CAST({VISITORS.hashes} AS DOUBLE)) AS BIGINT) AS at_least
  FROM ({HOURLY} count(DISTINCT p) AS bits FROM (
    SELECT us, unnest(list_transform(range({VISITORS.hashes}), lambda i:
      ((h + 1) * {VISITORS.FIRST} % {VISITORS.MODULUS} + i * ((h + 1) * {VISITORS.STEP} % {VISITORS.MODULUS}))
        % {VISITORS.bits})) AS p
    FROM (SELECT us, {POSITION} AS h FROM pv)) GROUP BY 1, 2)"""


@query("g17_hourly_visitors_approx", BLOOM_UV)
def _(t):
    views = t.behavior().where(F.col("behavior") == VIEW)
    return distinct.windowed_bloom(views, "ts", "1 hour", "user_id", VISITORS)


@query("g17_hourly_visitors_sketch")
def _(t):
    """Estimates from a sketch of constant size; tests hold them against the exact numbers."""
    views = t.behavior().where(F.col("behavior") == VIEW)
    return distinct.windowed_approx(views, "ts", "1 hour", "user_id", 0.01)


@query(
    "g18_hourly_visitors_bitmap",
    HOURLY + f"count(DISTINCT {POSITION}) AS uv FROM pv GROUP BY 1, 2",
)
def _(t):
    return distinct.windowed_bitmap(
        t.behavior().where(F.col("behavior") == VIEW), "ts", "1 hour", "user_id"
    )


@query(
    "g18_hourly_visitors_positions",
    HOURLY + f"count(DISTINCT {POSITION}) AS uv FROM pv GROUP BY 1, 2",
)
def _(t):
    return distinct.windowed_positions(
        t.behavior().where(F.col("behavior") == VIEW), "ts", "1 hour", "user_id"
    )


# --- windows -----------------------------------------------------------------------------


@query(
    "h1_tumbling",
    f"""SELECT id, {slot(HOUR)} AS window_start, {slot(HOUR)} + {HOUR} AS window_end,
         CAST(sum(vc) AS BIGINT) AS total FROM sensor GROUP BY 1, 2, 3""",
)
def _(t):
    return windows.tumbling(t.sensor(), ["id"], "ts", "1 hour", total=windows.sum_of("vc"))


def hops(source: str, keys: str, size: int, slide: int, what: str) -> str:
    starts = f"unnest(generate_series({slot(slide)} - {size - slide}, {slot(slide)}, {slide}))"
    return f"""SELECT {keys}, window_start, window_start + {size} AS window_end, {what}
      FROM (SELECT *, {starts} AS window_start FROM {source}) GROUP BY ALL"""


@query(
    "h2_sliding", hops("sensor", "id", HOUR, 5 * MINUTE, "CAST(sum(vc) AS BIGINT) AS total")
)
def _(t):
    return windows.sliding(
        t.sensor(), ["id"], "ts", "1 hour", "5 minutes", total=windows.sum_of("vc")
    )


@query(
    "h3_session",
    f"""SELECT id, min(us) AS window_start, max(us) + {2 * HOUR} AS window_end,
         count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS total FROM (
         SELECT *, sum(opens) OVER (PARTITION BY id ORDER BY us ROWS UNBOUNDED PRECEDING) AS s
         FROM (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY id ORDER BY us) <= {2 * HOUR}
           THEN 0 ELSE 1 END AS opens FROM sensor)) GROUP BY id, s""",
)
def _(t):
    return windows.sessions(
        t.sensor(),
        ["id"],
        "ts",
        "2 hours",
        cnt=windows.count_of(),
        total=windows.sum_of("vc"),
    )


COUNTED = "SELECT *, row_number() OVER (PARTITION BY id ORDER BY us, event_id) AS n FROM sensor"


@query(
    "h4_tumbling_count_window",
    """SELECT id, (n + 2) // 3 * 3 AS window_no, CAST(sum(vc) AS BIGINT) AS total
       FROM counted GROUP BY 1, 2 HAVING count(*) = 3""",
    counted=COUNTED,
)
def _(t):
    return windows.count_windows(t.sensor(), ["id"], IN_TIME, 3, total=F.sum("vc"))


@query(
    "h5_sliding_count_window",
    """SELECT id, n AS window_no, total FROM (SELECT id, n, CAST(sum(vc) OVER (
         PARTITION BY id ORDER BY n ROWS 2 PRECEDING) AS BIGINT) AS total FROM counted)
       WHERE n % 2 = 0""",
    counted=COUNTED,
)
def _(t):
    return windows.count_windows(t.sensor(), ["id"], IN_TIME, 3, 2, total=F.sum("vc"))


@query(
    "h6_unkeyed_window",
    f"""SELECT {slot(HOUR)} AS window_start, {slot(HOUR)} + {HOUR} AS window_end,
         count(*) AS cnt, CAST(sum(vc) AS BIGINT) AS total FROM sensor GROUP BY 1, 2""",
)
def _(t):
    return windows.tumbling(
        t.sensor(), [], "ts", "1 hour", cnt=windows.count_of(), total=windows.sum_of("vc")
    )


@query(
    "h7_window_assignment",
    f"""SELECT event_id, {slot(5 * SECOND)} AS window_start,
         {slot(5 * SECOND)} + {5 * SECOND} AS window_end FROM ev""",
)
def _(t):
    window = F.window("ts", "5 seconds")
    return t.events().select(
        "event_id", window["start"].alias("window_start"), window["end"].alias("window_end")
    )


@query(
    "h8_window_bounds",
    f"""SELECT {slot(HOUR)} AS window_start, {slot(HOUR)} + {HOUR} AS window_end,
         {slot(HOUR)} + {HOUR} - 1 AS last_instant, count(*) AS cnt FROM ev GROUP BY 1, 2, 3""",
)
def _(t):
    counted = t.events().groupBy(F.window("ts", "1 hour").alias("w")).agg(
        F.count(F.lit(1)).alias("cnt")
    )
    return counted.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        F.window_time("w").alias("last_instant"),
        "cnt",
    )


@query(
    "h9_processing_time_window",
    f"""SELECT {slot(HOUR, 'seen')} AS window_start, {slot(HOUR, 'seen')} + {HOUR} AS window_end,
         count(*) AS cnt FROM (SELECT us + (event_id % 90) * {MINUTE} AS seen FROM ev)
       GROUP BY 1, 2""",
)
def _(t):
    """Windows over a supplied arrival clock: up to 89 minutes after the event."""
    arrived = t.events().select(
        F.timestamp_micros(epoch_micros("ts") + (F.col("event_id") % 90) * MINUTE).alias("ingest_time")
    )
    return windows.tumbling(arrived, [], "ingest_time", "1 hour", cnt=windows.count_of())


@query("h10_group_window", hops("sensor", "id", HOUR, 5 * MINUTE, "count(*) AS cnt"))
def _(t):
    return windows.sliding(
        t.sensor(), ["id"], "ts", "1 hour", "5 minutes", cnt=windows.count_of("id")
    )


@query(
    "h11_sql_hop",
    f"""SELECT id, window_end, cnt FROM ({hops("sensor", "id", HOUR, 5 * MINUTE, "count(*) AS cnt")})""",
)
def _(t):
    return t.spark.sql(
        """SELECT id, window_end, sum(cnt) AS cnt FROM (
             SELECT id, w.end AS pane_end, count(*) AS cnt
             FROM (SELECT id, window(ts, '5 minutes') AS w FROM {sensor}) GROUP BY id, w.end)
           LATERAL VIEW explode(sequence(
             pane_end, pane_end + INTERVAL 55 MINUTES, INTERVAL 5 MINUTES)) AS window_end
           GROUP BY id, window_end""",
        sensor=t.sensor(),
    )


@query(
    "h12_per_row_visitors",
    f"""SELECT event_id, w AS window_start, CAST(sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) OVER (
         PARTITION BY w ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS uv
       FROM (SELECT event_id, w, row_number() OVER (PARTITION BY w, user_id ORDER BY event_id)
         AS n FROM (SELECT *, {slot(DAY)} AS w FROM pv))""",
)
def _(t):
    return traffic.windowed_visitors_so_far(t.behavior(), ARRIVAL, "1 day", VIEW).select(
        "event_id", "window_start", "uv"
    )


# --- analytic frames ---------------------------------------------------------------------


@query(
    "i1_moving_count",
    """SELECT id, event_id, count(id) OVER f AS cnt, CAST(sum(vc) OVER f AS BIGINT) AS total
       FROM sensor WINDOW f AS (PARTITION BY id ORDER BY us, event_id ROWS 2 PRECEDING)""",
)
def _(t):
    moved = windows.moving(
        t.sensor(), ["id"], IN_TIME, 2, cnt=F.count("id"), total=F.sum("vc")
    )
    return moved.select("id", "event_id", "cnt", "total")


@query(
    "i2_cumulative_with_peers",
    f"""SELECT id, event_id, count(id) OVER (PARTITION BY id ORDER BY {slot(DAY)}
         RANGE UNBOUNDED PRECEDING) AS cnt FROM sensor""",
)
def _(t):
    daily = t.sensor().withColumn("day", F.date_trunc("day", "ts"))
    return running(
        daily, ["id"], by_time("day", width="1 day"), peers=True, cnt=tally()
    ).select("id", "event_id", "cnt")


def ranked(source: str, keys: str, size: int, slide: int, n: int) -> str:
    counts = hops(source, keys, size, slide, "count(*) AS cnt")
    return f"""SELECT {keys}, window_end, cnt, CAST(rank AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, {keys}) AS rank
      FROM ({counts})) WHERE rank <= {n}"""


@query("i3_row_number", ranked("pv", "item_id", HOUR, HOUR, 10))
def _(t):
    views = t.behavior().where(F.col("behavior") == VIEW)
    counts = windows.tumbling(views, ["item_id"], "ts", "1 hour", cnt=windows.count_of())
    return top_n(counts, ["window_end"], "cnt", ["item_id"], 10).drop("window_start")


# --- rankings ------------------------------------------------------------------------------


@query("j1_hot_items", ranked("pv", "item_id", HOUR, 5 * MINUTE, 3))
def _(t):
    return traffic.hot_items(t.behavior(), view=VIEW)


@query(
    "j2_hot_pages",
    ranked("lines", "url", 10 * MINUTE, MINUTE, 3),
    lines="SELECT us // 1000000 * 1000000 AS us, '/p/' || k AS url FROM ev",
)
def _(t):
    return traffic.hot_pages(access_log(t), size="10 minutes", slide="1 minute")


@query("j3_hot_ads_by_province", ranked("clicks", "province, ad_id", HOUR, 5 * MINUTE, 3))
def _(t):
    return ads.hot_ads_by_province(t.user_clicks(), t.people())


@query("j4_hot_ads_by_user", ranked("clicks", "user_id, ad_id", HOUR, 5 * MINUTE, 3))
def _(t):
    return ads.hot_ads_by_user(t.user_clicks())


@query("j5_hot_items_sql", ranked("pv", "item_id", HOUR, 5 * MINUTE, 3))
def _(t):
    return traffic.hot_items_sql(t.behavior(), view=VIEW)


@query(
    "j6_sort_by_count",
    "SELECT item_id, count(*) AS cnt FROM pv GROUP BY 1 ORDER BY cnt DESC, item_id",
)
def _(t):
    views = t.behavior().where(F.col("behavior") == VIEW)
    return (
        views.groupBy("item_id")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.col("cnt").desc(), "item_id")
    )


# --- patterns --------------------------------------------------------------------------------



def fail() -> Column:
    return F.col("event_type") == FAILED


def click() -> Column:
    return F.col("event_type") == "click"


AFTER = "b.user_id = a.user_id AND b.us > a.us"


def pairs(matches: DataFrame) -> DataFrame:
    """Match rows to columns: the event numbers of both steps."""
    return matches.select(
        "user_id",
        F.col("first.event_id").alias("first_id"),
        F.col("second.event_id").alias("second_id"),
    )


@query(
    "l1_single_step", "SELECT id, event_id, vc FROM sensor WHERE (id = 8 AND vc >= 50) OR id = 12"
)
def _(t):
    condition = ((F.col("id") == 8) & (F.col("vc") >= 50)) | (F.col("id") == 12)
    return patterns.single(t.sensor(), condition).select("id", "event_id", "vc")


STRICT = """SELECT user_id, event_id AS first_id, next_id AS second_id FROM (
    SELECT *, lead(event_id) OVER w AS next_id, lead(event_type) OVER w AS next_type,
      lead(us) OVER w AS next_us
    FROM logins WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))
  WHERE event_type = '{first}' AND next_type = '{second}'"""


@query("l2_strict_next", STRICT.format(first="click", second="error"))
def _(t):
    return pairs(patterns.strict_next(t.logins(), ["user_id"], IN_TIME, click(), fail()))


NEAREST = """SELECT a.user_id, a.event_id AS first_id, arg_min(b.event_id, (b.us, b.event_id)) AS second_id
  FROM logins a JOIN logins b ON b.user_id = a.user_id AND b.us > a.us
  WHERE a.event_type = 'click' AND b.event_type = 'error'
  GROUP BY a.user_id, a.event_id, a.us"""


@query("l3_followed_by", NEAREST)
def _(t):
    return pairs(patterns.followed_by(t.logins(), ["user_id"], IN_TIME, click(), fail()))


@query(
    "l4_followed_by_any",
    f"""SELECT a.user_id, a.event_id AS first_id, b.event_id AS second_id
        FROM logins a JOIN logins b ON {AFTER} AND b.us - a.us < {12 * HOUR}
        WHERE a.event_type = 'click' AND b.event_type = 'error'""",
)
def _(t):
    return pairs(
        patterns.followed_by_any(t.logins(), ["user_id"], IN_TIME, click(), fail(), "12 hours")
    )


@query(
    "l5_times",
    f"""SELECT a.user_id, a.event_id AS first_id, b.event_id AS last_id,
          CAST(b.n - a.n + 1 AS INTEGER) AS length
        FROM numbered a JOIN numbered b ON a.user_id = b.user_id AND b.n - a.n BETWEEN 1 AND 2
        WHERE b.us - a.us < {24 * HOUR}""",
    numbered="""SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) AS n
      FROM logins WHERE event_type = 'error'""",
)
def _(t):
    found = patterns.times(t.logins(), ["user_id"], IN_TIME, fail(), 2, 3, "24 hours")
    return found.select(
        "user_id",
        F.col("steps")[0]["event_id"].alias("first_id"),
        F.element_at("steps", -1)["event_id"].alias("last_id"),
        F.size("steps").alias("length"),
    )


@query(
    "l6_within",
    f"SELECT * FROM ({NEAREST}) JOIN (SELECT event_id AS first_id, us AS u1 FROM ev) USING (first_id) "
    f"JOIN (SELECT event_id AS second_id, us AS u2 FROM ev) USING (second_id) WHERE u2 - u1 < {12 * HOUR}",
)
def _(t):
    found = patterns.followed_by(t.logins(), ["user_id"], IN_TIME, click(), fail(), "12 hours")
    return found.select(
        "user_id",
        F.col("first.event_id").alias("first_id"),
        F.col("second.event_id").alias("second_id"),
        F.col("first.ts").alias("u1"),
        F.col("second.ts").alias("u2"),
    )


@query(
    "l7_match_projection",
    f"""SELECT user_id, first_id || '-->' || second_id AS message FROM (
          {STRICT.format(first="error", second="error")} AND next_us - us < {6 * HOUR})""",
)
def _(t):
    found = patterns.strict_next(t.logins(), ["user_id"], IN_TIME, fail(), fail(), "6 hours")
    return found.select(
        "user_id",
        F.concat_ws("-->", F.col("first.event_id"), F.col("second.event_id")).alias("message"),
    )


@query(
    "l8_timed_out",
    f"""SELECT user_id, event_id FROM logins a WHERE event_type = 'click' AND NOT EXISTS (
          SELECT 1 FROM logins b WHERE {AFTER} AND b.event_type = 'error'
            AND b.us - a.us < {12 * HOUR})""",
)
def _(t):
    partial = patterns.timed_out(t.logins(), ["user_id"], IN_TIME, click(), fail(), "12 hours")
    return partial.select("user_id", "event_id")


# High, then low, then above where it began: the last step reads the first row.
SWING = [
    patterns.Step("first", lambda row, seen: row["vc"] >= 60),
    patterns.Step("second", lambda row, seen: row["vc"] < 30),
    patterns.Step("third", lambda row, seen: row["vc"] > seen["first"]["vc"]),
]
SWING_BOUND = "3 days"
SWINGS = f"""SELECT {{columns}} FROM (
    SELECT d.*, arg_min(c.event_id, (c.us, c.event_id)) AS third_id, min(c.us) AS u3 FROM (
        SELECT a.id, a.event_id AS first_id, a.us AS u1, a.vc AS v1,
          arg_min(b.event_id, (b.us, b.event_id)) AS second_id, min(b.us) AS u2
        FROM sensor a JOIN sensor b
          ON b.id = a.id AND (b.us, b.event_id) > (a.us, a.event_id) AND b.vc < 30 AND b.us - a.us < {3 * DAY}
        WHERE a.vc >= 60 GROUP BY ALL) d
      JOIN sensor c ON c.id = d.id AND (c.us, c.event_id) > (d.u2, d.second_id) AND c.vc > d.v1
        AND c.us - d.u1 < {3 * DAY}
    GROUP BY ALL)"""


@query("o7_swings", SWINGS.format(columns="id, first_id, second_id, third_id"))
def _(t):
    found = patterns.matched(t.sensor(), ["id"], IN_TIME, SWING, SWING_BOUND)
    return found.select("id", *[F.col(s.name)["event_id"].alias(f"{s.name}_id") for s in SWING])


# --- detections --------------------------------------------------------------------------------


CLIMB_VIEWS = dict(
    steps="""SELECT *, vc > coalesce(lag(vc) OVER (PARTITION BY id ORDER BY us, event_id), 0)
      AS rises FROM sensor""",
    climbs="""SELECT *, coalesce(sum(CASE WHEN rises THEN 0 ELSE 1 END) OVER (PARTITION BY id
      ORDER BY us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS climb
      FROM steps""",
    ends="SELECT id, climb, min(us) AS stop FROM climbs WHERE NOT rises GROUP BY 1, 2",
    rises="""SELECT c.id, c.climb, c.us, e.stop FROM climbs c LEFT JOIN ends e
      ON c.id = e.id AND c.climb = e.climb WHERE c.rises""",
    chain=f"""SELECT id, climb, stop, min(us) AS armed FROM rises GROUP BY 1, 2, 3
      UNION ALL
      SELECT c.id, c.climb, c.stop, min(r.us) FROM chain c JOIN rises r
        ON r.id = c.id AND r.climb = c.climb AND r.us > c.armed + {12 * HOUR}
      GROUP BY c.id, c.climb, c.stop, c.armed""",
)


@query(
    "m1_rising_alarms",
    f"""SELECT id, armed AS armed_at, armed + {12 * HOUR} AS alarm_at FROM chain
        WHERE stop IS NULL OR stop > armed + {12 * HOUR}""",
    **CLIMB_VIEWS,
)
def _(t):
    return sensors.rising_alarms(t.sensor(), IN_TIME, "12 hours")


@query(
    "m2_previous_value",
    """SELECT id, event_id, vc, lag(vc) OVER (PARTITION BY id ORDER BY us, event_id)
         AS previous_vc FROM sensor""",
)
def _(t):
    return sensors.with_previous(t.sensor(), IN_TIME).select(
        "id", "event_id", "vc", "previous_vc"
    )


@query("m3_threshold_alarms", "SELECT 'level ' || vc || ' at sensor ' || id AS message FROM sensor WHERE vc > 5")
def _(t):
    return sensors.threshold_alarms(t.sensor())[1]


NTH_CLICK = f"""SELECT *, us // {DAY} AS day, row_number() OVER (
    PARTITION BY user_id, ad_id, us // {DAY} ORDER BY us, event_id) AS nth FROM clicks"""


@query(
    "m4_blacklist_alarms",
    "SELECT user_id, ad_id, CAST(day AS INTEGER) AS day, us AS ts FROM nth WHERE nth = 2",
    nth=NTH_CLICK,
)
def _(t):
    return ads.blacklist_filter(t.user_clicks(), IN_TIME, limit=1)[1]


@query(
    "m4_blacklist_ranking",
    ranked("passed", "user_id, ad_id", DAY, HOUR, 3),
    passed=f"SELECT * FROM ({NTH_CLICK}) WHERE nth <= 2",
)
def _(t):
    passed, _alarms = ads.blacklist_filter(t.user_clicks(), IN_TIME, limit=2)
    return ads.hot_ads_by_user(passed, size="1 day", slide="1 hour")


@query(
    "m5_repeated_failures",
    f"""SELECT user_id, event_id, previous_us AS previous_ts FROM (
          SELECT *, lag(us) OVER (PARTITION BY user_id ORDER BY event_id) AS previous_us
          FROM logins WHERE event_type = 'error') WHERE abs(us - previous_us) <= {2 * HOUR}""",
)
def _(t):
    return logins.repeated_failures(t.logins(), ARRIVAL, "2 hours", FAILED).select(
        "user_id", "event_id", "previous_ts"
    )


@query(
    "m6_consecutive_failures",
    STRICT.format(first="error", second="error") + f" AND next_us - us < {2 * HOUR}",
)
def _(t):
    return pairs(logins.consecutive_failures(t.logins(), IN_TIME, "2 hours", FAILED))


@query(
    "m7_payment_status",
    f"""SELECT order_id, CASE WHEN c.us IS NULL THEN 'missing_create'
          WHEN p.us IS NULL THEN 'unpaid' WHEN p.us - c.us > {60 * DAY} THEN 'paid_late'
          ELSE 'paid' END AS status
        FROM created c FULL JOIN paid p USING (order_id)""",
)
def _(t):
    return orders.payment_status(t.order_events(), "60 days")


ORDER_TIME = by_time("ts", "event_type", width="1 day")
LIMIT = 60 * DAY


@query(
    "m8_paid_in_time",
    f"""SELECT order_id, 'tx' || order_id AS tx_id, (p.us - c.us) // 1000000 AS elapsed_seconds
        FROM created c JOIN paid p USING (order_id)
        WHERE p.us >= c.us AND p.us - c.us < {LIMIT}""",
)
def _(t):
    return orders.paid_in_time(t.order_events(), ORDER_TIME, "60 days")


@query(
    "m9_payment_timeouts",
    f"""SELECT order_id, c.us AS ts FROM created c LEFT JOIN paid p USING (order_id)
        WHERE p.us IS NULL OR p.us < c.us OR p.us - c.us >= {LIMIT}""",
)
def _(t):
    return orders.payment_timeouts(t.order_events(), ORDER_TIME, "60 days").select(
        "order_id", "ts"
    )


# --- tables, SQL and user functions -----------------------------------------------------------


@query("n1_stream_to_table", "SELECT id, us AS timestamp, vc FROM sensor")
def _(t):
    return t.sensor().select("id", F.col("ts").alias("timestamp"), "vc")


@query("n2_register_view", "SELECT id, vc FROM sensor WHERE vc >= 250")
def _(t):
    name = f"sensor_{uuid4().hex}"
    t.sensor().createOrReplaceTempView(name)
    found = t.spark.table(name).where("vc >= 250").select("id", "vc")
    t.spark.catalog.dropTempView(name)
    return found


@query("n4_sql_query", "SELECT id, count(id) AS cnt FROM sensor GROUP BY id")
def _(t):
    return t.spark.sql("SELECT id, count(id) AS cnt FROM {s} GROUP BY id", s=t.sensor())


@query(
    "n7_changelog",
    """SELECT id, us AS ts, event_id, true AS added, n AS cnt, s AS total FROM so_far
       UNION ALL SELECT id, us, event_id, false, n - 1, s - vc FROM so_far WHERE n > 1""",
    so_far=f"SELECT *, count(*) {SO_FAR} AS n, CAST(sum(vc) {SO_FAR} AS BIGINT) AS s FROM sensor",
)
def _(t):
    return changelog(t.sensor(), ["id"], IN_TIME, cnt=tally(), total=total(F.col("vc")))


@query("n8_time_attribute", "SELECT id, us // 1000000 * 1000000 AS rt, vc FROM sensor")
def _(t):
    return t.sensor().select(
        "id", F.timestamp_seconds(F.unix_seconds("ts")).alias("rt"), "vc"
    )


@query(
    "o4_user_aggregate",
    """SELECT id, count(*) AS n, CAST(sum(vc) AS BIGINT) AS total,
         CAST(max(vc) - min(vc) AS BIGINT) AS spread FROM sensor GROUP BY id""",
)
def _(t):
    def add(batch: pd.DataFrame) -> pd.DataFrame:
        by = batch.groupby("id", dropna=False)["vc"]
        parts = {"n": by.size(), "total": by.sum(min_count=1), "low": by.min(), "high": by.max()}
        return pd.DataFrame(parts).reset_index()

    def merge(states: pd.DataFrame) -> pd.DataFrame:
        by = states.groupby("id", dropna=False)
        parts = {
            "n": by["n"].sum(), "total": by["total"].sum(min_count=1), "low": by["low"].min(), "high": by["high"].max()
        }
        return pd.DataFrame(parts).reset_index()

    return accumulate(
        t.sensor().select("id", "vc"),
        ["id"],
        add,
        merge,
        "id bigint, n bigint, total bigint, low bigint, high bigint",
        result=lambda d: d.select("id", "n", "total", (F.col("high") - F.col("low")).alias("spread")),
    )
