"""Streams cut into several micro-batches against the batch operators.

Only the rows that come out are compared, never when they come out.
"""

import itertools
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import as_frame, skewed_events
from tests.test_detections import rising_by_hand
from tidemark.functions.durations import epoch_micros
from tidemark.operators import distinct, joins, patterns, windows
from tidemark.operators.running import by_time
from tidemark.plans import ads, batch_analyses, stream_analyses, traffic  # noqa: F401
from tidemark.plans.registry import FILES_PER_TRIGGER, SLICES, ORACLES, QUERIES, Tables
from tidemark.session import fresh_path
from tidemark.sinks.keyed import KeyedTable
from tidemark.streaming.drain import LateRowsDropped, drain, drain_batches, drain_latest, drain_updates
from tidemark.streaming.late import route_late
from tidemark.streaming.stateful import (
    ClickLimit, FollowedBy, History, Matcher, OneShot, Payment, Rising, stateful,
)
from tidemark.streaming.windows import ranked, session_counts, sliding_counts, tolerant

FAR = 10_000_000
clock = itertools.count(1_700_000_000, 10)


class Feed:
    """A folder that one file of rows lands in at a time, in a fixed order."""

    def __init__(self, spark, ddl, *batches):
        self.spark, self.ddl = spark, ddl
        self.path = fresh_path(spark, "feed")
        os.makedirs(self.path)
        for rows in batches:
            self.land(rows)

    def land(self, rows):
        stamp = next(clock)
        name = f"{self.path}/{stamp}.json"
        text = self.spark.createDataFrame(rows, self.ddl).toJSON().collect()
        with open(name, "w") as out:
            out.write("\n".join(text))
        os.utime(name, (stamp, stamp))

    def stream(self):
        return (
            self.spark.readStream.schema(self.ddl)
            .option("maxFilesPerTrigger", 1)
            .json(self.path)
            .withColumn("ts", F.timestamp_seconds("s"))
            .withColumn("at", epoch_micros("ts"))
        )


EVENT = "k bigint, s bigint, v int, event_id bigint"


def in_order(seed, parts=3, **kw):
    """Skewed events without NULL keys, by time, cut into files; plus all of them."""
    rows = sorted((r for r in skewed_events(seed, n=160, **kw) if r[0] is not None), key=lambda r: (r[1], r[3]))
    size = -(-len(rows) // parts)
    return [rows[i:i + size] for i in range(0, len(rows), size)], rows


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def test_late_rows_are_routed_by_earlier_batches(spark):
    feed = Feed(spark, "s bigint", [(11,)], [(20,)], [(12,), (21,)], [(13,)], [(19,)])
    got = route_late(feed.stream(), "ts", "5 seconds", "2 seconds", "0 seconds", "late")
    assert rows_of(got, "s", "late") == [(11, False), (12, True), (13, True), (19, False), (20, False), (21, False)]


def test_allowed_lateness_corrects_results(spark):
    feed = Feed(spark, "s bigint", [(11,), (12,)], [(18,)], [(13,)], [(FAR,)], [(FAR + 1,)])

    def counts():
        rows = tolerant(feed.stream(), "ts", "2 seconds", lateness="4 seconds")
        return windows.tumbling(rows, [], "ts", "5 seconds", n=windows.count_of())

    got = drain_updates(counts(), ["window_start"], "lateness")
    assert {int(r.window_start.timestamp()): r.n for r in got.collect()} == {10: 3, 15: 1, FAR: 2}
    feed.land([(14,)])
    with pytest.raises(LateRowsDropped):
        drain_updates(counts(), ["window_start"], "lateness")


def test_restart_neither_loses_nor_repeats(spark):
    feed = Feed(spark, EVENT, [(1, 10, 5, 0)], [(1, 11, 6, 1), (2, 12, 7, 2)])
    out, state, table, table_state = (fresh_path(spark, n) for n in ("out", "state", "table", "table-state"))

    def run():
        drain(feed.stream().select("k", "event_id"), "restart", out, state)
        sums = feed.stream().groupBy("k").agg(F.sum("v").alias("t"))
        return drain_updates(sums, ["k"], "restart", table_state, table)

    run()
    feed.land([(2, 13, 1, 3)])
    feed.land([(1, 14, 1, 4)])
    totals = run()
    assert rows_of(spark.read.parquet(out), "event_id") == [(i,) for i in range(5)]
    assert rows_of(totals, "k", "t") == [(1, 12), (2, 8)]


def test_upsert_stream(spark):
    feed = Feed(spark, EVENT, [(1, 10, 5, 0), (1, 11, 6, 1)], [(1, 12, 7, 2), (2, 13, 8, 3)])
    table = KeyedTable(spark, ["k"], ["event_id"])
    drain_batches(feed.stream().select("k", "v", "event_id"), table.upsert_batch, "upsert")
    assert rows_of(table.read(), "k", "v") == [(1, 7), (2, 8)]


@pytest.fixture(scope="module")
def closed(spark):
    """A feed whose last row lies far ahead, so everything else is settled."""
    parts, rows = in_order(41, span=9000)
    return Feed(spark, EVENT, *parts, [(-1, FAR, 0, 99_999)]), as_frame(spark, rows)


def settled(df, end="window_end"):
    return df.where(F.unix_seconds(end) < FAR)


def test_sessions(closed):
    feed, df = closed
    got = drain(session_counts(feed.stream().withWatermark("ts", "0 seconds"), ["k"], "ts", "1 minute", n=F.count("v")), "s")
    want = windows.sessions(df, ["k"], "ts", "1 minute", n=windows.count_of())
    assert rows_of(got, "k", "window_start", "window_end", "n") == rows_of(want, "k", "window_start", "window_end", "n")


def test_sliding_and_ranking(closed):
    feed, df = closed
    stream = feed.stream().withWatermark("ts", "0 seconds")
    counts = sliding_counts(stream, ["k"], "ts", "1 hour", "5 minutes")
    got = settled(ranked(counts, ["k"], 3, "rank"))
    want = traffic.hottest(df, ["k"])
    assert rows_of(got, "k", "window_end", "cnt", "rank") == rows_of(want, "k", "window_end", "cnt", "rank")


def test_windowed_distinct(closed):
    feed, df = closed
    got = drain(distinct.windowed_distinct_stream(feed.stream().withWatermark("ts", "0 seconds"), "ts", "10 minutes", "v"), "uv")
    want = distinct.windowed_distinct(df, "ts", "10 minutes", "v")
    assert rows_of(settled(got), "window_start", "uv") == rows_of(want, "window_start", "uv")


def test_interval_join(closed, spark):
    feed, df = closed
    other, rows = in_order(42, span=9000)
    right = Feed(spark, EVENT, *other)
    joined = joins.stream_interval_join(
        feed.stream().select("k", "ts", "event_id"), right.stream().select("k", "ts", "event_id"),
        "k", "ts", "15 seconds", "15 seconds", "10 hours",
    )
    want = joins.interval_join(df, as_frame(spark, rows), "k", "ts", "15 seconds", "15 seconds")
    assert rows_of(drain(joined, "ij"), "l_event_id", "r_event_id") == rows_of(want, "l_event_id", "r_event_id")


def shuffled(seed, parts=4, **kw):
    """The events of ``in_order`` dealt over files at random, ended by a far row; plus all in order."""
    _, rows = in_order(seed, **kw)
    mixed = random.Random(seed).sample(rows, len(rows))
    return [mixed[i::parts] for i in range(parts)] + [[(-1, FAR, 0, 99_999)]], rows


SPAN = "20 days"


def test_keyed_state(spark):
    parts, rows = shuffled(43)
    feed = Feed(spark, EVENT, *parts)
    stream = feed.stream().select(
        F.col("k").alias("id"), "ts", "at", F.col("v").alias("vc"), "event_id",
        F.when(F.col("v") < 50, "low").otherwise("high").alias("label"),
    )
    got = drain(stateful(stream.withWatermark("ts", SPAN), ["id"], History(), History.OUTPUT), "history")
    want, groups = [], {}
    for k, _, v, event_id in rows:
        seen = groups.setdefault(k, [])
        seen.append(v)
        want.append((k, event_id, seen[-2] if len(seen) > 1 else None, sum(seen[-3:]), sum((x < 50) == (v < 50) for x in seen)))
    key = lambda t: t[1]
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)


def test_one_timer_per_key(spark):
    feed = Feed(spark, EVENT, [(1, 12, 0, 2), (2, 11, 0, 1)], [(1, 10, 0, 0)], [(3, 18, 0, 3)])
    stream = feed.stream().withColumnRenamed("k", "id").withWatermark("ts", "2 seconds")
    got = drain(stateful(stream, ["id"], OneShot(), OneShot.OUTPUT), "timer")
    assert rows_of(got, "id", "fired_at") == [(1, 15_000_000), (2, 16_000_000)]


def test_rising_alarms(spark):
    parts, rows = shuffled(44, span=2000)
    feed = Feed(spark, EVENT, *parts)
    stream = feed.stream().select(
        F.col("k").alias("id"), F.col("v").alias("vc"), "at", "ts", "event_id"
    ).withWatermark("ts", SPAN)
    got = drain(stateful(stream, ["id"], Rising("30 seconds"), Rising.OUTPUT), "rising")
    want = sorted((k, s * 1_000_000) for k, s in rising_by_hand(rows, 30))
    assert rows_of(got, "id", "armed_at") == want


def test_alarm_due_before_the_row_that_would_clear_it(spark):
    """The fall at second 8 comes before the rise of second 2 and after the alarm of 7."""
    feed = Feed(spark, EVENT, [(1, 8, 5, 1)], [(1, 2, 10, 0)])
    stream = feed.stream().select(F.col("k").alias("id"), F.col("v").alias("vc"), "at", "ts", "event_id")
    got = drain(stateful(stream.withWatermark("ts", "6500 milliseconds"), ["id"], Rising(), Rising.OUTPUT), "t1",
                end=lambda: feed.land([(2, FAR, 1, 2)]))
    assert rows_of(got, "id", "alarm_at") == [(1, 7_000_000)]


def test_click_limit(spark):
    parts, rows = shuffled(45, span=3 * 86_400)
    feed = Feed(spark, EVENT, *parts)
    stream = feed.stream().select(
        F.col("k").alias("user_id"), F.lit(1).alias("ad_id"), "at", "ts", "event_id"
    ).withWatermark("ts", SPAN)
    got = drain(stateful(stream, ["user_id", "ad_id"], ClickLimit(5), ClickLimit.OUTPUT), "clicks")
    clicks = as_frame(spark, rows).select(F.col("k").alias("user_id"), F.lit(1).alias("ad_id"), "ts", "event_id")
    passed, alarms = ads.blacklist_filter(clicks, by_time("ts", "event_id"), 5)
    assert rows_of(got.where("kind = 'pass'"), "event_id") == rows_of(passed, "event_id")
    assert rows_of(got.where("kind = 'alarm'"), "user_id", "at") == rows_of(
        alarms.select("user_id", epoch_micros("ts").alias("at")), "user_id", "at"
    )


def test_payment_status(spark):
    ddl = "order_id bigint, event_type string, s bigint"
    feed = Feed(
        spark, ddl,
        [(1, "create", 1000), (2, "create", 1000), (3, "pay", 1000), (4, "create", 1000)],
        [(1, "pay", 1900), (3, "create", 990)],
        [(2, "pay", 1950), (5, "pay", 1960)],
        [(0, "create", FAR)],
    )
    stream = feed.stream().withWatermark("ts", "20 minutes")
    got = drain_latest(stateful(stream, ["order_id"], Payment(), Payment.OUTPUT), ["order_id"], ["version"], "pay")
    assert rows_of(got.where("order_id > 0"), "order_id", "status") == [
        (1, "paid"), (2, "paid_late"), (3, "paid"), (4, "unpaid"), (5, "missing_create"),
    ]


def test_orders_are_forgotten(spark):
    """Two days after its event an order is gone: what comes then is an order of its own."""
    day, ddl = 86_400, "order_id bigint, event_type string, s bigint"
    feed = Feed(
        spark, ddl,
        [(1, "create", day), (2, "create", day), (3, "pay", day)], [(1, "pay", day + 60)],
        [(4, "create", 4 * day)], [(4, "pay", 4 * day + 60)], [(2, "pay", 6 * day)], [(0, "create", FAR)],
    )
    stream = feed.stream().withWatermark("ts", "20 minutes")
    got = drain_latest(
        stateful(stream, ["order_id"], Payment(keep="2 days"), Payment.OUTPUT), ["order_id", "status"], ["version"], "gone"
    )
    assert rows_of(got.where("order_id > 0"), "order_id", "status") == [
        (1, "paid"), (2, "missing_create"), (2, "unpaid"), (3, "missing_create"), (4, "paid"),
    ]


def test_one_to_one_matching(spark):
    ddl = "tx_id bigint, side string, s bigint, row_id bigint"
    feed = Feed(
        spark, ddl,
        [(1, "left", 5, 10), (2, "right", 5, 20)],
        [(1, "left", 6, 11), (1, "right", 9, 21), (2, "left", 7, 12)],
        [(1, "right", 8, 22), (1, "right", 8, 23), (3, "left", 1, 13)],
        [(0, "left", FAR, 99)],
    )
    stream = feed.stream().withWatermark("ts", "1 minute")
    got = drain(stateful(stream, ["tx_id"], Matcher(), Matcher.OUTPUT), "match")
    assert rows_of(got, "tx_id", "left_id", "right_id") == [(1, 10, 22), (1, 11, 23), (2, 12, 20)]


def test_followed_by_and_timeouts(spark):
    parts, rows = shuffled(46, span=2000)
    feed = Feed(spark, EVENT, *parts)
    stream = feed.stream().withWatermark("ts", SPAN).where("v < 30 OR v > 70 OR k < 0").select(
        F.col("k").alias("key"), "at", "ts", "event_id",
        F.when(F.col("v") < 30, "first").otherwise("second").alias("step"),
    )
    got = drain(stateful(stream, ["key"], FollowedBy("20 seconds"), FollowedBy.OUTPUT), "cep")
    df, order = as_frame(spark, rows), by_time("ts", "event_id")
    args = (df, ["k"], order, F.col("v") < 30, F.col("v") > 70, "20 seconds")
    matched = patterns.followed_by(*args).select("first.event_id", F.col("second.event_id").alias("e2"))
    assert rows_of(got.where("kind = 'match'"), "first_id", "second_id") == rows_of(matched, "event_id", "e2")
    assert rows_of(got.where("kind = 'timeout'"), "first_id") == rows_of(patterns.timed_out(*args), "event_id")


def test_nothing_written_is_an_empty_table(spark):
    table = KeyedTable(spark, ["k"], ["event_id"], schema=spark.createDataFrame([], EVENT).schema)
    assert table.read().count() == 0


def test_folds_keep_the_newest_row_per_key(spark):
    table = KeyedTable(spark, ["k"], [], schema=None)
    table.FOLD = 3
    for batch in range(8):
        table.upsert_batch(spark.createDataFrame([(batch % 2, batch)], "k bigint, v int"), batch)
    table.upsert_batch(spark.createDataFrame([(0, 70), (5, 71)], "k bigint, v int"), 7)  # a replay
    assert rows_of(table.read(), "k", "v") == [(0, 70), (1, 5), (5, 71)]


def test_estimates_of_visitors(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    tables = Tables(spark, folder)
    views = tables.behavior().where(F.col("behavior") == "view")
    exact = {
        (r.window_start, r.window_end): r.uv
        for r in distinct.windowed_distinct(views, "ts", "1 hour", "user_id").collect()
    }
    for name in (
        "g17_hourly_visitors_approx", "g17_hourly_visitors_approx_stream",
        "g17_hourly_visitors_sketch", "g17_hourly_visitors_sketch_stream",
    ):
        guess = {
            (r.window_start, r.window_end): r.uv
            for r in QUERIES[name](spark, folder).withColumns({
                c: F.timestamp_micros(c) for c in ("window_start", "window_end")
            }).collect()
        }
        assert guess.keys() == exact.keys()
        assert all(abs(guess[w] - exact[w]) <= max(1, 0.05 * exact[w]) for w in exact)


def test_runs_are_folded_level_by_level(spark):
    table = KeyedTable(spark, ["k"], [])
    table.FOLD = 3
    written, batches = 0, 27
    for batch in range(batches):
        table.upsert_batch(spark.range(10 * batch, 10 * batch + 15).select(F.col("id").alias("k"), F.lit(batch).alias("v")), batch)
    assert table.cover() == [(3, 0)]
    assert rows_of(table.read(), "k", "v") == [(k, min(k // 10, batches - 1)) for k in range(10 * batches + 5)]
    for level, run in table._done():
        written += spark.read.parquet(table._folder(level, run)).count()
    # Each level holds a row for each batch it comes from at most, however long the table.
    assert written <= 4 * 15 * batches


def test_a_fold_that_was_cut_off_is_not_read(spark):
    table = KeyedTable(spark, ["k"], [])
    table.FOLD = 3
    for batch in range(9):
        table.upsert_batch(spark.range(6).select(F.col("id").alias("k"), F.lit(batch).alias("v")).repartition(3), batch)
    assert table.cover() == [(2, 0)]
    folder = table._folder(2, 0)
    parts = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
    os.remove(f"{folder}/{parts[0]}")
    os.remove(f"{folder}/{table.DONE}")
    assert table.cover() == [(1, 0), (1, 1), (1, 2)]
    assert rows_of(table.read(), "k", "v") == [(k, 8) for k in range(6)]
    table.upsert_batch(spark.range(6).select(F.col("id").alias("k"), F.lit(8).alias("v")), 8)  # the replay mends it
    assert table.cover() == [(2, 0)]


@pytest.fixture(scope="module")
def split_tables(spark, tmp_path_factory):
    """The smallest tables, the streamed ones in four files each with their rows dealt at random."""
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    out = str(tmp_path_factory.mktemp("split"))
    for entry in os.listdir(folder):
        name = entry.removesuffix(".parquet")
        table = spark.read.parquet(f"{folder}/{entry}")
        if name in SLICES:
            table = table.repartition(4, F.xxhash64(*table.columns))
        table.write.parquet(f"{out}/{entry}")
    spark.conf.set(FILES_PER_TRIGGER, "1")
    yield folder, out
    spark.conf.unset(FILES_PER_TRIGGER)


@pytest.mark.parametrize("name", sorted(n for n in ORACLES if n.endswith("_stream")))
def test_streams_do_not_depend_on_files(spark, split_tables, name):
    """Four shuffled files, a micro-batch each, against the SQL over the whole table."""
    duckdb = pytest.importorskip("duckdb")
    folder, split = split_tables
    connection = duckdb.connect()
    for entry in os.listdir(folder):
        table = entry.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{entry}'")
    got = QUERIES[name](spark, split)
    columns = sorted(got.columns)
    result = connection.execute(ORACLES[name])
    places = [[d[0] for d in result.description].index(c) for c in columns]
    want = Counter(tuple(row[i] for i in places) for row in result.fetchall())
    assert Counter(map(tuple, got.select(*columns).collect())) == want
