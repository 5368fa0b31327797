"""Time windows, sessions, distinct counts, rankings."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import as_frame, offset, skewed_events
from tidemark.operators import distinct, windows
from tidemark.operators.accumulate import process_window
from tidemark.operators.running import by_number
from tidemark.operators.topn import top_n
from tidemark.plans import traffic


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_sensor_tumbling(sensor):
    got = windows.tumbling(sensor, ["id"], "ts", "5 seconds", n=windows.count_of())
    assert {(r.id, offset(r.window_start), r.n) for r in got.collect()} == {
        ("s1", 0, 3), ("s1", 5, 2), ("s2", 5, 2), ("s3", 5, 1), ("s3", 10, 1),
    }


def test_sensor_sliding(sensor):
    by_rows = sensor.groupBy("id", F.window("ts", "5 seconds", "2 seconds")).count()
    assert by_rows.count() == 12
    assert by_rows.agg(F.sum("count")).first()[0] == 23
    with pytest.raises(ValueError):
        windows.sliding(sensor, ["id"], "ts", "5 seconds", "2 seconds", n=windows.count_of())


@pytest.mark.parametrize("size, slide", [("1 hour", "5 minutes"), ("10 minutes", "10 minutes")])
def test_sliding_from_panes_equals_sliding_rows(spark, size, slide):
    df = as_frame(spark, skewed_events(11))
    got = windows.sliding(
        df, ["k"], "ts", size, slide, n=windows.count_of(), t=windows.sum_of("v"),
        low=windows.min_of("v"), top=windows.max_of("v"),
    )
    want = (
        df.groupBy("k", F.window("ts", size, slide).alias("w"))
        .agg(F.count("*").alias("n"), F.sum("v").alias("t"), F.min("v").alias("low"), F.max("v").alias("top"))
        .select("k", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "t", "low", "top")
    )
    same(got, want)


def test_sensor_sessions(sensor):
    got = windows.sessions(sensor, ["id"], "ts", "3 seconds", "2 seconds", 2, n=windows.count_of())
    assert {(r.id, offset(r.window_start), offset(r.window_end), r.n) for r in got.collect()} == {
        ("s1", 2, 11, 5), ("s2", 5, 10, 2), ("s3", 9, 13, 2),
    }


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("width, hot_rows", [("4 seconds", 0), ("1 minute", 60), ("1 day", 0), ("1 day", 10_000)])
@pytest.mark.parametrize("gap", ["3 seconds", "1 minute"])
def test_sessions_equal_the_built_in_window(spark, gap, width, hot_rows, keys):
    df = as_frame(spark, skewed_events(12))
    got = windows.sessions(
        df, keys, "ts", gap, width, hot_rows, n=windows.count_of(), t=windows.sum_of("v")
    )
    want = (
        df.groupBy(*keys, F.session_window("ts", gap).alias("w"))
        .agg(F.count("*").alias("n"), F.sum("v").alias("t"))
        .select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "t")
    )
    same(got, want)


def test_distinct_counts_agree(spark):
    df = as_frame(spark, skewed_events(13)).withColumn("user", F.col("v") + 1000)
    args = (df, "ts", "10 minutes", "user")
    exact = distinct.windowed_distinct(*args)
    same(exact, distinct.windowed_bitmap(*args))
    same(exact, distinct.windowed_positions(*args))
    close = exact.join(
        distinct.windowed_approx(*args, rsd=0.01).withColumnRenamed("uv", "guess"), "window_start"
    )
    assert close.where(F.abs(F.col("uv") - F.col("guess")) > 2).count() == 0


def test_full_window_function(sensor):
    groups = ["id", "window_start", "window_end"]

    def add(rows):
        return rows.groupby(groups, as_index=False).agg(low=("vc", "min"), high=("vc", "max"))

    def merge(states):
        return states.groupby(groups, as_index=False).agg(low=("low", "min"), high=("high", "max"))

    got = process_window(
        sensor.repartition(4), ["id"], "ts", "5 seconds", add, merge, "low int, high int",
        lambda d: d.select("id", "window_start", (F.col("high") - F.col("low")).alias("spread")),
    )
    assert sorted((r.id, offset(r.window_start), r.spread) for r in got.collect()) == [
        ("s1", 0, 20), ("s1", 5, 20), ("s2", 5, 20), ("s3", 5, 0), ("s3", 10, 0),
    ]


def test_top_n_ties_and_short_groups(spark):
    df = spark.createDataFrame(
        [(1, "b", 5), (1, "a", 5), (1, "c", 9), (1, "d", 5), (2, "z", 1)], "w int, item string, cnt int"
    )
    got = top_n(df, ["w"], "cnt", ["item"], 3)
    assert sorted((r.w, r.rank, r.item) for r in got.collect()) == [
        (1, 1, "c"), (1, 2, "a"), (1, 3, "b"), (2, 1, "z"),
    ]
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()


def behavior(spark, rows):
    return spark.createDataFrame(rows, "user_id bigint, item_id int, behavior string, s bigint, event_id bigint").select(
        "*", F.timestamp_seconds("s").alias("ts")
    )


def test_hot_items_api_and_sql_agree(spark):
    rows = [
        (u % 7, (u * u) % 11, "pv" if u % 4 else "buy", 1_511_658_000 + 37 * u, u) for u in range(400)
    ]
    df = behavior(spark, rows)
    got = traffic.hot_items(df).select("item_id", "window_end", "cnt", "rank")
    same(got, traffic.hot_items_sql(df).select("item_id", "window_end", "cnt", "rank"))
    counts = df.where("behavior = 'pv'").groupBy("item_id", F.window("ts", "1 hour", "5 minutes")["end"].alias("window_end")).count()
    best = {}
    for r in counts.collect():
        best.setdefault(r.window_end, []).append((-r["count"], r.item_id))
    want = {(i, w, -c) for w, items in best.items() for c, i in sorted(items)[:3]}
    assert {(r.item_id, r.window_end, r.cnt) for r in got.collect()} == want


def test_page_views_and_visitors(spark):
    df = behavior(spark, [(1, 1, "pv", 10, 0), (2, 1, "buy", 11, 1), (1, 2, "pv", 12, 2), (3, 1, "pv", 4000, 3)])
    assert traffic.page_views(df).first()["cnt"] == 3
    order = by_number("event_id", 2)
    assert {r.event_id: r.cnt for r in traffic.page_views_so_far(df, order).collect()} == {0: 1, 2: 2, 3: 3}
    assert {r.event_id: r.uv for r in traffic.visitors_so_far(df, order).collect()} == {0: 1, 2: 1, 3: 2}
    per_window = traffic.windowed_visitors_so_far(df, order)
    assert {r.event_id: r.uv for r in per_window.collect()} == {0: 1, 2: 1, 3: 1}
    assert [r.cnt for r in traffic.hourly_page_views(df).orderBy("window_start").collect()] == [2, 1]
