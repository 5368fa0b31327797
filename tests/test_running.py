"""Running results against a plain walk over the rows of each key."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import as_frame, by_key, offset, skewed_events
from tidemark.operators import patterns
from tidemark.operators.running import (
    by_number, by_time, changelog, highest, lowest, opening, preceding, running,
    running_distinct, tally, total,
)
from tidemark.operators.windows import count_windows, moving


@pytest.mark.parametrize("hot_rows", [0, 60, 5_000_000])
@pytest.mark.parametrize("seed, width", [(1, "10 seconds"), (2, "5 minutes"), (3, "1 day")])
def test_running_folds(spark, seed, width, hot_rows):
    rows = skewed_events(seed)
    got = running(
        as_frame(spark, rows), ["k"], by_time("ts", "event_id", width=width, hot_rows=hot_rows),
        sum=total(F.col("v")), sum_before=total(F.col("v"), before=True), n=tally(),
        big=tally(F.col("v") > 50), top=highest(F.col("v")), low=lowest(F.col("v")),
        first=opening(F.col("v")), prev=preceding(F.col("v")),
        prev_big=preceding(F.col("v"), F.col("v") > 50),
    )
    want = set()
    for key, group in by_key(rows).items():
        seen, prev, prev_big = [], None, None
        for _, _, v, event_id in group:
            before = sum(seen) if seen else None
            seen.append(v)
            want.add((
                key, event_id, sum(seen), before, len(seen), sum(x > 50 for x in seen),
                max(seen), min(seen), seen[0], prev, prev_big,
            ))
            prev = v
            prev_big = v if v > 50 else prev_big
    columns = ["k", "event_id", "sum", "sum_before", "n", "big", "top", "low", "first", "prev", "prev_big"]
    assert {tuple(r) for r in got.select(*columns).collect()} == want


def test_reversed_order_finds_the_next_row(spark):
    rows = skewed_events(4)
    got = running(
        as_frame(spark, rows), ["k"], by_time("ts", "event_id", width="3 minutes", hot_rows=60).reversed(),
        next=preceding(F.col("event_id")),
    )
    want = {}
    for group in by_key(rows).values():
        ids = [r[3] for r in group]
        want.update(dict(zip(ids, [*ids[1:], None])))
    assert {r.event_id: r.next for r in got.collect()} == want


def test_null_value_of_previous_row_is_kept(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 5), (1, 3, None)], "k int, n bigint, v int")
    got = running(df, ["k"], by_number("n", 1, hot_rows=0), prev=preceding(F.col("v")), first=opening(F.col("v")))
    assert {r.n: (r.prev, r.first) for r in got.collect()} == {
        1: (None, None), 2: (None, None), 3: (5, None),
    }


def test_peers_count_as_one_step(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (1, 6), (1, 9)], "k int, s bigint").select(
        "k", F.timestamp_seconds("s").alias("ts")
    )
    got = running(df, ["k"], by_time("ts", width="2 seconds", hot_rows=0), peers=True, n=tally())
    assert sorted(r.n for r in got.collect()) == [2, 2, 3, 4]


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_running_distinct(spark, keys):
    rows = skewed_events(5)
    df = as_frame(spark, rows).withColumn("user", F.col("v") % 20)
    got = running_distinct(df, keys, "user", by_number("event_id", 50, hot_rows=60), "uv")
    want, seen = {}, {}
    for k, _, v, event_id in rows:
        users = seen.setdefault(k if keys else 0, set())
        users.add(v % 20)
        want[event_id] = len(users)
    assert {r.event_id: r.uv for r in got.collect()} == want


def test_sensor_running_sum(sensor):
    got = running(sensor, ["id"], by_time("ts", "event_id", width="3 seconds", hot_rows=2), t=total(F.col("vc")))
    rows = {}
    for r in got.orderBy("event_id").collect():
        rows.setdefault(r.id, []).append(r.t)
    assert rows == {"s1": [10, 30, 60, 110, 180], "s2": [40, 100], "s3": [80, 170]}


def test_sensor_count_windows(sensor):
    seq = by_time("ts", "event_id", width="2 seconds", hot_rows=2)
    tumbling = count_windows(sensor, ["id"], seq, 3, t=F.sum("vc")).collect()
    assert [(r.id, r.t) for r in tumbling] == [("s1", 60)]
    sliding = count_windows(sensor, ["id"], seq, 3, 2, t=F.sum("vc")).collect()
    assert sorted((r.id, r.t) for r in sliding) == [("s1", 30), ("s1", 100), ("s2", 100), ("s3", 170)]


@pytest.mark.parametrize("size, slide", [(3, 3), (5, 2), (2, 3), (1, 1)])
def test_count_windows(spark, size, slide):
    rows = skewed_events(6)
    got = count_windows(
        as_frame(spark, rows), ["k"], by_time("ts", "event_id", width="2 minutes", hot_rows=60), size, slide,
        t=F.sum("v"), n=F.count("v"),
    )
    want = set()
    for key, group in by_key(rows).items():
        values = [r[2] for r in group]
        for end in range(slide, len(values) + 1, slide):
            part = values[max(0, end - size):end]
            want.add((key, end, sum(part), len(part)))
    assert {(r.k, r.window_no, r.t, r.n) for r in got.collect()} == want


@pytest.mark.parametrize("block", [1, 7, 100_000])
def test_moving(spark, block):
    rows = skewed_events(7)
    got = moving(
        as_frame(spark, rows), ["k"], by_time("ts", "event_id", width="2 minutes", hot_rows=60), 2, block,
        t=F.sum("v"),
    )
    want = {}
    for group in by_key(rows).values():
        values = [r[2] for r in group]
        for i, row in enumerate(group):
            want[row[3]] = sum(values[max(0, i - 2):i + 1])
    assert {r.event_id: r.t for r in got.collect()} == want


def test_changelog(sensor):
    got = changelog(sensor, ["id"], by_time("ts", "event_id", width="2 seconds", hot_rows=2), n=tally())
    s2 = sorted((offset(r.ts), r.added, r.n) for r in got.where("id = 's2'").collect())
    assert s2 == [(5, True, 1), (7, False, 1), (7, True, 2)]
    assert got.count() == 9 + 6


def test_null_times_and_keys_do_not_depend_on_hot_keys(spark):
    """The same rows whether a key is cut into slices or not, in either order."""
    rows = [(k, t, v, i) for i, (k, t, v) in enumerate(
        (k, t, v) for k in (1, None) for t, v in ((100, 1), (None, 2), (200, 3), (300, 4), (None, 5))
    )]
    df = as_frame(spark, rows)
    results = []
    for hot_rows in (1, 1_000_000):
        order = by_time("ts", "event_id", width="1 minute", hot_rows=hot_rows)
        for sequence in (order, order.reversed()):
            got = running(df, ["k"], sequence, total=total(F.col("v")), before=preceding(F.col("v")))
            results.append(sorted(map(str, got.select("k", "event_id", "total", "before").collect())))
    assert results[0] == results[2] and results[1] == results[3]


def test_patterns_with_null_times_do_not_depend_on_hot_keys(spark):
    rows = [(k, t, v, i) for i, (k, t, v) in enumerate(
        (k, t, v) for k in (1, None) for t, v in ((100, 1), (None, 2), (200, 1), (300, 2), (400, 2))
    )]
    df = as_frame(spark, rows)
    for find in (patterns.strict_next, patterns.followed_by):
        found = [
            sorted(
                str((r.first.event_id, r.second.event_id))
                for r in find(df, ["k"], by_time("ts", "event_id", hot_rows=h), F.col("v") == 1, F.col("v") == 2).collect()
            )
            for h in (1, 1_000_000)
        ]
        assert found[0] == found[1] and found[0]


def test_running_without_key_over_many_slices(spark):
    """More slices than a group holds, so carries come by way of groups."""
    df = spark.range(5000).select(F.col("id").alias("event_id"), F.lit(1).alias("v"))
    got = running(df, [], by_number("event_id", rows=2), n=total(F.col("v")), first=opening(F.col("event_id")))
    assert got.where("n <> event_id + 1 OR first <> 0").count() == 0
    back = running(df, [], by_number("event_id", rows=2).reversed(), n=total(F.col("v")))
    assert back.where("n <> 5000 - event_id").count() == 0
