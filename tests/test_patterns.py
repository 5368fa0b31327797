"""Event patterns against nested loops."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import as_frame, by_key, offset, skewed_events
from tidemark.operators import patterns
from tidemark.operators.running import by_time

ORDER = by_time("ts", "event_id", width="3 minutes", hot_rows=40)

BOUNDS = [None, "1 second", "20 seconds", "10 minutes"]


def low():
    return F.col("v") < 30


def high():
    return F.col("v") > 70


def seconds(within):
    return {None: None, "1 second": 1, "20 seconds": 20, "10 minutes": 600}[within]


def ids(matches):
    return sorted((r.first.event_id, r.second.event_id) for r in matches.collect())


def inside(a, b, within):
    return within is None or b[1] - a[1] < seconds(within)


@pytest.mark.parametrize("within", BOUNDS)
@pytest.mark.parametrize("seed", [21, 22])
def test_strict_next(spark, seed, within):
    rows = skewed_events(seed)
    got = patterns.strict_next(as_frame(spark, rows), ["k"], ORDER, low(), high(), within)
    want = [
        (a[3], b[3])
        for group in by_key(rows).values()
        for a, b in zip(group, group[1:])
        if a[2] < 30 and b[2] > 70 and inside(a, b, within)
    ]
    assert ids(got) == sorted(want)


def nearest(rows, within):
    for group in by_key(rows).values():
        for i, a in enumerate(group):
            if a[2] < 30:
                b = next((r for r in group[i + 1:] if r[2] > 70), None)
                yield a, b if b and inside(a, b, within) else None


@pytest.mark.parametrize("within", BOUNDS)
def test_followed_by(spark, within):
    rows = skewed_events(23)
    got = patterns.followed_by(as_frame(spark, rows), ["k"], ORDER, low(), high(), within)
    assert ids(got) == sorted((a[3], b[3]) for a, b in nearest(rows, within) if b)


@pytest.mark.parametrize("within", BOUNDS[1:])
def test_timed_out(spark, within):
    rows = skewed_events(24)
    got = patterns.timed_out(as_frame(spark, rows), ["k"], ORDER, low(), high(), within)
    assert sorted(r.event_id for r in got.collect()) == sorted(
        a[3] for a, b in nearest(rows, within) if not b
    )


@pytest.mark.parametrize("within", BOUNDS[1:])
def test_followed_by_any(spark, within):
    rows = skewed_events(25)
    got = patterns.followed_by_any(as_frame(spark, rows), ["k"], ORDER, low(), high(), within)
    want = [
        (a[3], b[3])
        for group in by_key(rows).values()
        for i, a in enumerate(group)
        for b in group[i + 1:]
        if a[2] < 30 and b[2] > 70 and inside(a, b, within)
    ]
    assert ids(got) == sorted(want)


@pytest.mark.parametrize("within", [None, "2 minutes"])
@pytest.mark.parametrize("block", [2, 100_000])
def test_times(spark, within, block):
    rows = skewed_events(26)
    got = patterns.times(as_frame(spark, rows), ["k"], ORDER, low(), 1, 3, within, block)
    want = []
    for group in by_key(rows).values():
        matching = [r for r in group if r[2] < 30]
        for i in range(len(matching)):
            for length in (1, 2, 3):
                run = matching[i:i + length]
                if len(run) == length and (within is None or run[-1][1] - run[0][1] < 120):
                    want.append(tuple(r[3] for r in run))
    assert sorted(tuple(s.event_id for s in r.steps) for r in got.collect()) == sorted(want)


def test_a_start_row_may_also_end_a_match(spark):
    df = spark.createDataFrame([(1, 10, 0), (1, 11, 1), (1, 12, 2)], "k int, s bigint, event_id bigint").select(
        "k", F.timestamp_seconds("s").alias("ts"), "event_id"
    )
    always = F.lit(True)
    assert ids(patterns.strict_next(df, ["k"], ORDER, always, always, "2 seconds")) == [(0, 1), (1, 2)]
    assert ids(patterns.followed_by_any(df, ["k"], ORDER, always, always, "3 seconds")) == [(0, 1), (0, 2), (1, 2)]


def test_sensor_patterns(sensor):
    got = patterns.single(sensor, ((F.col("id") == "s1") & (F.col("vc") >= 50)) | (F.col("id") == "s2"))
    assert sorted(r.vc for r in got.collect()) == [40, 50, 60, 70]
    every = F.lit(True)
    pairs = patterns.strict_next(sensor, ["id"], ORDER, every, every, "3 seconds")
    assert sorted((r.first.vc, r.second.vc) for r in pairs.collect()) == [
        (10, 20), (20, 30), (30, 50), (40, 60), (50, 70), (80, 90),
    ]


def test_two_distant_readings_do_not_match(spark):
    rows = [("s1", 1549044122, 0), ("s1", 1549044125, 1)]
    df = spark.createDataFrame(rows, "id string, s bigint, event_id bigint").select(
        "id", F.timestamp_seconds("s").alias("ts"), "event_id"
    )
    s1 = F.col("id") == "s1"
    assert patterns.followed_by_any(df, ["id"], ORDER, s1, s1, "3 seconds").count() == 0
    assert patterns.followed_by_any(df, ["id"], ORDER, s1, s1, "4 seconds").count() == 1
    assert offset(df.first().ts) == 2
