"""Streams settled stretch by stretch, against results by hand."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import as_frame, by_key
from tests.test_detections import rising_by_hand
from tests.test_landing import FAR, HOUR, STEPS, events, frame, walked_by_hand
from tidemark.operators.running import by_time
from tidemark.plans import stream_analyses  # noqa: F401
from tidemark.plans.registry import QUERIES
from tidemark.session import fresh_path
from tidemark.sources.landing import land
from tidemark.streaming import drain as draining
from tidemark.streaming import stages
from tidemark.streaming.drain import LateRowsDropped
from tidemark.streaming.settled import drain_settled

#: Hot keys are those with more than 40 rows in a stretch.
IN_ORDER = by_time("ts", "event_id", hot_rows=40)
#: Queries that paid for state calls, key by key or row by row.
FREED = [
    "i1_moving_count_stream",
    "l2_strict_next_stream",
    "m1_rising_alarms_stream",
    "m6_consecutive_failures_stream",
    "n7_changelog_stream",
    "f2_reconcile_stream",
    "k9_keyed_state_stream",
    "k10_timer_stream",
    "m7_payment_status_stream",
    "m4_blacklist_stream",
    "o7_swings_stream",
    "f3_interval_join_stream",
    "m5_repeated_failures_stream",
    "h5_sliding_count_window_stream",
    "l4_followed_by_any_stream",
    "l8_followed_by_or_timeout_stream",
]


@pytest.mark.parametrize("name", FREED)
def test_no_row_waits_in_a_state_store(spark, monkeypatch, name):
    """What made these streams fail at size was the price of a state call for each key or row."""
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    runs = []

    class Watched(draining.Progress):
        def follow(self, query):
            runs.append(self)
            super().follow(query)

    monkeypatch.setattr(draining, "Progress", Watched)
    assert QUERIES[name](spark, folder).count()
    assert sum(run.batches for run in runs) >= 2
    assert all(run.most_state_rows == 0 for run in runs)


def stretches(spark, rows, stage, columns, width="15 hours", **kw):
    """``stage`` over the rows, landed in slices and ended by a far row of no key."""
    far = [(None, FAR, 60, 10**9)]
    stream = land(frame(spark, rows + far), "ts", width).stream(spark).selectExpr("ts", "event_id", *columns)
    return drain_settled(stream, spark, stage, "ts", width, "settled", **kw)


READING = ["k AS id", "v AS vc"]


def moved(rows, slide):
    want = []
    for key, own in by_key(rows).items():
        for n, row in enumerate(own, 1):
            last = [r[2] for r in own[max(0, n - 3):n]]
            if n % slide == 0:
                want.append((key, row[3], n, len(last), sum(last)))
    return want


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("slide", [1, 2])
def test_moving(spark, slide):
    rows = events(30, hot=0.6) + [(None, 1_600_000_000 + i, i, 5000 + i) for i in range(0, 80_000, 9000)]
    got = stretches(spark, rows, stages.Moving(IN_ORDER, 3, slide), READING)
    assert order(map(tuple, got.collect())) == order(moved(rows, slide))


def test_a_restart_goes_on_from_the_last_mark(spark):
    rows, far = events(30), [(None, FAR, 0, 10**9)]
    cut = 1_600_000_000 + 14 * HOUR
    inbox, path, state = (fresh_path(spark, n) for n in ("inbox", "path", "state"))
    schema = as_frame(spark, rows).schema
    for part in ([r for r in rows if r[1] < cut], [], [r for r in rows if r[1] >= cut], far):
        as_frame(spark, part).coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(schema).parquet(inbox).selectExpr("ts", "event_id", *READING)
        got = drain_settled(stream, spark, stages.Moving(IN_ORDER), "ts", "1 hour", "again", path=path, checkpoint=state)
    assert order(map(tuple, got.collect())) == order(moved(rows, 1))


def test_late_rows_raise(spark):
    path = fresh_path(spark, "disorder")
    rows = events(20)
    schema = as_frame(spark, rows).schema
    for part in ([r for r in rows if r[1] >= 1_600_000_000 + 10 * HOUR], [r for r in rows if r[1] < 1_600_000_000 + 10 * HOUR]):
        as_frame(spark, part).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path).selectExpr("ts", "event_id", *READING)
    with pytest.raises(LateRowsDropped):
        drain_settled(stream, spark, stages.Moving(IN_ORDER), "ts", "1 hour", "late")


def test_no_rows_are_no_results(spark):
    stream = land(frame(spark, events(1)[:0]), "ts", "1 hour").stream(spark).selectExpr("ts", "event_id", *READING)
    assert drain_settled(stream, spark, stages.Moving(IN_ORDER), "ts", "1 hour", "none").collect() == []


@pytest.mark.parametrize("within", [None, "20 minutes"])
def test_strict_next(spark, within):
    rows = events(30, hot=0.6)
    limit = None if within is None else 20 * 60
    want = [
        (key, a[3], b[3])
        for key, own in by_key(rows).items() for a, b in zip(own, own[1:])
        if a[2] < 50 <= b[2] and (limit is None or b[1] - a[1] < limit)
    ]
    got = stretches(spark, rows, stages.StrictNext(IN_ORDER, within), ["k AS key", "v < 50 AS first", "v >= 50 AS second"])
    assert order(map(tuple, got.collect())) == order(want)


def test_rising(spark):
    rows = events(30, per_hour=20, hot=0.5)
    got = stretches(spark, rows, stages.Rising(IN_ORDER, "15 minutes"), READING)
    want = [(k, s * 1_000_000, (s + 900) * 1_000_000) for k, s in rising_by_hand(rows, 900)]
    assert want and order(map(tuple, got.collect())) == order(want)


def test_alarms_over_the_end_of_a_stretch(spark):
    """Armed, cancelled by a fall, by the same level and by an early one, all one stretch later."""
    start = 1_600_020_000 // (15 * HOUR) * 15 * HOUR
    rows = []
    for key, level in enumerate([8, 5, 2, None]):
        rows += [(key, start - 60, 1, 10 * key), (key, start - 30, 5, 10 * key + 1)]
        rows += [] if level is None else [(key, start + 30, level, 10 * key + 2)]
    rows += [(9, start + n * 15 * HOUR, -n, 100 + n) for n in range(4)]
    got = stretches(spark, rows, stages.Rising(IN_ORDER, "2 minutes"), READING)
    assert sorted(r.id for r in got.collect()) == [0, 3]
    assert {r.armed_at for r in got.collect()} == {(start - 60) * 1_000_000}


def test_changelog(spark):
    rows = events(30, hot=0.6)
    want = []
    for key, own in by_key(rows).items():
        so_far = 0
        for n, row in enumerate(own):
            if n:
                want.append((key, row[3], False, so_far))
            so_far += row[2]
            want.append((key, row[3], True, so_far))
    got = stretches(spark, rows, stages.Changelog(IN_ORDER), READING)
    assert order(map(tuple, got.collect())) == order(want)


def test_matcher(spark):
    """The n-th of a side meets the n-th of the other; equal times go by number."""
    rows = events(30, per_hour=16, hot=0.5)
    sides = {}
    for key, own in by_key(rows).items():
        for row in own:
            sides.setdefault((key, row[2] < 60), []).append(row[3])
    want = [(k, a, b) for k in range(5) for a, b in zip(sides[k, True], sides[k, False])]
    columns = ["k AS tx_id", "event_id AS row_id", "IF(v < 60, 'left', 'right') AS side"]
    got = stretches(spark, rows, stages.Matcher(by_time("ts", "row_id", hot_rows=40)), columns)
    assert want and order(map(tuple, got.collect())) == order(want)


def test_history(spark):
    rows = events(30, hot=0.6)
    want, groups = [], {}
    for k, _, v, event_id in sorted(rows, key=lambda r: (r[1], r[3])):
        seen = groups.setdefault(k, [])
        seen.append(v)
        same = sum((x < 50) == (v < 50) for x in seen)
        want.append((k, event_id, seen[-2] if len(seen) > 1 else None, sum(seen[-3:]), same))
    got = stretches(spark, rows, stages.History(IN_ORDER), [*READING, "IF(v < 50, 'low', 'high') AS label"])
    assert order(map(tuple, got.collect())) == order(want)


def test_one_shot(spark):
    rows = events(30, keys=40)
    want = [(k, (own[0][1] + 7200) * 1_000_000) for k, own in by_key(rows).items()]
    got = stretches(spark, rows, stages.OneShot("2 hours"), READING)
    assert order(map(tuple, got.collect())) == order(want)


def test_payment(spark):
    """Values under 50 are creates; an order that was reported is corrected by a late pay."""
    rows = events(60, per_hour=2, keys=60, hot=0)
    want = []
    for k, own in by_key(rows).items():
        created, paid = (min((r[1] for r in own if (r[2] < 50) is side), default=None) for side in (True, False))
        if created is None or paid is None:
            want.append((k, "missing_create" if created is None else "unpaid"))
        else:
            want.append((k, "paid_late" if paid - created > 7200 else "paid"))
    assert {status for _, status in want} == set(stages.Payment.STATUS)
    got = stretches(
        spark, rows, stages.Payment("2 hours", keep="10000 days"),
        ["k AS order_id", "IF(v < 50, 'create', 'pay') AS event_type"],
    )
    assert order(map(tuple, got.collect())) == order(want)


def test_click_limit(spark):
    rows = events(60, hot=0.4)
    want, clicks = [], {}
    for k, s, v, event_id in sorted(rows, key=lambda r: (r[1], r[3])):
        group = k, v % 2, s // 86_400
        clicks[group] = n = clicks.get(group, 0) + 1
        if n <= 6:
            want.append(("pass" if n <= 5 else "alarm", k, v % 2, event_id, s * 1_000_000))
    got = stretches(spark, rows, stages.ClickLimit(IN_ORDER, 5), ["k AS user_id", "v % 2 AS ad_id"])
    assert order(map(tuple, got.collect())) == order(want)


def test_matched(spark):
    rows = events(30, per_hour=20)
    want = sorted(m for own in by_key(rows).values() for m in walked_by_hand(own, STEPS, 3600))
    got = stretches(spark, rows, stages.Matched(IN_ORDER, STEPS, "1 hour"), ["k AS key", "v"])
    assert want and sorted(tuple(r.events) for r in got.collect()) == want


def test_interval_join(spark):
    rows = events(30, per_hour=20)
    want = [
        (a[0], a[1], b[1]) for own in by_key(rows).values() for a in own if a[2] < 50 for b in own
        if b[2] >= 50 and -600 <= b[1] - a[1] <= 1200
    ]
    got = stretches(spark, rows, stages.IntervalJoin("k", "10 minutes", "20 minutes"), ["k", "v < 50 AS left"])
    assert want and order((r.l_k, r.l_ts.timestamp(), r.r_ts.timestamp()) for r in got.collect()) == order(want)


@pytest.mark.parametrize("every", [False, True])
def test_followed_by(spark, every):
    rows = events(30, per_hour=20, hot=0.5)
    want = []
    for key, own in by_key(rows).items():
        for i, a in enumerate(own):
            later = [b[3] for b in own[i + 1:] if b[2] > 70 and b[1] - a[1] < 1200]
            if a[2] >= 30:
                continue
            if every:
                want += [("match", key, a[3], b) for b in later]
            else:
                want.append(("match", key, a[3], later[0]) if later else ("timeout", key, a[3], None))
    rows = [r for r in rows if not 30 <= r[2] <= 70]
    stage = stages.FollowedBy(IN_ORDER, "20 minutes", every)
    got = stretches(spark, rows, stage, ["k AS key", "IF(v < 30, 'first', 'second') AS step"])
    assert order(map(tuple, got.collect())) == order(want)
