"""Joins and business detections: bounds, ties, NULL keys, hot keys."""

import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import as_frame, by_key, offset, skewed_events
from tidemark.operators import joins, routing
from tidemark.operators.running import by_number, by_time
from tidemark.plans import ads, logins, orders, sensors

ORDER = by_time("ts", "event_id", width="2 seconds", hot_rows=1)


def timed(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl).withColumn("ts", F.timestamp_seconds("s"))


# --- joins ---------------------------------------------------------------------------------


def test_left_join_keeps_both_column_sets(sensor):
    few = sensor.where("event_id < 2").select("id", "vc")
    got = joins.left_join(sensor, few, "id")
    assert got.columns == ["l_id", "l_ts", "l_vc", "l_event_id", "r_id", "r_vc"]
    assert got.count() == 5 * 2 + 4


def test_interval_join_is_inclusive_at_both_ends(spark):
    left = timed(spark, [("a", 100), (None, 100)], "k string, s bigint")
    right = timed(spark, [("a", s) for s in (84, 85, 100, 115, 116)] + [(None, 100)], "k string, s bigint")
    got = joins.interval_join(left, right, "k", "ts", "15 seconds", "15 seconds")
    assert sorted(r.r_s for r in got.collect()) == [85, 100, 115]


@pytest.mark.parametrize("back, ahead", [("0 seconds", "30 seconds"), ("7 seconds", "0 seconds"), ("15 seconds", "15 seconds")])
def test_interval_join_against_loops(spark, back, ahead):
    left, right = skewed_events(31, n=150, span=900), skewed_events(32, n=150, span=900)
    got = joins.interval_join(as_frame(spark, left), as_frame(spark, right), "k", "ts", back, ahead)
    low, high = int(back.split()[0]), int(ahead.split()[0])
    want = sorted(
        (a[3], b[3]) for a in left for b in right
        if a[0] is not None and a[0] == b[0] and a[1] - low <= b[1] <= a[1] + high
    )
    assert sorted((r.l_event_id, r.r_event_id) for r in got.collect()) == want


def test_reconcile_one_to_one_with_a_hot_key(spark):
    left = timed(spark, [("a", 1, 0), ("a", 2, 1), ("a", 3, 2), ("b", 1, 3), (None, 1, 4)], "tx string, s bigint, event_id bigint")
    right = timed(spark, [("a", 9, 0), ("a", 7, 1), ("c", 1, 2), (None, 1, 3)], "tx string, s bigint, event_id bigint")
    inner = joins.reconcile(left, right, "tx", ORDER, ORDER)
    assert sorted((r.l_event_id, r.r_event_id) for r in inner.collect()) == [(0, 1), (1, 0)]
    full = joins.reconcile(left, right, "tx", ORDER, ORDER, "full")
    key = lambda p: tuple(-1 if x is None else x for x in p)
    assert sorted(((r.l_event_id, r.r_event_id) for r in full.collect()), key=key) == [
        (None, 2), (None, 3), (0, 1), (1, 0), (2, None), (3, None), (4, None),
    ]


def test_receipts_within_15_seconds(spark):
    pays = timed(spark, [("t1", 100), ("t2", 100)], "tx_id string, s bigint")
    receipts = timed(spark, [("t1", 115), ("t2", 116)], "tx_id string, s bigint")
    assert [r.l_tx_id for r in orders.reconciled_within(pays, receipts).collect()] == ["t1"]


# --- sensors -------------------------------------------------------------------------------


def rising_by_hand(rows, hold):
    """(key, armed second) of every alarm, walking each key's rows once."""
    alarms = []
    for key, group in by_key(rows).items():
        level, armed = 0, None
        for _, s, v, _ in group:
            if armed is not None and s > armed + hold:
                alarms.append((key, armed))
                armed = None
            if v > level:
                armed = s if armed is None else armed
            else:
                armed = None
            level = v
        if armed is not None:
            alarms.append((key, armed))
    return alarms


def test_sensor_rising(sensor):
    got = sensors.rising_alarms(sensor, ORDER)
    assert sorted((r.id, offset(r.alarm_at)) for r in got.collect()) == [
        ("s1", 7), ("s1", 13), ("s2", 10), ("s3", 14),
    ]


@pytest.mark.parametrize("hold, width", [(5, "10 seconds"), (30, "2 minutes"), (400, "1 hour")])
def test_rising_alarms(spark, hold, width):
    rows = skewed_events(33, span=2000)
    # A third key that climbs for long stretches, so alarms chain within a climb.
    rows += [(9, 3 * i, i % 97, 10_000 + i) for i in range(1, 400)]
    df = as_frame(spark, rows).select(F.col("k").alias("id"), "ts", F.col("v").alias("vc"), "event_id")
    got = sensors.rising_alarms(df, by_time("ts", "event_id", width=width, hot_rows=50), f"{hold} seconds")
    none_last = lambda p: (p[0] is None, p[0] or 0, p[1])
    assert sorted(((r.id, int(r.armed_at.timestamp())) for r in got.collect()), key=none_last) == sorted(
        rising_by_hand(rows, hold), key=none_last
    )


def test_previous_value(sensor):
    got = sensors.with_previous(sensor, ORDER)
    assert {r.event_id: r.previous_vc for r in got.collect()} == {
        0: None, 1: 10, 2: 20, 3: None, 4: 30, 5: 40, 6: 50, 7: None, 8: 80,
    }


def test_threshold_alarms(sensor):
    main, alarms = sensors.threshold_alarms(sensor, above=50)
    assert (main.count(), alarms.count()) == (9, 4)


# --- ads -----------------------------------------------------------------------------------


def test_blacklist_counts_per_day_and_alarms_once(spark):
    day = 86_400
    rows = [(1, 7, 10 * day + i, i) for i in range(1, 124)] + [(1, 7, 11 * day + 5, 200), (2, 7, 10 * day, 201)]
    clicks = timed(spark, rows, "user_id bigint, ad_id int, s bigint, event_id bigint")
    passed, alarms = ads.blacklist_filter(clicks, ORDER, limit=100)
    assert passed.count() == 102
    assert [(r.user_id, r.ad_id, r.day, int(r.ts.timestamp())) for r in alarms.collect()] == [(1, 7, 10, 10 * day + 101)]


def test_clicks_by_province(spark):
    clicks = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (3, 1), (3, 2), (4, 1)], "user_id bigint, ad_id int")
    people = spark.createDataFrame([(1, "p1"), (2, "p2"), (3, "p1")], "user_id bigint, province string")
    got = ads.clicks_by_province(clicks, people)
    assert {(r.key, r.cnt) for r in got.collect()} == {("p1_1", 3), ("p2_1", 1), ("p1_2", 1)}


def test_few_groups_are_numbered(spark):
    """Only groups over the limit are numbered; the others, those without a user too, pass as they are."""
    rows = [(u, 1, 10 * 86_400 + i, 10 * u + i) for u in range(5) for i in range(u)]
    rows += [(None, 1, 10 * 86_400 + i, 100 + i) for i in range(4)]
    clicks = timed(spark, rows, "user_id bigint, ad_id int, s bigint, event_id bigint")
    passed, alarms = ads.blacklist_filter(clicks, ORDER, limit=2)
    assert sorted(r.event_id for r in passed.collect()) == sorted(
        r[3] for r in rows if (r[3] - 10 * r[0] if r[0] is not None else r[3] - 100) < 2
    )
    assert sorted(str(r.user_id) for r in alarms.collect()) == ["3", "4", "None"]


# --- logins --------------------------------------------------------------------------------


LOGINS = "user_id bigint, event_type string, s bigint, event_id bigint"


def test_state_rule_includes_two_seconds_and_pattern_rule_does_not(spark):
    df = timed(spark, [(1, "fail", 10, 0), (1, "fail", 12, 1), (1, "fail", 13, 2)], LOGINS)
    state = logins.repeated_failures(df, by_number("event_id", 2, hot_rows=1))
    assert sorted(r.event_id for r in state.collect()) == [1, 2]
    pattern = logins.consecutive_failures(df, ORDER)
    assert [(r.first.event_id, r.second.event_id) for r in pattern.collect()] == [(1, 2)]


def test_state_rule_follows_arrival_and_skips_successes(spark):
    df = timed(spark, [(1, "fail", 12, 0), (1, "success", 11, 1), (1, "fail", 10, 2)], LOGINS)
    state = logins.repeated_failures(df, by_number("event_id", 2, hot_rows=1))
    assert [r.event_id for r in state.collect()] == [2]
    assert logins.consecutive_failures(df, ORDER).count() == 0


# --- orders --------------------------------------------------------------------------------


ORDERS = "order_id bigint, event_type string, tx_id string, s bigint, event_id bigint"


def test_payment_rules_at_exactly_15_minutes(spark):
    rows = [
        (1, "create", None, 1000, 0), (1, "pay", "a", 1899, 1),
        (2, "create", None, 1000, 2), (2, "pay", "b", 1900, 3),
        (3, "create", None, 1000, 4), (3, "pay", "c", 1901, 5),
        (4, "create", None, 1000, 6),
        (5, "pay", "e", 1000, 7),
    ]
    df = timed(spark, rows, ORDERS)
    assert {r.order_id: r.status for r in orders.payment_status(df).collect()} == {
        1: "paid", 2: "paid", 3: "paid_late", 4: "unpaid", 5: "missing_create",
    }
    assert [(r.order_id, r.elapsed_seconds) for r in orders.paid_in_time(df, ORDER).collect()] == [(1, 899)]
    assert sorted(r.order_id for r in orders.payment_timeouts(df, ORDER).collect()) == [2, 3, 4]


# --- late rows -----------------------------------------------------------------------------


def test_lateness_and_watermark_by_arrival(spark):
    seconds = [11, 20, 12, 21, 16, 13]
    df = timed(spark, list(enumerate(seconds)), "n bigint, s bigint")
    order = by_number("n", 2, hot_rows=1)
    late = routing.lateness(df, order, "ts", "5 seconds", "2 seconds")
    assert [r.late for r in late.orderBy("n").collect()] == [False, False, True, False, False, True]
    allowed = routing.lateness(df, order, "ts", "5 seconds", "2 seconds", "4 seconds")
    assert [r.late for r in allowed.orderBy("n").collect()] == [False, False, False, False, False, True]
    marks = routing.watermarks(df, order, "ts", "2 seconds", "wm").orderBy("n").collect()
    assert [r.wm // 1_000_000 for r in marks] == [9, 18, 18, 19, 19, 19]


def test_utc_everywhere(spark):
    row = spark.sql("SELECT timestamp_seconds(0) AS t").first()
    assert row.t.astimezone(datetime.timezone.utc).year == 1970
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
