"""Parsing, row transforms, routing, sinks."""

import pytest
from pyspark.sql import Row, functions as F

from tidemark import schemas
from tidemark.functions import columns
from tidemark.functions.durations import bucket, micros
from tidemark.operators import joins, routing
from tidemark.operators.accumulate import accumulate, map_with_lifecycle
from tidemark.plans.tables import plan_text
from tidemark.session import fresh_path
from tidemark.sinks import files
from tidemark.sinks.keyed import KeyedTable
from tidemark.sources import lines, messages


def lines_of(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_durations():
    assert micros("1 hour 30 minutes") == 5_400_000_000
    assert micros("15 seconds") == 15_000_000
    with pytest.raises(ValueError):
        micros("soon")


def test_bucket_below_epoch(spark):
    df = spark.createDataFrame([(-1,), (0,), (4,), (5,)], "s bigint")
    got = df.select(bucket(F.timestamp_seconds("s"), "5 seconds")).collect()
    assert [r[0] for r in got] == [-1, 0, 0, 1]


def test_in_memory_source(spark):
    df = spark.createDataFrame([("sensor_1", 1549044122, 10)], schemas.SENSOR)
    assert df.first() == Row(id="sensor_1", ts=1549044122, vc=10)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("hello world", ["hello", "world"]),
        ("a  b ", ["a", "", "b"]),
        (" a", ["", "a"]),
        ("", [""]),
        ("   ", []),
    ],
)
def test_tokens(spark, text, expected):
    got = lines_of(spark, text).select(columns.tokens(F.col("value")).alias("t")).first()["t"]
    assert got == expected


def test_parse_order_reads_empty_as_null(spark):
    df = lines.parse_delimited(
        lines_of(spark, "34729,create,,1558430842", "34729,pay,sd76f87d6,1558430844"),
        schemas.ORDER,
    )
    assert [r.tx_id for r in df.collect()] == [None, "sd76f87d6"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_number_fails_the_job(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a bigint"):
            lines.parse_delimited(lines_of(spark, "sensor_1,soon,10"), schemas.SENSOR).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_access_log(spark):
    row = lines.parse_access_log(
        lines_of(spark, "83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /images/a.png")
    ).first()
    assert (row.ip, row.method, row.url) == ("83.149.9.216", "GET", "/images/a.png")
    assert row.event_time.timestamp() == 1431857103


def test_severity_bounds(spark):
    df = spark.createDataFrame([(49,), (50,), (79,), (80,)], "vc int")
    got = df.select(columns.severity(F.col("vc")), columns.severity_tags(F.col("vc"))).collect()
    assert [r[0] for r in got] == ["normal", "warn", "warn", "alarm"]
    assert [r[1] for r in got] == [
        ["normal", "happy", "hi"], ["warn", "happy"], ["warn", "happy"], ["alarm"],
    ]


def test_split_and_select_counts(sensor):
    counts = {
        r["o"]: r["count"]
        for r in sensor.groupBy(columns.severity(F.col("vc")).alias("o")).count().collect()
    }
    assert counts == {"normal": 4, "warn": 3, "alarm": 2}
    assert routing.tagged(sensor, columns.severity_tags(F.col("vc")), "happy").count() == 7


def test_side_output_keeps_main_rows(sensor):
    main, alarms = routing.side_output(sensor, F.col("vc") > 5, F.lit("high"))
    assert (main.count(), alarms.count()) == (9, 9)


def test_shuffle_keeps_rows(sensor):
    assert sorted(routing.shuffle(sensor, 3).collect()) == sorted(sensor.collect())


def test_bitmap_position(spark):
    df = spark.createDataFrame([("543462",)], "u string")
    assert df.select(columns.bitmap_position(F.col("u"))).first()[0] == 398203944


def test_connect(sensor, spark):
    numbers = spark.createDataFrame([(1,), (2,)], "n int")
    got = joins.connect(sensor, numbers, F.col("id"), F.col("n") + 10)
    assert got.where("src = 'right'").agg(F.sort_array(F.collect_list("value"))).first()[0] == ["11", "12"]
    assert got.count() == 11


def test_messages_round_trip(sensor, spark):
    rows = sensor.select("id", F.unix_seconds("ts").alias("ts"), "vc")
    encoded = messages.encode_messages(rows, F.col("id"))
    log = encoded.select(
        F.col("key").cast("binary"), F.col("value").cast("binary"), F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"),
    )
    assert sorted(messages.decode_messages(log, schemas.SENSOR).collect()) == sorted(rows.collect())
    as_json = messages.encode_messages(rows, F.col("id"), as_json=True)
    assert as_json.where("value LIKE '{\"id\":\"s%'").count() == 9


def test_delimited_file_and_documents(sensor, spark):
    rows = sensor.select("id", F.unix_seconds("ts").alias("ts"), "vc")
    path = fresh_path(spark, "delimited")
    files.write_delimited(rows, path, "、")
    assert "s1、1549044122、10" in {r.value for r in spark.read.text(path).collect()}
    assert sorted(lines.read_delimited(spark, path, schemas.SENSOR, "、").collect()) == sorted(rows.collect())
    docs = fresh_path(spark, "docs")
    files.write_documents(lines_of(spark, "a,1"), docs)
    assert spark.read.text(docs).first().value == '{"data":"a,1"}'


def test_sql_insert_and_union(sensor, spark):
    path = fresh_path(spark, "table")
    files.create_delimited_table(spark, "readings_out", path, schemas.SENSOR, "|")
    sensor.createOrReplaceTempView("readings_in")
    spark.sql("INSERT INTO readings_out SELECT id, unix_seconds(ts), vc FROM readings_in")
    assert spark.table("readings_out").count() == 9
    twice = spark.sql("SELECT id FROM readings_in UNION SELECT id FROM readings_in")
    assert twice.count() == 3


def test_labelled_print(sensor, capsys):
    files.print_rows(sensor.limit(1), "sensor")
    assert "sensor" in capsys.readouterr().out


def test_keyed_table_last_write_wins_and_replay(spark):
    table = KeyedTable(spark, ["id"], ["seq"])
    make = lambda *rows: spark.createDataFrame(rows, "id string, v int, seq bigint")
    table.upsert_batch(make(("a", 1, 1), ("a", 2, 2), ("b", 9, 1)), 0)
    table.upsert_batch(make(("a", 5, 3)), 1)
    table.upsert_batch(make(("a", 6, 3)), 1)
    expected = [("a", 6, 3), ("b", 9, 1)]
    assert sorted(map(tuple, table.read().collect())) == expected


def test_lifecycle_runs_per_task(spark):
    df = spark.range(10).repartition(2)
    out = map_with_lifecycle(
        df, lambda: ["open"], lambda r, b: b.assign(state=r[0]), lambda r: r.clear(),
        "id bigint, state string",
    )
    assert out.where("state = 'open'").count() == 10


def test_user_aggregate_matches_builtin_on_hot_and_null_keys(spark):
    df = spark.range(20_000).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 101 = 0 THEN NULL"
               " ELSE concat('k', id % 700) END").alias("k"),
        "id",
    ).repartition(8)

    def add(batch):
        return batch.groupby("k", as_index=False, dropna=False).agg(n=("id", "size"), t=("id", "sum"))

    def merge(states):
        return states.groupby("k", as_index=False, dropna=False).agg(n=("n", "sum"), t=("t", "sum"))

    got = accumulate(df, ["k"], add, merge, "k string, n bigint, t bigint", flush_rows=100)
    want = df.groupBy("k").agg(F.count("id").alias("n"), F.sum("id").alias("t"))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_plan_text(sensor):
    text = plan_text(sensor.where("vc > 5"))
    assert "Physical Plan" in text and "Optimized Logical Plan" in text
