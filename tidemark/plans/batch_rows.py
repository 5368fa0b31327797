"""Registered queries: sources, sinks, row transforms, routing, unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark import schemas
from tidemark.functions import columns
from tidemark.operators import accumulate, joins, routing
from tidemark.operators.running import by_number
from tidemark.plans.registry import VIEW, Tables, query
from tidemark.session import fresh_path
from tidemark.sinks import files, keyed
from tidemark.sources import lines, messages


# --- sources and parsing -------------------------------------------------------------


def sensor_rows(t: Tables) -> DataFrame:
    """Readings in the layout of a delimited sensor file."""
    return t.sensor().select(
        F.concat(F.lit("sensor_"), "id").alias("id"), F.unix_seconds("ts").alias("ts"), "vc"
    )


SENSOR_ROWS = "SELECT 'sensor_' || id AS id, us // 1000000 AS ts, vc FROM sensor"


def as_lines(df: DataFrame) -> DataFrame:
    """Comma-separated lines, NULL as an empty field."""
    return df.select(
        F.concat_ws(
            ",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
        ).alias("value")
    )


def exported(t: Tables, rows: DataFrame, label: str) -> str:
    path = fresh_path(t.spark, label)
    as_lines(rows).write.text(path)
    return path


@query(
    "a1_text_scan",
    "SELECT id || ',' || ts || ',' || vc AS value FROM rows",
    rows=SENSOR_ROWS,
)
def _(t):
    return lines.text_lines(t.spark, exported(t, sensor_rows(t), "lines"))


@query("a3_parse_sensor", SENSOR_ROWS)
def _(t):
    return lines.parse_delimited(as_lines(sensor_rows(t)), schemas.SENSOR)


@query(
    "a3_parse_behavior",
    "SELECT user_id, item_id, category_id, behavior, us // 1000000 AS ts FROM behavior",
    behavior="""SELECT user_id, CAST(k AS BIGINT) AS item_id, k % 10 AS category_id,
      event_type AS behavior, us, event_id FROM ev""",
)
def _(t):
    rows = t.behavior().select(
        "user_id", "item_id", "category_id", "behavior", F.unix_seconds("ts").alias("ts")
    )
    return lines.parse_delimited(as_lines(rows), schemas.BEHAVIOR)


@query(
    "a3_parse_ad_click",
    """SELECT user_id, CAST(ad_id AS BIGINT) AS ad_id, province, 'city' AS city,
       us // 1000000 AS ts FROM clicks""",
)
def _(t):
    rows = t.user_clicks().join(t.people(), "user_id").select(
        "user_id", "ad_id", "province", F.lit("city").alias("city"),
        F.unix_seconds("ts").alias("ts"),
    )
    return lines.parse_delimited(as_lines(rows), schemas.AD_CLICK)


@query(
    "a3_parse_order",
    """SELECT order_id, 'create' AS event_type, CAST(NULL AS VARCHAR) AS tx_id,
         us // 1000000 AS ts FROM created
       UNION ALL
       SELECT order_id, 'pay', 'tx' || order_id, us // 1000000 FROM paid""",
)
def _(t):
    rows = t.order_events().withColumn("ts", F.unix_seconds("ts"))
    return lines.parse_delimited(as_lines(rows), schemas.ORDER)


@query(
    "a3_parse_receipt",
    "SELECT 'tx' || tx_id AS tx_id, 'pay' || line AS pay_channel, us // 1000000 AS ts FROM receipts",
)
def _(t):
    rows = t.receipts().select(
        F.concat(F.lit("tx"), "tx_id").alias("tx_id"),
        F.concat(F.lit("pay"), "line").alias("pay_channel"),
        F.unix_seconds("ts").alias("ts"),
    )
    return lines.parse_delimited(as_lines(rows), schemas.RECEIPT)


@query(
    "a3_parse_login",
    """SELECT user_id, '10.0.0.' || (user_id % 256) AS ip, event_type, us // 1000000 AS ts
       FROM logins""",
)
def _(t):
    rows = t.logins().select(
        "user_id",
        F.concat(F.lit("10.0.0."), F.col("user_id") % 256).alias("ip"),
        "event_type",
        F.unix_seconds("ts").alias("ts"),
    )
    return lines.parse_delimited(as_lines(rows), schemas.LOGIN)


def access_log(t: Tables) -> DataFrame:
    """Access-log lines made from the events, parsed back to records."""
    raw = t.events().select(
        F.format_string(
            "10.0.0.%d u%d - %s +0000 GET /p/%d",
            F.col("user_id") % 256,
            "user_id",
            F.date_format("ts", lines.ACCESS_TIME),
            "k",
        ).alias("value")
    )
    return lines.parse_access_log(raw)


@query(
    "a4_access_log",
    """SELECT '10.0.0.' || (user_id % 256) AS ip, 'u' || user_id AS user_id,
         us // 1000000 * 1000000 AS event_time, 'GET' AS method, '/p/' || k AS url FROM ev""",
)
def _(t):
    return access_log(t)


@query("a6_message_decode", SENSOR_ROWS + " WHERE event_id >= 1000")
def _(t):
    log = t.sensor().select(
        F.col("id").cast("string").cast("binary").alias("key"),
        F.concat_ws(
            ",", F.concat(F.lit("sensor_"), "id"), F.unix_seconds("ts"), "vc"
        ).cast("binary").alias("value"),
        F.lit("sensor").alias("topic"),
        (F.col("id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )
    return messages.decode_messages(log, schemas.SENSOR, from_offset=1000)


@query(
    "a7_declared_table",
    "SELECT id AS name, ts AS at, vc AS level FROM rows",
    rows=SENSOR_ROWS,
)
def _(t):
    path = exported(t, sensor_rows(t), "declared")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    declared = lines.declare_table(t.spark, name, path, schema="name string, at bigint, level int")
    t.spark.catalog.dropTempView(name)
    return declared


# --- sinks ---------------------------------------------------------------------------


@query("b1_labelled_rows", "SELECT 'sensor' AS label, * FROM rows", rows=SENSOR_ROWS)
def _(t):
    return files.labelled(sensor_rows(t), "sensor")


@query("b2_delimited_sink", SENSOR_ROWS)
def _(t):
    path = fresh_path(t.spark, "delimited")
    files.write_delimited(sensor_rows(t), path, "、")
    return lines.read_delimited(t.spark, path, schemas.SENSOR, "、")


@query(
    "b3_message_encode",
    """SELECT id AS key, id || ',' || ts || ',' || vc AS value FROM rows""",
    rows=SENSOR_ROWS,
)
def _(t):
    return messages.encode_messages(sensor_rows(t), F.col("id"))


@query(
    "b4_keyed_upsert",
    """SELECT id, max_by(vc, event_id) AS vc, max(event_id) AS event_id FROM sensor GROUP BY id""",
)
def _(t):
    readings = t.sensor().select("id", "vc", "event_id")
    table = keyed.KeyedTable(t.spark, ["id"], ["event_id"])
    table.upsert_batch(readings.where("event_id % 2 = 1"), 0)
    table.upsert_batch(readings.where("event_id % 2 = 0"), 1)
    return table.read()


@query(
    "b5_document_sink",
    "SELECT id || ',' || ts || ',' || vc AS data FROM rows",
    rows=SENSOR_ROWS,
)
def _(t):
    path = fresh_path(t.spark, "documents")
    files.write_documents(as_lines(sensor_rows(t)), path)
    return t.spark.read.schema("data string").json(path)


@query("b7_table_insert", SENSOR_ROWS)
def _(t):
    path = fresh_path(t.spark, "table")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    files.create_delimited_table(t.spark, name, path, schemas.SENSOR, "|")
    files.insert_into(sensor_rows(t), name)
    t.spark.sql(f"DROP TABLE {name}")  # its rows stay in the folder
    return lines.read_delimited(t.spark, path, schemas.SENSOR, "|")


# --- projections, filters, row transforms ---------------------------------------------


@query("c1_map", "SELECT id, vc + 10 AS vc FROM sensor")
def _(t):
    return t.sensor().select("id", (F.col("vc") + 10).alias("vc"))


@query("c2_rich_map", "SELECT id, vc * 2 AS doubled, true AS opened FROM sensor")
def _(t):
    return accumulate.map_with_lifecycle(
        t.sensor().select("id", "vc"),
        open_task=lambda: {"open": True},
        map_batch=lambda task, batch: batch.assign(
            doubled=batch["vc"] * 2, opened=task["open"]
        )[["id", "doubled", "opened"]],
        close_task=lambda task: task.clear(),
        schema="id bigint, doubled int, opened boolean",
    )


@query(
    "c3_flat_map_words",
    """SELECT doc_id, word, CAST(1 AS INTEGER) AS one FROM (
         SELECT doc_id, unnest(CASE WHEN text <> '' AND rtrim(text, ' ') = '' THEN []
           ELSE string_split(rtrim(text, ' '), ' ') END) AS word FROM documents)""",
)
def _(t):
    return t.table("documents").select(
        "doc_id", F.explode(columns.tokens(F.col("text"))).alias("word"), F.lit(1).alias("one")
    )


@query(
    "c4_flat_map_list",
    "SELECT id, unnest([vc + 10, CAST(event_id AS INTEGER) + 10]) AS x FROM sensor",
)
def _(t):
    return t.sensor().select(
        "id",
        F.explode(
            F.transform(F.array("vc", F.col("event_id").cast("int")), lambda x: x + 10)
        ).alias("x"),
    )


@query(
    "c5_filter",
    """SELECT event_id, event_type, k FROM ev
       WHERE k % 2 = 0 AND event_type IN ('view', 'error')""",
)
def _(t):
    return (
        t.events()
        .where((F.col("k") % 2 == 0) & F.col("event_type").isin("view", "error"))
        .select("event_id", "event_type", "k")
    )


@query(
    "c6_filter_and_project",
    "SELECT 'pv' AS key, CAST(1 AS INTEGER) AS one FROM pv",
)
def _(t):
    return t.behavior().where(F.col("behavior") == VIEW).select(
        F.lit("pv").alias("key"), F.lit(1).alias("one")
    )


@query("c7_constant_key", "SELECT 'uv' AS key, count(DISTINCT user_id) AS uv FROM pv")
def _(t):
    return (
        t.behavior()
        .where(F.col("behavior") == VIEW)
        .agg(F.count_distinct("user_id").alias("uv"))
        .select(F.lit("uv").alias("key"), "uv")
    )


@query(
    "c8_concatenated_key",
    "SELECT channel || '_' || behavior AS key, count(*) AS cnt FROM marketing GROUP BY channel, behavior",
)
def _(t):
    return (
        t.marketing()
        .groupBy("channel", "behavior")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select(F.concat_ws("_", "channel", "behavior").alias("key"), "cnt")
    )


@query(
    "c9_composite_key",
    "SELECT user_id, ad_id, count(*) AS cnt FROM clicks GROUP BY user_id, ad_id",
)
def _(t):
    return t.user_clicks().groupBy("user_id", "ad_id").agg(F.count(F.lit(1)).alias("cnt"))


@query("c10_rename", "SELECT id, us AS timestamp FROM sensor")
def _(t):
    return t.sensor().select("id", F.col("ts").alias("timestamp"))


@query("c11_expression_filter", "SELECT id, us AS ts, vc FROM sensor WHERE id = 8")
def _(t):
    return t.sensor().where("id = 8").select("id", "ts", "vc")


@query("c12_sql_select_where", "SELECT * FROM sensor WHERE id = 8 AND vc >= 50")
def _(t):
    return t.spark.sql(
        "SELECT id, ts AS us, vc, event_id FROM {s} WHERE id = 8 AND vc >= 50", s=t.sensor()
    )


@query(
    "c13_event_time",
    "SELECT id, us // 1000000 * 1000000 AS from_seconds, us // 1000 * 1000 AS from_millis FROM sensor",
)
def _(t):
    return t.sensor().select(
        "id",
        F.timestamp_seconds(F.unix_seconds("ts")).alias("from_seconds"),
        F.timestamp_millis(F.unix_millis("ts")).alias("from_millis"),
    )


@query(
    "c14_message_rows",
    "SELECT id, us // 1000000 AS at, vc, 'key=' || id || ', ts=' || (us // 1000000) || ', vc=' || vc AS message FROM sensor",
)
def _(t):
    return t.sensor().select(
        "id",
        F.unix_seconds("ts").alias("at"),
        "vc",
        F.format_string("key=%d, ts=%d, vc=%d", "id", F.unix_seconds("ts"), "vc").alias("message"),
    )


# --- partitioning, routing, side outputs ----------------------------------------------


@query("d1_key_by", "SELECT id, min(vc) AS low, max(vc) AS high FROM sensor GROUP BY id")
def _(t):
    return t.sensor().groupBy("id").agg(F.min("vc").alias("low"), F.max("vc").alias("high"))


@query("d2_shuffle", "SELECT id, us AS ts, vc, event_id FROM sensor")
def _(t):
    return routing.shuffle(t.sensor(), t.spark.sparkContext.defaultParallelism)


SEVERITY = "CASE WHEN vc < 50 THEN 'normal' WHEN vc < 80 THEN 'warn' ELSE 'alarm' END"


@query("d3_split", f"SELECT id, vc, {SEVERITY} AS output FROM sensor")
def _(t):
    return t.sensor().select("id", "vc", columns.severity(F.col("vc")).alias("output"))


@query("d4_select_tag", "SELECT id, vc, event_id FROM sensor WHERE vc < 80")
def _(t):
    return routing.tagged(t.sensor(), columns.severity_tags(F.col("vc")), "happy").select(
        "id", "vc", "event_id"
    )


@query(
    "d5_side_output",
    """SELECT 'alarm' AS output, 'vc=' || vc AS text FROM sensor WHERE vc > 5
       UNION ALL SELECT 'main', CAST(id AS VARCHAR) FROM sensor""",
)
def _(t):
    main, alarms = routing.side_output(
        t.sensor(), F.col("vc") > 5, F.concat(F.lit("vc="), "vc")
    )
    return alarms.select(F.lit("alarm").alias("output"), F.col("message").alias("text")).unionByName(
        main.select(F.lit("main").alias("output"), F.col("id").cast("string").alias("text"))
    )


# --- unions and two-input maps ----------------------------------------------------------


@query(
    "e1_union_all",
    """SELECT id, vc FROM sensor UNION ALL SELECT id, vc FROM sensor
       UNION ALL SELECT user_id, k FROM ev""",
)
def _(t):
    readings = t.sensor().select("id", "vc")
    third = t.events().select(F.col("user_id").alias("id"), F.col("k").alias("vc"))
    return readings.unionByName(readings).unionByName(third)


@query("e2_union_distinct", "SELECT id, vc FROM sensor UNION SELECT user_id, k FROM ev")
def _(t):
    other = t.events().select("user_id", "k")
    return t.sensor().select("id", "vc").union(other).distinct()


@query(
    "e3_connect",
    """SELECT 'left' AS src, 'sensor ' || id AS value FROM sensor
       UNION ALL SELECT 'right', CAST(k + 10 AS VARCHAR) FROM ev""",
)
def _(t):
    return joins.connect(
        t.sensor(), t.events(), F.concat(F.lit("sensor "), "id"), F.col("k") + 10
    )


# --- watermarks over arrival order ------------------------------------------------------


@query(
    "k7_late_rows",
    """SELECT event_id, late FROM (
         SELECT event_id, coalesce((us // 10800000000 + 1) * 10800000000 + 3600000000 <=
           max(us) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
             - 3600000000, false) AS late FROM arrived)""",
    arrived="SELECT event_id, us, CASE WHEN event_id % 7 = 3 THEN event_id + 200 ELSE event_id END * 2 + (event_id % 7 = 3)::INT AS arrival FROM ev",
)
def _(t):
    """Every seventh event is held back by 200 places."""
    held = F.col("event_id") % 7 == 3
    arrival = F.when(held, F.col("event_id") + 200).otherwise(F.col("event_id")) * 2
    arrived = t.events().select(
        "event_id", "ts", (arrival + held.cast("int")).alias("arrival")
    )
    marked = routing.lateness(
        arrived, by_number("arrival", 100_000), "ts", "3 hours", "1 hour", allowed="1 hour"
    )
    return marked.select("event_id", "late")


@query(
    "k8_watermark_column",
    """SELECT id, event_id, max(us) OVER (ORDER BY event_id) - 3000000 AS watermark FROM sensor""",
)
def _(t):
    marked = routing.watermarks(
        t.sensor(), by_number("event_id", 100_000), "ts", "3 seconds", "watermark"
    )
    return marked.select("id", "event_id", "watermark")
