"""Named queries over the driver's tables, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.durations import epoch_micros
from tidemark.session import OWN_DIR, fresh_path, pin, shared_dir
from tidemark.sources.landing import land

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


# The event types that stand for a page view and a failed login.
VIEW = "view"
FAILED = "error"


#: Tables that are streamed, and the time that a slice of them holds when they are landed
#: in order: how far behind its newest row a row may come, and what a micro-batch reads.
SLICES = {"events": "8 days", "orders": "400 days", "lineitem": "400 days"}
#: Slices that a micro-batch reads; what a micro-batch costs besides its rows is paid less often.
SLICES_PER_BATCH = 2
# Fixed value: the time of the row that ends a bounded stream.
FAR = "2200-01-01 00:00:00"
#: Session setting: files that a micro-batch takes.
FILES_PER_TRIGGER = "tidemark.filesPerTrigger"


class Ended:
    """Rows landed in order of time, as a stream that can be ended.

    Beside the landed files it reads a folder that stays empty until ``end`` lands one row
    far ahead in time there. The row moves the watermark past all others, so open windows
    and timers come out; its own never do.
    """

    def __init__(self, tables: Tables, rows: DataFrame, by: str, width: str, /, **last: Column):
        self.spark, self.schema, self.last = tables.spark, rows.schema, last
        self.path = fresh_path(tables.spark, "end")
        self.spark.createDataFrame([], self.schema).write.parquet(self.path)
        end = tables.streams.readStream.schema(self.schema).parquet(self.path)
        self.rows = land(rows, by, width).stream(tables.streams, SLICES_PER_BATCH).unionByName(end)

    def end(self) -> None:
        columns = [
            self.last.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema.fields
        ]
        self.spark.range(1).select(*columns).write.mode("append").parquet(self.path)


class Tables:
    """The driver's Parquet tables and the views the analyses read."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = pin(spark)
        self.folder = folder
        self._streams: SparkSession | None = None

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def streams(self) -> SparkSession:
        """A session of the same application for streams, with settings of its own.

        State partitions stay as they are for the life of a checkpoint, so they follow
        from the input, two for each file, and not from the executors of the moment.
        """
        if self._streams is None:
            folder = shared_dir(self.spark)
            self._streams = pin(self.spark.newSession())
            self._streams.conf.set(OWN_DIR, folder)
            files = max(len(self.table(n).inputFiles()) for n in SLICES)
            most = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            self._streams.conf.set("spark.sql.shuffle.partitions", str(min(most, max(8, 2 * files))))
        return self._streams

    def stream(self, name: str) -> DataFrame:
        """The same table as a stream of its files."""
        return (
            self.streams.readStream.schema(self.table(name).schema)
            .option("maxFilesPerTrigger", self.spark.conf.get(FILES_PER_TRIGGER, "1000"))
            .parquet(f"{self.folder}/{name}.parquet*")
        )

    def landed(self, name: str, ts: str) -> DataFrame:
        """The table as a stream in order of time."""
        return land(self.table(name), ts, SLICES[name]).stream(self.streams, SLICES_PER_BATCH)

    def ended_events(self, event_type: str, *columns: str, only: Column | None = None) -> Ended:
        """The events as a stream that ends with one event of that type and no user.

        ``columns`` and ``only`` tell what is landed of them, if not everything.
        """
        last = {"ts": F.lit(FAR).cast("timestamp"), "event_type": F.lit(event_type), "value": F.lit(0.0)}
        rows = self.table("events") if only is None else self.table("events").where(only)
        return Ended(self, rows.select(*columns or rows.columns), "ts", SLICES["events"], **last)

    @staticmethod
    def as_events(raw: DataFrame) -> DataFrame:
        return raw.select(
            "event_id",
            F.col("ts").cast("timestamp").alias("ts"),
            "user_id",
            "event_type",
            "value",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
        )

    def events(self) -> DataFrame:
        return self.as_events(self.table("events"))

    def sensor(self, raw: DataFrame | None = None) -> DataFrame:
        raw = self.table("events") if raw is None else raw
        return raw.select(
            F.col("user_id").alias("id"), F.col("ts").cast("timestamp").alias("ts"),
            F.col("value").cast("int").alias("vc"), "event_id",
        )

    def behavior(self, raw: DataFrame | None = None) -> DataFrame:
        """User behavior; ``VIEW`` events are the page views."""
        events = self.events() if raw is None else self.as_events(raw)
        return events.select(
            "user_id",
            F.col("k").alias("item_id"),
            (F.col("k") % 10).alias("category_id"),
            F.col("event_type").alias("behavior"),
            "ts",
            "event_id",
        )

    def marketing(self) -> DataFrame:
        return self.events().select(
            F.col("event_type").alias("behavior"), (F.col("k") % 4).alias("channel")
        )

    def people(self) -> DataFrame:
        """Users and their province; the nation table is fixed in size."""
        return (
            self.table("customer")
            .join(F.broadcast(self.table("nation")), F.expr("c_nationkey = n_nationkey"))
            .select(F.col("c_custkey").alias("user_id"), F.col("n_name").alias("province"))
        )

    def user_clicks(self) -> DataFrame:
        """Ad clicks; the province is a property of the user."""
        return self.events().select("user_id", F.col("k").alias("ad_id"), "ts", "event_id")

    def logins(self, raw: DataFrame | None = None) -> DataFrame:
        """Login attempts; ``FAILED`` events are the failures."""
        raw = self.table("events") if raw is None else raw
        return raw.select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "event_id")

    def order_events(self) -> DataFrame:
        """A create per order and a pay at the order's first shipment."""
        created = self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.lit("create").alias("event_type"),
            F.lit(None).cast("string").alias("tx_id"),
            F.col("o_orderdate").cast("timestamp").alias("ts"),
        )
        paid = (
            self.table("lineitem")
            .groupBy(F.col("l_orderkey").alias("order_id"))
            .agg(F.min("l_shipdate").cast("timestamp").alias("ts"))
            .select(
                "order_id",
                F.lit("pay").alias("event_type"),
                F.concat(F.lit("tx"), "order_id").alias("tx_id"),
                "ts",
            )
        )
        return created.unionByName(paid)

    def payments(self) -> DataFrame:
        """Order dates as the payment side of a reconciliation."""
        return self.table("orders").select(
            F.col("o_orderkey").alias("tx_id"), F.col("o_orderdate").cast("timestamp").alias("ts")
        )

    def receipts(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("tx_id"),
            F.col("l_shipdate").cast("timestamp").alias("ts"),
            F.col("l_linenumber").alias("line"),
            F.col("l_partkey").alias("part"),
        )


# The same views for the SQL side; ``us`` is epoch microseconds.
SQL_VIEWS = {
    "ev": """SELECT event_id, ts, epoch_us(ts) AS us, user_id, event_type, value,
      CAST(props->>'$.k' AS INTEGER) AS k FROM events""",
    "sensor": """SELECT user_id AS id, us, CAST(floor(value) AS INTEGER) AS vc, event_id
      FROM ev""",
    "behavior": """SELECT user_id, k AS item_id, k % 10 AS category_id,
      event_type AS behavior, us, event_id FROM ev""",
    "pv": "SELECT * FROM behavior WHERE behavior = 'view'",
    "marketing": "SELECT event_type AS behavior, k % 4 AS channel FROM ev",
    "clicks": """SELECT user_id, k AS ad_id, us, event_id, n_name AS province FROM ev
      JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "logins": "SELECT user_id, us, event_id, event_type FROM ev",
    "created": "SELECT o_orderkey AS order_id, epoch_us(o_orderdate) AS us FROM orders",
    "paid": """SELECT l_orderkey AS order_id, min(epoch_us(l_shipdate)) AS us FROM lineitem
      GROUP BY 1""",
    "payments": "SELECT o_orderkey AS tx_id, epoch_us(o_orderdate) AS us FROM orders",
    "receipts": """SELECT l_orderkey AS tx_id, epoch_us(l_shipdate) AS us,
      l_linenumber AS line, l_partkey AS part FROM lineitem""",
}

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR


def sql(body: str, **views: str) -> str:
    """A SQL statement that may read any of the views above, or extra ones given."""
    all_views = {**SQL_VIEWS, **views}
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({q})" for n, q in all_views.items()) + "\n" + body


def plain(df: DataFrame) -> DataFrame:
    """Timestamps as epoch microseconds, so results compare across engines."""
    return df.select(
        *[
            epoch_micros(f.name).alias(f.name) if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(name: str, oracle: str | None = None, **views: str):
    """Register a function of :class:`Tables` as a named query."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, folder: plain(build(Tables(spark, folder)))
        if oracle is not None:
            ORACLES[name] = sql(oracle, **views)
        return build

    return register
