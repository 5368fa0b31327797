"""Session set-up and the shared folder operators write to."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)
#: Where a single-process session without spark.checkpoint.dir remembers its folder.
OWN_DIR = "tidemark.sharedDir"


def build_session(
    app: str = "tidemark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Session with UTC time, adaptive execution and the on-disk state store.

    On a cluster ``master`` and ``shuffle_partitions`` are left to spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin(spark: SparkSession) -> SparkSession:
    """Runtime settings every operator relies on, for a session built elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # A run's progress is read every few seconds; so many batches do not pass between.
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1000")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's ``spark.checkpoint.dir``.

    Without that setting only a single-process session, where driver and executors are
    one, gets a folder of its own; anywhere else it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(OWN_DIR, None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set(OWN_DIR, folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below :func:`shared_dir` that nothing else uses."""
    return f"{shared_dir(spark)}/{label}-{uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared folder and read back: later uses do not compute it again,
    and a lost executor costs only the tasks it ran."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
