import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.session import build_session  # noqa: E402

BASE = 1549044120


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        app="tests",
        master="local[4]",
        shuffle_partitions=2,
        **{
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


# Nine readings: (sensor, seconds after BASE, level).
READINGS = [
    ("s1", 2, 10), ("s1", 3, 20), ("s1", 4, 30), ("s2", 5, 40), ("s1", 6, 50),
    ("s2", 7, 60), ("s1", 8, 70), ("s3", 9, 80), ("s3", 10, 90),
]


@pytest.fixture(scope="session")
def sensor(spark):
    rows = [(i, BASE + s, v, n) for n, (i, s, v) in enumerate(READINGS)]
    return spark.createDataFrame(rows, "id string, s bigint, vc int, event_id bigint").select(
        "id", F.timestamp_seconds("s").alias("ts"), "vc", "event_id"
    )


def offset(ts):
    """Seconds after BASE of a collected timestamp."""
    return ts.timestamp() - BASE


def skewed_events(seed, n=400, keys=6, span=4000, ties=True):
    """(key, second, value, event_id) rows; one key holds half of them, some are NULL."""
    rng = random.Random(seed)
    rows = []
    for event_id in range(n):
        key = 0 if rng.random() < 0.5 else rng.choice([None, *range(1, keys)])
        second = rng.randrange(1, span)
        if not ties:
            second = second * 1000 + event_id
        rows.append((key, second, rng.randrange(0, 100), event_id))
    return rows


def as_frame(spark, rows):
    return spark.createDataFrame(rows, "k bigint, s bigint, v int, event_id bigint").select(
        "k", F.timestamp_seconds("s").alias("ts"), "v", "event_id", "s"
    )


def by_key(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[1], r[3])):
        groups.setdefault(row[0], []).append(row)
    return groups
