"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import fresh_path

Query = Callable[[SparkSession, str], DataFrame]

# White space and words of the query contracts, as Java and RE2 patterns.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: How many ways the rows of one key are dealt. A key that holds a third of all rows
#: then has about a thousandth of them in any one group.
SALTS = 256

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str, **settings: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage and fixes the rows, so that later passes see the same ones and a
    lost executor costs only the tasks it ran. Shuffle files of the write are dropped
    when it ends; the table itself lives as long as the shared folder. ``settings`` hold
    for the write.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    settings = {CLEAN_UP: "true", **settings}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def salt(*columns: Column) -> Column:
    """A small number that deals the rows of one key evenly."""
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def stretch(text: Column, length: int, *by: Column) -> Column:
    """A text of at most ``length`` characters; of a longer one, as much from a place that the
    hash of ``by`` gives."""
    spare = F.greatest(F.length(text) - F.lit(length), F.lit(0))
    start = F.pmod(F.xxhash64(F.lit("stretch"), *by), (spare + 1).cast("long")).cast("int")
    return F.substring(text, start + 1, F.lit(length))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else unchanged."""
    return F.translate(text, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; -1 for a null id."""
    crc = F.crc32(F.col(column).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(divisor)), F.lit(-1))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows, so that little of a batch is ever held as Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
