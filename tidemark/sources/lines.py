"""Text lines to typed records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.columns import literal_pattern, strict_cast

# Fixed value: time layout of an access-log line.
ACCESS_TIME = "dd/MM/yyyy:HH:mm:ss"


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def line_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Endless lines: every file that lands in ``path``."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)


def parse_delimited(
    lines: DataFrame, schema: T.StructType, separator: str = ",", column: str = "value"
) -> DataFrame:
    """Cast the fields of a line by position.

    A malformed number fails the job; an empty string field reads as NULL.
    Works on batch and streaming input.
    """
    fields = F.split(F.col(column), literal_pattern(separator))
    return lines.select(
        *[
            strict_cast(F.nullif(F.get(fields, position), F.lit("")), field.dataType.simpleString())
            .alias(field.name)
            for position, field in enumerate(schema.fields)
        ]
    )


def parse_access_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """Space-separated web access lines; times are UTC."""
    fields = F.split(F.col(column), " ")
    return lines.select(
        F.get(fields, 0).alias("ip"),
        F.get(fields, 1).alias("user_id"),
        F.to_timestamp(F.get(fields, 3), ACCESS_TIME).alias("event_time"),
        F.get(fields, 5).alias("method"),
        F.get(fields, 6).alias("url"),
    )


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType, separator: str = ","
) -> DataFrame:
    return (
        spark.read.schema(schema).option("sep", separator).option("mode", "FAILFAST").csv(path)
    )


def declare_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType, separator: str = ","
) -> DataFrame:
    """Name a delimited file as a table; columns bind by position."""
    read_delimited(spark, path, schema, separator).createOrReplaceTempView(name)
    return spark.table(name)
