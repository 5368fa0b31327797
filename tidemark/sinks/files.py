"""Delimited, document and table sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def labelled(df: DataFrame, label: str) -> DataFrame:
    """Rows with the output's label in front, as a labelled print shows them."""
    return df.select(F.lit(label).alias("label"), "*")


def print_rows(df: DataFrame, label: str = "", rows: int = 20) -> None:
    """Show rows on the console; a stream needs ``format("console")`` instead."""
    labelled(df, label).show(rows, truncate=False)


def write_delimited(df: DataFrame, path: str, separator: str = ",") -> None:
    """Delimited text; the separator may be several bytes long."""
    df.write.option("sep", separator).mode("append").csv(path)


def write_documents(df: DataFrame, path: str, line: str = "value") -> None:
    """Append one JSON document ``{"data": <line>}`` per row."""
    df.select(F.col(line).alias("data")).write.mode("append").json(path)


def create_delimited_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType, separator: str
) -> None:
    spark.catalog.createTable(name, path, source="csv", schema=schema, sep=separator)


def insert_into(df: DataFrame, table: str) -> None:
    """Append a query's rows to a declared table, by position."""
    df.write.insertInto(table)


def append_to_database(df: DataFrame, url: str, table: str, **properties: str) -> None:
    """Insert rows over one connection per task; batches of 1000 statements."""
    options = {"batchsize": "1000", **properties}
    df.write.format("jdbc").mode("append").option("url", url).option(
        "dbtable", table
    ).options(**options).save()
