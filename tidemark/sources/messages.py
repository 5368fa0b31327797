"""Message-log records: the columns of ``format("kafka")`` to records and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.sources.lines import parse_delimited


def decode_messages(
    messages: DataFrame, schema: T.StructType, from_offset: int = 0, separator: str = ","
) -> DataFrame:
    """Payload text of every message at or after ``from_offset``, parsed by position."""
    lines = messages.where(F.col("offset") >= from_offset).select(
        F.col("value").cast("string").alias("value")
    )
    return parse_delimited(lines, schema, separator)


def encode_messages(
    df: DataFrame, key: Column, as_json: bool = False, separator: str = ","
) -> DataFrame:
    """One ``(key, value)`` text message per row, as delimited text or JSON."""
    row = F.struct(*df.columns)
    payload = F.to_json(row) if as_json else F.to_csv(row, {"sep": separator})
    return df.select(key.cast("string").alias("key"), payload.alias("value"))
