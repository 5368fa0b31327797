"""Table and SQL interop that needs more than a DataFrame method."""

from __future__ import annotations

from pyspark.sql import DataFrame


def plan_text(df: DataFrame) -> str:
    """Parsed, analyzed, optimized and physical plan of a query."""
    return df.sparkSession.sql("EXPLAIN EXTENDED SELECT * FROM {df}", df=df).first()[0]
