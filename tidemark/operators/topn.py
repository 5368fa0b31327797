"""Best rows per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def top_n(
    df: DataFrame, group: list[str], by: str, ties: list[str], n: int = 3, rank: str = "rank"
) -> DataFrame:
    """The ``n`` rows of each group with the largest ``by``; ties go by ``ties`` ascending.

    Groups with fewer rows give what they have. Tasks keep only their own best ``n``
    per group before the shuffle.
    """
    order = Window.partitionBy(*group).orderBy(F.col(by).desc(), *ties)
    return df.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= n)
