"""Order payment checks and reconciliation with payment receipts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.durations import epoch_micros, micros
from tidemark.operators.joins import interval_join, reconcile
from tidemark.operators.patterns import followed_by, timed_out
from tidemark.operators.running import Sequence


def _created() -> Column:
    return F.col("event_type") == "create"


def _paid() -> Column:
    return F.col("event_type") == "pay"


def payment_status(orders: DataFrame, limit: str = "15 minutes") -> DataFrame:
    """One row per order: paid (up to and including the limit), paid_late, unpaid,
    or missing_create.
    """
    created, paid = F.col("created_us"), F.col("paid_us")
    return (
        orders.groupBy("order_id")
        .agg(
            F.min(F.when(_created(), epoch_micros("ts"))).alias("created_us"),
            F.min(F.when(_paid(), epoch_micros("ts"))).alias("paid_us"),
        )
        .where(created.isNotNull() | paid.isNotNull())
        .select(
            "order_id",
            F.when(created.isNull(), "missing_create")
            .when(paid.isNull(), "unpaid")
            .when(paid - created > micros(limit), "paid_late")
            .otherwise("paid")
            .alias("status"),
        )
    )


def paid_in_time(orders: DataFrame, sequence: Sequence, limit: str = "15 minutes") -> DataFrame:
    """Orders whose create is followed by a pay less than ``limit`` later."""
    elapsed = epoch_micros(F.col("second.ts")) - epoch_micros(F.col("first.ts"))
    return followed_by(orders, ["order_id"], sequence, _created(), _paid(), limit).select(
        "order_id",
        F.col("second.tx_id").alias("tx_id"),
        (elapsed / 1_000_000).cast("long").alias("elapsed_seconds"),
    )


def payment_timeouts(
    orders: DataFrame, sequence: Sequence, limit: str = "15 minutes"
) -> DataFrame:
    """Creates that no pay followed in time."""
    return timed_out(orders, ["order_id"], sequence, _created(), _paid(), limit)


def reconciled(
    orders: DataFrame,
    receipts: DataFrame,
    order_sequence: Sequence,
    receipt_sequence: Sequence,
    how: str = "inner",
) -> DataFrame:
    """Payments and receipts matched one to one on ``tx_id``."""
    return reconcile(orders, receipts, "tx_id", order_sequence, receipt_sequence, how)


def reconciled_within(
    orders: DataFrame, receipts: DataFrame, apart: str = "15 seconds"
) -> DataFrame:
    """Payment and receipt pairs at most ``apart`` from each other."""
    return interval_join(orders, receipts, "tx_id", "ts", apart, apart)
