"""Durations written like Spark intervals ("5 minutes"), as microseconds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Microseconds per unit.
UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def micros(duration: str) -> int:
    """``"90 seconds"`` -> 90000000; several parts add up."""
    parts = duration.split()
    if not parts or len(parts) % 2:
        raise ValueError(f"not a duration: {duration!r}")
    total = 0
    for amount, unit in zip(parts[::2], parts[1::2]):
        total += int(amount) * UNIT_MICROS[unit.lower().rstrip("s")]
    return total


def epoch_micros(ts: str | Column) -> Column:
    return F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)


def bucket(ts: str | Column, width: str) -> Column:
    """Number of the epoch-aligned slot of ``width`` that holds ``ts``."""
    return whole_part(epoch_micros(ts), micros(width))


def whole_part(number: Column, width: int) -> Column:
    """Floor division of integers, exact over the whole range and below zero."""
    step = F.lit(width).cast("long")
    down = F.when(F.pmod(number, step) > number % step, 1).otherwise(0)
    return F.call_function("div", number, step) - down
