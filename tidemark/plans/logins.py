"""Repeated login failures."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.durations import epoch_micros, micros
from tidemark.operators.patterns import strict_next
from tidemark.operators.running import Sequence, preceding, running


def repeated_failures(
    logins: DataFrame, arrival: Sequence, apart: str = "2 seconds", failed: str = "fail"
) -> DataFrame:
    """Failures at most ``apart`` (inclusive) from the user's previous failure.

    Only failures are looked at, in order of arrival; times may run backwards.
    """
    fails = logins.where(F.col("event_type") == failed)
    seen = running(fails, ["user_id"], arrival, previous_ts=preceding(F.col("ts")))
    distance = F.abs(epoch_micros("ts") - epoch_micros("previous_ts"))
    return seen.where(distance <= micros(apart))


def consecutive_failures(
    logins: DataFrame, sequence: Sequence, within: str = "2 seconds", failed: str = "fail"
) -> DataFrame:
    """Two failures in a row in event time, less than ``within`` apart."""
    fail = F.col("event_type") == failed
    return strict_next(logins, ["user_id"], sequence, fail, fail, within)
