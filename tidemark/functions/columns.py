"""Scalar expressions used across the analyses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Multiplier and 2^30 position space of the visitor bitmap.
POSITION_MULTIPLIER = 61
POSITION_MASK = (1 << 30) - 1


def literal_pattern(text: str) -> str:
    """Regular expression for a literal; one character stays one, which splits fastest."""
    if len(text) > 1:
        return "\\Q" + text + "\\E"
    return "\\" + text if text in ".$|()[{^?*+\\" else text


def tokens(value: Column, separator: str = " ") -> Column:
    """Split on one separator; inner empty tokens stay, trailing ones go.

    An empty line is one empty token, a line of separators only has none.
    """
    literal = literal_pattern(separator)
    if len(separator) == 1:
        trimmed = F.rtrim(value, F.lit(separator))
    else:
        trimmed = F.regexp_replace(value, f"(?:{literal})+$", "")
    return F.when((value != "") & (trimmed == ""), F.array().cast("array<string>")).otherwise(
        F.split(trimmed, literal)
    )


def strict_cast(value: Column, kind: str) -> Column:
    """Cast that fails the job on a malformed value, whatever the ANSI setting."""
    return F.coalesce(
        value.try_cast(kind),
        F.when(
            value.isNotNull(),
            F.raise_error(F.concat(F.lit(f"not a {kind}: "), value.cast("string"))).cast(kind),
        ),
    )


def bitmap_position(value: Column) -> Column:
    """Position of a value in a 2^30-bit map, from its decimal text."""
    return F.aggregate(
        F.split(value.cast("string"), ""),
        F.lit(0).cast("long"),
        lambda h, c: (h * POSITION_MULTIPLIER + F.ascii(c)).bitwiseAND(F.lit(POSITION_MASK)),
    )


def severity(level: Column, warn_from: int = 50, alarm_from: int = 80) -> Column:
    return (
        F.when(level < warn_from, "normal").when(level < alarm_from, "warn").otherwise("alarm")
    )


def severity_tags(level: Column, warn_from: int = 50, alarm_from: int = 80) -> Column:
    """Every output a reading is routed to; a reading may belong to several."""
    return (
        F.when(level < warn_from, F.array(F.lit("normal"), F.lit("happy"), F.lit("hi")))
        .when(level < alarm_from, F.array(F.lit("warn"), F.lit("happy")))
        .otherwise(F.array(F.lit("alarm")))
    )


def epoch_day(ts: Column) -> Column:
    return F.unix_date(F.to_date(ts))
