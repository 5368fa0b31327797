"""Unique visitors per time window: exact, approximate, by bitmap."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import bitmap_position


def _bounds(df: DataFrame, name: str) -> DataFrame:
    return df.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), name
    )


def windowed_distinct(
    df: DataFrame, ts: str, size: str, value: str, name: str = "uv"
) -> DataFrame:
    """Exact distinct values per window; duplicates are removed map-side first."""
    return _bounds(
        df.groupBy(F.window(ts, size).alias("_w")).agg(F.count_distinct(value).alias(name)), name
    )


def windowed_distinct_stream(
    df: DataFrame, ts: str, size: str, value: str, name: str = "uv"
) -> DataFrame:
    """The streaming form: deduplicate on (window, value), then count.

    ``df`` needs a watermark on ``ts``; the counts come out in update mode.
    """
    seen = df.select(F.window(ts, size).alias("_w"), value).dropDuplicates(["_w", value])
    return _bounds(seen.groupBy("_w").agg(F.count(value).alias(name)), name)


def windowed_approx(
    df: DataFrame, ts: str, size: str, value: str, rsd: float = 0.01, name: str = "uv"
) -> DataFrame:
    """Distinct values within a relative error, from a constant-size sketch."""
    return _bounds(
        df.groupBy(F.window(ts, size).alias("_w")).agg(
            F.approx_count_distinct(value, rsd).alias(name)
        ),
        name,
    )


@dataclass(frozen=True)
class Bloom:
    """Size of a filter for so many values at such a rate of false positives.

    A value sets ``hashes`` of ``bits`` bits. Positions come from products and remainders
    of small numbers, which any SQL engine computes alike.
    """

    bits: int
    hashes: int

    @classmethod
    def sized(cls, expected: int, rate: float) -> Bloom:
        bits = math.ceil(-expected * math.log(rate) / math.log(2) ** 2)
        return cls(bits, max(1, round(bits / expected * math.log(2))))

    # Multipliers and the prime modulus of two Lehmer generators.
    MODULUS, FIRST, STEP = 2_147_483_647, 48_271, 69_621

    def positions(self, value: Column) -> Column:
        """The bits of a value, as an array."""
        start = bitmap_position(value)
        first, step = ((start + 1) * F.lit(by) % self.MODULUS for by in (self.FIRST, self.STEP))
        return F.transform(
            F.sequence(F.lit(0), F.lit(self.hashes - 1)), lambda i: (first + i * step) % self.bits
        )

    def estimate(self, set_bits: Column) -> Column:
        """Number of values behind so many set bits, rounded; a full filter stands for the most it can tell."""
        free = F.greatest(1 - set_bits / F.lit(float(self.bits)), F.lit(0.5 / self.bits))
        return F.floor(-F.lit(self.bits / self.hashes) * F.log(free) + 0.5).cast("long")

    def at_least(self, set_bits: Column) -> Column:
        """What the number of values is never below."""
        return F.ceil(set_bits / self.hashes).cast("long")


def windowed_bloom(df: DataFrame, ts: str, size: str, value: str, bloom: Bloom, name: str = "uv") -> DataFrame:
    """Values per window from a Bloom filter: window, bits set, the estimate and a number that
    is never too high.

    A filter is built in pieces of 4 KB, each from partial pieces that are merged by OR, so
    the pieces of one window spread over tasks and a window costs at most the filter's size
    however many rows it has. A stream needs a watermark; its windows come out as they close.
    """
    # A filter on the value itself would be pushed below a stream's watermark, and rows without
    # a value would no longer move it.
    places = F.when(F.col(value).isNotNull(), bloom.positions(F.col(value)))
    bits = (
        df.select(F.window(ts, size).alias("_w"), F.explode_outer(places).alias("_p"))
        .where(F.col("_p").isNotNull())
        .groupBy("_w", F.bitmap_bucket_number("_p").alias("_piece"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_p")).alias("_bits"))
        .groupBy("_w").agg(F.sum(F.bitmap_count("_bits")).alias("bits"))
    )
    return bits.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "bits",
        bloom.estimate(F.col("bits")).alias(name), bloom.at_least(F.col("bits")).alias("at_least"),
    )


def windowed_bitmap(df: DataFrame, ts: str, size: str, value: str, name: str = "uv") -> DataFrame:
    """Distinct bit positions of the hashed values, in maps of 2^30 bits per window.

    Maps are built in 4 KB pieces, so a window costs at most 128 MB however many rows
    it holds, and pieces of one window spread over tasks.
    """
    position = bitmap_position(F.col(value))
    pieces = (
        df.where(F.col(value).isNotNull())
        .select(F.window(ts, size).alias("_w"), position.alias("_p"))
        .groupBy("_w", F.bitmap_bucket_number("_p").alias("_piece"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_p")).alias("_bits"))
    )
    return _bounds(
        pieces.groupBy("_w").agg(F.sum(F.bitmap_count("_bits")).alias(name)), name
    )


def windowed_positions(
    df: DataFrame, ts: str, size: str, value: str, name: str = "uv"
) -> DataFrame:
    """The same number without maps; cheaper while a window has few visitors."""
    return _bounds(
        df.groupBy(F.window(ts, size).alias("_w")).agg(
            F.count_distinct(bitmap_position(F.col(value))).alias(name)
        ),
        name,
    )
