"""Ad clicks: counts, rankings, click-fraud filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.columns import epoch_day
from tidemark.operators.running import Sequence, running, tally
from tidemark.operators.topn import top_n
from tidemark.operators.windows import count_of, sliding, sum_of, tumbling
from tidemark.plans.traffic import hottest


def clicks_by_province(clicks: DataFrame, people: DataFrame) -> DataFrame:
    """Clicks are counted per user and ad before users meet their province (``people``)."""
    per_user = clicks.groupBy("user_id", "ad_id").agg(F.count(F.lit(1)).alias("cnt"))
    return (
        per_user.join(people, "user_id").groupBy("province", "ad_id")
        .agg(F.sum("cnt").alias("cnt"))
        .select(F.concat_ws("_", "province", "ad_id").alias("key"), "province", "ad_id", "cnt")
    )


def hot_ads_by_province(
    clicks: DataFrame, people: DataFrame, n: int = 3, size: str = "1 hour", slide: str = "5 minutes"
) -> DataFrame:
    """Clicks are reduced to one row per user, ad and pane before users meet their province."""
    panes = tumbling(clicks, ["user_id", "ad_id"], "ts", slide, cnt=count_of())
    placed = panes.join(people, "user_id").withColumnRenamed("window_start", "ts")
    counts = sliding(placed, ["province", "ad_id"], "ts", size, slide, cnt=sum_of("cnt"))
    return top_n(counts, ["window_end"], "cnt", ["province", "ad_id"], n).drop("window_start")


def hot_ads_by_user(clicks: DataFrame, n: int = 3, **window: str) -> DataFrame:
    return hottest(clicks, ["user_id", "ad_id"], n=n, **window)


def numbered_clicks(clicks: DataFrame, sequence: Sequence) -> DataFrame:
    """Clicks with ``nth``, their number within user, ad and UTC day."""
    daily = clicks.withColumn("day", epoch_day(F.col("ts")))
    return running(daily, ["user_id", "ad_id", "day"], sequence, nth=tally())


def blacklist_filter(
    clicks: DataFrame, sequence: Sequence, limit: int = 100
) -> tuple[DataFrame, DataFrame]:
    """Clicks that pass, and one alarm per user, ad and day that goes over the limit.

    Groups are counted first, map-side. Those within the limit pass as they are; only the
    clicks of the others are numbered.
    """
    group = ["user_id", "ad_id", "day"]
    daily = clicks.withColumn("day", epoch_day(F.col("ts")))
    over = (
        daily.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
        .select(*[F.col(c).alias(f"_{c}") for c in group])
    )
    same = F.lit(True)
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    numbered = numbered_clicks(daily.join(over, same, "left_semi").select(*clicks.columns), sequence)
    within = daily.join(over, same, "left_anti").select(*clicks.columns)
    passed = within.unionByName(numbered.where(F.col("nth") <= limit).select(*clicks.columns))
    alarms = numbered.where(F.col("nth") == limit + 1).select("user_id", "ad_id", "day", "ts")
    return passed, alarms
