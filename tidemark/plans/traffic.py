"""Page views, unique visitors, hot items and hot pages.

``view`` is the behavior that counts as a page view; it stays a plain column
comparison so the scan can skip other rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.running import Sequence, running, running_distinct, tally
from tidemark.operators.topn import top_n
from tidemark.operators.windows import count_of, sliding, tumbling


PAGE_VIEW = "pv"


def only(behavior: DataFrame, view: str = PAGE_VIEW) -> DataFrame:
    return behavior.where(F.col("behavior") == view)


def page_views(behavior: DataFrame, view: str = PAGE_VIEW) -> DataFrame:
    """Total page views, as a one-row keyed result."""
    return (
        only(behavior, view)
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select(F.lit("pv").alias("key"), "cnt")
    )


def page_views_so_far(
    behavior: DataFrame, sequence: Sequence, view: str = PAGE_VIEW
) -> DataFrame:
    return running(only(behavior, view), [], sequence, cnt=tally())


def hourly_page_views(
    behavior: DataFrame, size: str = "1 hour", view: str = PAGE_VIEW
) -> DataFrame:
    return tumbling(only(behavior, view), [], "ts", size, cnt=count_of())


def visitors_so_far(
    behavior: DataFrame, sequence: Sequence, view: str = PAGE_VIEW
) -> DataFrame:
    """Unique page-view visitors after each view."""
    return running_distinct(only(behavior, view), [], "user_id", sequence, "uv")


def windowed_visitors_so_far(
    behavior: DataFrame, sequence: Sequence, size: str = "1 hour", view: str = PAGE_VIEW
) -> DataFrame:
    """Unique visitors of the current window after each view: a result per row."""
    views = only(behavior, view).withColumn("window_start", F.window("ts", size)["start"])
    return running_distinct(views, ["window_start"], "user_id", sequence, "uv")


def hottest(
    df: DataFrame,
    keys: list[str],
    ts: str = "ts",
    size: str = "1 hour",
    slide: str = "5 minutes",
    n: int = 3,
) -> DataFrame:
    """The ``n`` keys with most rows in every sliding window, ranked across all keys."""
    counts = sliding(df, keys, ts, size, slide, cnt=count_of())
    return top_n(counts, ["window_end"], "cnt", keys, n).drop("window_start")


def hot_items(
    behavior: DataFrame, n: int = 3, view: str = PAGE_VIEW, **window: str
) -> DataFrame:
    return hottest(only(behavior, view), ["item_id"], n=n, **window)


def hot_pages(access_log: DataFrame, n: int = 3, **window: str) -> DataFrame:
    return hottest(access_log, ["url"], "event_time", n=n, **window)


def hot_items_sql(behavior: DataFrame, n: int = 3, view: str = PAGE_VIEW) -> DataFrame:
    """The same ranking as one SQL statement over sliding windows of panes."""
    return behavior.sparkSession.sql(
        """
        WITH panes AS (
          SELECT item_id, w.start AS pane, count(*) AS cnt
          FROM (SELECT item_id, window(ts, '5 minutes') AS w
                FROM {behavior} WHERE behavior = {view})
          GROUP BY item_id, w.start),
        counts AS (
          SELECT item_id, window_end, sum(cnt) AS cnt
          FROM panes LATERAL VIEW explode(sequence(
            pane + INTERVAL 5 MINUTES, pane + INTERVAL 1 HOUR, INTERVAL 5 MINUTES)) AS window_end
          GROUP BY item_id, window_end),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS rank
          FROM counts)
        SELECT item_id, window_end, cnt, rank FROM ranked WHERE rank <= {n}
        """,
        behavior=behavior,
        n=n,
        view=view,
    )
