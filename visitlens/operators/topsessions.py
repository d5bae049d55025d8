"""Most active sessions per top category: per-session clicks (A9), join to the top list (J5),
grouped top-N (K2) and their detail rows (J6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlens.operators.sessions import detail_rows
from visitlens.plans.physical import broadcast_if_bounded


def session_category_clicks(detail: DataFrame) -> DataFrame:
    """Clicks per (session, category), partial-aggregated map-side."""
    return (
        detail.where(F.col("click_category_id").isNotNull())
        .groupBy("session_id", F.col("click_category_id").alias("category_id"))
        .agg(F.count(F.lit(1)).alias("click_count"))
    )



def top_sessions(clicks: DataFrame, top_categories: DataFrame, task_id: int, n: int, n_categories: int) -> DataFrame:
    """K2: for each top category the n sessions with most clicks on it (session id breaks ties).

    The top-category list has at most ``n_categories`` rows, so it is broadcast. The filter on
    ``row_number <= n`` (a literal) lets Spark insert a partial WindowGroupLimit before the
    shuffle: each map task forwards at most n rows per category, so even a category clicked in a
    third of all sessions never sends more than n x tasks rows to the one reducer that owns it.
    """
    cats = broadcast_if_bounded(top_categories.select("category_id"), n_categories)
    joined = clicks.join(cats, "category_id", "inner")
    w = Window.partitionBy("category_id").orderBy(F.col("click_count").desc(), F.col("session_id").asc())
    ranked = joined.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    return ranked.select(F.lit(task_id).cast("bigint").alias("task_id"), "category_id", "session_id", "click_count")


def top_session_detail(
    top: DataFrame, detail: DataFrame, task_id: int, row_bound: int, distinct: bool = False
) -> DataFrame:
    """Detail rows of the top sessions.

    By default an inner join on session_id: a session that is top in k categories yields its
    detail rows k times (one copy per category list). ``distinct=True`` gives each session's
    rows once (left semi join). The top list is bounded (categories x n), so it is broadcast and
    ``detail`` is never shuffled: it may be the task's whole action scan, because top sessions are
    filtered sessions and a filtered session's detail is all of its actions in the date range.
    """
    ids = top.select("session_id")
    if distinct:
        rows = detail.join(broadcast_if_bounded(ids.distinct(), row_bound), "session_id", "left_semi")
    else:
        rows = detail.join(broadcast_if_bounded(ids, row_bound), "session_id", "inner")
    return detail_rows(rows, task_id)
