"""Time-stratified session sample: sessions per day-hour (A8), per-hour quotas (K3), the
reproducible sample (K4) and its detail rows (J3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlens.functions import day_of, format_time, hour_of, ids_to_csv, int_div, strings_to_csv
from visitlens.operators.sessions import actions_of_sessions, detail_rows, session_sets
from visitlens.plans.physical import broadcast_if_bounded

# Fixed value: sessions sampled per task (spread over the task's days).
DEFAULT_SAMPLE_TOTAL = 100


def _with_day_hour(filtered: DataFrame) -> DataFrame:
    start = F.col("start_time")
    return filtered.where(start.isNotNull()).select("*", day_of(start).alias("date"), hour_of(start).alias("hour"))


def hour_session_counts(filtered: DataFrame) -> DataFrame:
    """Sessions per (date, hour) of their start time; stays distributed (no countByKey)."""
    return _with_day_hour(filtered).groupBy("date", "hour").agg(F.count(F.lit(1)).alias("session_count"))


def extract_quota(hour_counts: DataFrame, total: int) -> DataFrame:
    """K3: per_day = total div number of days; an hour gets count * per_day div day_count
    sessions, at most its count. Integer arithmetic, so the quota is exact.

    Input has one row per (date, hour), at most 24 per day, so the whole-table window that counts
    the days works on a table whose size does not grow with the number of sessions.
    """
    all_rows = Window.partitionBy()
    day = Window.partitionBy("date")
    first_of_day = (F.row_number().over(day.orderBy("hour")) == 1).cast("bigint")
    out = hour_counts.select(
        "date", "hour", "session_count", F.sum("session_count").over(day).alias("day_session_count"),
        first_of_day.alias("first_of_day"),
    )
    per_day = int_div(F.lit(total).cast("bigint"), F.sum("first_of_day").over(all_rows))
    out = out.select("date", "hour", "session_count", "day_session_count", per_day.alias("per_day"))
    quota = F.least(F.col("session_count"), int_div(F.col("session_count") * F.col("per_day"), F.col("day_session_count")))
    return out.withColumn("extract_count", quota)


def sample_key(seed: int | str) -> F.Column:
    """Pseudo-random, reproducible order of sessions: md5 of 'session_id:seed'."""
    return F.md5(F.concat(F.col("session_id"), F.lit(f":{seed}")))


def sample_sessions(
    filtered: DataFrame,
    quota: DataFrame,
    total: int,
    seed: int | str = 42,
) -> DataFrame:
    """K4: in every (date, hour), the ``extract_count`` sessions with the smallest sample key.

    ``extract_count <= per_day <= total``, so ``row_number <= total`` (a literal) is implied.
    Stating it lets Spark run a partial WindowGroupLimit on the map side: a huge hour sends at
    most ``total`` rows per map task through the shuffle, and the final window sorts only those.
    ``total`` must be the one that made ``quota``. The quota table, one row per (date, hour), is
    joined after the limit and the strategy is left to AQE's measured sizes.
    """
    start = F.col("start_time")
    w = Window.partitionBy("date", "hour").orderBy("sample_key", "session_id")
    keyed = filtered.where(start.isNotNull()).select(
        "*", day_of(start).alias("date"), hour_of(start).alias("hour"), sample_key(seed).alias("sample_key")
    )
    ranked = keyed.select("*", F.row_number().over(w).alias("pick")).where(F.col("pick") <= total)
    quotas = quota.select("date", "hour", "extract_count")
    return ranked.join(quotas, ["date", "hour"], "inner").where(F.col("pick") <= F.col("extract_count"))


def random_extract(
    filtered: DataFrame,
    quota: DataFrame,
    task_id: int,
    total: int,
    seed: int | str = 42,
    actions: DataFrame | None = None,
    sampled: DataFrame | None = None,
) -> DataFrame:
    """The ``session_random_extract`` rows of the sample (``sampled``, or drawn here).

    When the sessions are facts without keyword / category lists (the job's path), the lists of
    the sampled sessions (at most ``total``) are built from their ``actions`` through a broadcast
    of the sample (no shuffle of the actions).
    """
    picked = sampled if sampled is not None else sample_sessions(filtered, quota, total, seed)
    if "search_keywords" not in picked.columns:
        if actions is None:
            raise ValueError("session facts need the actions to list keywords and categories")
        picked = session_sets(actions, picked, total, carry=("start_time",))
    return picked.select(
        F.lit(task_id).cast("bigint").alias("task_id"),
        "session_id",
        format_time(F.col("start_time")).alias("start_time"),
        strings_to_csv(F.col("search_keywords")).alias("search_keywords"),
        ids_to_csv(F.col("click_category_ids")).alias("click_category_ids"),
    )


def random_extract_detail(actions: DataFrame, sample: DataFrame, task_id: int, total: int) -> DataFrame:
    """Action rows (of the task's date range) of the sampled sessions. The sample has at
    most ``total`` rows, so its ids are broadcast."""
    ids = broadcast_if_bounded(sample.select("session_id"), total)
    return detail_rows(actions_of_sessions(actions, ids), task_id)
