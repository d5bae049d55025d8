"""Bucket statistics over filtered sessions (A2), their ratios (A3) and long-form label counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.functions import STEP_BUCKETS, VISIT_BUCKETS, bucket_label, ratio_half_up
from visitlens.functions.buckets import in_bucket

SESSION_COUNT = "session_count"


def visit_columns() -> list[str]:
    return [f"visit_length_{name}" for name, _, _ in VISIT_BUCKETS]


def step_columns() -> list[str]:
    return [f"step_length_{name}" for name, _, _ in STEP_BUCKETS]


def session_stat_counts(filtered: DataFrame) -> DataFrame:
    """One row: number of sessions and number of sessions per duration and step bucket.

    A single global aggregate: each task emits one partial row, the final merge is one row.
    """
    visit, step = F.col("visit_length"), F.col("step_length")
    aggs = [F.count(F.lit(1)).alias(SESSION_COUNT)]
    aggs += [F.count_if(in_bucket(visit, lo, hi)).alias(f"visit_length_{n}") for n, lo, hi in VISIT_BUCKETS]
    aggs += [F.count_if(in_bucket(step, lo, hi)).alias(f"step_length_{n}") for n, lo, hi in STEP_BUCKETS]
    return filtered.agg(*aggs)


def session_aggr_stat(counts: DataFrame, task_id: int) -> DataFrame:
    """Ratios bucket / session_count, rounded half-up to 2 decimals (NULL when no session)."""
    total = F.col(SESSION_COUNT)
    ratios = [ratio_half_up(F.col(c), total).alias(f"{c}_ratio") for c in visit_columns() + step_columns()]
    return counts.select(F.lit(task_id).cast("bigint").alias("task_id"), total, *ratios)


def label_counts(filtered: DataFrame) -> DataFrame:
    """Long form of the statistics: (label, count) for every label that occurs.

    Each session contributes ``session_count``, its duration bucket and its step bucket label.
    """
    labels = F.array(
        F.lit(SESSION_COUNT),
        bucket_label(F.col("visit_length"), VISIT_BUCKETS, "visit_length_"),
        bucket_label(F.col("step_length"), STEP_BUCKETS, "step_length_"),
    )
    exploded = filtered.select(F.explode(labels).alias("label")).where(F.col("label").isNotNull())
    return exploded.groupBy("label").agg(F.count(F.lit(1)).alias("count"))
