"""Action and user scans of the session job (S1, S2) over any source DataFrame or catalog table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.params import TaskParams

USER_COLUMNS = ["user_id", "age", "professional", "city", "sex"]


def scan_actions(actions: DataFrame, params: TaskParams) -> DataFrame:
    """Actions inside the task's date range, both ends inclusive, compared as text.

    A missing bound is no bound; bounds are literals, never SQL text. Rows without a session id
    are dropped here (they cannot belong to a session). On a table partitioned by ``date`` the
    predicate prunes partitions; on parquet it is a pushed filter.
    """
    cond = F.col("session_id").isNotNull()
    if params.start_date is not None:
        cond = cond & (F.col("date") >= F.lit(params.start_date))
    if params.end_date is not None:
        cond = cond & (F.col("date") <= F.lit(params.end_date))
    return actions.where(cond)


def scan_users(users: DataFrame) -> DataFrame:
    """The user columns the session job reads (column pruning reaches the scan)."""
    return users.select(*USER_COLUMNS)


def catalog_actions(spark: SparkSession, table: str = "user_visit_action") -> DataFrame:
    return spark.table(table)


def catalog_users(spark: SparkSession, table: str = "user_info") -> DataFrame:
    return spark.table(table)


def bucketed_actions(spark: SparkSession, table: str) -> tuple[DataFrame, DataFrame]:
    """The two parts of an action table written by ``sinks.write_bucketed_actions``: the sessions in buckets, and the
    hot sessions. No session is in both."""
    return spark.table(table), spark.table(f"{table}_hot")
