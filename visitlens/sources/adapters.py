"""Adapter views that present the driver's synthetic tables in the original job's input shapes.

``user_visit_action`` is derived from ``events`` (one session per user and day, a base hour per
user and a span per user so that every duration bucket is populated); ``user_info`` from
``customer`` and ``nation``. These views are test-data plumbing, not an engine feature: on real
data the job reads the action and user tables directly (``visitlens.sources.actions``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.sources.tables import read_table

# Fixed values of the adapter: session span in seconds chosen by user_id % 6.
SPAN_SECONDS = (5, 11, 90, 300, 1500, 3600)
# Base hour of a user's sessions: user_id % 23.
BASE_HOUR_MODULUS = 23


def _iso_day(text: str | None) -> dt.date | None:
    if text is None:
        return None
    try:
        return dt.date.fromisoformat(text) if len(text) == 10 else None
    except ValueError:
        return None


def adapter_actions(
    spark: SparkSession, data_dir: str, start_date: str | None = None, end_date: str | None = None,
    session_per: str = "day",
) -> DataFrame:
    """``user_visit_action`` over ``events``, one session per user and day (or ``month``: long sessions).

    When the date bounds are ISO dates they are also applied to the raw ``ts`` column, which is
    what reaches the parquet scan as a pushed filter (row-group skipping); the exact string
    predicate on ``date`` is still applied by ``scan_actions``.
    """
    ev = read_table(spark, data_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    lo, hi = _iso_day(start_date), _iso_day(end_date)
    # Bounds are wall-clock text cast to timestamp_ntz: no time zone is involved anywhere.
    if lo is not None:
        ev = ev.where(F.col("ts") >= F.lit(f"{lo.isoformat()} 00:00:00").cast("timestamp_ntz"))
    if hi is not None:
        upper = hi + dt.timedelta(days=1)
        ev = ev.where(F.col("ts") < F.lit(f"{upper.isoformat()} 00:00:00").cast("timestamp_ntz"))

    day, period = f"{_DAY}) AS session_id", f"{_PERIODS[session_per]}) AS session_id"
    return ev.selectExpr(*[c.replace(day, period) for c in ACTION_COLUMNS])


# The projection as Spark SQL expressions (one call builds the whole select; the plan is the
# same as with column objects). `k` is the integer under "k" in the JSON props.
_K = "try_cast(get_json_object(props, '$.k') AS BIGINT)"
_DAY = "date_format(ts, 'yyyy-MM-dd')"
_PERIODS = {"day": _DAY, "month": "date_format(ts, 'yyyy-MM')"}
_SPAN = "CASE user_id % 6 " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(SPAN_SECONDS[:-1])) + f" ELSE {SPAN_SECONDS[-1]} END"
_TIME_OF_DAY = "(hour(ts) * 3600 + minute(ts) * 60 + second(ts))"
# ts moved by (base hour + time of day mod span - time of day) seconds keeps its fraction;
# formatting drops it.
_SHIFT = f"CAST((user_id % {BASE_HOUR_MODULUS}) * 3600 + {_TIME_OF_DAY} % ({_SPAN}) - {_TIME_OF_DAY} AS INT)"
ACTION_COLUMNS = [
    f"{_DAY} AS date",
    "user_id",
    f"concat('u', CAST(user_id AS STRING), '_', {_DAY}) AS session_id",
    "event_id % 10 AS page_id",
    f"date_format(timestampadd(SECOND, {_SHIFT}, ts), 'yyyy-MM-dd HH:mm:ss') AS action_time",
    f"CASE WHEN event_type = 'view' THEN concat('kw', CAST({_K} % 10 AS STRING)) END AS search_keyword",
    f"CASE WHEN event_type = 'click' THEN {_K} % 20 END AS click_category_id",
    "CASE WHEN event_type = 'click' THEN event_id % 100 END AS click_product_id",
    f"CASE WHEN event_type = 'purchase' THEN concat(CAST({_K} % 20 AS STRING), ',', CAST({_K} * 7 % 20 AS STRING)) END AS order_category_ids",
    f"CASE WHEN event_type = 'purchase' THEN concat(CAST({_K} % 100 AS STRING), ',', CAST({_K} * 7 % 100 AS STRING)) END AS order_product_ids",
    f"CASE WHEN event_type = 'signup' THEN CAST({_K} * 3 % 20 AS STRING) END AS pay_category_ids",
    f"CASE WHEN event_type = 'signup' THEN CAST({_K} * 3 % 100 AS STRING) END AS pay_product_ids",
    "user_id % 10 AS city_id",
]


def event_lines(spark: SparkSession, data_dir: str) -> DataFrame:
    """``events`` as tab-separated lines of id, type and user (column ``line``), every type ``error`` written as null
    and some lines short, long or with text for a number. Test-data plumbing."""
    ev = read_table(spark, data_dir, "events").selectExpr(
        "event_id", "CASE WHEN event_type = 'error' THEN 'null' ELSE event_type END AS kind", "coalesce(cast(user_id as string), 'null') AS user")
    ident = "CASE WHEN event_id % 83 = 5 THEN concat('x', event_id) ELSE cast(event_id as string) END"
    return ev.selectExpr(f"""CASE WHEN event_id % 97 = 3 THEN concat_ws('\t', {ident}, kind)
        WHEN event_id % 89 = 4 THEN concat_ws('\t', {ident}, kind, user, '')
        WHEN event_id % 79 = 6 THEN concat_ws('\t', {ident}, kind, 'n/a')
        ELSE concat_ws('\t', {ident}, kind, user) END AS line""")


def adapter_users(spark: SparkSession, data_dir: str) -> DataFrame:
    """``user_info`` over ``customer`` joined to ``nation`` (city = nation name).

    ``nation`` is the fixed 25-row dimension at every scale, so broadcasting it is bounded.
    """
    cust = read_table(spark, data_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, data_dir, "nation").select("n_nationkey", "n_name")
    joined = cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey, "inner")
    return joined.selectExpr(
        "c_custkey AS user_id",
        "c_name AS username",
        "c_name AS name",
        "CAST(c_custkey * 7 % 60 AS INT) AS age",
        "c_mktsegment AS professional",
        "n_name AS city",
        "CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex",
    )
