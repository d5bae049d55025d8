"""A session holding a third of all actions: the detail join is split by AQE and results stay exact."""

import pytest
from pyspark.sql import functions as F

from visitlens.operators import sessions
from visitlens.operators.topsessions import session_category_clicks
from visitlens.params import TaskParams
from visitlens.plans.job import SessionJob, SessionPlans
from visitlens.session import DEFAULT_CONF

N = 300_000
SKEW_CONF = {
    "spark.sql.adaptive.forceOptimizeSkewedJoin": DEFAULT_CONF["spark.sql.adaptive.forceOptimizeSkewedJoin"],
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "32",
}


@pytest.fixture
def skew_session(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def skewed_inputs(spark):
    ids = spark.range(N).repartition(8)
    i = F.col("id")
    session = F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), (i % 20000).cast("string")))
    actions = ids.select(
        F.lit("2024-01-01").alias("date"), (i % 500).alias("user_id"), session.alias("session_id"),
        (i % 10).alias("page_id"),
        F.format_string("2024-01-01 %d:%02d:%02d", (i % 24).cast("int"), (i % 60).cast("int"), (i % 59).cast("int")).alias("action_time"),
        F.lit(None).cast("string").alias("search_keyword"), (i % 20).alias("click_category_id"),
        F.lit(1).cast("bigint").alias("click_product_id"), F.lit(None).cast("string").alias("order_category_ids"),
        F.lit(None).cast("string").alias("order_product_ids"), F.lit(None).cast("string").alias("pay_category_ids"),
        F.lit(None).cast("string").alias("pay_product_ids"), F.lit(0).cast("bigint").alias("city_id"),
    )
    users = spark.range(500).select(
        F.col("id").alias("user_id"), F.lit("u").alias("username"), F.lit("n").alias("name"),
        F.lit(30).alias("age"), F.lit("p").alias("professional"), F.lit("c").alias("city"), F.lit("male").alias("sex"),
    )
    return actions, users


def expected_hot_clicks():
    # hot rows are ids 0, 3, 6, ...; their category is id % 20
    expected = {}
    for k in range(0, N, 3):
        expected[k % 20] = expected.get(k % 20, 0) + 1
    return expected


def test_hot_session_job_path_is_exact(skew_session):
    actions, users = skewed_inputs(skew_session)
    plans = SessionPlans(SessionJob(TaskParams(), task_id=1), actions, users)
    clicks = plans.session_category_clicks
    got = {r["category_id"]: r["click_count"] for r in clicks.where("session_id = 'hot'").collect()}
    assert got == expected_hot_clicks()
    clicks.collect()  # executes the adaptive plan of `clicks`
    final = clicks._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true)" in final
    assert plans.top10_session.where("session_id = 'hot'").count() == 10  # it leads every top category


def test_raw_detail_join_is_split(skew_session):
    actions, users = skewed_inputs(skew_session)
    plans = SessionPlans(SessionJob(TaskParams(), task_id=1), actions, users)
    clicks = session_category_clicks(plans.detail_actions)
    clicks.collect()  # executes the adaptive plan of `clicks`
    final = clicks._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true)" in final
    got = {r["category_id"]: r["click_count"] for r in clicks.where("session_id = 'hot'").collect()}
    assert got == expected_hot_clicks()


@pytest.mark.parametrize("mode", ["none", "persist", "checkpoint"])
def test_hot_session_is_split_with_broadcast_allowed(skew_session, mode):
    """The deployment's settings: users small enough to broadcast, a session without build_session's flag."""
    spark = skew_session
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
             "spark.sql.adaptive.forceOptimizeSkewedJoin")
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        spark.conf.set(names[0], "256k")
        spark.conf.set(names[1], "256k")
        spark.conf.unset(names[2])
        actions, users = skewed_inputs(spark)
        plans = SessionPlans(SessionJob(TaskParams(), task_id=1), actions, users, materialize_mode=mode)
        clicks = session_category_clicks(sessions.actions_of_sessions(plans.actions, plans.filtered))
        clicks.collect()
        final = clicks._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        # split, or the actions are not shuffled at all (written sessions measured small)
        assert "SortMergeJoin(skew=true)" in final or ("BroadcastHashJoin" in final and "SortMergeJoin" not in final)
        got = {r["category_id"]: r["click_count"] for r in clicks.where("session_id = 'hot'").collect()}
        assert got == expected_hot_clicks()
        plans.release()
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)
