"""An action table in buckets by session: no exchange of the actions, hot sessions apart and split."""

import uuid

import pytest
from pyspark.sql import functions as F

from tests.conftest import action, user
from tests.test_skew import skewed_inputs
from visitlens.params import TaskParams
from visitlens.plans import queries as Q
from visitlens.plans.job import SessionJob, SessionPlans, run
from visitlens.sinks import ResultSink, write_bucketed_actions
from visitlens.sources.actions import bucketed_actions

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def static(spark):
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def table(actions, tmp_path, buckets=8, hot_rows=1000):
    name = f"t_{uuid.uuid4().hex}"
    write_bucketed_actions(actions, name, buckets, str(tmp_path / name), hot_rows)
    return name


def scans_below_exchange(plan, below=False, found=None):
    """For each scan of a physical plan, is there an exchange above it?"""
    found = [] if found is None else found
    name = plan.nodeName()
    below = below or name in ("Exchange", "BroadcastExchange")
    if name.startswith("Scan parquet"):
        found.append((plan.simpleString(20_000), below))
    for i in range(plan.children().size()):
        scans_below_exchange(plan.children().apply(i), below, found)
    return found


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_sessions_aggregate_without_an_exchange(static, tmp_path):
    actions, _ = skewed_inputs(static)
    name = table(actions, tmp_path, hot_rows=1 << 40)  # nothing is hot
    main, hot = bucketed_actions(static, name)
    assert hot.count() == 0 and main.count() == actions.count()
    plans = SessionPlans(SessionJob(TaskParams(), task_id=1), main, static.createDataFrame([], "user_id bigint, age int, professional string, city string, sex string"))
    plan = plans.session_facts._jdf.queryExecution().executedPlan()
    assert scans_below_exchange(plan) and not any(b for _, b in scans_below_exchange(plan))
    assert "SelectedBucketsCount: 8 out of 8" in plan.toString() or "Bucketed: true" in plan.toString()
    plain = SessionPlans(SessionJob(TaskParams(), task_id=1), actions, plans.user_source)
    assert rows(plans.session_facts) == rows(plain.session_facts)
    for p in (plans, plain):
        p.release()


def test_hot_sessions_lie_apart_and_the_rest_is_not_shuffled(static, tmp_path):
    actions, users = skewed_inputs(static)
    name = table(actions, tmp_path)
    main, hot = bucketed_actions(static, name)
    assert {r[0] for r in hot.select("session_id").distinct().collect()} == {"hot"}
    assert main.groupBy("session_id").count().agg(F.max("count")).first()[0] <= 1000
    plans = SessionPlans.from_bucketed(static, name, users, SessionJob(TaskParams(), task_id=1))
    plan = plans.detail_actions._jdf.queryExecution().executedPlan()
    # J2 and A1 read the buckets twice; the action side of J2 meets no exchange, A1's rows only after the aggregate
    bucketed = [b for s, b in scans_below_exchange(plan) if name in s and f"{name}_hot" not in s and "order_category_ids" in s]
    assert bucketed and not any(bucketed)
    plain = SessionPlans(SessionJob(TaskParams(), task_id=1), actions, users)
    for what in ("session_facts", "category_counts", "top10_session"):
        assert rows(getattr(plans, what)) == rows(getattr(plain, what))
    plans.release(), plain.release()


def test_hot_part_is_split(spark, tmp_path):
    """AQE splits the hot session's join in the part that is not bucketed."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.files.openCostInBytes": "1k", "spark.sql.files.maxPartitionBytes": "32k", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        actions, users = skewed_inputs(spark)
        # the hot table holds the hot session and many warm ones; AQE goes by bytes, so all columns are read
        plans = SessionPlans.from_bucketed(spark, table(actions, tmp_path, hot_rows=8), users, SessionJob(TaskParams(), task_id=1))
        detail = plans.session_detail
        assert len(detail.collect()) == actions.count()
        assert "SortMergeJoin(skew=true)" in detail._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        plans.release()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_dates_prune_and_unnamed_sessions_stay_in_the_table(spark, make_actions, tmp_path):
    acts = [action("a"), action("a", date="2024-01-02"), action(None), action(None, date="2024-01-02"), action("b", date="2024-01-03")]
    name = table(make_actions(acts), tmp_path, buckets=2)
    main, hot = bucketed_actions(spark, name)
    assert main.count() + hot.count() == 5 and hot.where("session_id is not null").count() == 0
    params = TaskParams.from_values({"start_date": "2024-01-02", "end_date": "2024-01-02"})
    plans = SessionPlans.from_bucketed(spark, name, spark.createDataFrame([user(1)], "user_id long, username string, name string, age int, professional string, city string, sex string"), SessionJob(params))
    assert [r["session_id"] for r in plans.sessions.collect()] == ["a"]
    assert "PartitionFilters: [isnotnull(date" in plans.session_facts._jdf.queryExecution().executedPlan().toString()
    plans.release()


class Collected(ResultSink):
    def write(self, df, name):
        self.options[name] = rows(df)


def test_a_whole_job_is_equal(spark):
    base = Q.plans(spark, SMALL, "main")
    job = base.job
    base.release()
    sinks = []
    for make in (lambda: Q.bucketed_plans(spark, SMALL, "main"), lambda: SessionPlans.from_test_tables(spark, SMALL, job)):
        for mode in ("persist", "checkpoint"):
            plans, sink = make(), Collected()
            plans.materialize_mode = mode
            run(plans, sink)
            sinks.append(sink.options)
    assert all(s == sinks[0] for s in sinks) and len(sinks[0]["session_detail"]) > 100
