"""The listed sessions' ids reach the scan, and a table sorted by session is read in part."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import action, user
from visitlens.operators.sessions import MAX_PUSHED_IDS, actions_of_ids
from visitlens.params import TaskParams
from visitlens.plans import queries as Q
from visitlens.plans.job import PUSH_IDS, SPLIT_SKEW, SessionJob, SessionPlans, run
from visitlens.schemas import USER_VISIT_ACTION
from visitlens.sinks import ResultSink, write_action_table
SMALL = "/root/testdata/sf0.001"


def scan_rows(df):
    """Rows that the only scan of ``df`` handed on."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    if node.nodeName() == "AdaptiveSparkPlan":
        node = node.executedPlan()
    while not node.nodeName().startswith("Scan"):
        node = node.children().apply(0)
    return node.metrics().apply("numOutputRows").value(), node.toString()


@pytest.fixture
def sorted_table(spark, tmp_path):
    path = str(tmp_path / "actions")
    ids = F.md5((F.col("id") % 20_000).cast("string"))
    actions = spark.range(200_000).select(
        F.lit("2024-01-01").alias("date"), F.col("id").alias("user_id"), ids.alias("session_id"), F.lit(1).cast("bigint").alias("page_id"),
        F.lit("2024-01-01 10:00:00").alias("action_time"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in USER_VISIT_ACTION.fields[5:]])
    write_action_table(actions.coalesce(2), path, options={"parquet.block.size": "65536", "parquet.page.size": "8192"})
    return spark.read.schema(USER_VISIT_ACTION).parquet(path)


def test_few_row_groups_are_read(spark, sorted_table):
    wanted = [r[0] for r in spark.range(0, 20_000, 4000).select(F.md5(F.col("id").cast("string"))).collect()]
    wanted += [f"nobody{i}" for i in range(15)]  # more than Parquet's default number of alternatives
    old = spark.conf.get("spark.sql.parquet.pushdown.inFilterThreshold")
    spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", str(MAX_PUSHED_IDS))
    try:
        found = actions_of_ids(sorted_table, wanted)
        read, plan = scan_rows(found)
    finally:
        spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", old)
    assert found.count() == 50
    assert "In(session_id" in plan and read < 0.1 * 200_000


def test_job_pushes_its_ids_and_restores_the_settings(spark):
    before = {k: spark.conf.get(k, None) for k in PUSH_IDS | SPLIT_SKEW}
    seen = {}

    class Looking(ResultSink):
        def write(self, df, name):
            seen[name] = spark.conf.get("spark.sql.parquet.pushdown.inFilterThreshold")
            df.write.format("noop").mode("overwrite").save()

    job = SessionJob(Q.PARAMS["main"], task_id=1, sample_total=30)
    plans = SessionPlans.from_test_tables(spark, SMALL, job, materialize_mode="persist")
    run(plans, Looking())
    assert set(seen.values()) == {str(MAX_PUSHED_IDS)} and len(seen) == 5
    assert {k: spark.conf.get(k, None) for k in before} == before


def test_more_ids_than_can_be_pushed(spark, make_actions, make_users):
    with pytest.raises(ValueError):
        actions_of_ids(make_actions([]), [str(i) for i in range(MAX_PUSHED_IDS + 1)])
    job = SessionJob(TaskParams(), task_id=1, sample_total=MAX_PUSHED_IDS)
    plans = SessionPlans(job, make_actions([action("a", click=1)]), make_users([user(1)]), materialize_mode="persist")
    assert plans._pushed_ids is None and plans.session_detail_output.count() == 2  # in the sample and a top session
    plans.release()
    few = SessionPlans(SessionJob(TaskParams(), task_id=1), make_actions([action("a", click=1)]), make_users([user(1)]), push_ids=True)
    assert few._pushed_ids == ["a", "a"] and few.session_detail_output.count() == 2
    once = SessionPlans(SessionJob(TaskParams(), task_id=1, distinct_detail=True), make_actions([action("a", click=1)]), make_users([user(1)]), push_ids=True)
    assert once.session_detail_output.count() == 1
    few.release(), once.release()
