"""What the job reads once, the two forms of the category counts, distinct detail, catalog tables, long sessions."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import action, user
from visitlens.operators import categories, topsessions
from visitlens.params import TaskParams
from visitlens.plans import queries as Q
from visitlens.plans.job import SessionJob, SessionPlans
from visitlens.schemas import USER_INFO, USER_VISIT_ACTION
from visitlens.sources.actions import catalog_actions, catalog_users

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def rows(df):
    return Counter(map(tuple, df.collect()))


def job(**kw):
    return SessionJob(Q.PARAMS["main"], task_id=1, sample_total=Q.SAMPLE_TOTAL, **kw)


def test_category_counts_agree(make_actions):
    detail = make_actions([
        action("a", click=1), action("a", click=1), action("b", click=2, orders="2,2,x", pays=""), action("b", orders="3,"),
        action("c", pays="1,4"), action("c", keyword="k"), action("d", orders="99999999999999999999"),
    ])
    want = {(1, 2, 0, 1), (2, 1, 2, 0), (3, 0, 1, 0), (4, 0, 0, 1)}
    clicks = topsessions.session_category_clicks(detail)
    for got in (categories.category_counts(detail), categories.category_counts(detail, clicks),
                categories.category_counts_joined(detail)):
        assert rows(got.select("category_id", *categories.SORT_KEYS)) == Counter(want)
    # x, the empty piece behind a comma, the too large one; the empty pay list is one empty piece
    assert rows(categories.list_id_counts(detail)) == Counter([("order", 6, 3), ("pay", 3, 1)])


@pytest.mark.parametrize("mode", ["persist", "checkpoint"])
def test_results_do_not_depend_on_what_is_kept(spark, mode):
    plain, kept = (SessionPlans.from_test_tables(spark, SMALL, job(), materialize_mode=m) for m in ("none", mode))
    try:
        for name, df in kept.results().items():
            assert rows(df) == rows(plain.results()[name]), name
    finally:
        kept.release()


def test_three_scans_of_the_actions(spark, monkeypatch):
    from visitlens.plans import job as job_module

    seen = []
    write = job_module.materialize
    monkeypatch.setattr(job_module, "materialize", lambda df, *a: (seen.append(df), write(df, *a))[1])
    plans = SessionPlans.from_test_tables(spark, SMALL, job(), materialize_mode="checkpoint")
    try:
        seen += plans.results().values()
        scans = [df._jdf.queryExecution().optimizedPlan().toString().count("event_type#") > 0 for df in seen]
        assert sum(scans) == 3
    finally:
        plans.release()


def test_distinct_detail(spark):
    plans = SessionPlans.from_test_tables(spark, SMALL, job(distinct_detail=True))
    listed = plans.sampled.select("session_id").union(plans.top10_session.select("session_id")).distinct()
    want = plans.actions.join(listed, "session_id", "left_semi").count()
    assert plans.session_detail_output.count() == want
    assert SessionPlans.from_test_tables(spark, SMALL, job()).session_detail_output.count() >= want


def test_catalog_tables(spark, tmp_path):
    actions = spark.createDataFrame([action("s", click=1), action("t", user_id=2)], USER_VISIT_ACTION)
    actions.write.partitionBy("date").parquet(str(tmp_path / "a"))
    spark.createDataFrame([user(1), user(2, sex="female")], USER_INFO).write.parquet(str(tmp_path / "u"))
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in USER_VISIT_ACTION)
    spark.sql(f"CREATE TABLE user_visit_action ({columns}) USING parquet PARTITIONED BY (date) LOCATION '{tmp_path}/a'")
    spark.sql(f"CREATE TABLE user_info USING parquet LOCATION '{tmp_path}/u'")
    try:
        spark.sql("MSCK REPAIR TABLE user_visit_action")
        params = TaskParams.from_values({"start_date": "2024-01-01", "end_date": "2024-01-01", "sex": "female"})
        plans = SessionPlans(SessionJob(params, task_id=3), catalog_actions(spark), catalog_users(spark))
        assert [r.session_id for r in plans.filtered.collect()] == ["t"]
        assert "PartitionFilters: [isnotnull(date" in plans.actions._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.sql("DROP TABLE IF EXISTS user_visit_action")
        spark.sql("DROP TABLE IF EXISTS user_info")


def test_month_sessions_reach_the_long_buckets(spark):
    counts = Q.session_stat_counts_month(spark, MEDIUM).first()
    assert counts["step_length_30_60"] > 0 and counts["step_length_60"] > 0
    assert Q.top10_session_month(spark, MEDIUM).agg(F.max("click_count")).first()[0] > 2
