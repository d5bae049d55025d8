"""End-to-end job: five results written through a sink, checkpoint materialisation, streaming."""

import tempfile
import time

from visitlens.operators.categories import category_counts
from visitlens.plans import queries as Q
from visitlens.plans.job import SessionJob, SessionPlans, run
from visitlens.sinks import ResultSink, write_tab_separated
from visitlens.sources import adapter_actions
from visitlens.streaming import start_category_counts, stream_category_counts

DATA = "/root/testdata/sf0.001"


def test_job_writes_five_results(spark):
    out = tempfile.mkdtemp(prefix="visitlens-job-")
    job = SessionJob(Q.PARAMS["main"], task_id=9, sample_total=1000, seed=Q.SEED)
    plans = SessionPlans.from_test_tables(spark, DATA, job, materialize_mode="persist")
    expected = {name: df.count() for name, df in plans.results().items()}
    run(plans, ResultSink(fmt="parquet", base=out))
    for name, n in expected.items():
        written = spark.read.parquet(f"{out}/{name}")
        assert written.count() == n
    stat = spark.read.parquet(f"{out}/session_aggr_stat").first()
    assert stat["task_id"] == 9 and stat["session_count"] > 0
    from visitlens.schemas import (
        RANDOM_EXTRACT_COLUMNS,
        SESSION_DETAIL_COLUMNS,
        TOP10_CATEGORY_COLUMNS,
        TOP10_SESSION_COLUMNS,
    )

    declared = {
        "session_random_extract": RANDOM_EXTRACT_COLUMNS,
        "session_detail": SESSION_DETAIL_COLUMNS,
        "top10_category": TOP10_CATEGORY_COLUMNS,
        "top10_session": TOP10_SESSION_COLUMNS,
    }
    for name, columns in declared.items():
        assert spark.read.parquet(f"{out}/{name}").columns == columns


def test_checkpoint_mode_gives_same_results(spark):
    job = SessionJob(Q.PARAMS["main"], task_id=1, sample_total=1000)
    base = SessionPlans.from_test_tables(spark, DATA, job)
    cut = SessionPlans.from_test_tables(spark, DATA, job, materialize_mode="checkpoint")
    for name in ("top10_category", "session_aggr_stat"):
        assert sorted(base.results()[name].collect()) == sorted(cut.results()[name].collect())
    cut.release()


def test_word_count_text_sink(spark):
    out = tempfile.mkdtemp(prefix="visitlens-wc-") + "/counts"
    counts = Q.word_count(spark, DATA)
    write_tab_separated(counts, out)
    write_tab_separated(counts, out)  # overwrite replaces the folder
    lines = spark.read.text(out).collect()
    assert len(lines) == counts.count()
    assert all(r["value"].count("\t") >= 1 for r in lines)


def test_streaming_counts_equal_batch(spark):
    src = tempfile.mkdtemp(prefix="visitlens-stream-")
    actions = adapter_actions(spark, DATA)
    actions.where("date < '2024-01-15'").write.mode("append").parquet(src)
    counts = stream_category_counts(spark, src)
    query = start_category_counts(counts, query_name=f"cc_{int(time.time() * 1000)}")
    try:
        query.processAllAvailable()
        actions.where("date >= '2024-01-15'").write.mode("append").parquet(src)
        query.processAllAvailable()
        latest = spark.sql(f"select * from {query.name}")
        # update mode appends a row per changed category and batch; counts only grow
        final = {}
        for r in latest.collect():
            row = (r["click_count"], r["order_count"], r["pay_count"])
            final[r["category_id"]] = tuple(map(max, zip(final.get(r["category_id"], (0, 0, 0)), row)))
    finally:
        query.stop()
    batch = {r["category_id"]: (r["click_count"], r["order_count"], r["pay_count"]) for r in category_counts(actions).collect()}
    assert final == batch


def test_single_scan_detail_equals_union_of_branches(spark):
    job = SessionJob(Q.PARAMS["main"], task_id=2, sample_total=1000, seed=Q.SEED)
    plans = SessionPlans.from_test_tables(spark, DATA, job)
    def rows(df):
        return sorted((tuple(map(str, r)) for r in df.collect()))

    one_scan = rows(plans.session_detail_output)
    union = rows(plans.random_extract_detail.unionByName(plans.top10_session_detail))
    assert one_scan == union and len(one_scan) > 0


def test_date_partitioned_action_table_prunes(spark):
    from visitlens.params import TaskParams
    from visitlens.sinks import write_action_table
    from visitlens.sources import scan_actions

    path = tempfile.mkdtemp(prefix="visitlens-actions-") + "/user_visit_action"
    write_action_table(adapter_actions(spark, DATA), path)
    table = spark.read.parquet(path)
    scanned = scan_actions(table, TaskParams.from_values({"start_date": "2024-01-08", "end_date": "2024-01-09"}))
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-08" in plan
    expected = adapter_actions(spark, DATA, "2024-01-08", "2024-01-09").where("date <= '2024-01-09'").count()
    assert scanned.count() == expected


def test_command_line_runs_a_task_end_to_end(spark):
    from visitlens.__main__ import main
    from visitlens.params import TaskParams
    from visitlens.schemas import TASK
    from visitlens.sources import adapter_users

    base = tempfile.mkdtemp(prefix="visitlens-cli-")
    param = TaskParams.from_values({"start_date": "2024-01-01", "end_date": "2024-01-31", "sex": "male"}).to_json()
    spark.createDataFrame([(7, "t", None, None, None, None, None, param)], TASK).write.parquet(f"{base}/task")
    adapter_actions(spark, DATA).write.parquet(f"{base}/actions")
    adapter_users(spark, DATA).write.parquet(f"{base}/users")
    out = main(
        ["7", "--tasks-format", "parquet", "--tasks-path", f"{base}/task", "--input-format", "parquet",
         "--actions-table", f"{base}/actions", "--users-table", f"{base}/users",
         "--sink-path", f"{base}/out", "--sample-total", "1000", "--materialize", "none"],
        spark=spark,
    )
    assert out["task_id"] == 7 and out["params"]["sex"] == ["male"]
    stat = spark.read.parquet(f"{base}/out/session_aggr_stat").first()
    assert stat["task_id"] == 7 and stat["session_count"] > 0
    for name in ("session_random_extract", "session_detail", "top10_category", "top10_session"):
        assert spark.read.parquet(f"{base}/out/{name}").count() > 0


def test_idempotent_sink_replaces_a_rerun_task(spark):
    out = tempfile.mkdtemp(prefix="visitlens-idem-")
    sink = ResultSink(fmt="parquet", base=out, idempotent=True)
    for task_id in (1, 2, 1):  # task 1 runs twice (a retry)
        job = SessionJob(Q.PARAMS["main"], task_id=task_id, sample_total=1000)
        run(SessionPlans.from_test_tables(spark, DATA, job), sink)
    stat = spark.read.parquet(f"{out}/session_aggr_stat")
    assert sorted(r["task_id"] for r in stat.collect()) == [1, 2]
    top = spark.read.parquet(f"{out}/top10_category")
    assert top.where("task_id = 1").count() == top.where("task_id = 2").count() == 10


def test_command_line_checkpoint_and_idempotent_rerun(spark):
    from visitlens.__main__ import main
    from visitlens.params import TaskParams
    from visitlens.schemas import TASK
    from visitlens.sources import adapter_users

    base = tempfile.mkdtemp(prefix="visitlens-cli2-")
    param = TaskParams.from_values({"start_date": "2024-01-01", "end_date": "2024-01-31"}).to_json()
    spark.createDataFrame([(3, "t", None, None, None, None, None, param)], TASK).write.parquet(f"{base}/task")
    adapter_actions(spark, DATA).write.parquet(f"{base}/actions")
    adapter_users(spark, DATA).write.parquet(f"{base}/users")
    args = ["3", "--tasks-format", "parquet", "--tasks-path", f"{base}/task", "--input-format", "parquet",
            "--actions-table", f"{base}/actions", "--users-table", f"{base}/users", "--sink-path", f"{base}/out",
            "--sample-total", "1000", "--materialize", "checkpoint", "--idempotent"]
    main(args, spark=spark)
    first = {n: spark.read.parquet(f"{base}/out/{n}").count() for n in ("session_detail", "top10_session")}
    main(args, spark=spark)  # a re-run of the same task replaces its rows
    second = {n: spark.read.parquet(f"{base}/out/{n}").count() for n in ("session_detail", "top10_session")}
    assert first == second and first["top10_session"] > 0
