"""Command line: the committed sink, and an action table in buckets."""

import uuid

import pytest

from visitlens.__main__ import main
from visitlens.params import TaskParams
from visitlens.schemas import TASK
from visitlens.sinks import write_bucketed_actions
from visitlens.sinks.committed import read_committed
from visitlens.sources import adapter_actions, adapter_users

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def base(spark, tmp_path):
    param = TaskParams.from_values({"start_date": "2024-01-01", "end_date": "2024-01-31"}).to_json()
    spark.createDataFrame([(3, "t", None, None, None, None, None, param)], TASK).write.parquet(f"{tmp_path}/task")
    adapter_actions(spark, DATA).write.parquet(f"{tmp_path}/actions")
    adapter_users(spark, DATA).write.parquet(f"{tmp_path}/users")
    return str(tmp_path)


def test_committed_and_bucketed_runs_are_equal(spark, base):
    common = ["3", "--tasks-format", "parquet", "--tasks-path", f"{base}/task", "--committed", "--sample-total", "1000"]
    main([*common, "--input-format", "parquet", "--actions-table", f"{base}/actions", "--users-table", f"{base}/users", "--sink-path", f"{base}/one"], spark=spark)
    name = f"cli_{uuid.uuid4().hex}"
    write_bucketed_actions(spark.read.parquet(f"{base}/actions"), name, 4, f"{base}/bucketed", hot_rows=9)
    spark.read.parquet(f"{base}/users").createOrReplaceTempView("cli_users")
    for _ in range(2):
        main([*common, "--bucketed", "--actions-table", name, "--users-table", "cli_users", "--sink-path", f"{base}/two"], spark=spark)
    for table in ("session_aggr_stat", "session_detail", "session_random_extract", "top10_category", "top10_session"):
        one, two = (sorted(map(tuple, read_committed(spark, f"{base}/{k}", table).collect()), key=str) for k in ("one", "two"))
        assert one == two and one


@pytest.mark.parametrize("wrong", [["--bucketed", "--input-format", "parquet"], ["--committed", "--idempotent", "--sink-path", "x"]])
def test_options_that_exclude_each_other(wrong):
    with pytest.raises(ValueError):
        main(["3", *wrong])
