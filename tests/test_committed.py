"""One commit for a task's five tables: nothing of a failed run is seen, a re-run takes the place of the older one."""

import os

import pytest

from tests.conftest import action, user
from visitlens.params import TaskParams
from visitlens.plans.job import SessionJob, SessionPlans, run
from visitlens.sinks.committed import CommittedSink, commits, read_committed, remove_unreferenced

TABLES = ["session_aggr_stat", "session_random_extract", "session_detail", "top10_category", "top10_session"]


class Failing(CommittedSink):
    def write(self, df, name):
        if name == "session_detail":
            raise RuntimeError("third table")
        super().write(df, name)


class FailingLate(CommittedSink):
    def commit(self):
        raise RuntimeError("commit")


@pytest.fixture
def job(make_actions, make_users):
    acts = [action(f"s{i}", user_id=1, click=i % 3, time=f"2024-01-01 10:00:{i:02d}") for i in range(20)]

    def plans(task_id, n=20):
        return SessionPlans(SessionJob(TaskParams(), task_id=task_id), make_actions(acts[:n]), make_users([user(1)]), "persist")

    return plans


def held(spark, base, task_id=None):
    return {t: sorted(map(tuple, read_committed(spark, base, t, task_id).collect()), key=str) for t in TABLES}


def test_all_tables_or_none(spark, job, tmp_path):
    base = str(tmp_path)
    for sink in (Failing(base=base), FailingLate(base=base)):
        with pytest.raises(RuntimeError):
            run(job(1), sink)
    assert commits(spark, base).count() == 0 and os.listdir(f"{base}/runs") == []
    with pytest.raises(LookupError):
        read_committed(spark, base, "session_detail")
    run(job(1), CommittedSink(base=base))
    first = held(spark, base)
    assert len(first["session_detail"]) >= 20 and first["session_aggr_stat"][0][0] == 1
    with pytest.raises(RuntimeError):
        run(job(1, 5), Failing(base=base))
    assert held(spark, base) == first


def test_a_run_repeated_is_equal_and_a_new_one_replaces_it(spark, job, tmp_path):
    base = f"file://{tmp_path}/"
    sink = CommittedSink(base=base)
    for _ in range(2):
        run(job(1), sink)
        run(job(2), sink)
    first = held(spark, base, 1)
    assert commits(spark, base).count() == 2 and len(read_committed(spark, base, "session_aggr_stat").collect()) == 2
    run(job(1, 5), sink)
    assert held(spark, base, 1) != first and len(held(spark, base, 1)["session_random_extract"]) < len(first["session_random_extract"])
    assert held(spark, base, 2)["top10_category"] == [(2, *r[1:]) for r in first["top10_category"]]


def test_folders_that_no_commit_names_are_removed(spark, job, tmp_path):
    base = str(tmp_path)
    assert remove_unreferenced(spark, base) == []
    sink = CommittedSink(base=base)
    run(job(1), sink)
    run(job(1), sink)
    assert remove_unreferenced(spark, base) == []  # too young
    before = held(spark, base)
    assert len(remove_unreferenced(spark, base, 0)) == 1 and len(os.listdir(f"{base}/runs")) == 1
    assert held(spark, base) == before


def test_empty_results_and_wrong_use(spark, job, make_actions, make_users, tmp_path):
    plans = SessionPlans(SessionJob(TaskParams(), task_id=3), make_actions([]), make_users([]))
    run(plans, CommittedSink(base=str(tmp_path)))
    assert read_committed(spark, str(tmp_path), "session_detail", 3).count() == 0
    with pytest.raises(ValueError):
        CommittedSink()
    with pytest.raises(ValueError):
        CommittedSink(fmt="jdbc", base="x")
    with pytest.raises(RuntimeError):
        CommittedSink(base=str(tmp_path)).write(spark.range(1), "x")
