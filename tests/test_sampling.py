"""Hour counts (A8), quotas (K3), stratified sample (K4) and its detail (J3): invariants."""

import pytest
from conftest import action

from visitlens.operators.sampling import extract_quota, hour_session_counts, random_extract, random_extract_detail
from visitlens.operators.sessions import aggregate_sessions


def test_quota_is_integer_exact(spark):
    hours = spark.createDataFrame([("2024-01-01", "00", 29), ("2024-01-01", "01", 71)], "date string, hour string, session_count long")
    q = {r["hour"]: r["extract_count"] for r in extract_quota(hours, total=100).collect()}
    assert q == {"00": 29, "01": 71}  # 29/100*100 is 29, not 28


def test_quota_capped_at_count_and_split_by_days(spark):
    hours = spark.createDataFrame(
        [("d1", "00", 5), ("d1", "01", 1), ("d2", "00", 80)], "date string, hour string, session_count long"
    )
    q = {(r["date"], r["hour"]): (r["per_day"], r["extract_count"]) for r in extract_quota(hours, total=100).collect()}
    assert q == {("d1", "00"): (50, 5), ("d1", "01"): (50, 1), ("d2", "00"): (50, 50)}


@pytest.fixture
def sessions(make_actions):
    rows = []
    for i in range(300):
        hour = i % 7
        rows.append(action(f"s{i:03d}", time=f"2024-01-0{1 + i % 3} {hour}:00:00", date=f"2024-01-0{1 + i % 3}"))
    return make_actions(rows), aggregate_sessions(make_actions(rows))


def sample(sessions_df, total, seed=42):
    quota = extract_quota(hour_session_counts(sessions_df), total)
    return quota, random_extract(sessions_df, quota, task_id=1, seed=seed, total=total)


def test_sample_invariants(sessions):
    _, s = sessions
    quota, picked = sample(s, total=60)
    q = {(r["date"], r["hour"]): r for r in quota.collect()}
    assert all(r["extract_count"] <= r["session_count"] for r in q.values())
    ids = [r["session_id"] for r in picked.collect()]
    assert len(ids) == len(set(ids)) == sum(r["extract_count"] for r in q.values())
    assert set(ids) <= {r["session_id"] for r in s.collect()}
    assert len(ids) <= 60


def test_same_seed_same_sample_other_seed_differs(sessions):
    _, s = sessions
    a = {r["session_id"] for r in sample(s, 60, seed=1)[1].collect()}
    b = {r["session_id"] for r in sample(s, 60, seed=1)[1].collect()}
    c = {r["session_id"] for r in sample(s, 60, seed=2)[1].collect()}
    assert a == b and a != c


@pytest.mark.parametrize("partitions", ["1", "4", "200"])
def test_sample_independent_of_partitioning(spark, sessions, partitions):
    _, s = sessions
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    expected = sorted(r["session_id"] for r in sample(s, 60)[1].collect())
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert sorted(r["session_id"] for r in sample(s, 60)[1].collect()) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_detail_of_sample(sessions):
    actions, s = sessions
    _, picked = sample(s, 60)
    detail = random_extract_detail(actions, picked, task_id=1, total=60)
    assert {r["session_id"] for r in detail.collect()} == {r["session_id"] for r in picked.collect()}
