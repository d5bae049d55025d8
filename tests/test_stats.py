"""Bucket statistics (A2), ratios with exact half-up rounding (A3), long-form label counts."""

from conftest import action

from visitlens.operators.sessions import aggregate_sessions
from visitlens.operators.stats import label_counts, session_aggr_stat, session_stat_counts

DURATIONS = [0, 1, 3, 4, 60, 61, 180, 181, 600, 601, 1800, 1801]


def sessions_with_durations(make_actions):
    rows = []
    for i, d in enumerate(DURATIONS):
        rows.append(action(f"s{i}", time="2024-01-01 00:00:00"))
        rows.append(action(f"s{i}", time=f"2024-01-01 {d // 3600:02d}:{d % 3600 // 60:02d}:{d % 60:02d}"))
    return aggregate_sessions(make_actions(rows))


def test_duration_buckets(make_actions):
    c = session_stat_counts(sessions_with_durations(make_actions)).first().asDict()
    assert c["session_count"] == 12
    assert c["visit_length_1s_3s"] == 2  # 1, 3
    assert c["visit_length_4s_6s"] == 1
    assert c["visit_length_30s_60s"] == 1  # 60
    assert c["visit_length_1m_3m"] == 2  # 61, 180
    assert c["visit_length_3m_10m"] == 2  # 181, 600
    assert c["visit_length_10m_30m"] == 2  # 601, 1800
    assert c["visit_length_30m"] == 1  # 1801
    bucketed = sum(v for k, v in c.items() if k.startswith("visit_length_"))
    assert bucketed == 11  # the 0-second session is in no bucket
    assert c["step_length_1_3"] == 12


def test_step_buckets_and_true_ratios(make_actions):
    rows = [action("a")] * 3 + [action("b")] * 7 + [action("c")] * 61
    stat = session_aggr_stat(session_stat_counts(aggregate_sessions(make_actions(rows))), task_id=5).first()
    assert stat["task_id"] == 5 and stat["session_count"] == 3
    assert stat["step_length_1_3_ratio"] == 0.33
    assert stat["step_length_7_9_ratio"] == 0.33
    assert stat["step_length_60_ratio"] == 0.33
    assert stat["step_length_4_6_ratio"] == 0.0


def test_half_up_rounding_is_exact(spark):
    from pyspark.sql import functions as F

    from visitlens.functions import ratio_half_up

    df = spark.createDataFrame([(3, 200), (201, 20000), (1, 8), (5, 0)], "c long, t long")
    got = [r[0] for r in df.select(ratio_half_up(F.col("c"), F.col("t"))).collect()]
    assert got == [0.02, 0.01, 0.13, None]  # 0.015 -> 0.02; 0.01005 -> 0.01; 0.125 -> 0.13; /0 -> NULL


def test_no_session_gives_null_ratios(make_actions):
    empty = aggregate_sessions(make_actions([action("a")])).where("false")
    stat = session_aggr_stat(session_stat_counts(empty), task_id=1).first()
    assert stat["session_count"] == 0 and stat["visit_length_1s_3s_ratio"] is None


def test_label_counts_match_counts(make_actions):
    sessions = sessions_with_durations(make_actions)
    counts = session_stat_counts(sessions).first().asDict()
    labels = {r["label"]: r["count"] for r in label_counts(sessions).collect()}
    assert labels == {k: v for k, v in counts.items() if v}
