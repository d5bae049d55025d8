"""Release of materialised frames, one sample total, strict time text, the raw text sink."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import action
from visitlens.functions.columns import int_div, parse_action_time
from visitlens.operators.sampling import extract_quota, hour_session_counts, sample_sessions
from visitlens.operators.sessions import aggregate_sessions
from visitlens.plans import queries as Q
from visitlens.plans.job import SessionJob, SessionPlans, run
from visitlens.session import checkpoint_dir
from visitlens.sinks import ResultSink, write_tab_separated

SMALL = "/root/testdata/sf0.001"


class Noop(ResultSink):
    def write(self, df, name):
        df.write.format("noop").mode("overwrite").save()


class Raising(ResultSink):
    def write(self, df, name):
        df.count()
        if name == "top10_session":
            raise RuntimeError("sink")


def _folders(spark):
    base = checkpoint_dir(spark).removeprefix("file:")
    return {f for f in os.listdir(base) if f.startswith("job-")}


@pytest.mark.parametrize("mode", ["persist", "checkpoint"])
@pytest.mark.parametrize("sink", [Noop(), Raising()], ids=["ok", "raises"])
def test_a_run_leaves_nothing_behind(spark, mode, sink):
    cached, folders = spark.sparkContext._jsc.getPersistentRDDs().size(), _folders(spark)
    job = SessionJob(Q.PARAMS["main"], task_id=1, sample_total=Q.SAMPLE_TOTAL)
    plans = SessionPlans.from_test_tables(spark, SMALL, job, materialize_mode=mode)
    if isinstance(sink, Raising):
        with pytest.raises(RuntimeError):
            run(plans, sink)
    else:
        run(plans, sink)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached
    assert _folders(spark) == folders


def test_sample_total_is_the_quota_total(spark):
    hours = spark.range(500).select(F.concat(F.lit("s"), "id").alias("session_id"),
                                    F.expr("timestamp_ntz'2024-01-01 10:00:00'").alias("start_time"))
    quota = extract_quota(hour_session_counts(hours), 1000)
    assert sample_sessions(hours, quota, 1000).count() == 500
    with pytest.raises(TypeError):
        sample_sessions(hours, quota)


def test_action_time_text(spark):
    texts = {"2024-01-01 1:02:03": "2024-01-01 01:02:03", "2024-1-1 10:00:00.900": "2024-01-01 10:00:00", "2024": None,
             "2024-01-01": None, " 2024-01-01 10:00 ": None, "2024-01-01T10:00:00Z": None, "2024-13-01 10:00:00": None, "": None}
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    got = {r["t"]: r["p"] for r in df.select("t", parse_action_time(F.col("t")).cast("string").alias("p")).collect()}
    assert got == {**texts, None: None}


def test_visit_length_reads_whole_seconds(make_actions):
    rows = [action("s", time="2024-01-01 10:00:00.900"), action("s", time="2024-01-01 10:00:01.100")]
    assert aggregate_sessions(make_actions(rows)).first()["visit_length"] == 1


def test_text_sink_writes_the_words_as_they_are(spark, tmp_path):
    words = [("", 1), ('"hi', 2), ("#c", 3), ('say"so', 4), ("\ttab", 5), (None, 6)]
    path = str(tmp_path / "out")
    write_tab_separated(spark.createDataFrame(words, "word string, count bigint").coalesce(1), path)
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert sorted(lines) == sorted(f"{w or ''}\t{n}" for w, n in words)


def test_integer_division_is_exact(spark):
    big = (1 << 62) + 1
    assert spark.range(1).select(int_div(F.lit(big), F.lit(1)).alias("x")).first()["x"] == big
