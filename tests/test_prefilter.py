"""The Bloom filter before J2's shuffle: no session lost, few others pass, and it stands below the exchange."""

import pytest
from pyspark.sql import functions as F

from visitlens.operators import prefilter, sessions
from visitlens.params import TaskParams
from visitlens.plans import queries as Q
from visitlens.plans.job import SessionJob, SessionPlans

SMALL = "/root/testdata/sf0.001"


def ids(spark, n, step=1):
    return spark.range(0, n, step).select(F.concat(F.lit("s"), F.col("id")).alias("session_id"))


@pytest.mark.parametrize("words", [1, 64, 4096, prefilter.MAX_WORDS])
def test_no_id_of_the_filter_fails(spark, words):
    held = ids(spark, 20_000, 7)
    bloom = prefilter.bloom_words(held, words)
    assert bloom.count() <= words
    rows = ids(spark, 20_000).withColumn("x", F.lit(1))
    passed = prefilter.might_contain(rows, bloom, words)
    assert passed.columns == ["session_id", "x"]
    assert held.join(passed, "session_id", "left_anti").count() == 0


def test_few_foreign_rows_pass(spark):
    held = ids(spark, 100_000, 100)
    words = prefilter.words_for(1000)
    passed = prefilter.might_contain(ids(spark, 100_000), prefilter.bloom_words(held, words), words).count()
    assert words == 256 and 1000 <= passed <= 1000 + 0.05 * 99_000


def test_sizes():
    assert prefilter.words_for(0) == 1 and prefilter.words_for(5) == 2
    assert prefilter.words_for(4 << 19) == prefilter.words_for(16 << 19) == prefilter.MAX_WORDS
    assert prefilter.words_for((16 << 19) + 8) is None
    with pytest.raises(ValueError):
        prefilter.bloom_words(None, 0)


def test_null_ids_and_an_empty_filter(spark):
    rows = spark.createDataFrame([("a",), (None,)], "session_id string")
    bloom = prefilter.bloom_words(rows, 8)
    assert [r[0] for r in prefilter.might_contain(rows, bloom, 8).collect()] == ["a"]
    assert prefilter.might_contain(rows, prefilter.bloom_words(rows.where("false"), 8), 8).count() == 0


@pytest.fixture
def shuffled(spark):
    """Joins that do not broadcast the sessions, in static plans."""
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def exchanged_rows(df):
    """Records written by the exchange above the action scan (the first input of the semi join)."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()

    def find(node):
        name = node.nodeName()
        if name == "SortMergeJoin" and "LeftSemi" in node.simpleString(10_000):
            return node
        for i in range(node.children().size()):
            hit = find(node.children().apply(i))
            if hit is not None:
                return hit
        return None

    node = find(plan).children().apply(0)
    while node.nodeName() != "Exchange":
        node = node.children().apply(0)
    return node, node.metrics().apply("shuffleRecordsWritten").value()


def rare(prefiltered):
    """The month's actions of users of one age, a small share of all."""
    params = TaskParams.from_values({**Q.FULL_RANGE, "start_age": 7, "end_age": 7})
    return lambda spark: SessionPlans.from_test_tables(spark, SMALL, SessionJob(params, task_id=1), prefilter=prefiltered)


def test_the_filter_stands_below_the_exchange_and_saves_rows(shuffled):
    with_, without = rare(True)(shuffled).session_detail, rare(False)(shuffled).session_detail
    node, few = exchanged_rows(with_)
    assert "BroadcastHashJoin" in node.toString() and "LeftSemi" in node.toString()
    _, many = exchanged_rows(without)
    assert few < 0.2 * many
    assert sorted(map(tuple, with_.collect()), key=str) == sorted(map(tuple, without.collect()), key=str)


@pytest.mark.parametrize("name", ["category_counts", "top10_session", "session_detail"])
def test_results_are_equal(spark, name):
    got, want = (sorted(map(tuple, getattr(rare(p)(spark), name).collect()), key=str) for p in (True, False))
    assert got == want


def test_a_job_decides_by_the_counted_sessions(spark):
    job = SessionJob(Q.PARAMS["main"], task_id=1)
    plans = SessionPlans.from_test_tables(spark, SMALL, job, materialize_mode="persist", prefilter_from=1)
    assert plans._prefilter_words and "LeftSemi" in plans.detail_actions._jdf.queryExecution().optimizedPlan().toString()
    plans.release()
    for values in ({"prefilter_from": 1 << 40}, {"prefilter": False}):
        plans = SessionPlans.from_test_tables(spark, SMALL, job, materialize_mode="persist", **values)
        assert plans._prefilter_words is None
        plans.release()
    unfiltered = SessionPlans.from_test_tables(spark, SMALL, SessionJob(Q.PARAMS["all"]), materialize_mode="persist", prefilter_from=1)
    assert unfiltered._prefilter_words is None  # every session is wanted
    unfiltered.release()
    assert SessionPlans.from_test_tables(spark, SMALL, job)._prefilter_words is None


def test_one_session_is_enough(spark, make_actions):
    from tests.conftest import action

    acts = make_actions([action("a"), action("b"), action("c")])
    held = spark.createDataFrame([("b",)], "session_id string")
    got = sessions.actions_of_sessions(acts, held, prefilter_words=4)
    assert [r["session_id"] for r in got.collect()] == ["b"]
