"""Plan shape of the registered queries: what should (and should not) be in the physical plan."""

import pytest

import __spark_entry__ as E
from visitlens.plans.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # inspect the static plan
    try:
        yield {name: physical(fn(spark, DATA)) for name, fn in QUERIES.items()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_python_udf_cross_join_or_driver_collect(plans):
    for name, plan in plans.items():
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)


def test_no_interpreted_lambdas(plans):
    # higher-order functions (transform/filter lambdas) are evaluated row by row outside codegen
    for name, plan in plans.items():
        assert "lambdafunction" not in plan, name


@pytest.mark.parametrize("name", ["top10_session", "random_extract"])
def test_grouped_top_n_is_limited_before_the_shuffle(plans, name):
    plan = plans[name]
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan


def test_top_categories_use_take_ordered(plans):
    assert "TakeOrderedAndProject" in plans["top10_category"]


def test_date_range_reaches_the_scan(spark):
    df = E.queries()["action_scan"](spark, DATA)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in text


def test_word_count_reads_one_column(spark):
    text = E.queries()["word_count"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string>" in text


def test_aggregations_are_partial(plans):
    for name in ("session_aggregate", "category_counts", "word_count", "session_category_clicks"):
        assert "partial_" in plans[name], name


def test_results_do_not_depend_on_the_session_time_zone(spark):
    names = ["action_scan", "session_aggregate", "random_extract", "hour_session_counts"]
    before = {n: sorted(tuple(map(str, r)) for r in E.queries()[n](spark, DATA).collect()) for n in names}
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        after = {n: sorted(tuple(map(str, r)) for r in E.queries()[n](spark, DATA).collect()) for n in names}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert before == after


def _children(node):
    seq = node.children()
    return [seq.apply(i) for i in range(seq.size())]


def _subtree_names(node):
    names = [node.nodeName()]
    for child in _children(node):
        names += _subtree_names(child)
    return names


def _top_broadcast_join(node):
    if node.nodeName() == "BroadcastHashJoin":
        return node
    for child in _children(node):
        found = _top_broadcast_join(child)
        if found is not None:
            return found
    return None


@pytest.mark.parametrize("which", ["session_detail_output", "top10_session_detail", "random_extract_detail"])
def test_detail_outputs_do_not_shuffle_actions(spark, which):
    from visitlens.plans.job import SessionJob, SessionPlans
    from visitlens.plans import queries as Q

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plans = SessionPlans.from_test_tables(spark, DATA, SessionJob(Q.PARAMS["main"], task_id=1, sample_total=1000))
        root = getattr(plans, which)._jdf.queryExecution().executedPlan()
        join = _top_broadcast_join(root)
        assert join is not None
        streamed = _children(join)[0] if join.buildSide().toString() == "BuildRight" else _children(join)[1]
        names = _subtree_names(streamed)
        assert "FileSourceScanExec" in names or any("Scan" in n for n in names)
        assert "ShuffleExchangeExec" not in names and "Exchange" not in names, names
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
