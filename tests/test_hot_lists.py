"""The lists of a session with a million distinct keywords, in the test session's 1 GB heap."""

from pyspark.sql import functions as F

from visitlens.operators.sessions import aggregate_sessions
from visitlens.schemas import USER_VISIT_ACTION


def test_a_million_keywords(spark):
    n = 1_000_000
    i = F.col("id")
    given = {"date": F.lit("2024-01-01"), "user_id": i % 7, "session_id": F.when(i < 2 * n, "hot").otherwise(F.concat(F.lit("s"), i % 100)),
             "action_time": F.lit("2024-01-01 10:00:00"), "search_keyword": F.concat(F.lit("kw"), i % n), "click_category_id": i % 3}
    actions = spark.range(2 * n + 1000).select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in USER_VISIT_ACTION.fields])
    got = aggregate_sessions(actions).select(
        "session_id", F.size("search_keywords").alias("k"), "step_length", "user_id", F.size("click_category_ids").alias("c"), F.get("search_keywords", F.lit(1)).alias("second"))
    rows = {r["session_id"]: tuple(r)[1:] for r in got.collect()}
    assert rows["hot"] == (n, 2 * n, 0, 3, "kw1") and len(rows) == 101
    plan = aggregate_sessions(actions)._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.rindex("HashAggregate(keys=[session_id"):]
    assert "search_keyword" in first and "collect_set" not in first  # the rows meet a hash aggregate that can spill
