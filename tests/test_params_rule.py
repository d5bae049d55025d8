"""One rule for a task's parameters in both forms, and the cost-free form of the time parser."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from visitlens.functions.columns import ACTION_TIME, parse_action_time
from visitlens.params import FIELD_NAMES, TaskParams
from visitlens.sources.task import checked_task_params, load_task_params

DOCUMENTS = [
    None, "", "{}", " {} ", "null", "[]", "[{}]", '"x"', "7", "{", "{}x", "{} {}", '{},{}', '{}],[{}', '{},"a":{}', "{'sex':['male']}", '{"sex":["male"],}',
    '{"sex":["male"]}', '{"sex":"male"}', '{"sex":[]}', '{"sex":[null]}', '{"sex":[""]}', '{"sex":["a","b"]}', '{"sex":[" a "]}', '{"sex":[1.50]}', '{"sex":[true]}',
    '{"sex":["male"],"sex":["female"]}', '{"other":[1],"sex":["é"]}', '{"sex":[NaN]}', '{"sex":{"a":1}}', '{"sex":["\\u0041\\n"]}',
    '{"startAge":["abc"],"sex":["m"]}', '{"startAge":[10.0],"endAge":["20"]}', '{"startAge":["x"],"endAge":["y"]}', '{"startAge":[10],"endAge":[" +20 "]}', '{"startAge":["-5"]}',
    '{"startAge":["2147483648"]}', '{"startAge":["2147483647"]}', '{"startAge":["1_0"]}', '{"startAge":["１"]}', '{"startAge":["1e1"]}', '{"startAge":[1e1]}', '{"startAge":[" "]}', '{"startAge":[""]}',
    '{"cities":[","]}', '{"cities":[""]}', '{"cities":["a,,b,,"]}', '{"cities":[",a"]}', '{"cities":["a"]}', '{"keywords":["a, b"]}', '{"categoryIds":[3]}', '{"professionals":[["a"]]}',
    '{"startDate":["2024-01-01"],"endDate":["2024-01-31"],"startAge":["10"],"endAge":["50"],"professionals":["p,q"],"cities":["c"],"sex":["male"],"keywords":["k"],"categoryIds":["1,2"]}',
]


def driver_form(text):
    try:
        p = TaskParams.from_json(text)
    except ValueError as exc:
        return {a: None for a in FIELD_NAMES} | {"errors": str(exc).split("; ")}
    return {a: list(v) if isinstance(v := getattr(p, a), tuple) else v for a in FIELD_NAMES} | {"errors": []}


def test_both_forms_agree(spark):
    tasks = spark.createDataFrame(list(enumerate(DOCUMENTS)), "task_id bigint, task_param string")
    got = {r["task_id"]: r.asDict() for r in checked_task_params(tasks).collect()}
    for i, text in enumerate(DOCUMENTS):
        assert got[i] == {"task_id": i} | driver_form(text), text
    assert sum(bool(r["errors"]) for r in got.values()) >= 20


def test_errors_name_every_fault_and_stop_a_job(spark):
    tasks = spark.createDataFrame([(1, '{"startAge":["x"],"endAge":["y"]}')], "task_id bigint, task_param string")
    tasks = tasks.selectExpr("task_id", *[f"'' as {c}" for c in ("task_name", "create_time", "start_time", "finish_time", "task_type", "task_status")], "task_param")
    with pytest.raises(ValueError, match="startAge: not a whole number; endAge: not a whole number"):
        load_task_params(tasks, 1)


def test_a_list_of_nothing_matches_nothing(spark):
    from visitlens.operators.filters import filter_sessions

    rows = spark.createDataFrame([("c",), ("",)], "city string")
    assert filter_sessions(rows, TaskParams.from_json('{"cities":[","]}')).count() == 0
    assert filter_sessions(rows, TaskParams.from_json('{"cities":[""]}')).count() == 2


BASE = "2024-01-31 09:08:07"
edits = st.lists(st.tuples(st.integers(0, len(BASE) - 1), st.sampled_from(list("0123456789-: +.TZazé\t١"))), max_size=3)


@settings(max_examples=25, deadline=None)
@given(texts=st.lists(st.tuples(edits, st.sampled_from(["", " ", ".5", "Z", "+01:00", "x"]), st.integers(0, 3)), min_size=30, max_size=60))
def test_padded_times_equal_the_pattern(spark, texts):
    rows = []
    for changes, tail, drop in texts:
        chars = list(BASE)
        for at, c in changes:
            chars[at] = c
        rows.append(("".join(chars[drop:] if drop else chars) + tail,))
    df = spark.createDataFrame(rows, "t string")
    old = F.regexp_extract("t", ACTION_TIME, 1).try_cast("timestamp_ntz")
    wrong = df.select("t", parse_action_time(F.col("t")).alias("new"), old.alias("old")).where(~F.col("new").eqNullSafe(F.col("old")))
    assert wrong.collect() == []
