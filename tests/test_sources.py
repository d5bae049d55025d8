"""Parameters (F10), task source (S5), text/TSV (S12/S14), inline table (S3), generator."""

import json
import tempfile

import pytest

from visitlens.params import TaskParams, task_id_from_args
from visitlens.schemas import INFO, TASK
from visitlens.sources.generate import GeneratorSpec, generate_actions, generate_products, generate_users
from visitlens.sources.inline import inline_table
from visitlens.sources.task import find_task, load_task_params, parse_task_params
from visitlens.sources.text import read_text_lines, read_tsv


def test_params_element_zero_and_csv():
    doc = {"startDate": ["2024-01-01", "ignored"], "endAge": ["50"], "startAge": ["10"],
           "cities": ["NATION_1,NATION_2,"], "sex": [], "keywords": "not an array"}
    p = TaskParams.from_json(json.dumps(doc))
    assert p.start_date == "2024-01-01" and p.end_date is None
    assert (p.start_age, p.end_age) == (10, 50) and p.has_age_range
    assert p.cities == ("NATION_1", "NATION_2")
    assert p.sex is None and p.keywords is None
    assert TaskParams.from_json(p.to_json()) == p


def test_task_id_from_args():
    assert task_id_from_args(["7"]) == 7
    assert task_id_from_args([]) == -1
    assert task_id_from_args(["x"]) == -1


def test_task_lookup_and_columnar_params(spark):
    param = TaskParams.from_values({"start_date": "2024-01-02", "end_date": "2024-01-03", "start_age": 5,
                                    "end_age": 9, "professionals": "A,B"}).to_json()
    tasks = spark.createDataFrame([(1, "t", None, None, None, None, None, param), (2, "u", None, None, None, None, None, "{}")], TASK)
    assert find_task(tasks, 3).count() == 0
    assert load_task_params(tasks, 1).professionals == ("A", "B")
    with pytest.raises(LookupError):
        load_task_params(tasks, 3)
    with pytest.raises(LookupError):
        load_task_params(tasks.union(tasks), 1)
    rows = {r["task_id"]: r for r in parse_task_params(tasks).collect()}
    assert rows[1]["start_date"] == "2024-01-02" and rows[1]["start_age"] == 5 and rows[1]["professionals"] == "A,B"
    assert rows[2]["start_date"] is None and rows[2]["start_age"] is None


def test_text_and_tsv_sources(spark):
    folder = tempfile.mkdtemp(prefix="visitlens-test-")
    with open(f"{folder}/data.tsv", "w") as f:
        f.write("1\tAnn\t1990\n2\tBob\tnull\n")
    rows = read_tsv(spark, f"{folder}/data.tsv").collect()
    assert [(r["id"], r["name"], r["year"]) for r in rows] == [(1, "Ann", 1990), (2, "Bob", None)]
    assert [r["line"] for r in read_text_lines(spark, f"{folder}/data.tsv").collect()][1] == "2\tBob\tnull"


def test_inline_table_view_and_sql(spark):
    inline_table(spark, [(1, "a", 1990), (2, "b", None)], INFO, view="info")
    assert [r["year"] for r in spark.sql("select * from info order by id").collect()] == [1990, None]


def test_generator_shape_and_determinism(spark):
    spec = GeneratorSpec(users=20, user_draws=10, sessions_per_user_draw=5, seed=3)
    a = generate_actions(spark, spec)
    rows = a.collect()
    assert sorted(rows) == sorted(generate_actions(spark, spec).collect())
    assert all(0 <= r["user_id"] < 20 for r in rows)
    assert all(r["action_time"].startswith("2024-01-01 ") for r in rows)
    # a session's first clicked category stays on its later rows
    by_session = {}
    for r in sorted(rows, key=lambda r: r["session_id"]):
        by_session.setdefault(r["session_id"], set()).add(r["click_category_id"])
    assert all(len(v - {None}) <= 1 for v in by_session.values())
    assert generate_users(spark, spec).count() == 20
    assert generate_products(spark, spec).count() == 100


def test_both_parameter_forms_agree(spark):
    """Empty, mixed and malformed fields: each costs only itself, and empty text is absent."""
    docs = ['{}', '{"cities":[""],"sex":[""],"keywords":[""],"categoryIds":[""],"professionals":[""],"startAge":[""],"endAge":[""]}',
            '{"startDate":"2024-01-01","sex":["male"]}', '{"n":3,"sex":["male"]}', '{"sex":["male"],"obj":{"a":1}}',
            '{"sex":[],"cities":[null],"keywords":["a,b","c"],"startAge":[5],"endAge":["9"]}']
    tasks = spark.createDataFrame([(i, "t", None, None, None, None, None, d) for i, d in enumerate(docs)], TASK)
    rows = {r["task_id"]: r.asDict() for r in parse_task_params(tasks).collect()}
    for i, d in enumerate(docs):
        p = TaskParams.from_json(d)
        for name, value in rows[i].items():
            if name != "task_id":
                own = getattr(p, name)
                assert value == (",".join(own) if isinstance(own, tuple) else own), (d, name)
    assert TaskParams.from_json(docs[1]) == TaskParams()
