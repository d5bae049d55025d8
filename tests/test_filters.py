"""Session predicates F1-F6 and their conjunction."""

import pytest
from conftest import action, user

from visitlens.operators.filters import filter_sessions
from visitlens.operators.sessions import aggregate_sessions, enrich_sessions
from visitlens.params import TaskParams


@pytest.fixture
def enriched(make_actions, make_users):
    actions = make_actions(
        [
            action("s1", 1, keyword="kw1", click=1),
            action("s2", 2, keyword="kw2"),
            action("s3", 3, click=3),
            action("s4", 4),
        ]
    )
    users = make_users(
        [
            user(1, age=20, professional="BUILDING", city="NATION_1", sex="male"),
            user(2, age=50, professional="FURNITURE", city="NATION_2", sex="female"),
            user(3, age=51, professional="MACHINERY", city="NATION_3", sex="male"),
            user(4, age=None, professional=None, city=None, sex=None),
        ]
    )
    return enrich_sessions(aggregate_sessions(actions), users)


def ids(df):
    return sorted(r["session_id"] for r in df.collect())


@pytest.mark.parametrize(
    "values, expected",
    [
        ({}, ["s1", "s2", "s3", "s4"]),
        ({"start_age": 20, "end_age": 50}, ["s1", "s2"]),
        ({"start_age": 20}, ["s1", "s2", "s3", "s4"]),  # one bound only: no predicate
        ({"professionals": "BUILDING,MACHINERY"}, ["s1", "s3"]),
        ({"cities": "NATION_2"}, ["s2"]),
        ({"sex": "male"}, ["s1", "s3"]),
        ({"sex": "mal"}, []),  # whole-string equality
        ({"keywords": "kw2,kw9"}, ["s2"]),
        ({"keywords": "kw"}, []),
        ({"category_ids": "1,3"}, ["s1", "s3"]),
        ({"category_ids": "01"}, []),  # ids compare as text
        ({"sex": "male", "start_age": 0, "end_age": 30, "category_ids": "1,3"}, ["s1"]),
    ],
)
def test_predicates(enriched, values, expected):
    assert ids(filter_sessions(enriched, TaskParams.from_values(values))) == expected


def test_user_predicates_reach_user_side(enriched):
    df = filter_sessions(enriched, TaskParams.from_values({"sex": "male"}))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    join_at = plan.index("Join Inner")
    assert "sex" in plan[join_at:] and "= male" in plan[join_at:]


@pytest.mark.parametrize(
    "values",
    [
        {"keywords": "kw2,kw9"},
        {"keywords": ""},
        {"keywords": "kw1,,kw2"},
        {"category_ids": "1,3"},
        {"category_ids": "01"},
        {"sex": "male", "start_age": 0, "end_age": 30, "category_ids": "1,3", "keywords": "kw1"},
        {"professionals": "BUILDING,MACHINERY", "cities": "NATION_1,NATION_3"},
    ],
)
def test_fact_flags_select_the_same_sessions(make_actions, make_users, values):
    from visitlens.operators.filters import FACT_PREDICATES
    from visitlens.operators.sessions import aggregate_session_facts

    actions = make_actions(
        [
            action("s1", 1, keyword="kw1", click=1),
            action("s1", 1, keyword="", click=None),
            action("s2", 2, keyword="kw2"),
            action("s3", 3, click=3),
            action("s4", 4),
        ]
    )
    users = make_users(
        [
            user(1, age=20, professional="BUILDING", city="NATION_1", sex="male"),
            user(2, age=50, professional="FURNITURE", city="NATION_2", sex="female"),
            user(3, age=51, professional="MACHINERY", city="NATION_3", sex="male"),
            user(4),
        ]
    )
    params = TaskParams.from_values(values)
    lists = filter_sessions(enrich_sessions(aggregate_sessions(actions), users), params)
    facts = enrich_sessions(aggregate_session_facts(actions, params.keywords, params.category_ids), users)
    assert ids(filter_sessions(facts, params, FACT_PREDICATES)) == ids(lists)
