"""Per-session clicks (A9), grouped top-N (K2) and top-session detail multiplicity."""

from conftest import action

from visitlens.operators.categories import category_counts, top_categories
from visitlens.operators.topsessions import session_category_clicks, top_session_detail, top_sessions


def test_ties_broken_by_session_id(make_actions, spark):
    rows = [action(f"s{i:02d}", click=7) for i in range(12)] + [action("s99", click=7)] * 2
    detail = make_actions(rows)
    top_cat = top_categories(category_counts(detail), task_id=1)
    top = top_sessions(session_category_clicks(detail), top_cat, task_id=1, n=10, n_categories=10)
    got = [(r["session_id"], r["click_count"]) for r in top.orderBy("click_count", "session_id").collect()]
    assert len(got) == 10
    assert got[-1] == ("s99", 2)  # the two-click session ranks first
    assert [s for s, _ in got[:-1]] == [f"s{i:02d}" for i in range(9)]


def test_detail_repeats_per_category_list(make_actions):
    detail = make_actions([action("a", click=1), action("a", click=2), action("b", click=2)])
    top_cat = top_categories(category_counts(detail), task_id=1)
    top = top_sessions(session_category_clicks(detail), top_cat, task_id=1, n=10, n_categories=10)
    multi = top_session_detail(top, detail, 1, 100)
    once = top_session_detail(top, detail, 1, 100, distinct=True)
    # session a is in two category lists: its 2 rows appear twice
    assert sorted(r["session_id"] for r in multi.collect()) == ["a", "a", "a", "a", "b"]
    assert sorted(r["session_id"] for r in once.collect()) == ["a", "a", "b"]


def test_only_top_categories_get_sessions(make_actions):
    rows = [action(f"s{c}_{i}", click=c) for c in range(12) for i in range(c + 1)]
    detail = make_actions(rows)
    top_cat = top_categories(category_counts(detail), task_id=1)
    cats = {r["category_id"] for r in top_sessions(session_category_clicks(detail), top_cat, task_id=1, n=10, n_categories=10).collect()}
    assert cats == set(range(2, 12))
