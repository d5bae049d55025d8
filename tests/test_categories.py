"""Category universe, counts (A4-A7 vs J4), top categories (K1), composite sort (K5)."""

from conftest import action

from visitlens.operators.categories import (
    category_counts,
    category_counts_joined,
    category_universe,
    composite_sort,
    top_categories,
)


def rows_of(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_counts_per_occurrence_and_bad_ids(make_actions):
    detail = make_actions(
        [
            action("s", click=1),
            action("s", click=1),
            action("s", orders="1,2,2"),
            action("s", orders="x,,3"),  # bad and empty pieces are dropped
            action("s", pays="2"),
            action("s", pays=""),
        ]
    )
    got = rows_of(category_counts(detail), "category_id", "click_count", "order_count", "pay_count")
    assert got == [(1, 2, 1, 0), (2, 0, 2, 1), (3, 0, 1, 0)]
    assert rows_of(category_universe(detail), "category_id") == [(1,), (2,), (3,)]


def test_one_pass_equals_three_joins(make_actions):
    detail = make_actions(
        [action(f"s{i}", click=i % 4, orders=f"{i % 3},{i % 5}", pays=str(i % 6)) for i in range(40)]
        + [action("t", click=None, orders=None, pays=None)]
    )
    cols = ("category_id", "click_count", "order_count", "pay_count")
    assert rows_of(category_counts(detail), *cols) == rows_of(category_counts_joined(detail), *cols)


def test_top_categories_order_and_ties(spark):
    counts = spark.createDataFrame(
        [(c, 5, 1, 1) for c in range(12, 0, -1)] + [(99, 5, 2, 0), (98, 6, 0, 0)],
        "category_id long, click_count long, order_count long, pay_count long",
    )
    top = [r["category_id"] for r in top_categories(counts, task_id=1, n=10).collect()]
    assert top == [98, 99, 1, 2, 3, 4, 5, 6, 7, 8]


def test_composite_descending_sort(spark):
    # three keys; the label column says which row is which
    df = spark.createDataFrame([(30, 35, 40, "1"), (35, 30, 40, "3"), (30, 38, 30, "4")], "a long, b long, c long, label string")
    got = [r["label"] for r in composite_sort(df, keys=("a", "b", "c"), tie_breaker=None).collect()]
    assert got == ["3", "4", "1"]



def test_lists_of_picked_sessions_match_session_lists(make_actions):
    from visitlens.operators.sessions import aggregate_sessions, session_sets

    actions = make_actions(
        [
            action("a", keyword="kw2", click=5),
            action("a", keyword="kw1", orders="7,8"),
            action("a", keyword="", click=5),
            action("b", pays="3"),  # no click, no keyword: empty lists
            action("c", orders="x"),  # only an unparsable id
        ]
    )
    full = aggregate_sessions(actions)
    got = {r["session_id"]: (r["search_keywords"], r["click_category_ids"], r["step_length"])
           for r in session_sets(actions, full, 10, carry=("step_length",)).collect()}
    want = {r["session_id"]: (r["search_keywords"], r["click_category_ids"], r["step_length"]) for r in full.collect()}
    assert got == want
    assert got["c"] == ([], [], 1)
