"""Session aggregate (A1), user join (J1) and detail selection (J2) on hand-made rows."""

from conftest import action, user

from visitlens.operators.sessions import actions_of_sessions, aggregate_sessions, enrich_sessions, session_output


def test_session_row_fields(make_actions):
    rows = [
        action("s1", 3, "2024-01-01 5:00:00", keyword="b"),
        action("s1", 2, "2024-01-01 05:00:07", keyword="a", click=12),
        action("s1", 2, "2024-01-01 05:01:00", keyword="", click=1),
        action("s1", 2, "2024-01-01 05:00:30", keyword="b", click=12),
        action("s2", 9, "2024-01-01 23:59:59"),
    ]
    out = {r["session_id"]: r for r in session_output(aggregate_sessions(make_actions(rows))).collect()}
    s1 = out["s1"]
    assert s1["user_id"] == 2  # smallest user of the session
    assert s1["search_keywords"] == "a,b"  # distinct, sorted, empty keyword ignored
    assert s1["click_category_ids"] == "1,12"  # 1 is kept next to 12 (no substring test)
    assert s1["visit_length"] == 60  # unpadded hour parsed
    assert s1["step_length"] == 4
    assert s1["start_time"] == "2024-01-01 05:00:00"
    s2 = out["s2"]
    assert (s2["search_keywords"], s2["click_category_ids"], s2["visit_length"], s2["step_length"]) == ("", "", 0, 1)


def test_keyword_inside_longer_keyword_is_kept(make_actions):
    rows = [action("s", keyword="hotpot"), action("s", keyword="pot")]
    row = session_output(aggregate_sessions(make_actions(rows))).first()
    assert row["search_keywords"] == "hotpot,pot"


def test_bad_time_is_ignored(make_actions):
    rows = [action("s", time="not a time"), action("s", time="2024-01-01 01:00:00"), action("s", time="2024-01-01 01:00:05")]
    row = aggregate_sessions(make_actions(rows)).first()
    assert row["visit_length"] == 5 and row["step_length"] == 3


def test_sessions_without_user_disappear(make_actions, make_users):
    sessions = aggregate_sessions(make_actions([action("a", 1), action("b", 2)]))
    enriched = enrich_sessions(sessions, make_users([user(1, age=33)]))
    rows = enriched.collect()
    assert [(r["session_id"], r["age"]) for r in rows] == [("a", 33)]


def test_detail_keeps_every_action_of_selected_sessions(make_actions):
    actions = make_actions([action("a"), action("a"), action("b"), action("c")])
    picked = aggregate_sessions(actions).where("session_id in ('a', 'c')")
    got = sorted(r["session_id"] for r in actions_of_sessions(actions, picked).collect())
    assert got == ["a", "a", "c"]


def test_typed_session_row_schema(make_actions):
    from visitlens.schemas import SESSION

    got = aggregate_sessions(make_actions([action("a", keyword="k", click=1)])).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in SESSION]
