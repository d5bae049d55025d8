"""Session aggregate (A1), user join (J1), detail rows of selected sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.functions import format_time, ids_to_csv, parse_action_time, strings_to_csv
from visitlens.operators.prefilter import bloom_words, might_contain
from visitlens.plans.physical import broadcast_if_bounded
from visitlens.schemas import SESSION_DETAIL_COLUMNS


def _session_inputs(actions: DataFrame) -> DataFrame:
    keyword = F.col("search_keyword")
    return actions.select(
        "session_id",
        "user_id",
        F.when(keyword != "", keyword).alias("search_keyword"),
        "click_category_id",
        parse_action_time(F.col("action_time")).alias("action_ts"),
    )


def _scalar_aggregates() -> list:
    return [
        F.min("user_id").alias("user_id"),
        F.min("action_ts").alias("start_time"),
        F.max("action_ts").alias("end_time"),
        F.count(F.lit(1)).alias("step_length"),
    ]


def _set_aggregates() -> list:
    return [
        F.array_sort(F.collect_set("search_keyword")).alias("search_keywords"),
        F.array_sort(F.collect_set("click_category_id")).alias("click_category_ids"),
    ]


def _visit_length() -> F.Column:
    return F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time")).alias("visit_length")


def aggregate_sessions(actions: DataFrame) -> DataFrame:
    """One typed row per session_id.

    user_id: smallest user id of the session; search_keywords / click_category_ids: distinct,
    sorted (empty keywords ignored); start_time / end: min / max parsed action time; visit_length:
    whole seconds between them; step_length: number of actions.

    Two steps. First one row for each session, keyword and category: a code-generated hash aggregate
    that can spill, with partial results map-side, shuffled on all three, so the distinct keywords of
    a hot session are counted off on many tasks. Then the sets: what is collected holds every value
    about once, so a session with n distinct values needs the memory of that one output row, in
    whatever number of actions they occur. The job itself uses ``aggregate_session_facts`` and
    reads lists only for the sessions it outputs.
    """
    values = _session_inputs(actions).groupBy("session_id", "search_keyword", "click_category_id").agg(*_scalar_aggregates())
    grouped = values.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
        F.sum("step_length").alias("step_length"),
        *_set_aggregates(),
    )
    return grouped.select(
        "session_id", "user_id", "search_keywords", "click_category_ids", _visit_length(), "step_length", "start_time"
    )


def aggregate_session_facts(
    actions: DataFrame, keywords: tuple[str, ...] | None = None, category_ids: tuple[str, ...] | None = None
) -> DataFrame:
    """A1 without the keyword and category sets: what the job's filters and statistics read.

    Keyword and category any-match become per-session flags (``keyword_match``,
    ``category_match``: does any action search a listed keyword / click a listed category id,
    compared as text), so the whole aggregate is a code-generated hash aggregate with map-side
    partial results, with no object aggregate and no per-task sort of the action rows.
    """
    aggs = _scalar_aggregates()
    if keywords is not None:
        aggs.append(F.bool_or(F.col("search_keyword").isin(list(keywords))).alias("keyword_match"))
    if category_ids is not None:
        hit = F.col("click_category_id").cast("string").isin(list(category_ids))
        aggs.append(F.bool_or(hit).alias("category_match"))
    flags = [c for c, on in (("keyword_match", keywords), ("category_match", category_ids)) if on is not None]
    grouped = _session_inputs(actions).groupBy("session_id").agg(*aggs)
    return grouped.select("session_id", "user_id", _visit_length(), "step_length", "start_time", *flags)


def session_sets(
    actions: DataFrame, sessions: DataFrame, row_bound: int | None, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Sorted keyword and category lists of the given sessions, from their actions, with the
    sessions' ``carry`` columns kept. ``sessions`` is read once: it is broadcast (when
    ``row_bound`` proves it small) and inner-joined to the actions, which are not shuffled; every
    session has at least one action, so none is lost."""
    picked = broadcast_if_bounded(sessions.select("session_id", *carry), row_bound)
    rows = _session_inputs(actions).join(picked, "session_id", "inner")
    return rows.groupBy("session_id", *carry).agg(*_set_aggregates())


def enrich_sessions(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Inner join of sessions to users on user_id: sessions without a user disappear.

    The join strategy is left to AQE: the user side is broadcast only when its measured size is
    under the broadcast threshold, otherwise both sides shuffle on user_id and a skewed user is
    split by AQE's skew-join handling. User predicates applied after this join are pushed below
    it to the user scan by Catalyst.
    """
    return sessions.join(users.select("user_id", "age", "professional", "city", "sex"), "user_id", "inner")


def session_output(sessions: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Edge form of a session row: CSV lists and text timestamps (plus ``extra`` columns)."""
    return sessions.select(
        "session_id",
        "user_id",
        strings_to_csv(F.col("search_keywords")).alias("search_keywords"),
        ids_to_csv(F.col("click_category_ids")).alias("click_category_ids"),
        "visit_length",
        "step_length",
        format_time(F.col("start_time")).alias("start_time"),
        *extra,
    )


USER_ATTRIBUTES = ("age", "professional", "city", "sex")


def enriched_output(enriched: DataFrame) -> DataFrame:
    """Edge form of an enriched session row (session columns plus user attributes)."""
    return session_output(enriched, USER_ATTRIBUTES)


# Ids pushed to a scan at most: a Parquet predicate of that many alternatives.
MAX_PUSHED_IDS = 2000


def actions_of_ids(actions: DataFrame, ids: list[str]) -> DataFrame:
    """Action rows of the listed sessions (at most ``MAX_PUSHED_IDS``), as a filter that reaches the scan.

    On a table whose files are sorted by session the reader then skips the row groups and pages that hold none
    of the ids. Parquet gets the single ids up to ``spark.sql.parquet.pushdown.inFilterThreshold`` of them (a job
    raises it while it runs) and only their range beyond.
    """
    if len(ids) > MAX_PUSHED_IDS:
        raise ValueError(f"{len(ids)} ids; at most {MAX_PUSHED_IDS} are pushed to a scan")
    return actions.where(F.col("session_id").isin(sorted(set(ids))))


def actions_of_sessions(actions: DataFrame, sessions: DataFrame, prefilter_words: int | None = None) -> DataFrame:
    """Action rows whose session is in ``sessions`` (left semi join on session_id).

    Equal to the inner join that keeps only the action side, because session_id is unique on the
    session side. AQE broadcasts the session side only when measured small; otherwise a
    sort-merge semi join whose skewed action partitions AQE splits. With ``prefilter_words`` a Bloom
    filter of the sessions (a broadcast table of at most so many rows) drops most other actions
    before that shuffle.
    """
    if prefilter_words:
        actions = might_contain(actions, bloom_words(sessions, prefilter_words), prefilter_words)
    return actions.join(sessions.select("session_id"), "session_id", "left_semi")


def detail_rows(actions: DataFrame, task_id: int) -> DataFrame:
    """The 12 detail columns (date and city_id dropped), task id first."""
    return actions.select(F.lit(task_id).cast("bigint").alias("task_id"), *SESSION_DETAIL_COLUMNS[1:])
