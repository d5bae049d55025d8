"""The session analysis job: task parameters -> actions -> sessions -> enriched -> filtered ->
five results, all in Catalyst plans. The driver only holds the parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession

from visitlens.operators import categories, prefilter, sampling, sessions, stats, topsessions
from visitlens.operators.filters import FACT_PREDICATES, filter_sessions, session_predicate
from visitlens.params import TaskParams
from visitlens.plans.physical import Settings, broadcast_if_bounded, drop_folder, materialize
from visitlens.session import checkpoint_dir
from visitlens.sinks import ResultSink
from visitlens.sources import adapter_actions, adapter_users, scan_actions, scan_users
from visitlens.sources.actions import bucketed_actions

# Fixed values of the job: result sizes.
TOP_CATEGORIES = 10
TOP_SESSIONS_PER_CATEGORY = 10

# Filtered sessions from which a job puts a Bloom filter before the shuffle of the actions (J2): below, their ids
# are small enough to be broadcast by measured size, and the actions are not shuffled at all.
PREFILTER_FROM = 200_000

# Session settings while a job's plans are in use, read when a plan runs, so they must not depend on who built the
# session. The skewed semi join of J2 is split only with the first one. The second lets listed ids reach Parquet one by
# one, and is set only where ids are pushed.
SPLIT_SKEW = {"spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}
PUSH_IDS = {"spark.sql.parquet.pushdown.inFilterThreshold": str(sessions.MAX_PUSHED_IDS)}


@dataclass
class SessionJob:
    """What to compute: the task and the job's constants."""

    params: TaskParams
    task_id: int = -1
    sample_total: int = sampling.DEFAULT_SAMPLE_TOTAL
    seed: int | str = 42
    top_categories: int = TOP_CATEGORIES
    top_sessions: int = TOP_SESSIONS_PER_CATEGORY
    # A session that is in the sample or in several top lists is listed in session_detail once for
    # each of them; with this option once in all.
    distinct_detail: bool = False


@dataclass
class SessionPlans:
    """Lazily built DataFrames of one job run over an action and a user source.

    ``hot_source``: the hot sessions' actions where the action table is bucketed by session (see
    ``sinks.write_bucketed_actions``); ``action_source`` then holds all other sessions, in buckets. The two share no
    session, so every step by session works on each and the rows are put together.

    ``prefilter``: put a Bloom filter of the filtered sessions before J2's shuffle; by default decided from their
    counted number where they are materialised (``prefilter_from`` or more). ``push_ids``: read the listed sessions'
    actions through a pushed filter on their ids; by default where they are materialised.

    ``release()`` drops what was materialised and restores the session settings that the plans hold.
    """

    job: SessionJob
    action_source: DataFrame
    user_source: DataFrame
    materialize_mode: str = "none"
    hot_source: DataFrame | None = None
    prefilter: bool | None = None
    prefilter_from: int = PREFILTER_FROM
    push_ids: bool | None = None
    _materialized: list[DataFrame] = field(default_factory=list)
    _folder: str | None = None

    def __post_init__(self) -> None:
        self._settings = [Settings(self.action_source.sparkSession, SPLIT_SKEW)]

    @classmethod
    def from_bucketed(cls, spark: SparkSession, table: str, users: DataFrame, job: SessionJob, **kw) -> SessionPlans:
        """Plans over an action table written by ``sinks.write_bucketed_actions``."""
        main, hot = bucketed_actions(spark, table)
        return cls(job, main, users, hot_source=hot, **kw)

    @classmethod
    def from_test_tables(cls, spark: SparkSession, data_dir: str, job: SessionJob, session_per: str = "day", **kw) -> SessionPlans:
        """Plans over the adapter views of a test-data directory."""
        actions = adapter_actions(spark, data_dir, job.params.start_date, job.params.end_date, session_per)
        return cls(job, actions, adapter_users(spark, data_dir), **kw)

    def _keep(self, df: DataFrame) -> DataFrame:
        if self.materialize_mode == "checkpoint" and self._folder is None:
            self._folder = f"{checkpoint_dir(df.sparkSession)}/job-{uuid.uuid4().hex}"
        out = materialize(df, self.materialize_mode, f"{self._folder}/{len(self._materialized)}")
        if self.materialize_mode != "none":  # persist() returns the frame itself
            self._materialized.append(out)
        return out

    def _each(self, step: Callable[[DataFrame, bool], DataFrame]) -> DataFrame:
        """``step(actions, bucketed)`` on each action source, which share no session; the rows together."""
        sources = [(self.action_source, self.hot_source is not None), (self.hot_source, False)]
        parts = [step(scan_actions(s, self.job.params), bucketed) for s, bucketed in sources if s is not None]
        return reduce(DataFrame.unionByName, parts)

    @cached_property
    def actions(self) -> DataFrame:
        return self._each(lambda actions, _: actions)

    @cached_property
    def sessions(self) -> DataFrame:
        return self._each(lambda actions, _: sessions.aggregate_sessions(actions))

    @cached_property
    def enriched(self) -> DataFrame:
        return sessions.enrich_sessions(self.sessions, scan_users(self.user_source))

    @cached_property
    def session_facts(self) -> DataFrame:
        """A1 as the job needs it: no keyword / category lists, any-match flags instead."""
        p = self.job.params
        return self._each(lambda actions, _: sessions.aggregate_session_facts(actions, p.keywords, p.category_ids))

    @cached_property
    def filtered(self) -> DataFrame:
        """Filtered session facts, read by statistics, sampling and the category reports:
        materialised once when the job runs."""
        # A merge join with the users: if they were broadcast, the sessions would reach J2 without a
        # shuffle of their own, and AQE splits a hot session only between two shuffles.
        users = scan_users(self.user_source).hint("merge")
        enriched = sessions.enrich_sessions(self.session_facts, users)
        return self._keep(filter_sessions(enriched, self.job.params, FACT_PREDICATES))

    @cached_property
    def detail_actions(self) -> DataFrame:
        """Actions of the filtered sessions (J2), pruned to the columns the category reports
        read; read by both of them, so materialised when the job runs. A session holding a large
        share of all actions is split across tasks by AQE's skew join handling."""
        rows = self._filtered_actions()
        return self._keep(rows.select("session_id", "click_category_id", "order_category_ids", "pay_category_ids"))

    @cached_property
    def _prefilter_words(self) -> int | None:
        """Words of the Bloom filter before J2's shuffle; None without one (no predicate, too few or too many sessions)."""
        if self.prefilter is False or session_predicate(self.job.params, FACT_PREDICATES) is None:
            return None
        if not self._shares:  # the sessions cannot be counted without computing them
            return prefilter.MAX_WORDS if self.prefilter else None
        n = self.filtered.count()
        return prefilter.words_for(n) if self.prefilter or n >= self.prefilter_from else None

    def _filtered_actions(self) -> DataFrame:
        """J2. Actions that lie in buckets are not shuffled, so no filter stands before them."""
        return self._each(lambda actions, bucketed: sessions.actions_of_sessions(
            actions, self.filtered, None if bucketed else self._prefilter_words))

    @cached_property
    def session_detail(self) -> DataFrame:
        return sessions.detail_rows(self._filtered_actions(), self.job.task_id)

    @cached_property
    def stat_counts(self) -> DataFrame:
        return stats.session_stat_counts(self.filtered)

    @cached_property
    def aggr_stat(self) -> DataFrame:
        return stats.session_aggr_stat(self.stat_counts, self.job.task_id)

    @cached_property
    def hour_counts(self) -> DataFrame:
        return sampling.hour_session_counts(self.filtered)

    @cached_property
    def quota(self) -> DataFrame:
        return sampling.extract_quota(self.hour_counts, self.job.sample_total)

    @cached_property
    def sampled(self) -> DataFrame:
        """The sampled filtered sessions (at most sample_total rows), read by the sample output and
        by both detail outputs: materialised (it is small by construction)."""
        j = self.job
        return self._keep(sampling.sample_sessions(self.filtered, self.quota, j.sample_total, j.seed))

    @cached_property
    def random_extract(self) -> DataFrame:
        j = self.job
        return sampling.random_extract(
            self.filtered, self.quota, j.task_id, j.sample_total, j.seed,
            actions=self.listed_actions if self._shares else self.actions, sampled=self.sampled
        )

    @cached_property
    def random_extract_detail(self) -> DataFrame:
        j = self.job
        return sampling.random_extract_detail(self.actions, self.sampled, j.task_id, j.sample_total)

    @property
    def _shares(self) -> bool:
        """Are intermediate tables kept, so that reading one twice does not compute it twice?"""
        return self.materialize_mode != "none"

    @cached_property
    def category_counts(self) -> DataFrame:
        return categories.category_counts(self.detail_actions, self.session_category_clicks if self._shares else None)

    @cached_property
    def top10_category(self) -> DataFrame:
        """At most 10 rows, read by its output and by the top sessions: materialised."""
        return self._keep(categories.top_categories(self.category_counts, self.job.task_id, self.job.top_categories))

    @cached_property
    def session_category_clicks(self) -> DataFrame:
        """Read by the category counts and by the top sessions, so materialised when the job runs."""
        return self._keep(topsessions.session_category_clicks(self.detail_actions))

    @cached_property
    def top10_session(self) -> DataFrame:
        """At most categories x n rows, read by its output and by the detail: materialised."""
        j = self.job
        return self._keep(
            topsessions.top_sessions(
                self.session_category_clicks, self.top10_category, j.task_id, j.top_sessions, j.top_categories
            )
        )

    @cached_property
    def top10_session_detail(self) -> DataFrame:
        j = self.job
        return topsessions.top_session_detail(
            self.top10_session, self.actions, j.task_id, row_bound=j.top_categories * j.top_sessions
        )

    @property
    def _listed_bound(self) -> int:
        return self.job.sample_total + self.job.top_categories * self.job.top_sessions

    @property
    def _listed_ids(self) -> DataFrame:
        """Ids of the sampled and of the top sessions, once for each list they are in."""
        return self.sampled.select("session_id").unionByName(self.top10_session.select("session_id"))

    @cached_property
    def _pushed_ids(self) -> list[str] | None:
        """The listed ids on the driver, once for each list they are in; None where they are not pushed to the scan."""
        push = self._shares if self.push_ids is None else self.push_ids
        if not push or self._listed_bound > sessions.MAX_PUSHED_IDS:
            return None
        self._settings.append(Settings(self.action_source.sparkSession, PUSH_IDS))
        return [r["session_id"] for r in self._listed_ids.collect()]

    @cached_property
    def listed_actions(self) -> DataFrame:
        """Actions of the sampled and the top sessions, each once, from one scan: the sample's keyword and
        category lists and the detail table read them, so materialised when the job runs. Their ids are few, so
        they are pushed to the scan as a filter; beyond ``MAX_PUSHED_IDS`` they are broadcast."""
        if self._pushed_ids is not None:
            return self._keep(sessions.actions_of_ids(self.actions, self._pushed_ids))
        ids = broadcast_if_bounded(self._listed_ids.distinct(), self._listed_bound)
        return self._keep(sessions.actions_of_sessions(self.actions, ids))

    @cached_property
    def session_detail_output(self) -> DataFrame:
        """The ``session_detail`` table: rows of the sampled sessions (once each) and of the top
        sessions (once per category list they are in), read in ONE scan of the actions joined to
        the broadcast multiset of those ids (at most sample_total + categories x n rows). Equal to
        the union of ``random_extract_detail`` and ``top10_session_detail``; with
        ``distinct_detail`` every listed session's rows once."""
        ids, pushed = self._listed_ids, self._pushed_ids
        if pushed is not None:
            ids = self.action_source.sparkSession.createDataFrame([(i,) for i in pushed], "session_id string")
        if self.job.distinct_detail:
            ids = ids.distinct()
        source = self.listed_actions if self._shares or pushed is not None else self.actions
        rows = source.join(broadcast_if_bounded(ids, self._listed_bound), "session_id", "inner")
        return sessions.detail_rows(rows, self.job.task_id)

    def results(self) -> dict[str, DataFrame]:
        """The five result tables."""
        return {
            "session_aggr_stat": self.aggr_stat,
            "session_random_extract": self.random_extract,
            "session_detail": self.session_detail_output,
            "top10_category": self.top10_category,
            "top10_session": self.top10_session,
        }

    def release(self) -> None:
        """Drop what the run materialised (cached blocks, or the run's folder of written tables) and restore the
        session settings."""
        for df in reversed(self._materialized):
            df.unpersist(blocking=True)
        self._materialized.clear()
        if self._folder is not None:
            drop_folder(self.action_source.sparkSession, self._folder)
            self._folder = None
        while self._settings:
            self._settings.pop().restore()


def run(plans: SessionPlans, sink: ResultSink) -> dict[str, int | None]:
    """Write the five results through ``sink``; return what the sink reports per table. The sink commits after the
    last table, and is told to abort if anything fails before."""
    try:
        sink.begin(plans.action_source.sparkSession, plans.job.task_id)
        try:
            written = {name: sink.write(df, name) for name, df in plans.results().items()}
            sink.commit()
        except BaseException:
            sink.abort()
            raise
        return written
    finally:
        plans.release()
