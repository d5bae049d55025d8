"""Registered queries: name -> (spark, data_dir) -> DataFrame, over the whole test tables.

Every query reads the driver's tables (through the adapter views) and runs the library's
operators on all of their rows. The parameters are fixed here and mirrored in ``oracle.py``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions import format_time

from visitlens.operators import categories, filters, sessions, stats, topsessions, wordcount
from visitlens.params import TaskParams
from visitlens.plans.job import SessionJob, SessionPlans
from visitlens.session import checkpoint_dir
from visitlens.sinks import write_bucketed_actions
from visitlens.sources import adapter_actions, adapter_users, read_table
from visitlens.sources.adapters import event_lines
from visitlens.sources.task import checked_task_params, day_tasks, find_task, odd_day_tasks, parse_task_params
from visitlens.sources.text import malformed_counts, parse_tsv

# Fixed query parameters (mirrored by the oracle SQL).
TASK_ID = 1
SEED = 42
SAMPLE_TOTAL = 1000
FULL_RANGE = {"start_date": "2024-01-01", "end_date": "2024-01-31"}
SCAN_RANGE = {"start_date": "2024-01-08", "end_date": "2024-01-14"}
AGE = {"start_age": 10, "end_age": 50}
PROFESSIONALS = "BUILDING,FURNITURE"
CITIES = "NATION_1,NATION_2,NATION_10,NATION_20"
SEX = "male"
KEYWORDS = "kw1,kw2"
CATEGORY_IDS = "1,2,3"
LOOKUP_TASK_ID = 20240108

PARAMS: dict[str, TaskParams] = {
    "scan": TaskParams.from_values(SCAN_RANGE),
    "all": TaskParams.from_values(FULL_RANGE),
    "age": TaskParams.from_values({**FULL_RANGE, **AGE}),
    "professional": TaskParams.from_values({**FULL_RANGE, "professionals": PROFESSIONALS}),
    "city": TaskParams.from_values({**FULL_RANGE, "cities": CITIES}),
    "sex": TaskParams.from_values({**FULL_RANGE, "sex": SEX}),
    "keyword": TaskParams.from_values({**FULL_RANGE, "keywords": KEYWORDS}),
    "category": TaskParams.from_values({**FULL_RANGE, "category_ids": CATEGORY_IDS}),
    "conjunction": TaskParams.from_values(
        {
            **FULL_RANGE,
            **AGE,
            "professionals": "BUILDING,FURNITURE,MACHINERY",
            "sex": SEX,
            "keywords": "kw1,kw2,kw3,kw4,kw5",
            "category_ids": "1,2,3,4,5,6,7,8,9,10",
        }
    ),
    # the task of the downstream reports: whole month, ages 10-50, men
    "main": TaskParams.from_values({**FULL_RANGE, **AGE, "sex": SEX}),
}


def plans(spark: SparkSession, data_dir: str, key: str, session_per: str = "day", **kw) -> SessionPlans:
    job = SessionJob(PARAMS[key], task_id=TASK_ID, sample_total=SAMPLE_TOTAL, seed=SEED)
    return SessionPlans.from_test_tables(spark, data_dir, job, session_per, **kw)


def bucketed_plans(spark: SparkSession, data_dir: str, key: str) -> SessionPlans:
    """Plans over the actions written in 16 buckets by session; a session of more than 8 actions counts as hot."""
    name = f"actions_{uuid.uuid4().hex}"
    write_bucketed_actions(adapter_actions(spark, data_dir), name, 16, f"{checkpoint_dir(spark)}/{name}", hot_rows=8)
    job = SessionJob(PARAMS[key], task_id=TASK_ID, sample_total=SAMPLE_TOTAL, seed=SEED)
    return SessionPlans.from_bucketed(spark, name, adapter_users(spark, data_dir), job)


def _filter_query(key: str, predicate) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, data_dir: str) -> DataFrame:
        p = plans(spark, data_dir, key)
        return sessions.enriched_output(filters.filter_sessions(p.enriched, p.job.params, (predicate,)))

    return query


def action_scan(spark, data_dir):
    return plans(spark, data_dir, "scan").actions


def session_aggregate(spark, data_dir):
    return sessions.session_output(plans(spark, data_dir, "all").sessions)


def session_enriched(spark, data_dir):
    return sessions.enriched_output(plans(spark, data_dir, "all").enriched)


def session_filter_all(spark, data_dir):
    p = plans(spark, data_dir, "conjunction")
    return sessions.enriched_output(filters.filter_sessions(p.enriched, p.job.params))


def session_filter_all_facts(spark, data_dir):
    """The same conjunction on the job's path (flags instead of lists); session ids and facts."""
    p = plans(spark, data_dir, "conjunction")
    return p.filtered.select(
        "session_id", "user_id", "visit_length", "step_length", format_time(F.col("start_time")).alias("start_time"),
        "age", "professional", "city", "sex",
    )


def session_stat_counts(spark, data_dir):
    return plans(spark, data_dir, "main").stat_counts


def session_aggr_stat(spark, data_dir):
    return plans(spark, data_dir, "main").aggr_stat


def session_stat_counts_month(spark, data_dir):
    """Sessions of a user and month: long ones, which reach the last step buckets."""
    return plans(spark, data_dir, "all", "month").stat_counts


def session_aggr_stat_month(spark, data_dir):
    return plans(spark, data_dir, "all", "month").aggr_stat


def top10_session_month(spark, data_dir):
    """Top sessions where a session clicks a category several times, so that ranks rest on counts."""
    return plans(spark, data_dir, "all", "month").top10_session


def session_detail(spark, data_dir):
    return plans(spark, data_dir, "main").session_detail


def session_detail_prefiltered(spark, data_dir):
    """J2 with a Bloom filter of the filtered sessions before the actions are shuffled."""
    return plans(spark, data_dir, "main", prefilter=True).session_detail


def category_counts_prefiltered(spark, data_dir):
    return plans(spark, data_dir, "main", prefilter=True).category_counts


def session_detail_output_pushed(spark, data_dir):
    """The job's ``session_detail`` table, its sessions' ids pushed to the scan."""
    return plans(spark, data_dir, "main", push_ids=True).session_detail_output


def session_aggregate_bucketed(spark, data_dir):
    """A1 over an action table in buckets by session, hot sessions apart."""
    return sessions.session_output(bucketed_plans(spark, data_dir, "all").sessions)


def category_counts_bucketed(spark, data_dir):
    return bucketed_plans(spark, data_dir, "main").category_counts


def hour_session_counts(spark, data_dir):
    return plans(spark, data_dir, "main").hour_counts


def extract_quota(spark, data_dir):
    return plans(spark, data_dir, "main").quota


def random_extract(spark, data_dir):
    return plans(spark, data_dir, "main").random_extract


def random_extract_detail(spark, data_dir):
    return plans(spark, data_dir, "main").random_extract_detail


def category_universe(spark, data_dir):
    return categories.category_universe(plans(spark, data_dir, "main").detail_actions)


def click_category_counts(spark, data_dir):
    return categories.click_category_counts(plans(spark, data_dir, "main").detail_actions)


def order_category_counts(spark, data_dir):
    return categories.order_category_counts(plans(spark, data_dir, "main").detail_actions)


def pay_category_counts(spark, data_dir):
    return categories.pay_category_counts(plans(spark, data_dir, "main").detail_actions)


def category_counts(spark, data_dir):
    return plans(spark, data_dir, "main").category_counts


def session_detail_output(spark, data_dir):
    """The job's ``session_detail`` table: sampled and top sessions' rows in one scan."""
    return plans(spark, data_dir, "main").session_detail_output


def session_filter_empty(spark, data_dir):
    """A form with every filter field left empty: nothing is filtered."""
    form = TaskParams.from_values({"start_age": "", "end_age": "", "professionals": "", "cities": "", "sex": "",
                                   "keywords": "", "category_ids": ""})
    return sessions.enriched_output(filters.filter_sessions(plans(spark, data_dir, "main").enriched, form))


def category_list_ids(spark, data_dir):
    """How many listed category ids there are, and how many are dropped as no number."""
    return categories.list_id_counts(plans(spark, data_dir, "main").detail_actions)


def category_counts_joined(spark, data_dir):
    return categories.category_counts_joined(plans(spark, data_dir, "main").detail_actions)


def top10_category(spark, data_dir):
    return plans(spark, data_dir, "main").top10_category


def session_category_clicks(spark, data_dir):
    return plans(spark, data_dir, "main").session_category_clicks


def top10_session(spark, data_dir):
    return plans(spark, data_dir, "main").top10_session


def top10_session_detail(spark, data_dir):
    return plans(spark, data_dir, "main").top10_session_detail


def top10_session_detail_distinct(spark, data_dir):
    p = plans(spark, data_dir, "main")
    return topsessions.top_session_detail(p.top10_session, p.actions, TASK_ID, p.job.top_categories * p.job.top_sessions, distinct=True)


def composite_sort(spark, data_dir):
    return categories.composite_sort(plans(spark, data_dir, "main").category_counts)


def label_counts(spark, data_dir):
    return stats.label_counts(plans(spark, data_dir, "main").filtered)


def word_count(spark, data_dir):
    docs = read_table(spark, data_dir, "documents").select("text")
    return wordcount.word_count(wordcount.text_lines(docs))


def task_params(spark, data_dir):
    return parse_task_params(day_tasks(spark, data_dir))


def task_params_checked(spark, data_dir):
    """Task documents as users get them wrong: typed parameters (lists joined by |) and what is wrong."""
    rows = checked_task_params(odd_day_tasks(spark, data_dir))
    joined = [F.array_join(c, "|").alias(c) if kind.startswith("array") else F.col(c) for c, kind in rows.dtypes]
    return rows.select(*joined)


def tsv_rows(spark, data_dir):
    """Events as tab-separated lines, some malformed, read back."""
    return parse_tsv(event_lines(spark, data_dir))


def tsv_malformed(spark, data_dir):
    return malformed_counts(parse_tsv(event_lines(spark, data_dir)))


def task_lookup(spark, data_dir):
    return find_task(day_tasks(spark, data_dir), LOOKUP_TASK_ID)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "action_scan": action_scan,
    "session_aggregate": session_aggregate,
    "session_enriched": session_enriched,
    "session_filter_age": _filter_query("age", filters.age_between),
    "session_filter_professional": _filter_query("professional", filters.professional_in),
    "session_filter_city": _filter_query("city", filters.city_in),
    "session_filter_sex": _filter_query("sex", filters.sex_equals),
    "session_filter_keyword": _filter_query("keyword", filters.keywords_any),
    "session_filter_category": _filter_query("category", filters.categories_any),
    "session_filter_all": session_filter_all,
    "session_filter_all_facts": session_filter_all_facts,
    "session_stat_counts": session_stat_counts,
    "session_aggr_stat": session_aggr_stat,
    "session_stat_counts_month": session_stat_counts_month,
    "session_aggr_stat_month": session_aggr_stat_month,
    "top10_session_month": top10_session_month,
    "session_detail": session_detail,
    "hour_session_counts": hour_session_counts,
    "extract_quota": extract_quota,
    "random_extract": random_extract,
    "random_extract_detail": random_extract_detail,
    "category_universe": category_universe,
    "click_category_counts": click_category_counts,
    "order_category_counts": order_category_counts,
    "pay_category_counts": pay_category_counts,
    "category_counts": category_counts,
    "session_detail_output": session_detail_output,
    "session_filter_empty": session_filter_empty,
    "category_list_ids": category_list_ids,
    "category_counts_joined": category_counts_joined,
    "top10_category": top10_category,
    "session_category_clicks": session_category_clicks,
    "top10_session": top10_session,
    "top10_session_detail": top10_session_detail,
    "top10_session_detail_distinct": top10_session_detail_distinct,
    "composite_sort": composite_sort,
    "label_counts": label_counts,
    "word_count": word_count,
    "task_params": task_params,
    "task_lookup": task_lookup,
    "session_detail_prefiltered": session_detail_prefiltered,
    "category_counts_prefiltered": category_counts_prefiltered,
    "session_detail_output_pushed": session_detail_output_pushed,
    "session_aggregate_bucketed": session_aggregate_bucketed,
    "category_counts_bucketed": category_counts_bucketed,
    "task_params_checked": task_params_checked,
    "tsv_rows": tsv_rows,
    "tsv_malformed": tsv_malformed,
}
