"""DuckDB SQL for every registered query: an independent formulation of the same results over
the raw tables (events, customer, nation, documents are views in the checker).

The adapter views are spelled in DuckDB's dialect; everything after them is plain SQL written
from the documented semantics, not generated from the Spark plans.
"""

from __future__ import annotations

# The tasks' date ranges and session predicates in SQL, written out: nothing is taken from the engine.
MONTH = "date >= '2024-01-01' AND date <= '2024-01-31'"
WEEK = "date >= '2024-01-08' AND date <= '2024-01-14'"


def _any(values_list: str, wanted: str) -> str:
    return f"EXISTS (SELECT 1 FROM unnest({values_list}) t(x) WHERE CAST(x AS VARCHAR) IN ({wanted}))"


TASKS = {
    "scan": (WEEK, "TRUE"),
    "all": (MONTH, "TRUE"),
    "age": (MONTH, "age BETWEEN 10 AND 50"),
    "professional": (MONTH, "professional IN ('BUILDING', 'FURNITURE')"),
    "city": (MONTH, "city IN ('NATION_1', 'NATION_2', 'NATION_10', 'NATION_20')"),
    "sex": (MONTH, "sex = 'male'"),
    "keyword": (MONTH, _any("kw_list", "'kw1', 'kw2'")),
    "category": (MONTH, _any("cat_list", "'1', '2', '3'")),
    "conjunction": (
        MONTH,
        "age BETWEEN 10 AND 50 AND professional IN ('BUILDING', 'FURNITURE', 'MACHINERY') AND sex = 'male' AND "
        + _any("kw_list", "'kw1', 'kw2', 'kw3', 'kw4', 'kw5'") + " AND "
        + _any("cat_list", "'1', '2', '3', '4', '5', '6', '7', '8', '9', '10'")),
    "main": (MONTH, "age BETWEEN 10 AND 50 AND sex = 'male'"),
}

# Bucket names and inclusive bounds, as documented.
VISIT_BUCKETS = [("1s_3s", 1, 3), ("4s_6s", 4, 6), ("7s_9s", 7, 9), ("10s_30s", 10, 30), ("30s_60s", 31, 60),
                 ("1m_3m", 61, 180), ("3m_10m", 181, 600), ("10m_30m", 601, 1800), ("30m", 1801, None)]
STEP_BUCKETS = [("1_3", 1, 3), ("4_6", 4, 6), ("7_9", 7, 9), ("10_30", 10, 30), ("30_60", 31, 60), ("60", 61, None)]

SPANS = "CASE user_id % 6 WHEN 0 THEN 5 WHEN 1 THEN 11 WHEN 2 THEN 90 WHEN 3 THEN 300 WHEN 4 THEN 1500 ELSE 3600 END"

ADAPTERS = f"""
ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
user_visit_action AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, user_id,
    'u' || user_id || '_' || strftime(ts, '%Y-%m-%d') AS session_id,
    event_id % 10 AS page_id,
    strftime(date_trunc('day', ts) + to_hours(user_id % 23)
      + to_seconds((hour(ts) * 3600 + minute(ts) * 60 + CAST(floor(second(ts)) AS BIGINT)) % ({SPANS})),
      '%Y-%m-%d %H:%M:%S') AS action_time,
    CASE WHEN event_type = 'view' THEN 'kw' || (k % 10) END AS search_keyword,
    CASE WHEN event_type = 'click' THEN k % 20 END AS click_category_id,
    CASE WHEN event_type = 'click' THEN event_id % 100 END AS click_product_id,
    CASE WHEN event_type = 'purchase' THEN (k % 20) || ',' || ((k * 7) % 20) END AS order_category_ids,
    CASE WHEN event_type = 'purchase' THEN (k % 100) || ',' || ((k * 7) % 100) END AS order_product_ids,
    CASE WHEN event_type = 'signup' THEN CAST((k * 3) % 20 AS VARCHAR) END AS pay_category_ids,
    CASE WHEN event_type = 'signup' THEN CAST((k * 3) % 100 AS VARCHAR) END AS pay_product_ids,
    user_id % 10 AS city_id
  FROM ev),
user_info AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
    CAST(c_custkey * 7 % 60 AS INTEGER) AS age, c_mktsegment AS professional, n_name AS city,
    CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

DETAIL_COLUMNS = (
    "user_id, session_id, page_id, action_time, search_keyword, click_category_id, click_product_id, "
    "order_category_ids, order_product_ids, pay_category_ids, pay_product_ids"
)
SESSION_COLUMNS = (
    "session_id, user_id, array_to_string(kw_list, ',') AS search_keywords, "
    "array_to_string(cat_list, ',') AS click_category_ids, visit_length, step_length, "
    "strftime(start_ts, '%Y-%m-%d %H:%M:%S') AS start_time"
)
ENRICHED_COLUMNS = SESSION_COLUMNS + ", age, professional, city, sex"


def base(key: str, period: str = "%Y-%m-%d") -> str:
    """WITH ... up to ``filtered`` (and the detail actions) for the task ``key``; a session is a user's ``period``."""
    dates, predicate = TASKS[key]
    adapters = ADAPTERS.replace("strftime(ts, '%Y-%m-%d') AS session_id", f"strftime(ts, '{period}') AS session_id")
    return f"""WITH {adapters},
actions AS (SELECT * FROM user_visit_action WHERE session_id IS NOT NULL AND {dates}),
session_rows AS (
  SELECT session_id, min(user_id) AS user_id,
    list_sort(list_distinct(list(CASE WHEN search_keyword <> '' THEN search_keyword END))) AS kw_list,
    list_sort(list_distinct(list(click_category_id))) AS cat_list,
    min(TRY_CAST(action_time AS TIMESTAMP)) AS start_ts,
    max(TRY_CAST(action_time AS TIMESTAMP)) AS end_ts,
    count(*) AS step_length
  FROM actions GROUP BY session_id),
sessions AS (
  SELECT session_id, user_id, kw_list, cat_list, date_diff('second', start_ts, end_ts) AS visit_length,
    step_length, start_ts FROM session_rows),
enriched AS (SELECT s.*, u.age, u.professional, u.city, u.sex FROM sessions s JOIN user_info u USING (user_id)),
filtered AS (SELECT * FROM enriched WHERE {predicate}),
detail AS (SELECT * FROM actions WHERE session_id IN (SELECT session_id FROM filtered)),
cat_events AS (
  SELECT category_id, kind FROM (
    SELECT click_category_id AS category_id, 0 AS kind FROM detail WHERE click_category_id IS NOT NULL
    UNION ALL
    SELECT TRY_CAST(x AS BIGINT), 1 FROM (SELECT unnest(string_split(order_category_ids, ',')) AS x FROM detail)
    UNION ALL
    SELECT TRY_CAST(x AS BIGINT), 2 FROM (SELECT unnest(string_split(pay_category_ids, ',')) AS x FROM detail)
  ) WHERE category_id IS NOT NULL),
category_counts AS (
  SELECT category_id, count(*) FILTER (WHERE kind = 0) AS click_count,
    count(*) FILTER (WHERE kind = 1) AS order_count, count(*) FILTER (WHERE kind = 2) AS pay_count
  FROM cat_events GROUP BY category_id),
top10 AS (
  SELECT * FROM category_counts
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10),
clicks AS (
  SELECT session_id, click_category_id AS category_id, count(*) AS click_count
  FROM detail WHERE click_category_id IS NOT NULL GROUP BY session_id, click_category_id),
top_sessions AS (
  SELECT * FROM (
    SELECT c.*, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS rk
    FROM clicks c WHERE category_id IN (SELECT category_id FROM top10)) WHERE rk <= 10),
hour_counts AS (
  SELECT strftime(start_ts, '%Y-%m-%d') AS date, strftime(start_ts, '%H') AS hour, count(*) AS session_count
  FROM filtered WHERE start_ts IS NOT NULL GROUP BY 1, 2),
quota AS (
  SELECT date, hour, session_count, day_session_count, per_day,
    least(session_count, session_count * per_day // day_session_count) AS extract_count
  FROM (
    SELECT date, hour, session_count,
      CAST(sum(session_count) OVER (PARTITION BY date) AS BIGINT) AS day_session_count,
      CAST(1000 // (SELECT count(DISTINCT date) FROM hour_counts) AS BIGINT) AS per_day
    FROM hour_counts)),
sample AS (
  SELECT r.* FROM (
    SELECT f.*, strftime(start_ts, '%Y-%m-%d') AS date, strftime(start_ts, '%H') AS hour,
      row_number() OVER (PARTITION BY strftime(start_ts, '%Y-%m-%d'), strftime(start_ts, '%H')
                         ORDER BY md5(session_id || ':42'), session_id) AS pick
    FROM filtered f WHERE start_ts IS NOT NULL) r
  JOIN quota q USING (date, hour) WHERE r.pick <= q.extract_count)
"""


TASK = "CAST(1 AS BIGINT) AS task_id"


def _filter_sql(key: str) -> str:
    return base(key) + f"SELECT {ENRICHED_COLUMNS} FROM filtered"


def _bucket_cases(column: str, buckets, prefix: str) -> str:
    parts = []
    for name, lo, hi in buckets:
        cond = f"{column} >= {lo}" if hi is None else f"{column} BETWEEN {lo} AND {hi}"
        parts.append(f"WHEN {cond} THEN '{prefix}{name}'")
    return "CASE " + " ".join(parts) + " END"


def _count_filters(column: str, buckets, prefix: str) -> list[str]:
    out = []
    for name, lo, hi in buckets:
        cond = f"{column} >= {lo}" if hi is None else f"{column} BETWEEN {lo} AND {hi}"
        out.append(f"count(*) FILTER (WHERE {cond}) AS {prefix}{name}")
    return out


STAT_COUNTS = ", ".join(
    ["count(*) AS session_count"]
    + _count_filters("visit_length", VISIT_BUCKETS, "visit_length_")
    + _count_filters("step_length", STEP_BUCKETS, "step_length_")
)
RATIOS = ", ".join(
    f"CAST((200 * {c} + nullif(session_count, 0)) // (2 * nullif(session_count, 0)) AS DOUBLE) / 100 AS {c}_ratio"
    for c in [f"visit_length_{n}" for n, _, _ in VISIT_BUCKETS] + [f"step_length_{n}" for n, _, _ in STEP_BUCKETS]
)

WORD_COUNT = r"""
WITH lines AS (
  SELECT unnest(CASE WHEN text = '' THEN []::VARCHAR[]
    ELSE regexp_split_to_array(regexp_replace(text, '(\r\n|\n|\r)\z', ''), '\r\n|\n|\r') END) AS line
  FROM documents),
words AS (
  SELECT unnest(CASE WHEN line <> '' AND rtrim(line, ' ') = '' THEN []::VARCHAR[]
    ELSE string_split(rtrim(line, ' '), ' ') END) AS word
  FROM lines)
SELECT word, count(*) AS count FROM words GROUP BY word
"""


DAY_TASKS = """
WITH days AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM events WHERE ts IS NOT NULL),
tasks AS (
  SELECT CAST(replace(day, '-', '') AS BIGINT) AS task_id, 'sessions of ' || day AS task_name,
    day || ' 00:00:00' AS create_time, CAST(NULL AS VARCHAR) AS start_time, CAST(NULL AS VARCHAR) AS finish_time,
    'session' AS task_type, 'created' AS task_status,
    '{"startDate": ["' || day || '"], "endDate": ["' || day || '"], "startAge": ["10"], "endAge": ["50"], "sex": ["'
      || CASE WHEN dayofmonth(CAST(day AS DATE)) % 2 = 0 THEN 'male' ELSE 'female' END || '"]}' AS task_param
  FROM days)
"""
TASK_PARAM_COLUMNS = ", ".join(
    f"TRY_CAST(json_extract_string(task_param, '$.{name}[0]') AS INTEGER) AS {attr}"
    if attr in ("start_age", "end_age")
    else f"json_extract_string(task_param, '$.{name}[0]') AS {attr}"
    for attr, name in (
        ("start_date", "startDate"), ("end_date", "endDate"), ("start_age", "startAge"), ("end_age", "endAge"),
        ("professionals", "professionals"), ("cities", "cities"), ("sex", "sex"), ("keywords", "keywords"),
        ("category_ids", "categoryIds"))
)


ODD_TASKS = DAY_TASKS.rstrip() + """,
odd AS (
  SELECT task_id, CASE task_id % 100 % 8
    WHEN 1 THEN replace(task_param, '"10"', '"abc"')
    WHEN 2 THEN replace(task_param, '"10"', '10.0')
    WHEN 3 THEN substr(task_param, 1, 30)
    WHEN 4 THEN substr(task_param, 1, length(task_param) - 1)
      || ', "cities": [","], "keywords": ["a,,b,,"], "professionals": [""]}'
    WHEN 5 THEN '[' || task_param || ']'
    WHEN 6 THEN ''
    WHEN 7 THEN replace(task_param, '"50"', '" +50 "')
    ELSE task_param END AS text
  FROM tasks),
typed AS (
  SELECT task_id, text <> '' AND NOT coalesce(json_valid(text) AND starts_with(ltrim(text), '{'), FALSE) AS no_object,
    CASE WHEN json_valid(text) AND starts_with(ltrim(text), '{') THEN text ELSE '{}' END AS doc
  FROM odd),
fields AS (
  SELECT task_id, no_object,
    nullif(json_extract_string(doc, '$.startDate[0]'), '') AS start_date, nullif(json_extract_string(doc, '$.endDate[0]'), '') AS end_date,
    nullif(json_extract_string(doc, '$.startAge[0]'), '') AS low, nullif(json_extract_string(doc, '$.endAge[0]'), '') AS high,
    nullif(json_extract_string(doc, '$.sex[0]'), '') AS sex,
    nullif(json_extract_string(doc, '$.professionals[0]'), '') AS professionals, nullif(json_extract_string(doc, '$.cities[0]'), '') AS cities,
    nullif(json_extract_string(doc, '$.keywords[0]'), '') AS keywords, nullif(json_extract_string(doc, '$.categoryIds[0]'), '') AS category_ids
  FROM typed),
faults AS (
  SELECT *, concat_ws('|', CASE WHEN no_object THEN 'document: not a JSON object' END,
    CASE WHEN low IS NOT NULL AND NOT regexp_matches(low, '^ *[+-]?[0-9]+ *$') THEN 'startAge: not a whole number' END,
    CASE WHEN high IS NOT NULL AND NOT regexp_matches(high, '^ *[+-]?[0-9]+ *$') THEN 'endAge: not a whole number' END) AS errors
  FROM fields)
SELECT task_id, errors,
  CASE WHEN errors = '' THEN start_date END AS start_date, CASE WHEN errors = '' THEN end_date END AS end_date,
  CASE WHEN errors = '' THEN TRY_CAST(replace(trim(low), '+', '') AS INTEGER) END AS start_age,
  CASE WHEN errors = '' THEN TRY_CAST(replace(trim(high), '+', '') AS INTEGER) END AS end_age,
  CASE WHEN errors = '' THEN sex END AS sex,
  CASE WHEN errors = '' THEN replace(rtrim(professionals, ','), ',', '|') END AS professionals,
  CASE WHEN errors = '' THEN replace(rtrim(cities, ','), ',', '|') END AS cities,
  CASE WHEN errors = '' THEN replace(rtrim(keywords, ','), ',', '|') END AS keywords,
  CASE WHEN errors = '' THEN replace(rtrim(category_ids, ','), ',', '|') END AS category_ids
FROM faults
"""

TSV_LINES = """
WITH ev AS (
  SELECT event_id AS n, CASE WHEN event_id % 83 = 5 THEN 'x' || event_id ELSE CAST(event_id AS VARCHAR) END AS a,
    CASE WHEN event_type = 'error' THEN 'null' ELSE event_type END AS b, coalesce(CAST(user_id AS VARCHAR), 'null') AS c
  FROM events),
parts AS (
  SELECT a, b, CASE WHEN n % 97 = 3 THEN NULL WHEN n % 89 = 4 THEN c WHEN n % 79 = 6 THEN 'n/a' ELSE c END AS c,
    CASE WHEN n % 97 = 3 THEN 2 WHEN n % 89 = 4 THEN 4 ELSE 3 END AS size
  FROM ev),
parsed AS (
  SELECT TRY_CAST(nullif(a, 'null') AS INTEGER) AS id, nullif(b, 'null') AS name, TRY_CAST(nullif(c, 'null') AS BIGINT) AS year,
    a || chr(9) || b || CASE size WHEN 2 THEN '' WHEN 3 THEN chr(9) || c ELSE chr(9) || c || chr(9) END AS line,
    CASE WHEN size <> 3 THEN size || ' of 3 fields' WHEN a <> 'null' AND TRY_CAST(a AS INTEGER) IS NULL THEN 'id: no valid int'
      WHEN c <> 'null' AND TRY_CAST(c AS BIGINT) IS NULL THEN 'year: no valid bigint' END AS error
  FROM parts)
"""


def oracle_sql() -> dict[str, str]:
    main = base("main")
    month = base("all", "%Y-%m")
    detail_output = main + f"""SELECT {TASK}, {DETAIL_COLUMNS} FROM actions WHERE session_id IN (SELECT session_id FROM sample)
            UNION ALL SELECT {TASK}, {DETAIL_COLUMNS} FROM top_sessions t JOIN detail d USING (session_id)"""
    return {
        "session_detail_prefiltered": main + f"SELECT {TASK}, {DETAIL_COLUMNS} FROM detail",
        "category_counts_prefiltered": main + "SELECT * FROM category_counts",
        "session_detail_output_pushed": detail_output,
        "session_aggregate_bucketed": base("all") + f"SELECT {SESSION_COLUMNS} FROM sessions",
        "category_counts_bucketed": main + "SELECT * FROM category_counts",
        "task_params_checked": ODD_TASKS,
        "tsv_rows": TSV_LINES + "SELECT id, name, year, CASE WHEN error IS NOT NULL THEN line END AS malformed_line, error FROM parsed",
        "tsv_malformed": TSV_LINES + "SELECT error, count(*) AS n_lines FROM parsed WHERE error IS NOT NULL GROUP BY error",
        "action_scan": base("scan") + "SELECT * FROM actions",
        "session_aggregate": base("all") + f"SELECT {SESSION_COLUMNS} FROM sessions",
        "session_enriched": base("all") + f"SELECT {ENRICHED_COLUMNS} FROM enriched",
        "session_filter_age": _filter_sql("age"),
        "session_filter_professional": _filter_sql("professional"),
        "session_filter_city": _filter_sql("city"),
        "session_filter_sex": _filter_sql("sex"),
        "session_filter_keyword": _filter_sql("keyword"),
        "session_filter_category": _filter_sql("category"),
        "session_filter_all": _filter_sql("conjunction"),
        "session_filter_all_facts": base("conjunction")
        + """SELECT session_id, user_id, visit_length, step_length,
            strftime(start_ts, '%Y-%m-%d %H:%M:%S') AS start_time, age, professional, city, sex FROM filtered""",
        "session_stat_counts": main + f"SELECT {STAT_COUNTS} FROM filtered",
        "session_aggr_stat": main
        + f", counts AS (SELECT {STAT_COUNTS} FROM filtered) SELECT {TASK}, session_count, {RATIOS} FROM counts",
        "session_stat_counts_month": month + f"SELECT {STAT_COUNTS} FROM filtered",
        "session_aggr_stat_month": month
        + f", counts AS (SELECT {STAT_COUNTS} FROM filtered) SELECT {TASK}, session_count, {RATIOS} FROM counts",
        "top10_session_month": month + f"SELECT {TASK}, category_id, session_id, click_count FROM top_sessions",
        "category_list_ids": main
        + """, pieces AS (
            SELECT 'order' AS kind, unnest(string_split(order_category_ids, ',')) AS x FROM detail
            UNION ALL SELECT 'pay', unnest(string_split(pay_category_ids, ',')) FROM detail)
            SELECT kind, count(*) AS n_ids, count(*) FILTER (TRY_CAST(x AS BIGINT) IS NULL) AS n_dropped
            FROM pieces GROUP BY kind""",
        "session_detail": main + f"SELECT {TASK}, {DETAIL_COLUMNS} FROM detail",
        "hour_session_counts": main + "SELECT * FROM hour_counts",
        "extract_quota": main + "SELECT * FROM quota",
        "random_extract": main
        + f"""SELECT {TASK}, session_id, strftime(start_ts, '%Y-%m-%d %H:%M:%S') AS start_time,
            array_to_string(kw_list, ',') AS search_keywords, array_to_string(cat_list, ',') AS click_category_ids
            FROM sample""",
        "random_extract_detail": main
        + f"SELECT {TASK}, {DETAIL_COLUMNS} FROM actions WHERE session_id IN (SELECT session_id FROM sample)",
        "category_universe": main + "SELECT DISTINCT category_id FROM cat_events",
        "click_category_counts": main
        + "SELECT category_id, count(*) AS click_count FROM cat_events WHERE kind = 0 GROUP BY category_id",
        "order_category_counts": main
        + "SELECT category_id, count(*) AS order_count FROM cat_events WHERE kind = 1 GROUP BY category_id",
        "pay_category_counts": main
        + "SELECT category_id, count(*) AS pay_count FROM cat_events WHERE kind = 2 GROUP BY category_id",
        "category_counts": main + "SELECT * FROM category_counts",
        "category_counts_joined": main + "SELECT * FROM category_counts",
        "top10_category": main
        + f"SELECT {TASK}, category_id, click_count, order_count, pay_count FROM top10",
        "session_category_clicks": main + "SELECT * FROM clicks",
        "top10_session": main + f"SELECT {TASK}, category_id, session_id, click_count FROM top_sessions",
        "top10_session_detail": main
        + f"SELECT {TASK}, {DETAIL_COLUMNS} FROM top_sessions t JOIN detail d USING (session_id)",
        "top10_session_detail_distinct": main
        + f"SELECT {TASK}, {DETAIL_COLUMNS} FROM detail WHERE session_id IN (SELECT session_id FROM top_sessions)",
        "session_detail_output": main
        + f"""SELECT {TASK}, {DETAIL_COLUMNS} FROM actions WHERE session_id IN (SELECT session_id FROM sample)
            UNION ALL SELECT {TASK}, {DETAIL_COLUMNS} FROM top_sessions t JOIN detail d USING (session_id)""",
        "session_filter_empty": base("main") + f"SELECT {ENRICHED_COLUMNS} FROM enriched",
        "composite_sort": main + "SELECT * FROM category_counts",
        "label_counts": main
        + f"""SELECT label, count(*) AS count FROM (
              SELECT 'session_count' AS label FROM filtered
              UNION ALL SELECT {_bucket_cases('visit_length', VISIT_BUCKETS, 'visit_length_')} FROM filtered
              UNION ALL SELECT {_bucket_cases('step_length', STEP_BUCKETS, 'step_length_')} FROM filtered)
            WHERE label IS NOT NULL GROUP BY label""",
        "word_count": WORD_COUNT,
        "task_params": DAY_TASKS + f"SELECT task_id, {TASK_PARAM_COLUMNS} FROM tasks",
        "task_lookup": DAY_TASKS + f"SELECT * FROM tasks WHERE task_id = 20240108",
    }
