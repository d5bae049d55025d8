"""Declared schemas: inputs, the typed session row and the five result tables."""

from pyspark.sql import types as T

USER_VISIT_ACTION = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("action_time", T.StringType()),
        T.StructField("search_keyword", T.StringType()),
        T.StructField("click_category_id", T.LongType()),
        T.StructField("click_product_id", T.LongType()),
        T.StructField("order_category_ids", T.StringType()),
        T.StructField("order_product_ids", T.StringType()),
        T.StructField("pay_category_ids", T.StringType()),
        T.StructField("pay_product_ids", T.StringType()),
        T.StructField("city_id", T.LongType()),
    ]
)

USER_INFO = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("username", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("professional", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("sex", T.StringType()),
    ]
)

PRODUCT_INFO = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("extend_info", T.StringType()),
    ]
)

TASK = T.StructType(
    [
        T.StructField("task_id", T.LongType()),
        T.StructField("task_name", T.StringType()),
        T.StructField("create_time", T.StringType()),
        T.StructField("start_time", T.StringType()),
        T.StructField("finish_time", T.StringType()),
        T.StructField("task_type", T.StringType()),
        T.StructField("task_status", T.StringType()),
        T.StructField("task_param", T.StringType()),
    ]
)

# The demo table of the SQL example: nullable year.
INFO = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("year", T.LongType()),
    ]
)

# One typed row per session (internal form; arrays become CSV only at the output edge).
SESSION = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("search_keywords", T.ArrayType(T.StringType(), containsNull=False)),
        T.StructField("click_category_ids", T.ArrayType(T.LongType(), containsNull=False)),
        T.StructField("visit_length", T.LongType()),
        T.StructField("step_length", T.LongType()),
        T.StructField("start_time", T.TimestampNTZType()),
    ]
)

# Result table column names, in output order.
SESSION_DETAIL_COLUMNS = [
    "task_id",
    "user_id",
    "session_id",
    "page_id",
    "action_time",
    "search_keyword",
    "click_category_id",
    "click_product_id",
    "order_category_ids",
    "order_product_ids",
    "pay_category_ids",
    "pay_product_ids",
]
RANDOM_EXTRACT_COLUMNS = ["task_id", "session_id", "start_time", "search_keywords", "click_category_ids"]
TOP10_CATEGORY_COLUMNS = ["task_id", "category_id", "click_count", "order_count", "pay_count"]
TOP10_SESSION_COLUMNS = ["task_id", "category_id", "session_id", "click_count"]
