"""Seeded synthetic inputs in the original job's input shapes (S15), generated by Spark at any size.

Randomness is a hash of (seed, purpose, row coordinates), so the output does not depend on the
partitioning and is the same on every run with the same seed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

KEYWORDS = [f"keyword{i}" for i in range(10)]
SEARCH, CLICK, ORDER, PAY = 0, 1, 2, 3


@dataclass(frozen=True)
class GeneratorSpec:
    users: int = 100
    sessions_per_user_draw: int = 10  # sessions created per (randomly drawn) user
    user_draws: int = 100  # users drawn with repeats
    max_actions: int = 23  # actions per session uniform in [0, max_actions)
    categories: int = 100
    products: int = 100
    day: str = "2024-01-01"
    seed: int = 0


def _draw(seed: int, purpose: str, modulus: int, *coords: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(purpose), *coords), F.lit(modulus))


def generate_actions(spark: SparkSession, spec: GeneratorSpec = GeneratorSpec()) -> DataFrame:
    """``user_visit_action`` rows: sessions of drawn users, actions of four kinds; the category of
    a session's first click stays on its later rows, hours are not zero-padded."""
    s = spec.seed
    sid = F.col("id")
    sessions = spark.range(spec.user_draws * spec.sessions_per_user_draw).select(
        sid.alias("s"),
        _draw(s, "user", spec.users, F.floor(sid / spec.sessions_per_user_draw)).alias("user_id"),
        F.md5(F.concat(F.lit(f"{s}:"), sid.cast("string"))).alias("session_id"),
        _draw(s, "hour", 23, sid).alias("base_hour"),
        _draw(s, "count", spec.max_actions, sid).alias("n_actions"),
    )
    steps = sessions.where(F.col("n_actions") > 0).withColumn(
        "k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_actions") - 1))
    )
    at = (F.col("s"), F.col("k"))
    kind = _draw(s, "kind", 4, *at)

    def when_kind(k: int, value: Column) -> Column:
        return F.when(kind == k, value)

    first_click = Window.partitionBy("s").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    clicked = when_kind(CLICK, _draw(s, "category", spec.categories, *at))
    time = F.concat(
        F.lit(spec.day + " "),
        F.col("base_hour").cast("string"),
        F.lit(":"),
        F.lpad(_draw(s, "minute", 59, *at).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad(_draw(s, "second", 59, *at).cast("string"), 2, "0"),
    )
    return steps.select(
        F.lit(spec.day).alias("date"),
        "user_id",
        "session_id",
        _draw(s, "page", 10, *at).alias("page_id"),
        time.alias("action_time"),
        when_kind(SEARCH, F.element_at(F.array(*map(F.lit, KEYWORDS)), (_draw(s, "kw", 10, *at) + 1).cast("int"))).alias(
            "search_keyword"
        ),
        F.first(clicked, ignorenulls=True).over(first_click).alias("click_category_id"),
        when_kind(CLICK, _draw(s, "product", spec.products, *at)).alias("click_product_id"),
        when_kind(ORDER, _draw(s, "ocat", spec.categories, *at).cast("string")).alias("order_category_ids"),
        when_kind(ORDER, _draw(s, "oprod", spec.products, *at).cast("string")).alias("order_product_ids"),
        when_kind(PAY, _draw(s, "pcat", spec.categories, *at).cast("string")).alias("pay_category_ids"),
        when_kind(PAY, _draw(s, "pprod", spec.products, *at).cast("string")).alias("pay_product_ids"),
        _draw(s, "city", 10, *at).alias("city_id"),
    )


def generate_users(spark: SparkSession, spec: GeneratorSpec = GeneratorSpec()) -> DataFrame:
    """``user_info`` rows for user ids 0 .. users-1."""
    s, uid = spec.seed, F.col("id")
    return spark.range(spec.users).select(
        uid.alias("user_id"),
        F.concat(F.lit("user"), uid.cast("string")).alias("username"),
        F.concat(F.lit("name"), uid.cast("string")).alias("name"),
        _draw(s, "age", 60, uid).cast("int").alias("age"),
        F.concat(F.lit("professional"), _draw(s, "professional", 100, uid).cast("string")).alias("professional"),
        F.concat(F.lit("city"), _draw(s, "city", 100, uid).cast("string")).alias("city"),
        F.when(_draw(s, "sex", 2, uid) == 0, F.lit("male")).otherwise(F.lit("female")).alias("sex"),
    )


def generate_products(spark: SparkSession, spec: GeneratorSpec = GeneratorSpec()) -> DataFrame:
    """``product_info`` rows with a JSON ``product_status`` of 0 or 1."""
    s, pid = spec.seed, F.col("id")
    status = _draw(s, "status", 2, pid).cast("string")
    return spark.range(spec.products).select(
        pid.alias("product_id"),
        F.concat(F.lit("product"), pid.cast("string")).alias("product_name"),
        F.concat(F.lit('{"product_status": '), status, F.lit("}")).alias("extend_info"),
    )
