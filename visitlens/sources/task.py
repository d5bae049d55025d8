"""Task source (S5) and columnar task-parameter parsing.

The task table lives wherever the deployment keeps it (JDBC, parquet, a catalog table); the job
reads it with Spark's own data sources, finds one task by id, and turns its JSON parameters into
typed values. Only that one small row reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.params import FIELD_NAMES, INTEGER_VALUED, MULTI_VALUED, NOT_AN_OBJECT, WHOLE_NUMBER, TaskParams
from visitlens.sources.tables import read_table

TASK_COLUMNS = [
    "task_id",
    "task_name",
    "create_time",
    "start_time",
    "finish_time",
    "task_type",
    "task_status",
    "task_param",
]


def read_tasks(spark: SparkSession, fmt: str = "jdbc", path: str | None = None, **options: str) -> DataFrame:
    """The task table from any Spark source, e.g. ``read_tasks(spark, "jdbc", url=..., dbtable="task",
    user=..., password=...)`` or ``read_tasks(spark, "parquet", "/path/task")``."""
    reader = spark.read.format(fmt).options(**options)
    return reader.load(path) if path else reader.load()


def find_task(tasks: DataFrame, task_id: int) -> DataFrame:
    """The row of one task (empty when there is none); a pushed-down equality filter."""
    return tasks.where(F.col("task_id") == F.lit(task_id)).select(*TASK_COLUMNS)


# A declared struct: a field of another shape becomes NULL by itself and leaves the others alone.
PARAM_DOC = ", ".join(f"{name} array<string>" for name in FIELD_NAMES.values())


def _first(doc: Column, field: str) -> Column:
    """Element 0 of the array under ``field``; NULL when absent, not an array, empty, or empty text."""
    return F.nullif(F.get(doc[field], F.lit(0)), F.lit(""))


def parse_task_params(tasks: DataFrame) -> DataFrame:
    """F10 as a column expression: one typed row of parameters per task (for many tasks at once)."""
    doc = F.from_json(F.col("task_param"), PARAM_DOC)
    cols = []
    for attr, name in FIELD_NAMES.items():
        value = _first(F.col("doc"), name)
        if attr in ("start_age", "end_age"):
            value = value.try_cast("int")
        cols.append(value.alias(attr))
    return tasks.select("task_id", doc.alias("doc")).select("task_id", *cols)


def _pieces(value: Column) -> Column:
    """A comma list's pieces without empty ones at the end; NULL stays NULL."""
    held = F.regexp_replace(value, ",+$", "")
    none = F.array().cast("array<string>")
    return F.when(held == "", F.when(value.isNotNull(), none)).otherwise(F.split(held, ","))


def checked_task_params(tasks: DataFrame) -> DataFrame:
    """F10 with its errors, for many tasks at once: task_id, a column for each parameter (ages as int, lists as
    array<string>) and ``errors``, an empty list where the document is in order. The rule is that of
    ``TaskParams.from_json``; where that raises, ``errors`` holds the same messages and every parameter is NULL.
    """
    text = F.col("task_param")
    # Strict JSON, as a whole. The variant parser stops after the first document, so the text is read inside brackets
    # and inside an object: only a single whole document stands in both.
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    named = F.try_parse_json(F.concat(F.lit('{"document":'), text, F.lit(',"end":0}')))
    single = F.try_variant_get(listed, "$[1]", "variant").isNull() & F.try_variant_get(named, "$.end", "int").isNotNull()
    is_object = F.schema_of_variant(listed).startswith("ARRAY<OBJECT<") & single
    doc = F.from_json(F.when(is_object, text), PARAM_DOC, {"allowSingleQuotes": "false"})
    rows = tasks.select("task_id", doc.alias("doc"), (F.coalesce(text, F.lit("")) != "").alias("given"), F.coalesce(is_object, F.lit(False)).alias("ok"))
    rows = rows.select("task_id", "given", "ok", *[_first(F.col("doc"), name).alias(attr) for attr, name in FIELD_NAMES.items()])
    number = lambda c: F.when(F.col(c).rlike(WHOLE_NUMBER), F.trim(c).try_cast("int"))
    errors = [F.when(F.col("given") & ~F.col("ok"), NOT_AN_OBJECT)]
    errors += [F.when(F.col(a).isNotNull() & number(a).isNull(), f"{FIELD_NAMES[a]}: not a whole number") for a in INTEGER_VALUED]
    rows = rows.withColumn("errors", F.array_except(F.array(*errors), F.array(F.lit(None).cast("string"))))
    good = F.size("errors") == 0
    cols = []
    for attr in FIELD_NAMES:
        value = number(attr) if attr in INTEGER_VALUED else _pieces(F.col(attr)) if attr in MULTI_VALUED else F.col(attr)
        cols.append(F.when(good, value).alias(attr))
    return rows.select("task_id", *cols, "errors")


def load_task_params(tasks: DataFrame, task_id: int) -> TaskParams:
    """Parameters of one task for building the job's plan; an unknown or ambiguous id is an error, not a
    job over everything."""
    rows = find_task(tasks, task_id).select("task_param").limit(2).collect()
    if len(rows) != 1:
        raise LookupError(f"task {task_id}: {'not found' if not rows else 'more than one row'}")
    return TaskParams.from_json(rows[0]["task_param"])


def odd_day_tasks(spark: SparkSession, data_dir: str) -> DataFrame:
    """``day_tasks`` with documents as users get them wrong, by the day of the month. Test-data plumbing."""
    tasks = day_tasks(spark, data_dir)
    day = (F.col("task_id") % 100).cast("int")
    as_given = F.col("task_param")
    odd = (
        F.when(day % 8 == 1, F.regexp_replace(as_given, '"10"', '"abc"'))
        .when(day % 8 == 2, F.regexp_replace(as_given, '"10"', "10.0"))
        .when(day % 8 == 3, F.substring(as_given, 1, 30))
        .when(day % 8 == 4, F.regexp_replace(as_given, "}$", ', "cities": [","], "keywords": ["a,,b,,"], "professionals": [""]}'))
        .when(day % 8 == 5, F.concat(F.lit("["), as_given, F.lit("]")))
        .when(day % 8 == 6, F.lit(""))
        .when(day % 8 == 7, F.regexp_replace(as_given, '"50"', '" +50 "'))
        .otherwise(as_given)
    )
    return tasks.withColumn("task_param", odd)


def day_tasks(spark: SparkSession, data_dir: str) -> DataFrame:
    """A task table derived from the test data: one task per calendar day of ``events``, asking
    for that day's sessions of one sex (alternating) aged 10-50. Test-data plumbing, like the
    adapter views."""
    days = (
        read_table(spark, data_dir, "events")
        .select(F.date_format("ts", "yyyy-MM-dd").alias("day"))
        .where(F.col("day").isNotNull())
        .distinct()
    )
    day = F.col("day")
    task_id = F.regexp_replace(day, "-", "").cast("bigint")
    sex = F.when(F.dayofmonth(F.to_date(day)) % 2 == 0, F.lit("male")).otherwise(F.lit("female"))
    param = F.concat(
        F.lit('{"startDate": ["'), day, F.lit('"], "endDate": ["'), day,
        F.lit('"], "startAge": ["10"], "endAge": ["50"], "sex": ["'), sex, F.lit('"]}'),
    )
    return days.select(
        task_id.alias("task_id"),
        F.concat(F.lit("sessions of "), day).alias("task_name"),
        F.concat(day, F.lit(" 00:00:00")).alias("create_time"),
        F.lit(None).cast("string").alias("start_time"),
        F.lit(None).cast("string").alias("finish_time"),
        F.lit("session").alias("task_type"),
        F.lit("created").alias("task_status"),
        param.alias("task_param"),
    )
