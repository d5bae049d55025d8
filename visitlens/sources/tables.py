"""Parquet tables of a data directory (one ``<name>.parquet`` per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


# Declared schemas of the tables the engine reads: no inference job, no footer reads over many
# files at scale, and a changed input type fails at once instead of flowing through.
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table_path(data_dir: str, name: str) -> str:
    return f"{data_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan with the declared schema when there is one; callers select only the
    columns they need so the scan is pruned."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(table_path(data_dir, name))
