"""In-memory rows with a declared schema, registered as a temp view (S3)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def inline_table(spark: SparkSession, rows: Iterable[tuple], schema: StructType, view: str | None = None) -> DataFrame:
    """A small table from driver-side rows (demos, parameters, fixtures); optionally a temp view."""
    df = spark.createDataFrame(list(rows), schema)
    if view:
        df.createOrReplaceTempView(view)
    return df
