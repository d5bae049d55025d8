"""Streaming category counts (A7 over ``readStream``)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from visitlens.operators.categories import category_counts
from visitlens.schemas import USER_VISIT_ACTION
from visitlens.session import checkpoint_dir


def stream_category_counts(spark: SparkSession, source_dir: str, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """Streaming DataFrame of click/order/pay counts per category over action files in
    ``source_dir`` (declared schema, no inference)."""
    reader = spark.readStream.format(fmt).schema(USER_VISIT_ACTION)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return category_counts(reader.load(source_dir))


def start_category_counts(
    counts: DataFrame, sink_format: str = "memory", query_name: str = "category_counts", **options: str
) -> StreamingQuery:
    """Start the query in ``update`` mode (only changed categories are emitted per trigger)."""
    location = options.pop("checkpointLocation", None) or (
        f"{checkpoint_dir(counts.sparkSession).rstrip('/')}/stream-{query_name}-{uuid.uuid4().hex}"
    )
    writer = counts.writeStream.outputMode("update").format(sink_format).option("checkpointLocation", location)
    if sink_format == "memory":
        writer = writer.queryName(query_name)
    return writer.options(**options).start()
