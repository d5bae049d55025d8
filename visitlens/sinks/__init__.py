"""Result writers: any Spark data source (parquet, JDBC, ...) and the tab-separated text sink."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.plans.physical import broadcast_if_bounded


@dataclass
class ResultSink:
    """Writes a result DataFrame to ``<base>/<name>`` (file formats) or to table ``name``
    (JDBC and other table sources, via ``options``). Writes are batched per partition; nothing is
    written row by row from the driver.

    For JDBC: ``ResultSink(fmt="jdbc", options={"url": ..., "user": ..., "password": ...,
    "batchsize": "1000"})``; each result goes to the table of its name. (Not exercised by the
    tests: there is no database here.)
    """

    fmt: str = "parquet"
    base: str | None = None
    mode: str = "append"
    options: dict[str, str] = field(default_factory=dict)
    partition_by: dict[str, list[str]] = field(default_factory=dict)
    idempotent: bool = False

    def begin(self, spark: SparkSession, task_id: int) -> None:
        """A job is about to write its tables."""

    def commit(self) -> None:
        """All tables of the job are written."""

    def abort(self) -> None:
        """The job failed before all tables were written."""

    def write(self, df: DataFrame, name: str) -> None:
        """Write one result table.

        ``idempotent=True`` (file formats): every result is partitioned by ``task_id`` and
        written with dynamic partition overwrite, so re-running a task after a failure replaces
        exactly that task's partitions instead of appending a second copy.
        """
        mode, partition_cols = self.mode, self.partition_by.get(name)
        options = dict(self.options)
        if self.idempotent and self.fmt != "jdbc":
            mode, partition_cols = "overwrite", ["task_id"]
            options["partitionOverwriteMode"] = "dynamic"
        writer = df.write.format(self.fmt).mode(mode).options(**options)
        if partition_cols:
            writer = writer.partitionBy(*partition_cols)
        if self.fmt == "jdbc":
            writer.option("dbtable", name).save()
        else:
            if self.base is None:
                raise ValueError("a file sink needs a base path")
            writer.save(f"{self.base.rstrip('/')}/{name}")


def write_tab_separated(df: DataFrame, path: str) -> None:
    """Text sink of key<TAB>count lines, the values as they are (no quoting); an existing output folder is
    replaced."""
    values = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws("\t", *values).alias("value")).write.mode("overwrite").text(path)


def write_action_table(actions: DataFrame, path: str, mode: str = "append", options: dict[str, str] | None = None) -> None:
    """Lay out an action table partitioned by ``date``: a task's date range then prunes whole
    partition folders (PartitionFilters) before any file is opened.

    The REBALANCE hint groups rows by date but lets AQE split a large day over several tasks
    (and merge small ones), so a day, or a session holding a third of all rows, never lands in
    one task or one file. Within a file rows are sorted by session and time, so a filter on a few
    session ids skips the row groups and pages whose statistics exclude them. ``options``: writer
    options, such as ``parquet.block.size``."""
    (
        actions.hint("rebalance", "date")
        .sortWithinPartitions("date", "session_id", "action_time")
        .write.mode(mode)
        .options(**(options or {}))
        .partitionBy("date")
        .parquet(path)
    )


# Actions of a session from which it is hot: kept out of the buckets.
HOT_ROWS = 1_000_000


def write_bucketed_actions(actions: DataFrame, table: str, buckets: int, path: str, hot_rows: int = HOT_ROWS) -> None:
    """An action table in ``buckets`` by session, partitioned by date, as catalog table ``table`` below ``path``.

    Session aggregates (A1) and the join to the filtered sessions (J2) then need no exchange of the actions: a task
    reads one bucket of all dates of the range. One task must never get a hot session with its bucket, so sessions of
    more than ``hot_rows`` actions go to the table ``<table>_hot``, laid out like ``write_action_table``; a bucket
    holds at most ``hot_rows`` rows of any session. Rows without a session id go there too. There are at most rows / ``hot_rows`` hot ids; they are written
    once and broadcast only when counted small. Both tables replace older ones. There is a file for each bucket and date, so
    ``buckets`` is chosen by the bytes that one task should read of a usual date range.
    """
    spark = actions.sparkSession
    sizes = actions.where(F.col("session_id").isNotNull()).groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
    sizes.where(F.col("n") > hot_rows).select("session_id").write.mode("overwrite").parquet(f"{path}/hot_ids")
    ids = spark.read.schema("session_id string").parquet(f"{path}/hot_ids")
    ids = broadcast_if_bounded(ids, ids.count())
    named, unnamed = F.col("session_id").isNotNull(), F.col("session_id").isNull()
    rest = actions.where(named).join(ids, "session_id", "left_anti").repartition(buckets, "session_id").select(*actions.columns)
    writer = rest.write.mode("overwrite").format("parquet").option("path", f"{path}/main").partitionBy("date")
    writer.bucketBy(buckets, "session_id").sortBy("session_id", "action_time").saveAsTable(table)
    hot = actions.join(ids, "session_id", "left_semi").select(*actions.columns).unionByName(actions.where(unnamed))
    hot = hot.hint("rebalance", "date").sortWithinPartitions("date", "session_id", "action_time")
    hot.write.mode("overwrite").format("parquet").option("path", f"{path}/hot").partitionBy("date").saveAsTable(f"{table}_hot")
