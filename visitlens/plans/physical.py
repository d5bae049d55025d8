"""Small physical-plan helpers: size-bounded broadcast and lineage cuts."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# The bound counts rows, not bytes: the sides are narrow (ids and a few short columns).
# A side is broadcast explicitly only when a bound on its row count is known before running
# (a top-N list, a sample of a requested size, a fixed dimension) and that bound is below this.
# Above it, the join is left to AQE, which broadcasts only from measured sizes.
MAX_BROADCAST_ROWS = 1_000_000


def broadcast_if_bounded(df: DataFrame, row_bound: int | None, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when ``row_bound`` (a proven upper bound on its rows) is small enough."""
    if row_bound is not None and row_bound <= max_rows:
        return F.broadcast(df)
    return df


class Settings:
    """Session settings that hold until ``restore``; what the caller had set before is put back."""

    def __init__(self, spark: SparkSession, values: dict[str, str]):
        self.spark = spark
        self.before = {name: spark.conf.get(name, None) for name in values}
        for name, value in values.items():
            spark.conf.set(name, value)

    def restore(self) -> None:
        for name, value in self.before.items():
            if value is None:
                self.spark.conf.unset(name)
            else:
                self.spark.conf.set(name, value)
        self.before = {}


def materialize(df: DataFrame, mode: str = "persist", path: str | None = None) -> DataFrame:
    """Materialise a DataFrame read by several branches.

    ``persist``: MEMORY_AND_DISK cache; a lost executor's blocks are recomputed from lineage.
    ``checkpoint``: written as a table to ``path`` (below the shared ``spark.checkpoint.dir``) and read
    again; lineage is cut, so a lost executor costs no recomputation of the upstream plan.
    ``none``: keep the plan as is.
    """
    if mode == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if mode == "checkpoint":
        if path is None:
            raise ValueError("a checkpointed table needs a path")
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    if mode == "none":
        return df
    raise ValueError(f"unknown materialisation mode: {mode}")


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file system access (it may be on a remote store)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
