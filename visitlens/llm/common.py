"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import visitlens
from visitlens.plans.physical import MAX_BROADCAST_ROWS
from visitlens.session import checkpoint_dir


def body(text: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def numbered(df: DataFrame) -> DataFrame:
    """The columns as c0, c1, ...: names that no operator uses itself, so that none of the user's is lost or ambiguous.
    ``toDF(*names)`` on a result with the same columns gives the names back."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))])


def number_of(df: DataFrame, column: str) -> str:
    """What ``numbered`` calls ``column``."""
    return f"c{df.columns.index(column)}"


def cut(df: DataFrame) -> DataFrame:
    """Eager checkpoint in the shared folder: lineage ends here and a lost executor recomputes nothing above."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small(df: DataFrame, rows: int, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when the counted ``rows`` are within ``max_rows``; else the join is left to a shuffle."""
    return F.broadcast(df) if rows <= max_rows else df


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each context (they may not have it installed)."""
    sc = spark.sparkContext
    if not getattr(sc, "_visitlens_shipped", False):
        home = os.path.dirname(os.path.abspath(visitlens.__file__))
        to = os.path.join(tempfile.mkdtemp(prefix="visitlens-"), "visitlens")
        sc.addPyFile(shutil.make_archive(to, "zip", os.path.dirname(home), os.path.basename(home)))
        sc._visitlens_shipped = True
