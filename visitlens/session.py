"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every run of the engine relies on. AQE re-plans joins from measured sizes (so a
# broadcast is only chosen for a side that was actually measured small) and splits skewed
# shuffle partitions; timestamps are wall-clock (timestamp_ntz), the zone is pinned anyway.
#
# forceOptimizeSkewedJoin: the detail semi join (actions x filtered sessions on session_id) feeds
# an aggregate on (session_id, category_id) that would reuse the join's partitioning. Without this
# flag AQE refuses to split a skewed session there (splitting needs one more shuffle), so a
# session holding a third of all actions would be joined and aggregated in one task. With it the
# join is split (SortMergeJoin(skew=true)) and the aggregate gets its own partial+final exchange.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # PySpark records the Python call site of every column expression for error messages, at the
    # price of extra JVM round trips while plans are built; batch jobs do without.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app: str = "visitlens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
    hive: bool = False,
) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; tests pass ``local[*]``.
    ``hive=True`` reads the action and user tables from a Hive metastore; otherwise the session's
    default catalog (temp views, paths) is used.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if hive:
        builder = builder.enableHiveSupport()
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, partition_bytes: int = 256 << 20,
               max_partitions: int = 20_000, shuffled_share: float = 0.125) -> dict[str, str]:
    """Partition sizing for a run over ``input_bytes`` of action data on a cluster.

    Scans are split into pieces of ``partition_bytes``, larger ones where there would be more than eight
    map tasks for each of ``max_partitions``. What is shuffled is ``shuffled_share`` of the input (pruned
    columns and partial aggregates); the first shuffle starts with enough partitions that each holds about
    ``partition_bytes`` of it, at most ``max_partitions`` (the driver tracks maps x reducers), and AQE
    coalesces small ones back to the advisory size. Skew thresholds follow the same size.
    """
    shuffled = int(input_bytes * shuffled_share)
    partitions = max(200, min(max_partitions, -(-shuffled // partition_bytes)))
    split_bytes = max(partition_bytes, -(-input_bytes // (8 * max_partitions)))
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder of the session, registering one if needed.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object store) folder; Spark
    registers it when the context starts, and it is used as is. Only when nothing is configured,
    as in local tests, a fresh local folder is created and registered on the context (the setting
    itself cannot be changed at runtime).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    else:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="visitlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp")))
    return sc.getCheckpointDir()
