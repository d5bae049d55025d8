"""Session helpers: partition sizing, the shared checkpoint folder, bounded broadcast."""

from visitlens.plans.physical import MAX_BROADCAST_ROWS, broadcast_if_bounded
from visitlens.session import checkpoint_dir, scale_conf


def test_scale_conf_sizes_partitions_from_input():
    big = scale_conf(100 * 2**40)  # 100 TiB of actions
    assert int(big["spark.sql.shuffle.partitions"]) == 20_000  # capped: the driver tracks maps x reducers
    assert 100 * 2**40 / int(big["spark.sql.files.maxPartitionBytes"]) <= 8 * 20_000
    mid = scale_conf(512 * 2**30, partition_bytes=256 << 20)  # an eighth of 512 GiB is shuffled
    assert int(mid["spark.sql.shuffle.partitions"]) == 256
    assert int(scale_conf(10**6)["spark.sql.shuffle.partitions"]) == 200  # floor
    assert mid["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 << 20)


def test_checkpoint_dir_is_stable_and_usable(spark):
    first = checkpoint_dir(spark)
    assert first and checkpoint_dir(spark) == first
    assert spark.range(10).checkpoint(eager=True).count() == 10


def test_checkpoint_dir_registers_a_folder_in_a_fresh_context():
    import subprocess
    import sys

    import os

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {repo!r});"
        "from pyspark.sql import SparkSession;"
        "from visitlens.session import checkpoint_dir;"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate();"
        "d = checkpoint_dir(s); assert d and s.sparkContext.getCheckpointDir() == d;"
        "assert s.range(3).checkpoint().count() == 3; print('ok')"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith("ok"), out.stderr[-2000:]


def test_broadcast_only_with_a_small_bound(spark):
    df = spark.range(5)

    def hinted(d):
        return "broadcast" in d._jdf.queryExecution().logical().toString().lower()

    assert hinted(broadcast_if_bounded(df, 5))
    assert not hinted(broadcast_if_bounded(df, None))
    assert not hinted(broadcast_if_bounded(df, MAX_BROADCAST_ROWS + 1))
