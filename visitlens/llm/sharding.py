"""Sharding by sampled splitters, near-equal in bytes.

The key is the hash of the text, so equal texts stand together. A size-weighted sample of keys gives quantile
boundaries of many small ranges; a key that fills a range alone gets a range of its own, and an overfull range
is subdivided (a single key by row, others by key). The exact bytes of the ranges, added up in order, place
every row at its offset in the whole, and the shard is that offset's share of the total: shards differ by
about one record. Texts are dropped before the first shuffle; what reaches the driver are sampled keys and
one total per range (a range is about ``ROWS_PER_RANGE`` rows).

Defined cases: a null text has size 8; equal rows are told apart by a row number fixed in a checkpoint; fewer
rows than shards leave shards empty; an empty table gives no rows; other columns are only kept if named in
``carry``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitlens.llm.common import body, cut
from visitlens.sources.tables import read_table

N_SHARDS = 24
ROWS_PER_RANGE = 100_000
SAMPLES_PER_RANGE = 32


def sampled_splitters(rows: DataFrame, total: int, n_ranges: int) -> tuple[list[int], set[int]]:
    """(first keys of the ranges, keys that have a range alone) from a size-weighted sample of keys."""
    want = SAMPLES_PER_RANGE * n_ranges
    chance = F.least(F.col("size") * F.lit(want / total), F.lit(1.0))
    draw = F.pmod(F.xxhash64("key", "n"), F.lit(1 << 40)) < chance * F.lit(float(1 << 40))
    keys = np.sort(np.array([r[0] for r in rows.where(draw).select("key").collect()], np.int64))
    if not len(keys):
        return [], set()
    distinct, count = np.unique(keys, return_counts=True)
    hot = set(distinct[count >= SAMPLES_PER_RANGE].tolist())
    cuts = {int(keys[i * len(keys) // n_ranges]) for i in range(1, n_ranges)}
    alone = hot | {k + 1 for k in hot if k < (1 << 63) - 1}
    return sorted(cuts | alone), hot


def shard(docs: DataFrame, n_shards: int = N_SHARDS, doc: str = "doc_id", text: str = "text",
          carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) and the columns named in ``carry``."""
    kept = F.struct(*[F.col(c) for c in carry]).alias("carried") if carry else F.lit(None).cast("string").alias("carried")
    rows = cut(docs.select(
        F.col(doc).alias("doc_id"), (F.octet_length(body(text)).cast("long") + 8).alias("size"),
        F.crc32(body(text).cast("binary")).alias("text_crc32"), F.xxhash64(body(text)).alias("key"),
        F.monotonically_increasing_id().alias("n"), kept))
    total, n_rows = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    n_ranges = max(8 * n_shards, n_rows // ROWS_PER_RANGE)
    starts, hot = sampled_splitters(rows, max(total, 1), n_ranges)
    starts_ = np.array(starts, np.int64)

    @F.pandas_udf("long")
    def range_of(keys: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for k in keys:
            yield pd.Series(np.searchsorted(starts_, k.to_numpy(), side="right"))

    rows = rows.withColumn("range", range_of("key"))
    target = max(1, total // n_ranges)
    full = rows.groupBy("range").agg(F.sum("size").alias("b")).where(F.col("b") > 2 * target).collect()
    alone = set((np.searchsorted(starts_, np.array(sorted(hot), np.int64)) + 1).tolist())
    spark = docs.sparkSession
    split = spark.createDataFrame([(r["range"], -(-r["b"] // target), r["range"] in alone) for r in full],
                                  "range bigint, parts bigint, alone boolean")
    part = F.when(F.col("parts").isNull(), F.lit(0)).when(F.col("alone"), F.pmod(F.xxhash64("n"), "parts")).otherwise(
        F.pmod(F.xxhash64("key", F.lit(7)), "parts"))
    rows = rows.join(F.broadcast(split), "range", "left").withColumn("part", part)

    sums = rows.groupBy("range", "part").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("c"))
    bases, at_byte, at_row = [], 0, 0
    for r in sorted(sums.collect(), key=lambda r: (r["range"], r["part"])):
        bases.append((r["range"], r["part"], at_byte, at_row))
        at_byte, at_row = at_byte + r["b"], at_row + r["c"]
    base = F.broadcast(spark.createDataFrame(bases, "range bigint, part bigint, byte_base bigint, row_base bigint"))
    own = Window.partitionBy("range", "part").orderBy("key", "n")
    before = F.coalesce(F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = (
        rows.withColumn("before", before).withColumn("nth", F.row_number().over(own))
        .join(base, ["range", "part"])
        .withColumn("middle", 2 * (F.col("byte_base") + F.col("before")) + F.col("size"))
        .withColumn("shard", F.least(F.expr(f"middle * {n_shards} div {2 * max(total, 1)}"), F.lit(n_shards - 1)).cast("int"))
        .select("doc_id", "size", "text_crc32", "carried", "shard", (F.col("row_base") + F.col("nth") - 1).alias("row"))
    )
    placed = cut(placed)
    first = F.broadcast(placed.groupBy("shard").agg(F.min("row").alias("first")))  # at most n_shards rows
    columns = ["doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first")).alias("slot")]
    return placed.join(first, "shard").select(*columns, *(["carried.*"] if carry else []))


def write_shards(docs: DataFrame, path: str, n_shards: int = N_SHARDS, **options) -> None:
    """Write all columns of ``docs`` as Parquet, one folder for each shard, rows in slot order in each file."""
    taken = {"size", "text_crc32", "shard", "slot"} & set(docs.columns)
    if taken:
        raise ValueError(f"columns that the shards add themselves must be renamed first: {', '.join(sorted(taken))}")
    out = shard(docs, n_shards, carry=tuple(c for c in docs.columns if c != "doc_id"), **options)
    out.repartition("shard", F.expr("slot div 1000000")).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards by the law of near-equal bytes."""
    out = shard(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
