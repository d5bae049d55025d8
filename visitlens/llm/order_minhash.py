"""Document fingerprints by Order MinHash.

Every k-mer of code points is paired with its occurrence number. For each of ``SKETCHES`` orders the ``PICK``
least pairs are selected, put back in text order, and their k-mers hashed together; equal entries of two
fingerprints estimate a likeness that falls with the edit distance, also when the same k-mers stand in another
order. Equal texts have equal fingerprints.

Defined cases: a null text is empty; the empty text has the all-zero fingerprint; a text shorter than a k-mer
is one k-mer; fewer than ``PICK`` k-mers give shorter tuples; very long texts are worked a few orders at a time;
an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import body, ship_package
from visitlens.sources.tables import read_table

K = 8
SKETCHES = 48
PICK = 2
ROWS_PER_BUCKET = 50_000
SAMPLED = 48  # ids for each bucket, of which the boundaries are drawn
LEAST_BUCKETS = 64
BLOCK = 1 << 21  # hash values held at once

_rng = np.random.default_rng(20240501)
_XOR = _rng.integers(0, 1 << 32, SKETCHES, np.uint32)[:, None]
_MUL = (_rng.integers(0, 1 << 31, SKETCHES, np.uint32) * 2 + 1).astype(np.uint32)[:, None]
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def _kmers(text: str) -> np.ndarray:
    h = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    if len(h) < K:
        whole = np.uint64(len(h))
        with np.errstate(over="ignore"):
            for c in h:
                whole = (whole ^ c) * _M[0]
        return np.array([whole])
    width, step = 1, 0
    while width < K:
        h = h[:-width] * _M[step] + (h[width:] ^ (h[width:] >> np.uint64(29)))
        width, step = width * 2, step + 1
    h = (h ^ (h >> np.uint64(32))) * _M[3]
    return h ^ (h >> np.uint64(29))


def fingerprint(text: str) -> np.ndarray:
    """``SKETCHES`` unsigned 32-bit values."""
    if not text:
        return np.zeros(SKETCHES, np.uint32)
    h = _kmers(text)
    n = len(h)
    top = h >> np.uint64(32)
    order = np.sort(top << np.uint64(32) | np.arange(n, dtype=np.uint64))
    place = (order & np.uint64(0xFFFFFFFF)).astype(np.int64)
    same = order >> np.uint64(32)
    fresh = np.concatenate(([True], same[1:] != same[:-1]))
    run = np.flatnonzero(fresh)
    occurrence = np.empty(n, np.uint32)
    occurrence[place] = np.arange(n) - np.repeat(run, np.diff(np.append(run, n)))
    x = top.astype(np.uint32) + occurrence * np.uint32(0x85EBCA6B)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    x ^= x >> np.uint32(13)
    out = np.empty(SKETCHES, np.uint64)
    per = max(1, BLOCK // n)
    for a in range(0, SKETCHES, per):
        v = (x[None, :] ^ _XOR[a : a + per]) * _MUL[a : a + per]
        rows = np.arange(len(v))
        picked = []
        for _ in range(min(PICK, n)):
            i = v.argmin(1)
            v[rows, i] = 0xFFFFFFFF
            picked.append(i)
        tuples = np.zeros(len(v), np.uint64)
        for i in np.sort(np.stack(picked), axis=0):
            tuples = (tuples ^ h[i]) * _M[0]
            tuples ^= tuples >> np.uint64(31)
        out[a : a + per] = tuples
    return (out >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a == b))


def shown(f: np.ndarray) -> str:
    return f.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every whole text."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(doc).alias("doc_id"), body(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [shown(fingerprint(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    return rows.mapInArrow(work, f"doc_id {dict(rows.dtypes)['doc_id']}, fingerprint string")


def with_next(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (bucket, closing, doc_id, text), each followed in its partition by the next by descending id.

    Ids are cut into buckets at sampled quantiles; a bucket ends with a ``closing`` row that carries the first
    text of the next bucket (after the last: of the first), so no order over the whole table is needed. Equal
    ids go by descending text, null ids last; rows of one id lie in one bucket.
    """
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), body(text).alias("text"))
    ids = rows.select("doc_id")
    n = ids.count()
    if not n:
        return rows.select(F.lit(0).alias("bucket"), F.lit(0).alias("closing"), "doc_id", "text")
    n_buckets = max(LEAST_BUCKETS, n // ROWS_PER_BUCKET)
    share = min(1.0, SAMPLED * n_buckets / n)
    picked = np.sort(ids.where(F.col("doc_id").isNotNull() & (
        F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))).toArrow().column("doc_id").to_numpy())
    inner = sorted({float(picked[i * len(picked) // n_buckets]) for i in range(1, n_buckets)}) if len(picked) else []
    splits = [float("-inf"), *inner, float("inf")]
    cutter = Bucketizer(splits=splits, inputCol="_id", outputCol="_bucket", handleInvalid="keep")
    last = len(splits)  # null ids
    number = F.when(F.col("doc_id").isNull(), F.lit(last)).otherwise(F.lit(last - 1) - F.col("_bucket")).cast("int")

    def bucketed(df: DataFrame) -> DataFrame:
        return cutter.transform(df.withColumn("_id", F.col("doc_id").cast("double"))).withColumn("bucket", number).drop("_id", "_bucket")

    tops = bucketed(ids).groupBy("bucket").agg(F.max("doc_id").alias("doc_id")).orderBy("bucket").collect()
    follows = list(zip(tops, [*tops[1:], tops[0]], strict=True))
    spark = docs.sparkSession
    closing = spark.createDataFrame([(a["bucket"], b["doc_id"]) for a, b in follows], "bucket int, head bigint")
    heads = rows.join(F.broadcast(closing.select("head").distinct()), F.col("doc_id").eqNullSafe(F.col("head")), "left_semi")
    heads = heads.groupBy(F.col("doc_id").alias("h")).agg(F.max("text").alias("text"))
    ends = closing.join(heads, F.col("head").eqNullSafe(F.col("h"))).select(
        "bucket", F.lit(1).alias("closing"), F.lit(None).cast("long").alias("doc_id"), "text")
    every = bucketed(rows).select("bucket", F.lit(0).alias("closing"), "doc_id", "text").unionByName(ends)
    # Each bucket in a partition of its own: by hash, some partitions would get several and others none.
    return every.repartitionById(last, "bucket").sortWithinPartitions("bucket", "closing", F.col("doc_id").desc_nulls_last(), F.col("text").desc())


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and the likeness to it and to the next document."""
    ship_package(spark)
    rows = with_next(read_table(spark, sf_dir, "documents"))
    schema = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out = []
            for closing, doc, text in zip(*(batch.column(c).to_pylist() for c in ("closing", "doc_id", "text")), strict=True):
                print_ = held[2] if held and held[1] == text else fingerprint(text)
                if held:
                    mine, old = held[2], held[1]
                    half = len(old) // 2
                    edited = old[: len(old) - half] + text[:half]
                    other = mine if edited == old else fingerprint(edited)
                    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((held[0], len(old), digest, shown(mine), shown(other), likeness(mine, other), likeness(mine, print_)))
                held = None if closing else (doc, text, print_)
            columns = list(zip(*out, strict=True)) or [[]] * 7
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            names = [f.split()[0] for f in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return rows.mapInArrow(work, schema)
