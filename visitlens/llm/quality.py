"""Quality by compression: which of two zstandard dictionaries shortens a text more.

One dictionary is trained on blocks of texts labelled good, one on blocks of texts labelled bad. A text is cut
into blocks of ``BLOCK`` bytes and each block is compressed with both, so a long text does not drown the
dictionaries in its own repetitions. The difference of the two total sizes over the text's own size is
calibrated to a probability by a logistic curve whose slope and offset depend on the text's length (a short
text says less), fitted on labelled texts that no dictionary saw.

The fit reads bounded samples, chosen by hash order: ``FIT_DOCS`` documents per class for the dictionaries, of
them ``FIT_BLOCKS`` blocks per class, and ``CALIBRATION_DOCS`` documents for the curve. Scores are computed for
every whole text.

Defined cases: a null or empty text has difference 0 and gets the curve's value there; a document labelled
more than once counts as bad if any label says so; null labels are ignored; a class without texts gets an
empty dictionary, and without calibration texts of both classes the curve is flat at the labelled share (0.5
with no labels); rows are independent; a null id is held out; empty tables give no rows; further columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import body, number_of, numbered, ship_package
from visitlens.sources.tables import read_table, table_path

BLOCK = 512
FIT_DOCS = 6_000
FIT_BLOCKS = 10_000
CALIBRATION_DOCS = 6_000
DICTIONARY_BYTES = 512 << 10
LEVEL = 3
SHORT = 64  # bytes of a text whose shortness is one half
FOLDS = 5
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    """``curve``: slope, offset, and what is added to offset and slope times ``shortness``."""

    bad: bytes
    good: bytes
    curve: tuple[float, float, float, float]


def fold(doc: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo the folds; fold 0 is held out, the last one calibrates."""
    return F.crc32(F.coalesce(F.col(doc).cast("string"), F.lit("")).cast("binary")) % FOLDS


def _compressor(dictionary: bytes):
    import zstandard as zs

    options = {"level": LEVEL, "write_content_size": False, "write_dict_id": False, "write_checksum": False}
    if dictionary:
        options["dict_data"] = zs.ZstdCompressionDict(dictionary)
        options["dict_data"].precompute_compress(level=LEVEL)
    return zs.ZstdCompressor(**options)


def train_dictionary(blocks: list[bytes]) -> bytes:
    """A zstandard dictionary of at most ``DICTIONARY_BYTES``; the joined blocks where there are too few to train."""
    import zstandard as zs

    try:
        return zs.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except zs.ZstdError:
        return b"".join(blocks)[-DICTIONARY_BYTES:] if sum(map(len, blocks)) >= 8 else b""


def difference(data: bytes, bad, good) -> float:
    """Bytes more with the bad dictionary than with the good one, for a byte of the text."""
    more = 0
    for i in range(0, len(data), BLOCK):
        block = data[i : i + BLOCK]
        more += len(bad.compress(block)) - len(good.compress(block))
    return more / max(1, len(data))


def differences(docs: DataFrame, bad: bytes, good: bytes, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """``keep`` columns, the compressed-size ``difference`` and the ``n_bytes`` of every whole text."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((bad, good))
    read = text if text in keep else "_text"
    rows = docs.select(*keep) if text in keep else docs.select(*keep, body(text).alias("_text"))
    ship_package(spark)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = map(_compressor, shared.value)
        for batch in batches:
            data = [(t or "").encode() for t in batch.column(read).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array([difference(t, one, two) for t in data], pa.float64()),
                 pa.array(list(map(len, data)), pa.int64())], [*keep, "difference", "n_bytes"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(work, ", ".join([f"`{c}` {kinds[c]}" for c in keep] + ["difference double", "n_bytes bigint"]))


def calibrate(d: np.ndarray, n: np.ndarray, y: np.ndarray) -> tuple[float, float, float, float]:
    """The logistic curve, by Newton steps with a slight pull to a flat one."""
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return 0.0, float(np.log(share / (1 - share))), 0.0, 0.0
    short = SHORT / (SHORT + n)
    x = np.stack([d * 10, np.ones_like(d), short, short * d * 10], axis=1)
    w = np.zeros(4)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x.T * (p * (1 - p))) @ x + 1e-2 * np.eye(4)
        step = np.linalg.solve(hess, x.T @ (p - y) + 1e-2 * w)
        w -= step
        if abs(step).max() < 1e-9:
            break
    return float(w[0] * 10), float(w[1]), float(w[2]), float(w[3] * 10)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc: str = "doc_id", text: str = "text") -> Model:
    known = labels.where(F.col(label).isNotNull() & F.col(doc).isNotNull() & (fold(doc) != 0))
    known = known.groupBy(F.col(doc).alias("id")).agg(F.min(label).alias("y"), F.first(fold(doc)).alias("f"))
    draw = F.xxhash64("id", F.lit(41))
    rows = docs.select(F.col(doc).alias("doc"), body(text).alias("text"))
    dictionaries = []
    for y in (0, 1):
        picked = known.where((F.col("y") == y) & (F.col("f") != FOLDS - 1)).orderBy(draw, "id").limit(FIT_DOCS).select("id")
        texts = rows.join(F.broadcast(picked), F.col("doc") == F.col("id"), "left_semi").where("text <> ''")
        parts = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))  # one pass, however long the text
        blocks = texts.select("doc", F.posexplode(parts).alias("i", "block")).orderBy(F.xxhash64("doc", "i"), "block")
        dictionaries.append(train_dictionary([r[0].encode() for r in blocks.limit(FIT_BLOCKS).select("block").collect()]))
    bad, good = dictionaries
    picked = known.where(F.col("f") == FOLDS - 1).orderBy(draw, "id").limit(CALIBRATION_DOCS).select("id", "y")
    seen = rows.join(F.broadcast(picked), F.col("doc") == F.col("id")).dropDuplicates(["id"])
    found = differences(seen, bad, good, ("y",)).collect()
    d, n, y = (np.array([r[c] for r in found], float) for c in ("difference", "n_bytes", "y"))
    return Model(bad, good, calibrate(d, n, y))


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns and ``score``, the probability of label 1, for every whole text."""
    kept = docs.select(*keep)
    names = numbered(kept).columns
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], *([] if text in keep else [F.col(f"`{text}`").alias("c_text")]))
    found = differences(rows, model.bad, model.good, tuple(names), number_of(kept, text) if text in keep else "c_text")
    slope, offset, short_offset, short_slope = map(F.lit, model.curve)
    short = F.lit(float(SHORT)) / (F.lit(float(SHORT)) + F.col("n_bytes"))
    logit = F.col("difference") * (slope + short_slope * short) + offset + short_offset * short
    return found.select(*names, (F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))).alias("score")).toDF(*keep, "score")


def op4_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored; labels are learnt outside fold 0 only."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(table_path(sf_dir, "labels")))
    return score(docs, model).select(
        "doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
