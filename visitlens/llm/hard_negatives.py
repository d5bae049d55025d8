"""Hard negatives by threshold joins in the manner of L2AP: norm-bounded index, partial scores, falling thresholds.

Rows are integer vectors. Dimensions are ordered by their energy over all rows, the heaviest first, and rows are
kept in blocks, an inverted index by segments of dimensions with the norms of what follows each segment. For a
threshold t and queries of norm at most q, a row's dimensions are indexed only up to the segment where q times the
norm of the rest falls below t: what is covered by that bound cannot make a score of t alone. A search adds
up partial scores over the indexed segments, drops a pair once its partial score plus the product of the two remaining
norms is below t, and computes the scores of what is left in full.

Anchors are searched in chunks of bounded size against all rows. Thresholds begin high and fall: first until an
anchor has its positives, then until the window of every positive holds its negatives or has been searched down to
its lower end. Within a task the threshold rises again to the score of the last place once all places are taken. A
task returns at most the wanted number of rows for each anchor or window; the driver holds one chunk's anchors and
positives at a time.

Defined cases: rows with a null id, label or vector or with null or non-finite components take no part. Of rows that
share an id the first by label and vector counts (so repeated rows count once). Shorter vectors are read as if padded
with zeros. Anchors without positives, and windows without negatives, have no rows; so has an empty table. Ties go to
the smaller id. Scores must be below 2^53 / 100, which is checked; further columns are not looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from visitlens.llm.common import ship_package
from visitlens.llm.near_vectors import matrix
from visitlens.session import checkpoint_dir
from visitlens.sources.tables import read_table

SCALE = 256
CHUNK = 8192  # anchors searched at a time
BLOCK_VALUES = 1 << 18  # components of a block of rows
TILE = 256  # anchors scored against a block at once
SEGMENT = 8
LEVELS = (0.9, 0.6, 0.4, 0.3, 0.2, 0.1, 0.0, -1.0)  # of the largest possible score; the last one lets all pass
WINDOW_LEVELS = (0.95, 0.9, 0.85)  # of the positive's score, before the window's lower end
LARGEST = 2**53 // 100


@dataclass
class Block:
    """Rows of a block, dimensions in index order; ``rest[s]``: norms from segment s on."""

    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    rest: np.ndarray

    def of(self, label: int) -> Block:
        keep = self.labels == label
        return Block(self.ids[keep], self.labels[keep], self.rows[keep], self.rest[:, keep])


def rests(rows: np.ndarray) -> np.ndarray:
    """Norms of the rows from each segment on; the last is zero."""
    squares = rows * rows
    starts = np.arange(0, rows.shape[1], SEGMENT)
    parts = np.add.reduceat(squares, starts, axis=1) if len(starts) and len(rows) else np.zeros((len(rows), len(starts)))
    tail = np.cumsum(parts[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([tail, np.zeros((len(rows), 1))], 1)).T


def pairs_above(x: np.ndarray, x_rest: np.ndarray, least: np.ndarray, block: Block, use: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the pairs in ``use`` (anchor by row) that reach the anchor's threshold."""
    none = np.zeros(0, np.int64)
    if not len(x) or not len(block.ids):
        return none, none, none
    lowest, longest = least.min(), x_rest[0].max()
    # Segments indexed for each row: those up to where the rest is covered by the bound.
    indexed = (longest * block.rest[:-1] >= lowest - 0.5).sum(0)
    order = np.argsort(-indexed, kind="stable")
    alive = use[:, order] & (indexed[order] > 0) & (x_rest[0][:, None] * block.rest[0][order] >= least[:, None] - 0.5)
    total, segments = alive.size, len(block.rest) - 1
    score = np.zeros(alive.shape)
    for s in range(segments):
        n = int(np.searchsorted(-indexed[order], -s, "left"))  # rows whose segment s is indexed
        here = slice(s * SEGMENT, (s + 1) * SEGMENT)
        score[:, :n] += x[:, here] @ block.rows[order[:n], here].T
        # Of a row whose index ends before s, everything from its end on is still ahead.
        ahead = np.minimum(s + 1, indexed[order])
        alive &= score + x_rest[ahead].T * block.rest[ahead, order] >= least[:, None] - 0.5
        if alive.sum() * 8 < total:
            break
    i, j = np.nonzero(alive)
    done, score = min(s + 1, segments) if segments else 0, score[i, j]
    rows = order[j]
    if segments and done < segments:
        upto = np.minimum(done, indexed[rows])
        for s in range(int(upto.min(initial=done)), segments):
            here = slice(s * SEGMENT, (s + 1) * SEGMENT)
            go = upto <= s
            score[go] += np.einsum("ij,ij->i", x[i[go], here], block.rows[rows[go], here])
            after = np.maximum(s + 1, upto)
            keep = score + x_rest[after, i] * block.rest[after, rows] >= least[i] - 0.5
            i, rows, score, upto = i[keep], rows[keep], score[keep], upto[keep]
    elif segments:
        for s in range(segments):  # dimensions that were left out of the index
            go = indexed[rows] <= s
            here = slice(s * SEGMENT, (s + 1) * SEGMENT)
            if go.any():
                score[go] += np.einsum("ij,ij->i", x[i[go], here], block.rows[rows[go], here])
    hit = score >= least[i]
    return i[hit], rows[hit], score[hit].astype(np.int64)


def best(group: np.ndarray, score: np.ndarray, ident: np.ndarray, want: int) -> np.ndarray:
    """Places of the first ``want`` of each group, higher scores first, then smaller ids; group by group."""
    order = np.lexsort((ident, -score, group))
    sorted_ = group[order]
    start = np.flatnonzero(np.diff(sorted_, prepend=-1))
    rank = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
    return order[rank < want]


@dataclass
class Search:
    """One search of a chunk: the anchors, and the windows [low, high] of scores that are to be filled.

    Without windows the positives are wanted (rows of the anchor's label); with windows the negatives.
    """

    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    rest: np.ndarray
    anchor: np.ndarray  # of each window
    low: np.ndarray
    high: np.ndarray
    same_label: bool
    want: int

    def run(self, blocks: Iterator[Block]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, id, score) of the best rows of all blocks."""
        w, ids, scores = (np.zeros(0, np.int64) for _ in range(3))
        low = self.low.astype(np.float64)
        first = np.searchsorted(self.anchor, np.arange(len(self.ids)))  # windows stand by anchor
        last = np.searchsorted(self.anchor, np.arange(len(self.ids)), "right")
        groups = [(np.flatnonzero(self.labels == x), x) for x in np.unique(self.labels)] if self.same_label else [(np.arange(len(self.ids)), None)]
        tiles = [(own[k : k + TILE], label) for own, label in groups for k in range(0, len(own), TILE)]
        for whole in blocks:
            least = np.minimum.reduceat(low, first)
            found, at, block = [], None, whole
            for t, label in tiles:
                if label != at:
                    at, block = label, whole.of(label)
                use = self.ids[t, None] != block.ids
                if label is None:
                    use &= self.labels[t, None] != block.labels
                a, row, score = pairs_above(self.rows[t], self.rest[:, t], least[t], block, use)
                a = t[a]
                for step in range(int((last - first).max(initial=0))):
                    window = first[a] + step
                    ok = window < last[a]
                    ok[ok] = (score[ok] <= self.high[window[ok]]) & (score[ok] >= low[window[ok]])
                    found.append((window[ok], block.ids[row[ok]], score[ok]))
            if not found:
                continue
            w, ids, scores = (np.concatenate([old, *new]) for old, new in zip((w, ids, scores), zip(*found, strict=True), strict=True))
            top = best(w, scores, ids, self.want)
            w, ids, scores = w[top], ids[top], scores[top]
            full = np.bincount(w, minlength=len(low)) == self.want  # nothing below the last place matters any more
            end = np.searchsorted(w, np.arange(len(low)), "right") - 1
            low[full] = scores[end[full]]
        return w, ids, scores


def _packed(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


BLOCK = "ids binary, labels binary, rows binary"


def _block_rows(order: np.ndarray, scale: int) -> Callable:
    """Blocks of integer rows, their dimensions in index order."""
    per = max(64, BLOCK_VALUES // max(1, len(order)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, per):
                part = batch.slice(k, per)
                rows = np.floor(scale * matrix(part.column("vector"), len(order)))[:, order]
                if len(rows) and (rows * rows).sum(1).max() > LARGEST:
                    raise OverflowError("scores of 2^53 / 100 or more are not exact")
                cols = [part.column("id").to_numpy(), part.column("label").to_numpy(), rows.astype("<i4")]
                yield pa.RecordBatch.from_arrays([pa.array([_packed(c)], pa.binary()) for c in cols], ["ids", "labels", "rows"])

    return work


def _energy(width: int, scale: int) -> Callable:
    """Sum of squares of each dimension."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            total += (np.floor(scale * matrix(batch.column("vector"), width)) ** 2).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], ["dim", "energy"])

    return work


def _search(job) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search: Search = job.value
        width = search.rows.shape[1]

        def blocks() -> Iterator[Block]:
            for batch in batches:
                for k in range(batch.num_rows):
                    ids, labels, rows = (np.frombuffer(batch.column(c)[k].as_py(), t) for c, t in (("ids", "<i8"), ("labels", "<i8"), ("rows", "<i4")))
                    rows = rows.reshape(-1, width).astype(np.float64)
                    yield Block(ids, labels, rows, rests(rows))

        found = search.run(blocks())
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["w", "id", "score"])

    return work


def _best_of(index: DataFrame, search: Search) -> DataFrame:
    """(w, id, score, place): the first rows of every window over all tasks."""
    job = index.sparkSession.sparkContext.broadcast(search)
    found = index.mapInArrow(_search(job), "w bigint, id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("w").orderBy(F.desc("score"), "id"))
    return found.select("*", place.alias("place")).where(F.col("place") <= search.want)


def prepared(rows: DataFrame) -> DataFrame:
    """One usable row for each id."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where("id is not null and label is not null and vector is not null").where(~bad)
    return rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("r")).select("id", "r.label", "r.vector")


def hard_negatives(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80, scale: int = SCALE, chunk: int = CHUNK) -> DataFrame:
    """Negatives of every anchor and positive of ``rows`` (id, label, vector; ids and labels whole numbers).

    Anchors: ids divisible by ``every``. Their positives are the ``positives`` rows of the same label with the highest
    inner products; a positive's negatives are the first ``negatives`` rows of other labels whose score lies between
    ``low`` per cent of the positive's score and that score.
    """
    spark = rows.sparkSession
    ship_package(spark)
    at = f"{checkpoint_dir(spark)}/negatives-{uuid.uuid4().hex}"
    rows = prepared(rows.select(F.col("id").cast("bigint"), F.col("label").cast("bigint"), "vector"))
    rows.write.parquet(f"{at}/rows")
    rows = spark.read.schema(rows.schema).parquet(f"{at}/rows")
    out = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    width, n = rows.agg(F.max(F.size("vector")), F.count(F.when(F.col("id") % every == 0, 1))).first()
    if not n:
        return spark.createDataFrame([], out)
    width = max(width, 1)

    energy = rows.mapInArrow(_energy(width, scale), "dim bigint, energy double").groupBy("dim").agg(F.sum("energy").alias("energy"))
    order = np.array([r.dim for r in energy.orderBy(F.desc("energy"), "dim").collect()])
    rows.mapInArrow(_block_rows(order, scale), BLOCK).write.parquet(f"{at}/index")
    index = spark.read.schema(BLOCK).parquet(f"{at}/index")
    longest = float(index.mapInArrow(_longest(width), "norm double").agg(F.max("norm")).first()[0])

    chunks = -(-n // chunk)
    of_chunk = F.pmod(F.xxhash64("id"), F.lit(chunks))
    parts = 0
    for c in range(chunks):
        mine = rows.where((F.col("id") % every == 0) & (of_chunk == c)).toArrow()
        if not mine.num_rows:
            continue
        x = np.floor(scale * matrix(mine.column("vector").combine_chunks(), width))[:, order]
        anchors = (mine.column("id").to_numpy(), mine.column("label").to_numpy(), x, rests(x))
        found = _positives(index, anchors, positives, longest)
        parts = _negatives(index, anchors, found, negatives, low, f"{at}/found", parts)
    if not parts:
        return spark.createDataFrame([], out)
    return spark.read.schema(out).parquet(*[f"{at}/found/{k}" for k in range(parts)])


def _longest(width: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = 0.0
        for batch in batches:
            for k in range(batch.num_rows):
                rows = np.frombuffer(batch.column("rows")[k].as_py(), "<i4").reshape(-1, width).astype(np.float64)
                most = max(most, float(np.sqrt((rows * rows).sum(1).max(initial=0))))
        yield pa.RecordBatch.from_arrays([pa.array([most])], ["norm"])

    return work


def _of(anchors, keep: np.ndarray):
    ids, labels, x, rest = anchors
    return ids[keep], labels[keep], x[keep], rest[:, keep]


def _positives(index: DataFrame, anchors, want: int, longest: float) -> dict[str, np.ndarray]:
    """(anchor, id, score) of the positives: thresholds fall until each anchor has ``want`` or all rows were let pass."""
    open_ = np.arange(len(anchors[0]))
    parts = []
    for level in LEVELS:
        ids, labels, x, rest = _of(anchors, open_)
        low = np.ceil(level * rest[0] * longest) - 1 if level >= 0 else np.full(len(open_), -float(LARGEST))
        search = Search(ids, labels, x, rest, np.arange(len(open_)), low, np.full(len(open_), LARGEST), True, want)
        got = _best_of(index, search).toArrow()
        w, ident, score = (got.column(k).to_numpy() for k in ("w", "id", "score"))
        done = np.bincount(w, minlength=len(open_)) >= want
        done |= level < 0
        take = done[w]
        parts.append((open_[w[take]], ident[take], score[take]))
        open_ = open_[~done]
        if not len(open_):
            break
    a, ident, score = (np.concatenate(p) for p in zip(*parts, strict=True))
    by = np.lexsort((ident, -score, a))
    return {"anchor": a[by], "id": ident[by], "score": score[by]}


def _negatives(index: DataFrame, anchors, positives: dict[str, np.ndarray], want: int, low: int, to: str, parts: int) -> int:
    """Write the negatives of all windows, a folder for each threshold; returns the number of folders."""
    spark = index.sparkSession
    open_ = np.flatnonzero(positives["score"] >= 0)  # below zero the window is empty
    for level in (*WINDOW_LEVELS, None):
        if not len(open_):
            break
        score = positives["score"][open_]
        end = -(-low * score // 100)
        floor = end if level is None else np.maximum(end, np.ceil(level * score).astype(np.int64))
        own, anchor = np.unique(positives["anchor"][open_], return_inverse=True)
        ids, labels, x, rest = _of(anchors, own)
        found = _best_of(index, Search(ids, labels, x, rest, anchor, floor, score, False, want))
        size = F.count(F.lit(1)).over(Window.partitionBy("w"))
        whole = np.flatnonzero(floor == end)  # searched to their end: done, however many there are
        windows = spark.createDataFrame(pa.table({"w": np.arange(len(open_)), "anchor_id": ids[anchor], "positive_id": positives["id"][open_],
                                                  "positive_score": score, "whole": floor == end}))
        found = found.withColumn("size", size).join(F.broadcast(windows), "w").where((F.col("size") >= want) | F.col("whole"))
        found.select("w", "anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                     "positive_score", F.col("score").alias("negative_score")).write.parquet(f"{to}/{parts}")
        done = spark.read.parquet(f"{to}/{parts}").select("w").distinct().toArrow().column("w").to_numpy()
        parts += 1
        left = np.ones(len(open_), bool)
        left[done] = left[whole] = False
        open_ = open_[left]
    return parts


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the embeddings whose id is divisible by 100; every seventh row's label is moved on by one."""
    rows = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select(F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vector")))


ORACLE = """
WITH good AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM unnest(embedding) t(x) WHERE x IS NULL OR NOT isfinite(x))),
scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
    CAST(list_dot_product(a.e, r.e) AS BIGINT) AS score
  FROM good a JOIN good r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5
"""
