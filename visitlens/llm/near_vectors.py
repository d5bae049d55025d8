"""Near-duplicate vectors by product quantisation: coarse lists, residual codes, table look-ups, exact rerank.

1. Equal vectors of a group become one class. A bounded sample gives coarse centroids and one codebook for each
   subspace of the residuals.
2. Every class lies in the list of its nearest centroid (home) and visits the lists that can hold a near vector.
   Two unit vectors at distance ``reach`` cannot lie on different sides of the plane between two centroids unless
   both are within ``reach`` of it, so the visited lists are those whose plane is that near: sufficient probes.
3. Only codes visit. In each list the distance of home x to visitor y is looked up in x's tables (asymmetric).
   It is off by at most y's coding error, which is stored, so a visit whose every distance exceeds reach + error
   holds no link and ends there.
4. The vectors of the other visits, few, are sent to those lists and the cosine is computed in double precision.
   A class is credited with the visitors that link with it, as homes do; a task emits sums and a star for each of
   its own clusters, never pairs.

Both bounds hold for any data, so no link is lost, whatever the sample; it only decides how much is compared. Lists
of one place in a hot group are split in blocks on both sides.

Defined cases: vectors that are null, zero or hold null or non-finite components, and rows without a group, link
with nothing; shorter vectors are read as if padded with zeros. Every row is returned: repeated rows are vectors of
their own that link with each other, a row's id may be null or of any ordered type, and among rows of one id the
component's least id marks each as kept. An empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import ship_package
from visitlens.llm.components import components
from visitlens.session import checkpoint_dir
from visitlens.sources.tables import read_table

LEAST = 0.98
SAMPLE_VALUES = 1 << 20  # components that the model is fitted on, at most: 16,384 vectors of 64
MAX_LISTS = 4096
SUBSPACES = 16
CODES = 256
HOMES, VISITS = 2048, 16384  # rows of a block
EXACT = 2048
SPREAD, SPREAD_ROWS = 8, 128  # a list is dealt to as many as 8 blocks a side while they hold 128 rows
SLACK = 1e-3  # single precision against the bounds


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of doubles, shorter lists padded with zeros."""
    lens = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lens == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lens), width))
    out[np.arange(width) < lens[:, None]] = flat
    return out


def units(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square over- or underflows."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = 0.5 * (centres * centres).sum(1)
    return np.concatenate([np.argmin(half - rows[k : k + 4096] @ centres.T, 1) for k in range(0, len(rows), 4096)])


def _lloyd(rows: np.ndarray, k: int, seed: int, rounds: int = 8) -> np.ndarray:
    """k-means centres; a centre that loses its rows stays where it is."""
    centres = rows[np.random.default_rng(seed).choice(len(rows), k, replace=False)].copy()
    for _ in range(rounds):
        at = _nearest(rows, centres)
        order = np.argsort(at, kind="stable")
        n = np.bincount(at, minlength=k)
        has = n > 0
        centres[has] = np.add.reduceat(rows[order], (np.cumsum(n) - n)[has]) / n[has, None]
    return centres


@dataclass
class Quantizer:
    """Coarse centroids and the codebooks of the residuals' subspaces."""

    width: int
    centres: np.ndarray
    books: np.ndarray  # subspace, code, component
    gaps: np.ndarray = field(init=False)

    def __post_init__(self):
        c = self.centres
        squares = (c * c).sum(1)
        self.gaps = np.sqrt(np.maximum(squares[:, None] + squares - 2 * c @ c.T, 0))

    def parts(self, rows: np.ndarray) -> np.ndarray:
        m, _, size = self.books.shape
        return np.pad(rows, ((0, 0), (0, m * size - rows.shape[1]))).reshape(len(rows), m, size)

    def distances(self, rows: np.ndarray) -> np.ndarray:
        """Squared distances of unit rows to all centroids."""
        return 1 + (self.centres * self.centres).sum(1) - 2 * rows @ self.centres.T

    def code(self, rows: np.ndarray, reach: float):
        """(home, codes, shift, error, visited lists as row and list) of unit rows."""
        far = self.distances(rows)
        home = far.argmin(1)
        gap = self.gaps[home]
        margin = far - far[np.arange(len(rows)), home][:, None] <= 2 * gap * (reach + SLACK)
        rest = self.parts(rows - self.centres[home])
        codes = np.stack([_nearest(rest[:, k], self.books[k]) for k in range(len(self.books))], 1)
        coded = np.stack([self.books[k][codes[:, k]] for k in range(len(self.books))], 1)
        error = np.sqrt(((rest - coded) ** 2).sum((1, 2)))
        shift = (coded * coded).sum((1, 2)) + 2 * (self.parts(self.centres[home]) * coded).sum((1, 2))
        return home, codes.astype(np.uint8), shift, error, np.nonzero(margin)

    def look_up(self, rows: np.ndarray, home: np.ndarray, codes: np.ndarray, shift: np.ndarray) -> np.ndarray:
        """Squared distances of unit rows to coded vectors: a table for each row and subspace, then look-ups."""
        tables = -2 * np.einsum("nms,mcs->nmc", self.parts(rows), self.books)
        out = self.distances(rows)[:, home] + shift
        for k in range(len(self.books)):
            out += tables[:, k][:, codes[:, k]]
        return out


def fit(sample: np.ndarray, lists: int) -> Quantizer:
    """A model from sampled unit vectors."""
    width = sample.shape[1]
    centres = _lloyd(sample, min(lists, len(sample)), 1)
    rest = sample - centres[_nearest(sample, centres)]
    m = min(SUBSPACES, width)
    size = -(-width // m)
    rest = np.pad(rest, ((0, 0), (0, m * size - width))).reshape(len(rest), m, size)
    books = np.stack([_lloyd(rest[:, k], min(CODES, len(rest)), 2 + k, 6) for k in range(m)])
    return Quantizer(width, centres, books)


def usable(vector: str, group: str) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(group).isNotNull() & F.col(vector).isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _index(model, reach: float) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, node = model.value, TaskContext.get().partitionId() << 33
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            home, codes, shift, error, (row, lists) = q.code(units(matrix(batch.column("vector"), q.width)), reach)
            ends = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
            visits = pa.ListArray.from_arrays(pa.array(ends), pa.array(lists, pa.int32()))
            more = [pa.array(np.arange(node, node + n)), pa.array(home, pa.int32()), visits,
                    pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(shift), pa.array(error)]
            node += n
            yield pa.RecordBatch.from_arrays(batch.columns + more, [*batch.schema.names, "node", "home", "lists", "codes", "shift", "error"])

    return work


def _blocked(homes: DataFrame, visits: DataFrame, home_rows: int, visit_rows: int, spread: int = 1) -> tuple[DataFrame, DataFrame]:
    """Both sides of every list with blocks of bounded rows: each home block meets each visiting block. A list that needs
    fewer than ``spread`` blocks of these sizes is dealt to up to ``spread`` smaller ones, for more even tasks."""
    key = ["grp", "list"]
    size = homes.groupBy(key).agg(F.count(F.lit(1)).alias("h")).join(visits.groupBy(key).agg(F.count(F.lit(1)).alias("v")), key)
    blocks = lambda n, rows: F.greatest(F.ceil(F.col(n) / rows), F.least(F.lit(spread), F.ceil(F.col(n) / min(rows, SPREAD_ROWS))))
    size = size.select(*key, blocks("h", home_rows).alias("hs"), blocks("v", visit_rows).alias("vs"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    mine = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    homes = homes.join(size, key).select("*", mine("hs").alias("hb"), every("vs").alias("vb")).drop("hs", "vs")
    visits = visits.join(size, key).select("*", mine("vs").alias("vb"), every("hs").alias("hb")).drop("hs", "vs")
    return homes, visits


def _joined(homes: DataFrame, visits: DataFrame, work: Callable, schema: str) -> DataFrame:
    key = ["grp", "list", "hb", "vb"]
    visits = visits.select(*[F.col(c).alias(f"v_{c}") for c in visits.columns])
    return homes.groupBy(key).cogroup(visits.groupBy([f"v_{k}" for k in key])).applyInArrow(work, schema)


KEPT = pa.schema([("node", pa.int64()), ("list", pa.int32()), ("is_home", pa.bool_())])


def _sift(model, reach: float) -> Callable:
    """The homes and the visits of a list block that may have a link there."""

    def work(homes: pa.Table, visits: pa.Table) -> pa.Table:
        if not homes.num_rows or not visits.num_rows:
            return KEPT.empty_table()
        q = model.value
        rows = units(matrix(homes.column("vector").combine_chunks(), q.width)).astype(np.float32)
        node, other = homes.column("node").to_numpy(), visits.column("v_node").to_numpy()
        codes = np.frombuffer(b"".join(visits.column("v_codes").to_pylist()), np.uint8).reshape(len(other), -1)
        home, shift = visits.column("v_home").to_numpy(), visits.column("v_shift").to_numpy().astype(np.float32)
        most = ((reach + SLACK + visits.column("v_error").to_numpy()) ** 2).astype(np.float32)
        keep_home, keep_visit = np.zeros(len(node), bool), np.zeros(len(other), bool)
        step = max(1, (4 << 20) // max(len(other), q.books.shape[0] * q.books.shape[1]))
        for k in range(0, len(node), step):
            near = (q.look_up(rows[k : k + step], home, codes, shift) <= most) & (node[k : k + step, None] != other)
            keep_home[k : k + step] = near.any(1)
            keep_visit |= near.any(0)
        nodes = np.concatenate([node[keep_home], other[keep_visit]])
        at = homes.column("list")[0].as_py()
        return pa.table([nodes, np.full(len(nodes), at, np.int32), np.arange(len(nodes)) < keep_home.sum()], schema=KEPT)

    return work


def clusters(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node of each node's cluster under the links (a, b)."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        while True:
            jump = new[new]
            if (jump == new).all():
                break
            new = jump
        label = new[label]
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])


def _rerank(width: int, least: float) -> Callable:
    """Exact cosines of a list block: copies linked with each home, and a star for each cluster."""

    def work(homes: pa.Table, visits: pa.Table) -> pa.Table:
        if not homes.num_rows or not visits.num_rows:
            return FOUND.empty_table()
        x, y = (units(matrix(t.column(c).combine_chunks(), width)) for t, c in ((homes, "vector"), (visits, "v_vector")))
        node, other = homes.column("node").to_numpy(), visits.column("v_node").to_numpy()
        copies = visits.column("v_copies").to_numpy()
        nodes, at = np.unique(np.concatenate([node, other]), return_inverse=True)
        n, label = np.zeros(len(node), np.int64), np.arange(len(nodes))
        for k in range(0, len(node), 256):
            near = (x[k : k + 256] @ y.T >= least) & (node[k : k + 256, None] != other)
            n[k : k + 256] = near @ copies
            i, j = np.nonzero(near)
            label = clusters(len(nodes), np.concatenate([np.arange(len(nodes)), at[k + i]]), np.concatenate([label, at[len(node) + j]]))
        star = np.flatnonzero(label != np.arange(len(nodes)))
        linked = np.flatnonzero(n)
        a = np.concatenate([node[linked], nodes[star]])
        b = np.concatenate([node[linked], nodes[label[star]]])
        return pa.table([a, b, np.concatenate([n[linked], np.zeros(len(star), np.int64)])], schema=FOUND)

    return work


def near_vectors(vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding", group: str = "label", least: float = LEAST,
                 lists: int | None = None, homes: int = HOMES, visits: int = VISITS, exact: int = EXACT) -> DataFrame:
    """(id, n_links, component_id, kept) of every row: vectors of one group with a cosine of ``least`` or more link.

    ``lists``: coarse lists, about half the root of the number of vectors if not given, at most 4096.
    """
    if not 0 < least <= 1:
        raise ValueError("least must lie above 0 and at most at 1")
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col(ident).alias("id"), F.col(vector).alias("vector"), F.col(group).alias("grp"))
    good = rows.where(usable("vector", "grp"))
    width, n = good.agg(F.max(F.size("vector")), F.count(F.lit(1))).first()
    if not n:
        return rows.select(F.col("id").alias(ident), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"),
                           F.col("id").isNotNull().alias("kept"))
    reach = float(np.sqrt(2 - 2 * least))
    at = f"{checkpoint_dir(spark)}/near-{uuid.uuid4().hex}"

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{at}/{name}")
        return spark.read.schema(df.schema).parquet(f"{at}/{name}")

    sample = good.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(max(256, SAMPLE_VALUES // width)).toArrow()
    model = fit(units(matrix(sample.column("vector").combine_chunks(), width)), lists or min(MAX_LISTS, max(1, int(n**0.5 / 2))))
    model = spark.sparkContext.broadcast(model)

    classes = good.groupBy("grp", "vector").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first"))
    kinds = dict(classes.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in classes.columns), "node bigint, home int, lists array<int>, codes binary, shift double, error double"])
    classes.mapInArrow(_index(model, reach), schema).write.parquet(f"{at}/index")
    index = spark.read.schema(schema).parquet(f"{at}/index")

    stay = index.select("grp", F.col("home").alias("list"), "node", "vector")
    visit = index.select("grp", F.explode("lists").alias("list"), "node", "home", "codes", "shift", "error")
    kept = written(_joined(*_blocked(stay, visit, homes, visits), _sift(model, reach), "node bigint, list int, is_home boolean").distinct(), "kept")

    held = index.select("grp", "node", "vector", "copies")
    stay, visit = (held.join(kept.where("is_home" if side else "not is_home").select("node", "list"), "node") for side in (True, False))
    found = written(_joined(*_blocked(stay, visit, exact, exact, SPREAD), _rerank(width, least), "a bigint, b bigint, links bigint"), "found")

    links = found.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    parts = components(found.where("a <> b").select("a", "b")).select(F.col("id").alias("node"), F.col("label").alias("part"))
    ours = index.select("grp", "vector", "node", "copies", "first").join(links, "node", "left").join(parts, "node", "left")
    ours = ours.withColumn("part", F.coalesce("part", "node"))
    heads = ours.groupBy("part").agg(F.min("first").alias("component_id"))
    ours = ours.join(heads, "part").select("grp", "vector", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.join(ours, ["grp", "vector"], "left")
    head = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(ident), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), head.alias("component_id"),
                      F.coalesce(F.col("id") == head, F.lit(False)).alias("kept"))


def op12_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings: vectors of one label with a cosine of 0.98 or more."""
    return near_vectors(read_table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND NOT EXISTS (SELECT 1 FROM unnest(embedding) t(x) WHERE x IS NULL OR NOT isfinite(x))
    AND EXISTS (SELECT 1 FROM unnest(embedding) t(x) WHERE x <> 0)),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reached AS (
  SELECT x, y FROM links
  UNION
  SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x),
heads AS (SELECT x, min(y) AS y FROM reached GROUP BY x)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, least(v.vec_id, coalesce(h.y, v.vec_id)) AS component_id,
  v.vec_id = least(v.vec_id, coalesce(h.y, v.vec_id)) AS kept
FROM embeddings v LEFT JOIN counts c ON c.x = v.vec_id LEFT JOIN heads h ON h.x = v.vec_id
"""
