"""Similarity self-join on word 5-grams: MinHash LSH forest, then exact Jaccard.

Words are the lower-case text split at white space; a text's set is its distinct runs of ``N`` words (a shorter
text: all its words). A signature has ``TREES`` paths of ``DEPTH`` one-byte digits, each digit a hash of one
MinHash value; texts with the same first digits of a path share a node of that tree's trie. The join starts at
full depth. Texts that share a node are candidates; they are gathered into candidate clusters by links to each
node's first member, never as pairs, and all pairs of a cluster are compared exactly, in blocks. A link of
similarity J is met at depth k with probability 1 - (1 - J**k)**TREES, so the links found give an estimate
of the links missed; if found / (found + missed) is below the target the matched prefixes are shortened to the
depth that the estimate asks for, and the join runs again, until it is met or the prefixes are ``LEAST_DEPTH`` long,
where an estimate below ``LEAST_RECALL`` is an error. A link at the threshold is met with probability 0.994 at
full depth, 0.9986 one digit shorter, 0.99999 at the least depth.

Equal texts are one text class and only its first document is compared. A large cluster is cut into blocks of
about ``BLOCK_TEXTS`` texts or ``BLOCK_WORDS`` words and every pair of blocks is a task of its own, so no
task holds more than two blocks; what leaves a task is one row per text, not the pairs.

Defined cases: null and empty texts (or only white space) have no words, so they are linked to nothing; equal
ones among them are still one class. Repeated rows belong to the same class. A null id takes part; a class is
named by its least id that is not null. An empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import body, cut, number_of, numbered, ship_package, small
from visitlens.llm.components import components
from visitlens.llm.pretoken import chunks
from visitlens.sources.tables import read_table

N = 5
THRESHOLD = (4, 5)  # similarity 0.8, as a ratio so that the test is exact
TREES = 28
DEPTH = 8  # at most 8: a path is a long
LEAST_DEPTH = 4
TARGET = 0.998
LEAST_RECALL = 0.9  # at the shortest prefixes; an estimate below is an error
BLOCK_TEXTS = 512
BLOCK_WORDS = 2_000_000

_rng = np.random.default_rng(7)
_XOR = _rng.integers(0, 1 << 32, TREES * DEPTH, np.uint32)
_MUL = (_rng.integers(0, 1 << 31, TREES * DEPTH, np.uint32) * 2 + 1).astype(np.uint32)
_P = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all word runs, how many each text has, words of each text); runs may repeat."""
    import xxhash

    lists = [t.lower().split() for t in texts]
    n_words = np.fromiter(map(len, lists), np.int64, len(lists))
    coded = pa.array([w for ws in lists for w in ws], pa.string()).dictionary_encode()
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    codes = coded.indices.to_numpy(zero_copy_only=False)
    word = one[codes] if len(codes) else np.zeros(0, np.uint64)
    count = np.where(n_words >= N, n_words - N + 1, np.minimum(n_words, 1))
    first = np.repeat(np.cumsum(n_words) - n_words, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    width = np.repeat(np.minimum(n_words, N), count)
    h = np.zeros(len(first), np.uint64)
    for k in range(N):
        on = k < width
        h[on] = h[on] * _P + word[first[on] + k]
    return _mix(h + width.astype(np.uint64)), count, n_words


def paths(h: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The ``TREES`` paths of each text that has shingles, digits from the top byte down."""
    full = count > 0
    starts = (np.cumsum(count) - count)[full]
    out = np.zeros((int(full.sum()), TREES), np.uint64)
    if not len(out):
        return out
    x = (h >> np.uint64(32)).astype(np.uint32)
    for j in range(TREES * DEPTH):
        least = np.minimum.reduceat((x ^ _XOR[j]) * _MUL[j], starts)
        tree, digit = divmod(j, DEPTH)
        out[:, tree] |= (least & np.uint32(0xFF)).astype(np.uint64) << np.uint64(8 * (7 - digit))
    return out


def signatures(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc_id, node: digest of the text, n_words, paths: null without words)."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), node(text).alias("node"), body(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in chunks(batch.column("text")):
                h, count, n_words = shingles(texts)
                found = paths(h, count)
                sizes = np.where(count > 0, TREES, 0)
                mask = pa.array(count == 0)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()),
                                                 pa.array(found.reshape(-1).view(np.int64), pa.int64()), mask=mask)
                ids, nodes = (batch.column(c).slice(a, b - a) for c in ("doc_id", "node"))
                yield pa.RecordBatch.from_arrays([ids, nodes, pa.array(n_words), lists], ["doc_id", "node", "n_words", "paths"])

    return rows.mapInArrow(work, "doc_id bigint, node string, n_words bigint, paths array<bigint>")


def node(text: str = "text"):
    """What stands for a text: half of its SHA-256."""
    return F.substring(F.sha2(body(text), 256), 1, 32)


def candidate_clusters(nodes: DataFrame, depth: int) -> DataFrame:
    """(id, label): texts gathered by shared trie nodes at ``depth``."""
    prefix = F.shiftrightunsigned("path", 64 - 8 * depth) if depth < 8 else F.col("path")
    at = nodes.where("paths IS NOT NULL").select("id", F.posexplode("paths").alias("tree", "path"))
    at = at.select("id", F.xxhash64("tree", prefix).alias("key"))  # a clash only adds candidates
    shared = at.groupBy("key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return components(at.join(shared.drop("n"), "key").select(F.col("id").alias("a"), F.col("first").alias("b")))


def _links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, same: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each text in ``left`` its partners in ``right`` (positions) with their similarities."""
    num, den = THRESHOLD
    size = np.array([len(s) for s in sets])
    pool = np.concatenate([sets[i] for i in right])
    owner = np.repeat(np.arange(len(right)), size[right])
    order = np.argsort(pool, kind="stable")
    pool, owner = pool[order], owner[order]
    for i in left.tolist():
        lo, hi = np.searchsorted(pool, sets[i], "left"), np.searchsorted(pool, sets[i], "right")
        n = hi - lo
        ends = np.cumsum(n)
        hits = owner[np.arange(ends[-1]) + np.repeat(lo - (ends - n), n)]
        both = np.bincount(hits, minlength=len(right))
        ok = both * (num + den) >= num * (size[i] + size[right])
        if same:
            ok &= right != i
        j = np.flatnonzero(ok)
        if len(j):
            yield i, right[j], both[j] / (size[i] + size[right[j]] - both[j])


def compare(ids: np.ndarray, blocks: np.ndarray, sets: list[np.ndarray], one: int, two: int) -> list[tuple[int, int, int, list[float]]]:
    """Links between block ``one`` and block ``two``: (id, least id linked to it here, links, expected misses by depth)."""
    left, right = np.flatnonzero(blocks == one), np.flatnonzero(blocks == two)
    if not len(left) or not len(right):
        return []
    same = one == two
    links = np.zeros(len(ids), np.int64)
    missed = np.zeros((len(ids), DEPTH - LEAST_DEPTH + 1))
    root = np.arange(len(ids))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    depths = np.arange(LEAST_DEPTH, DEPTH + 1)
    for i, partners, sim in _links(sets, left, right, same):
        met = 1 - (1 - sim[:, None] ** depths) ** TREES
        miss = (1 - met) / met
        links[i] += len(partners)
        missed[i] += miss.sum(0)
        if not same:
            links[partners] += 1
            missed[partners] += miss
        for j in partners.tolist():
            a, b = find(i), find(j)
            if a != b:
                if ids[a] > ids[b]:
                    a, b = b, a
                root[b] = a
    return [(int(ids[i]), int(ids[find(i)]), int(links[i]), missed[i].tolist()) for i in np.flatnonzero(links).tolist()]


def verify(docs: DataFrame, nodes: DataFrame, clusters: DataFrame, doc: str, text: str) -> DataFrame:
    """(id, root, links, missed) of every text linked to another one."""
    members = nodes.select("id", "node", "rep", "n_words").join(clusters, "id")
    size = members.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("w"))
    parts = F.greatest(F.ceil(F.col("n") / BLOCK_TEXTS), F.ceil(F.col("w") / BLOCK_WORDS)).cast("int")
    members = cut(members.join(size.select("label", parts.alias("parts")), "label")
                  .withColumn("block", F.pmod(F.xxhash64("id"), "parts").cast("int")))
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), node(text).alias("node"), body(text).alias("text"))
    n = members.count()
    picked = rows.join(small(members, n, 500_000), "node").where("doc_id <=> rep").select("id", "label", "parts", "block", "text")

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in chunks(batch.column("text")):
                h, count, _ = shingles(texts)
                ends = np.cumsum(count)
                sets = [np.unique(h[e - c : e]) for e, c in zip(ends, count, strict=True)]
                sizes = [len(s) for s in sets]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()),
                                                 pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)))
                given = [batch.column(c).slice(a, b - a) for c in ("id", "label", "parts", "block")]
                yield pa.RecordBatch.from_arrays([*given, lists], ["id", "label", "parts", "block", "hashes"])

    sets = picked.mapInArrow(shingle, "id bigint, label bigint, parts int, block int, hashes array<bigint>")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    tasks = sets.select("id", "label", "block", "hashes", other).select(
        "label", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "id", "block", "hashes")
    tasks = tasks.repartition("label", "one", "two").sortWithinPartitions("label", "one", "two", "id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {}

        def done() -> list:
            if key is None or len(held) < 2:
                return []
            ids = np.array(list(held))
            return compare(ids, np.array([b for b, _ in held.values()]), [s for _, s in held.values()], key[1], key[2])

        def packed(out: list) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64()))
            columns = list(zip(*out, strict=True)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                              ["id", "root", "links", "missed"])

        for batch in batches:
            out = []
            lists = batch.column("hashes")
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
            plain = (batch.column(c).to_pylist() for c in ("label", "one", "two", "id", "block"))
            for i, (label, one, two, id_, block) in enumerate(zip(*plain, strict=True)):
                if (label, one, two) != key:
                    out += done()
                    key, held = (label, one, two), {}
                held[id_] = (block, flat[ends[i] : ends[i + 1]].copy())
            yield packed(out)
        yield packed(done())

    return tasks.mapInArrow(work, "id bigint, root bigint, links bigint, missed array<double>")


@dataclass
class Rounds:
    """The prefix depths that a join ran at, and the estimated share of the links that each found."""

    depths: list[int] = field(default_factory=list)
    recall: list[float] = field(default_factory=list)


def classes(docs: DataFrame, doc: str = "doc_id", text: str = "text", target: float = TARGET, rounds: Rounds | None = None) -> DataFrame:
    """For every row: (doc_id, node, text_id, class_id, keeper, n_links). ``rounds`` is filled while the join runs.

    ``text_id`` is the least id with the same text, ``class_id`` the least id of all texts linked directly or
    over others, ``keeper`` the node of the class's representative, ``n_links`` the number of different texts
    within the similarity.
    """
    signed = cut(signatures(docs, doc, text))
    nodes = signed.groupBy("node", "n_words", "paths").agg(F.min("doc_id").alias("rep"))
    nodes = cut(nodes.withColumn("id", F.monotonically_increasing_id()))
    depth, rounds = DEPTH, Rounds() if rounds is None else rounds
    while True:
        found = cut(verify(docs, nodes, candidate_clusters(nodes, depth), doc, text))
        sums = found.agg(F.sum("links"), *[F.sum(F.get("missed", F.lit(k))) for k in range(DEPTH - LEAST_DEPTH + 1)]).first()
        enough = [d for d in range(LEAST_DEPTH, DEPTH + 1)
                  if not sums[0] or sums[0] / (sums[0] + sums[1 + d - LEAST_DEPTH]) >= target]
        wanted = max(enough, default=LEAST_DEPTH)
        rounds.depths.append(depth)
        rounds.recall.append(sums[0] / (sums[0] + sums[1 + depth - LEAST_DEPTH]) if sums[0] else 1.0)
        if wanted >= depth:
            if rounds.recall[-1] < LEAST_RECALL:
                raise RuntimeError(f"estimated recall {rounds.recall[-1]:.3f} at the shortest prefixes")
            break
        depth = wanted
    linked = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("n_links"))
    placed = nodes.select("id", "node", "rep").join(linked, "id", "left").join(links, "id", "left").select(
        "node", "rep", F.coalesce("label", "id").alias("label"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    named = placed.groupBy("label").agg(F.min(F.struct(F.col("rep").isNull(), "rep", "node")).alias("first"))
    named = named.select("label", F.col("first.rep").alias("class_id"), F.col("first.node").alias("keeper"))
    by_text = placed.join(named, "label").select("node", F.col("rep").alias("text_id"), "class_id", "keeper", "n_links")
    return signed.select("doc_id", "node").join(by_text, "node")


def keep_one(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each class: that of the least id (one of them, where rows repeat)."""
    names, doc, text, docs = docs.columns, number_of(docs, doc), number_of(docs, text), numbered(docs)
    found = cut(classes(docs, doc, text))
    kept = found.where("node = keeper AND doc_id <=> class_id").groupBy("node", "doc_id").agg(F.count(F.lit(1)).alias("rows"))
    kept = cut(kept.select(F.col("node").alias("_node"), F.col("doc_id").alias("_id"), "rows"))
    n, most = kept.agg(F.count(F.lit(1)), F.max("rows")).first()
    out = docs.withColumn("_n", node(text)).join(
        small(kept, n), (F.col("_n") == F.col("_node")) & F.col(doc).cast("long").eqNullSafe(F.col("_id")), "left_semi")
    if (most or 0) > 1:  # repeated rows: only then another shuffle
        out = out.dropDuplicates(["_n"])
    return out.drop("_n").toDF(*names)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its text class, its class of near duplicates and its number of links."""
    return classes(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "text_id", "class_id", "n_links")


ORACLE = r"""
WITH RECURSIVE t AS (SELECT text, min(doc_id) AS id FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents) GROUP BY text),
w AS (SELECT id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '') AS w FROM t),
s AS (SELECT DISTINCT id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
p AS (SELECT a.id AS a, b.id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.id <> b.id GROUP BY a.id, b.id),
l AS (SELECT a, b FROM p JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE c * 9 >= 4 * (x.n + y.n)),
r AS (SELECT id AS a, id AS b FROM t UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT doc_id, t.id AS text_id, (SELECT min(b) FROM r WHERE r.a = t.id) AS class_id,
  (SELECT count(*) FROM l WHERE l.a = t.id)::BIGINT AS n_links
FROM documents JOIN t ON t.text = coalesce(documents.text, '')
"""
