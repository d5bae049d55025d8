"""Alignment of two tokenizers' tokens: lockstep merging of both token-end sequences.

A and B cut the same bytes. A byte offset where both end a token is a cut; the tokens between two cuts are a
group, and every A-B pair within a group is a link. ``lockstep`` keeps one NumPy state vector of pointers for a
whole chunk of documents (long documents on several lanes): each step emits the pair every lane stands on as a
link, the lanes that reach a cut, moves the pointer that ends first (both at a cut) and drops finished lanes. In
groups of several tokens on both sides the pairs that do not overlap are added afterwards.

How many documents hold a pair needs the whole corpus. Documents are worked in blocks of bounded bytes; a block
carries the table of its distinct pairs. These tables are summed by pair, and each block gets back the sums of its
own pairs only (a shuffle of block tables, never of links, and nothing passes through the driver).

Defined cases: texts that are null, empty or not cut loss-free by both tokenizers have no tokens: zeros, and an
empty digest. Every row is a document of its own, so repeated rows count each, and null ids stay null. An empty
table gives no rows; further columns are not looked at. A very long text is a block by itself.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import body, ship_package
from visitlens.llm.pretoken import Splitter, chunks, to_bytes
from visitlens.session import checkpoint_dir
from visitlens.sources.tables import read_table

CHUNK_BYTES = 1 << 20
BLOCK_BYTES = 8 << 20
LANE = 256  # A tokens of a lane
WIDE = 1 << 12  # pairs of a group beyond which they are counted by id instead of one by one
REMEMBERED = 400_000


class Vocabulary:
    """The bytes and the decimal text of every token of a vocabulary."""

    def __init__(self, entries: list[bytes]):
        self.size = len(entries)
        self.lens = np.fromiter(map(len, entries), np.int64, self.size)
        self.first = np.cumsum(self.lens) - self.lens
        self.flat = np.frombuffer(b"".join(entries), np.uint8)
        shown = [str(i).encode() for i in range(self.size)]
        self.shown_lens = np.fromiter(map(len, shown), np.int64, self.size)
        self.digits = int(self.shown_lens.max(initial=0)) + 1  # an id and its separator
        self.shown = np.frombuffer(b"".join(s.ljust(self.digits, b",") for s in shown), np.uint8).reshape(self.size, -1)

    def join(self, ids: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """The bytes of all tokens of ``ids`` in a row."""
        ends = np.cumsum(lens)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[ids] - (ends - lens), lens)
        return self.flat[at]


class _Known(dict):
    """Numbers of words; an unknown word has -1."""

    def __missing__(self, word: bytes) -> int:
        return -1


class Words:
    """Token ids of words, remembered between chunks up to a fixed number of words."""

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]]):
        self.encode = encode
        self._forget()

    def _forget(self) -> None:
        self.known = _Known()
        self.lens, self.first, self.flat = (np.zeros(0, np.int64) for _ in range(3))

    def spread(self, words: list[bytes], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words at all places in a row, and the number of ids at each place."""
        number = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        new = np.flatnonzero(number < 0)
        if len(new):
            spelled = [words[k] for k in new.tolist()]
            ids = self.encode(spelled)
            lens = np.fromiter(map(len, ids), np.int64, len(ids))
            number[new] = range(len(self.lens), len(self.lens) + len(new))
            self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(lens) - lens])
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.int64, int(lens.sum()))])
            self.lens = np.concatenate([self.lens, lens])
            self.known.update((w, k) for w, k in zip(spelled, number[new].tolist(), strict=True) if len(w) <= 64)
        number = number[codes]
        n = self.lens[number]
        ends = np.cumsum(n)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[number] - (ends - n), n)
        out = self.flat[at]
        if len(self.lens) > REMEMBERED or len(self.flat) > 8 * REMEMBERED:
            self._forget()
        return out, n


class ByteLevel:
    """A: a byte-level vocabulary; special strings are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        entries = [b""] * (max(vocab.values(), default=-1) + 1)
        for token, i in vocab.items():
            entries[i] = to_bytes(token)
        self.vocabulary = Vocabulary(entries)
        self.splitter = Splitter(path, True)
        self.splitter.special = {}
        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True
        tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        tok.no_truncation()
        tok.no_padding()
        self.words = Words(lambda new: [e.ids for e in tok.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each."""
        words, codes, per_text = self.splitter.split([" " + t for t in texts])
        ids, n = self.words.spread(words.to_pylist(), codes)
        total = np.concatenate(([0], np.cumsum(n)))
        ends = np.concatenate(([0], np.cumsum(per_text)))
        return ids, total[ends[1:]] - total[ends[:-1]]


class Pieces:
    """B: a vocabulary of pieces with byte fallback; the library adds the blank before the text itself.

    Where no piece has a blank after another character, no merge crosses the place before a run of blanks, so the runs
    with the word that follows are cut apart and encoded once each. Otherwise whole texts are encoded.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.vocabulary = Vocabulary([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])
        probe = "a  ﬁ Ａ e\u0301 ½\tx\r\n "
        plain = self.model.normalize(probe) == "▁" + probe.replace(" ", "▁")
        self.by_word = plain and "▁" in pieces and not any("▁" in p.lstrip("▁") for p in pieces)
        self.words = Words(self._encode_words)

    def _encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Words with their blanks; the library adds the first one itself, but not to an empty text."""
        ids = self.model.encode([w[1:].decode() for w in words], num_threads=1)
        return [i or [self.model.piece_to_id("▁")] for i in ids]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (none of them empty) in a row, and the number of ids of each."""
        if not self.by_word:
            each = self.model.encode(texts, num_threads=1) if texts else []
            lens = np.fromiter(map(len, each), np.int64, len(each))
            return np.fromiter(chain.from_iterable(each), np.int64, int(lens.sum())), lens
        raw, sizes = _raw(texts)
        start = raw == 0x20
        start[1:] &= raw[:-1] != 0x20
        first = np.cumsum(sizes) - sizes
        start[first] = True
        begin = np.flatnonzero(start)
        offsets = pa.py_buffer(np.append(begin, len(raw)).astype(np.int32))
        coded = pa.Array.from_buffers(pa.binary(), len(begin), [None, offsets, pa.py_buffer(raw)]).dictionary_encode()
        ids, n = self.words.spread(coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64))
        return ids, np.add.reduceat(n, np.searchsorted(begin, first)) if len(first) else first


@lru_cache(maxsize=4)
def encoder(path: str) -> ByteLevel | Pieces:
    """Tables of a tokenizer file, read once in each Python worker."""
    return ByteLevel(path) if path.endswith(".json") else Pieces(path)


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray):
    """Links and cuts of all lanes: (A places, B places) of the links, and those of the tokens that end at a cut.

    Lane k merges the A tokens from a[k] to a_end[k] with the B tokens from b[k] to b_end[k]. All lanes go one
    step at a time; the lane standing on the pair (i, j) emits it, a cut if both end there, and moves on.
    """
    links, cuts = [], []
    live = (a < a_end) & (b < b_end)
    while True:
        if not live.all():
            a, a_end, b, b_end = a[live], a_end[live], b[live], b_end[live]
        if not len(a):
            break
        links.append((a, b))
        end_a, end_b = ends_a[a], ends_b[b]
        both = end_a == end_b
        if both.any():
            cuts.append((a[both], b[both]))
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        live = (a < a_end) & (b < b_end)
    gather = lambda parts, k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64)
    return gather(links, 0), gather(links, 1), gather(cuts, 0), gather(cuts, 1)


def lanes(ends_a: np.ndarray, ends_b: np.ndarray, n_a: np.ndarray, lane: int = LANE):
    """Pointers of the lanes: each document's A tokens in runs of ``lane``, and the B tokens that meet them."""
    first = np.cumsum(n_a) - n_a
    runs = -(-n_a // lane)
    a = np.repeat(first, runs) + lane * (np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs))
    a_end = np.minimum(a + lane, np.repeat(first + n_a, runs))
    start = np.where(a > 0, ends_a[np.maximum(a - 1, 0)], 0)
    b = np.searchsorted(ends_b, start, "right")
    b_end = np.searchsorted(ends_b, ends_a[a_end - 1], "left") + 1
    return a, a_end, b, np.minimum(b_end, len(ends_b))


def align(a_ids, b_ids, ends_a, ends_b, n_a, lane: int = LANE):
    """Groups and links of documents that stand in a row.

    Returns the places where groups end in A and B, and the links as (A id, B id, A place, times).
    """
    la, lb, cut_a, cut_b = lockstep(ends_a, ends_b, *lanes(ends_a, ends_b, n_a, lane))
    order = np.argsort(cut_a)
    cut_a, cut_b = cut_a[order], cut_b[order]
    in_a, in_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
    tangled = (in_a > 1) & (in_b > 1)
    times = np.ones(len(la), np.int64)
    if tangled.any():
        keep = ~np.repeat(tangled, in_a)[la]
        la, lb, times = la[keep], lb[keep], times[keep]
    ids_a, ids_b = a_ids[la], b_ids[lb]
    more = []
    wide = tangled & (in_a * in_b > WIDE)
    t = np.flatnonzero(tangled & ~wide)
    if len(t):
        n = in_a[t] * in_b[t]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = np.repeat(in_b[t], n)
        pa_, pb_ = np.repeat(cut_a[t] - in_a[t] + 1, n) + k // width, np.repeat(cut_b[t] - in_b[t] + 1, n) + k % width
        more.append((a_ids[pa_], b_ids[pb_], pa_, np.ones(len(pa_), np.int64)))
    for g in np.flatnonzero(wide):
        ua, ca = np.unique(a_ids[cut_a[g] - in_a[g] + 1 : cut_a[g] + 1], return_counts=True)
        ub, cb = np.unique(b_ids[cut_b[g] - in_b[g] + 1 : cut_b[g] + 1], return_counts=True)
        more.append((np.repeat(ua, len(ub)), np.tile(ub, len(ua)), np.full(len(ua) * len(ub), cut_a[g]), np.outer(ca, cb).ravel()))
    out = [np.concatenate(x) for x in zip((ids_a, ids_b, la, times), *more, strict=True)]
    return cut_a, cut_b, in_a, in_b, *out


def group_texts(a: Vocabulary, b: Vocabulary, a_ids, b_ids, cut_a, cut_b, in_a, in_b) -> tuple[np.ndarray, np.ndarray]:
    """The groups as text 'a1,a2|b1;' in a row, and where in it each group ends."""
    n = len(a_ids) + len(b_ids)
    of_a, of_b = np.repeat(np.arange(len(cut_a)), in_a), np.repeat(np.arange(len(cut_b)), in_b)
    at_a = np.arange(len(a_ids)) + (cut_b - in_b + 1)[of_a]
    at_b = np.arange(len(b_ids)) + (cut_a + 1)[of_b]
    width = max(a.digits, b.digits)
    table, lens = np.empty((n, width), np.uint8), np.empty(n, np.int64)
    table[at_a, : a.digits], table[at_b, : b.digits] = a.shown[a_ids], b.shown[b_ids]
    lens[at_a], lens[at_b] = a.shown_lens[a_ids], b.shown_lens[b_ids]
    table[at_a[cut_a], lens[at_a[cut_a]]] = ord("|")
    table[at_b[cut_b], lens[at_b[cut_b]]] = ord(";")
    flat = table[np.arange(width) <= lens[:, None]]
    return flat, np.cumsum(lens + 1)[at_b[cut_b]]


def _raw(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a blank and each text, and their lengths."""
    data = [b" " + t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.fromiter(map(len, data), np.int64, len(data))


def _cut_whole(vocabulary: Vocabulary, ids, lens, n, raw, sizes) -> np.ndarray:
    """Documents whose joined token bytes are the raw bytes."""
    own = np.add.reduceat(np.append(lens, 0), np.cumsum(n) - n) * (n > 0) if len(n) else n
    good = own == sizes
    keep = np.repeat(good, n)
    bad = np.flatnonzero(vocabulary.join(ids[keep], lens[keep]) != raw[np.repeat(good, sizes)])
    hit = np.searchsorted(np.cumsum(sizes * good), bad, "right")
    good[hit] = False
    return good


def align_texts(a: ByteLevel | Pieces, b: ByteLevel | Pieces, texts: list[str], lane: int = LANE):
    """Per text (n_a, n_b, n_groups, n_links, sha256), and the links as (text, A id, B id, times)."""
    out = np.zeros((4, len(texts)), np.int64)
    digests = [""] * len(texts)
    use = np.array([k for k, t in enumerate(texts) if t], np.int64)
    none = np.zeros(0, np.int64)
    if not len(use):
        return out, digests, (none, none, none, none)
    held = [texts[k] for k in use]
    raw, sizes = _raw(held)
    sides = []
    for side in (a, b):
        ids, n = side.encode(held)
        lens = side.vocabulary.lens[ids]
        sides.append((ids, n, lens, _cut_whole(side.vocabulary, ids, lens, n, raw, sizes)))
    good = sides[0][3] & sides[1][3]
    (a_ids, n_a, a_lens), (b_ids, n_b, b_lens) = ((ids[keep := np.repeat(good, n)], n[good], lens[keep]) for ids, n, lens, _ in sides)
    use = use[good]
    if not len(use):
        return out, digests, (none, none, none, none)
    cut_a, cut_b, in_a, in_b, la, lb, place, times = align(a_ids, b_ids, np.cumsum(a_lens), np.cumsum(b_lens), n_a, lane)
    last = np.searchsorted(cut_a, np.cumsum(n_a) - 1)  # a document's end is a cut
    first = np.concatenate(([0], last[:-1] + 1))
    out[:, use] = n_a, n_b, last - first + 1, np.add.reduceat(in_a * in_b, first)
    flat, ends = group_texts(a.vocabulary, b.vocabulary, a_ids, b_ids, cut_a, cut_b, in_a, in_b)
    shown, begin = flat.tobytes(), 0
    for k, end in zip(use.tolist(), ends[last].tolist(), strict=True):
        digests[k] = hashlib.sha256(shown[begin : end - 1]).hexdigest()
        begin = end
    return out, digests, (np.repeat(use, n_a)[place], la, lb, times)


def distinct_links(doc: np.ndarray, pair: np.ndarray, times: np.ndarray):
    """(doc, code, times) of each document's distinct pairs, by document and pair, and the pairs that the codes number."""
    pairs, code = np.unique(pair, return_inverse=True) if len(pair) < 1 << 12 else _numbered(pair)
    key = doc << 32 | code
    if len(times) and times.max() > 1:
        order = np.argsort(key)
        key, times = key[order], times[order]
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        times = np.add.reduceat(times, starts)
    else:
        key = np.sort(key)
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        times = np.diff(starts, append=len(key))
    key = key[starts]
    return (key >> 32).astype(np.int32), (key & 0xFFFFFFFF).astype(np.int32), times, pairs


def _numbered(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Like ``np.unique`` with the inverse, by hashing: there are far fewer different pairs than links."""
    code, pairs = pd.factorize(pair)
    order = np.argsort(pairs)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return pairs[order], place[code]


def _packed(x: np.ndarray, kind: str) -> bytes:
    return zlib.compress(x.astype(kind).tobytes(), 1)


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind).astype(np.int64)


def _blocks(a_path: str, b_path: str, doc_type: pa.DataType, block_bytes: int) -> Callable:
    """Blocks of documents: their figures, links by number in the block's pair table, and that table."""

    def one(number: int, ids: list, parts: list) -> pa.RecordBatch:
        figures = np.concatenate([p[0] for p in parts], axis=1)
        digests = [d for p in parts for d in p[1]]
        pairs = np.unique(np.concatenate([p[2][3] for p in parts]))
        code = np.concatenate([np.searchsorted(pairs, p[2][3])[p[2][1]] for p in parts])
        n = np.concatenate([np.bincount(p[2][0], minlength=len(p[1])) for p in parts])
        times = np.concatenate([p[2][2] for p in parts])
        step, first = np.diff(code, prepend=0), (np.cumsum(n) - n)[n > 0]
        step[first] = code[first]  # each document counts from 0
        holds = np.bincount(code, minlength=len(pairs))
        columns = [pa.array([number], pa.int64()), pa.array([ids], pa.list_(doc_type)), *(pa.array([f], pa.list_(pa.int64())) for f in figures),
                   pa.array([digests], pa.list_(pa.string())), pa.array([n], pa.list_(pa.int64())), pa.array([_packed(step, "<u4")], pa.binary()),
                   pa.array([_packed(times, "<u8")], pa.binary()), pa.array([pairs], pa.list_(pa.int64())), pa.array([holds], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_distinct", "steps", "times", "pairs", "holds"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = encoder(a_path), encoder(b_path)
        width = b.vocabulary.size
        number, size, ids, parts = TaskContext.get().partitionId() << 32, 0, [], []
        for batch in batches:
            whole = batch.column("text")
            lens = pc.binary_length(whole)
            for start, end, texts in chunks(whole, CHUNK_BYTES):
                more = pc.sum(lens.slice(start, end - start)).as_py() or 0
                if parts and size + more > block_bytes:
                    yield one(number, ids, parts)
                    number, size, ids, parts = number + 1, 0, [], []
                figures, digests, (doc, id_a, id_b, times) = align_texts(a, b, texts)
                parts.append((figures, digests, distinct_links(doc, id_a * width + id_b, times)))
                ids += batch.column("doc_id").slice(start, end - start).to_pylist()
                size += more
        if parts:
            yield one(number, ids, parts)

    return work


def _with_counts(out_schema: pa.Schema) -> Callable:
    """A block and the corpus-wide counts of its pairs: the rows of its documents."""

    def work(block: pa.Table, counts: pa.Table) -> pa.Table:
        if not block.num_rows:
            return out_schema.empty_table()
        order = np.argsort(counts.column("pair").to_numpy())
        count = counts.column("documents").to_numpy()[order]
        best = counts.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
        row = {c: block.column(c)[0] for c in block.column_names}
        n = row["n_distinct"].values.to_numpy()
        first = np.cumsum(n) - n
        code, times = np.cumsum(_unpacked(row["steps"].as_py(), "<u4")), _unpacked(row["times"].as_py(), "<u8")
        if len(code):
            has = first[n > 0]
            code -= np.repeat(np.concatenate(([0], code[has[1:] - 1])), n[n > 0])  # each document counts from 0
        sums = [np.concatenate(([0], np.cumsum(x))) for x in (best[code] * times, count[code] * times)]
        n_best, count_sum = (s[first + n] - s[first] for s in sums)
        columns = {c: row[c].values for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
        return pa.table(columns | {"n_best": n_best, "count_sum": count_sum}).select(out_schema.names).cast(out_schema)

    return work


def align_documents(docs: DataFrame, a_path: str, b_path: str, doc: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every whole text.

    The texts are cut once: blocks are written below the shared checkpoint folder and read from there.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(doc).alias("doc_id"), body(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    from pyspark.sql.pandas.types import to_arrow_type

    doc_type = to_arrow_type(rows.schema["doc_id"].dataType)
    longs = ", ".join(f"{c} array<bigint>" for c in ("n_a", "n_b", "n_groups", "n_links"))
    schema = f"block bigint, doc_id array<{kind}>, {longs}, groups_sha256 array<string>, n_distinct array<bigint>, steps binary, times binary, pairs array<bigint>, holds array<bigint>"
    at = f"{checkpoint_dir(spark)}/align-{uuid.uuid4().hex}"
    rows.mapInArrow(_blocks(a_path, b_path, doc_type, block_bytes), schema).write.option("compression", "zstd").parquet(at)
    blocks = spark.read.schema(schema).parquet(at)

    width = encoder(b_path).vocabulary.size
    pairs = spark.read.schema(schema).parquet(at).select("block", F.inline(F.arrays_zip("pairs", "holds")).alias("pair", "holds"))
    counts = pairs.groupBy("pair").agg(F.sum("holds").alias("documents")).withColumn("a", F.expr(f"pair div {width}"))
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))
    counts = counts.join(most, "a").select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))
    own = pairs.select("block", "pair").join(counts, "pair").select(F.col("block").alias("of"), "pair", "documents", "best")
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    types = [doc_type, *[pa.int64()] * 6, pa.string()]
    out = pa.schema(list(zip(names, types, strict=True)))
    ddl = ", ".join(f"{n} {kind if n == 'doc_id' else 'string' if n == 'groups_sha256' else 'bigint'}" for n in names)
    return blocks.drop("pairs", "holds").groupBy("block").cogroup(own.groupBy("of")).applyInArrow(_with_counts(out), ddl)


def op13_token_align(spark: SparkSession, sf_dir: str, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """All documents cut by the byte-level vocabulary and by the pieces, aligned."""
    if a_path is None or b_path is None:
        import public_tokenizers

        a_path = a_path or public_tokenizers.path("byte_bpe_50k.json")
        b_path = b_path or public_tokenizers.path("piece_bpe_32k.model")
    return align_documents(read_table(spark, sf_dir, "documents"), a_path, b_path)
