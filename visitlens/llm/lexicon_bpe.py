"""BPE encoding and decoding over a minimal acyclic transducer of frequent words.

The words of all documents are counted; the most frequent (at most ``LEXICON_WORDS``) are merged once and compiled
into a minimal acyclic automaton in which words share prefixes and suffixes. Every arc carries an output; the sum
of outputs along a word is its ordinal, which addresses the word's ids in the same file. The file is shipped
with ``SparkContext.addFile`` and memory-mapped by the Python workers, so workers of one machine share it.
Words of more than ``WORD_BYTES`` bytes are not looked up: an unbroken string of any length neither grows the file nor is
walked byte by byte. Words that the automaton does not accept are merged exactly: many at a time in numpy up to ``LONG`` bytes, on
a heap and a linked list beyond. The lexicon decides speed only, never results.

Decoding follows a tokenizer file without a decoder: the tokens' strings joined by a blank.

Defined cases: a null or empty text has no ids and decodes to the empty string; ids outside the vocabulary
decode to nothing; rows are independent; a null id column stays null; an empty table gives no rows (and an
empty lexicon); further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import body, cut, ship_package
from visitlens.llm.merges import NONE, Merges, load
from visitlens.llm.pretoken import chunks
from visitlens.sources.tables import read_table

LEXICON_WORDS = 100_000
WORD_BYTES = 64  # longer words are in no lexicon, so it holds at most LEXICON_WORDS * WORD_BYTES bytes of words
LONG = 48


def word_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(word as bytes, count) of all words of up to ``WORD_BYTES`` over all whole texts; counted per chunk before the
    shuffle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = load(path, False)[1]
        for batch in batches:
            for _, _, texts in chunks(batch.column(0)):
                words, codes, _ = splitter.split(texts)
                n = np.bincount(codes[codes >= 0], minlength=len(words))
                counted = pa.RecordBatch.from_arrays([words, pa.array(n, pa.int64())], ["word", "n"])
                yield counted.filter(pc.less_equal(pc.binary_length(words), WORD_BYTES))

    part = docs.select(body(text).alias("text")).mapInArrow(work, "word binary, n bigint")
    return part.groupBy("word").agg(F.sum("n").alias("n"))


def compile_lexicon(words: list[bytes], merges: Merges) -> bytes:
    """The transducer file of distinct ``words``: sorted arcs, their targets and outputs, final states, ids.

    Words are added in order; when a branch can no longer change, its states are replaced by equal ones seen
    before (same finality, same arcs), which makes the automaton minimal.
    """
    words = sorted(words)
    ids = [merged(merges, w) for w in words]
    arcs: list[dict[int, int]] = [{}]
    final = [False]
    register: dict[tuple, int] = {}
    path: list[tuple[int, int]] = []  # (state, byte) of the last word, not yet settled

    def settle(depth: int) -> None:
        while len(path) > depth:
            state, byte = path.pop()
            child = arcs[state][byte]
            key = (final[child], *sorted(arcs[child].items()))
            same = register.setdefault(key, child)
            arcs[state][byte] = same

    last = b""
    for word in words:
        common = len(os.path.commonprefix([last, word]))
        settle(common)
        state = arcs[path[-1][0]][path[-1][1]] if path else 0
        for byte in word[common:]:
            arcs.append({})
            final.append(False)
            arcs[state][byte] = len(arcs) - 1
            path.append((state, byte))
            state = len(arcs) - 1
        final[state] = True
        last = word
    settle(0)

    below: dict[int, int] = {}  # words accepted from a state
    order, stack = [], [0]
    seen = {0}
    while stack:
        state = stack.pop()
        order.append(state)
        for child in arcs[state].values():
            if child not in seen:
                seen.add(child)
                stack.append(child)
    number = {state: k for k, state in enumerate(order)}

    def count(root: int) -> int:
        todo = [root]
        while todo:
            state = todo[-1]
            missing = [c for c in arcs[state].values() if c not in below]
            if missing:
                todo += missing
            else:
                below[state] = final[state] + sum(below[c] for c in arcs[state].values())
                todo.pop()
        return below[root]

    count(0)
    rows = []
    for state in order:
        before = int(final[state])
        for byte, child in sorted(arcs[state].items()):
            rows.append((number[state] << 8 | byte, number[child], before))
            before += below[child]
    rows.sort()
    keys = np.array([r[0] for r in rows], np.int64)
    target = np.array([r[1] for r in rows], np.int32)
    out = np.array([r[2] for r in rows], np.int32)
    ends = np.array([final[s] for s in order], np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
    flat = np.array([i for x in ids for i in x], np.int32)
    head = np.array([len(keys), len(ends), len(offsets), len(flat)], np.int64)
    return b"".join(a.tobytes() for a in (head, keys, target, out, offsets, flat, ends))


def merged(merges: Merges, word: bytes) -> list[int]:
    sym = merges.symbols(word)
    merges.run(sym)
    return [int(merges.ids[s]) for s in sym if s >= 0]


class Lexicon:
    """The memory-mapped file; ``find`` walks many words at once."""

    def __init__(self, file: str):
        raw = np.memmap(file, np.uint8, "r")
        n_arcs, n_states, n_offsets, n_ids = raw[:32].view(np.int64).tolist()
        at = 32

        def take(n: int, kind: type) -> np.ndarray:
            nonlocal at
            part = raw[at : at + n * np.dtype(kind).itemsize].view(kind)
            at += part.nbytes
            return part

        self.keys, self.target, self.out = take(n_arcs, np.int64), take(n_arcs, np.int32), take(n_arcs, np.int32)
        self.offsets, self.ids, self.final = take(n_offsets, np.int32), take(n_ids, np.int32), take(n_states, np.uint8)

    def find(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The ordinal of each word, -1 where the automaton does not accept it."""
        found = np.full(len(start), -1, np.int64)
        live = np.flatnonzero((size > 0) & (size <= WORD_BYTES)) if len(self.keys) else np.zeros(0, np.int64)
        state = np.zeros(len(live), np.int64)
        total = np.zeros(len(live), np.int64)
        step = 0
        while len(live):
            key = state << 8 | data[start[live] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[at] == key
            live, at = live[ok], at[ok]
            state, total = self.target[at].astype(np.int64), total[ok] + self.out[at]
            step += 1
            done = size[live] == step
            hit = done & (self.final[state] > 0)
            found[live[hit]] = total[hit]
            live, state, total = live[~done], state[~done], total[~done]
        return found


@lru_cache(maxsize=4)
def open_lexicon(name: str) -> Lexicon:
    return Lexicon(SparkFiles.get(name))


def frequent_words(counts: DataFrame, most: int) -> list[bytes]:
    """The words seen at least 2**k times, for the least k at which they are at most ``most``."""
    counts = cut(counts)
    many = counts.agg(*[F.count_if(F.col("n") >= F.lit(1 << k)).alias(f"k{k}") for k in range(48)]).first()
    least = next((1 << k for k in range(48) if many[k] <= most), 1 << 48)
    return [bytes(r[0]) for r in counts.where(F.col("n") >= least).select("word").collect()]


def ship_lexicon(spark: SparkSession, words: list[bytes], path: str) -> str:
    """Compile on the driver (at most ``LEXICON_WORDS`` words) and add the file to the session's executors, once."""
    blob = compile_lexicon(words, load(path, False)[0])
    name = f"lexicon-{hashlib.sha256(blob).hexdigest()[:24]}.bin"
    sc = spark.sparkContext
    shipped = sc.__dict__.setdefault("_visitlens_lexicons", set())
    if name not in shipped:
        file = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), name)
        with open(file, "wb") as f:
            f.write(blob)
        sc.addFile(file)
        shipped.add(name)
    return name


def merge_many(merges: Merges, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many words by simultaneous single merges, lowest rank first and leftmost among equals: (flat, lengths)."""
    n = len(start)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.concatenate(([0], np.cumsum(size)))
    sym = data[np.arange(first[-1]) + np.repeat(start - first[:-1], size)].astype(np.int64)
    sym[first[1:] - 1] = merges.final[data[start + size - 1]]
    word, lens = np.arange(n), size.copy()
    pair = np.full(len(sym), NONE)
    pair[:-1] = merges.rank(sym[:-1], sym[1:])
    pair[first[1:] - 1] = NONE
    done_words, done_lens, done_syms = [], [], []
    while len(word):
        first = np.concatenate(([0], np.cumsum(lens)))
        low = np.minimum.reduceat(pair, first[:-1])
        open_ = low < NONE
        if not open_.all():
            keep = np.repeat(open_, lens)
            done_words.append(word[~open_])
            done_lens.append(lens[~open_])
            done_syms.append(sym[~keep])
            word, lens, low, sym, pair = word[open_], lens[open_], low[open_], sym[keep], pair[keep]
            if not len(word):
                break
            first = np.concatenate(([0], np.cumsum(lens)))
        hits = np.flatnonzero(pair == np.repeat(low, lens))
        place = hits[np.searchsorted(hits, first[:-1])]  # leftmost hit of each word
        sym[place] = merges.made_ids[low]
        keep = np.ones(len(sym), bool)
        keep[place + 1] = False
        sym, pair = sym[keep], pair[keep]
        lens = lens - 1
        place = place - np.arange(len(place))
        first = np.concatenate(([0], np.cumsum(lens)))
        at_end = place == first[1:] - 1
        right = np.minimum(place + 1, len(sym) - 1)
        pair[place] = np.where(at_end, NONE, merges.rank(sym[place], sym[right]))
        inner = place > first[:-1]
        left = place[inner] - 1
        pair[left] = merges.rank(sym[left], sym[left + 1])
    words, lens, syms = np.concatenate(done_words), np.concatenate(done_lens), np.concatenate(done_syms)
    out_lens = np.zeros(n, np.int64)
    out_lens[words] = lens
    begin = np.concatenate(([0], np.cumsum(out_lens)))
    flat = np.empty(len(syms), np.int64)
    ends = np.cumsum(lens)
    flat[np.arange(len(syms)) + np.repeat(begin[words] - (ends - lens), lens)] = syms
    return merges.ids[flat], out_lens


def _gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The concatenation of flat[start : start + size]."""
    ends = np.cumsum(size)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)]


def encode_chunk(path: str, name: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(all ids in order, number of ids of each text)."""
    merges, splitter = load(path, False)
    lexicon = open_lexicon(name)
    words, codes, per_text = splitter.split(texts)
    _, offs, buf = words.buffers()
    offs = np.frombuffer(offs, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64) if len(words) else np.zeros(1, np.int64)
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    start, size = offs[:-1], np.diff(offs)
    known = lexicon.find(data, start, size)
    lens = np.zeros(len(words), np.int64)
    begin = np.zeros(len(words), np.int64)
    hit = known >= 0
    begin[hit] = lexicon.offsets[known[hit]]
    lens[hit] = lexicon.offsets[known[hit] + 1] - begin[hit]
    new = np.flatnonzero(~hit & (size <= LONG))
    made, made_lens = merge_many(merges, data, start[new], size[new])
    pool, base = [lexicon.ids.astype(np.int64), made], len(lexicon.ids)
    lens[new], begin[new] = made_lens, base + np.cumsum(made_lens) - made_lens
    base += len(made)
    for w in np.flatnonzero(~hit & (size > LONG)).tolist():
        ids = np.array(merged(merges, data[start[w] : start[w] + size[w]].tobytes()), np.int64)
        begin[w], lens[w] = base, len(ids)
        pool.append(ids)
        base += len(ids)
    if (codes < 0).any():  # special strings: their ids stand behind the words
        special = np.unique(codes[codes < 0])
        pool.append(-1 - special)
        codes = np.where(codes >= 0, codes, len(lens) + np.searchsorted(special, codes))
        begin = np.concatenate([begin, base + np.arange(len(special))])
        lens = np.concatenate([lens, np.ones(len(special), np.int64)])
    each = lens[codes] if len(codes) else np.zeros(0, np.int64)
    flat = _gather(np.concatenate(pool), begin[codes], each) if len(codes) else np.zeros(0, np.int64)
    total = np.concatenate(([0], np.cumsum(each)))
    ends = np.concatenate(([0], np.cumsum(per_text)))
    return flat, total[ends[1:]] - total[ends[:-1]]


@lru_cache(maxsize=2)
def _strings(path: str) -> list[str]:
    merges, splitter = load(path, False)
    names = merges.tokens | {i: s for s, i in splitter.special.items()}
    return [names.get(i, "") for i in range(max(names) + 1)]


def decode_ids(path: str, ids: list[int]) -> str:
    names = _strings(path)
    return " ".join([names[i] for i in ids if 0 <= i < len(names)])


def encode(docs: DataFrame, path: str, doc: str = "doc_id", text: str = "text", digests: bool = False,
           lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """(doc_id, n_tokens, ids), or with ``digests`` (doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    ship_package(docs.sparkSession)
    name = ship_lexicon(docs.sparkSession, frequent_words(word_counts(docs, path, text), lexicon_words), path)
    rows = docs.select(F.col(doc).alias("doc_id"), body(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in chunks(batch.column("text")):
                flat, n = encode_chunk(path, name, texts)
                ends = np.concatenate(([0], np.cumsum(n)))
                given = [batch.column("doc_id").slice(a, b - a), pa.array(n, pa.int64())]
                if not digests:
                    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                    yield pa.RecordBatch.from_arrays([*given, ids], ["doc_id", "n_tokens", "ids"])
                    continue
                packed, names = flat.astype("<u4").tobytes(), _strings(path)
                sha, back = [], []
                for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                    sha.append(hashlib.sha256(packed[4 * i : 4 * j]).hexdigest())
                    text_ = " ".join(map(names.__getitem__, flat[i:j].tolist()))
                    back.append(hashlib.sha256(text_.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([*given, pa.array(sha, pa.string()), pa.array(back, pa.string())],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    out = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>"
    return rows.mapInArrow(work, f"doc_id {kind}, n_tokens bigint, {out}")


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``text`` decoded from ``ids`` (null ids: the empty text)."""

    ship_package(encoded.sparkSession)

    @F.pandas_udf("string")
    def back(col):
        return col.map(lambda x: "" if x is None else decode_ids(path, list(x)))

    return encoded.withColumn("text", back(F.col(ids)))


def op1_lexicon_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """All documents encoded and decoded in the word-end vocabulary, as digests."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return encode(read_table(spark, sf_dir, "documents"), path, digests=True)
