"""Token alignment against a plain version that looks at every byte offset."""

import hashlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import EDGE, LONG, SMALL, rows
from visitlens.llm import token_align
from visitlens.llm.pretoken import to_bytes

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@lru_cache
def libraries():
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    return tok, sentencepiece.SentencePieceProcessor(model_file=B)


def cut(text):
    """((A id, bytes)..., (B id, bytes)...) or None."""
    if not text:
        return None
    tok, model = libraries()
    a = [(i, to_bytes(tok.id_to_token(i))) for i in tok.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode())
         for i in model.encode(text)]
    want = (" " + text).encode()
    return None if any(b"".join(x for _, x in side) != want for side in (a, b)) else (a, b)


def brute(docs):
    found = []
    holds = Counter()
    for doc, text in docs:
        sides = cut(text)
        groups = []
        if sides:
            ends = []
            for side in sides:
                at = np.cumsum([len(x) for _, x in side]).tolist()
                ends.append(dict(zip(at, range(len(at)))))
            i = j = 0
            for offset in sorted(set(ends[0]) & set(ends[1])):
                k, m = ends[0][offset] + 1, ends[1][offset] + 1
                groups.append(([t for t, _ in sides[0][i:k]], [t for t, _ in sides[1][j:m]]))
                i, j = k, m
        links = Counter((x, y) for g, h in groups for x in g for y in h)
        holds.update(links.keys())
        found.append((doc, sides, groups, links))
    most = defaultdict(int)
    for (x, _), n in holds.items():
        most[x] = max(most[x], n)
    out = []
    for doc, sides, groups, links in found:
        shown = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((doc, len(sides[0]) if sides else 0, len(sides[1]) if sides else 0, len(groups), sum(links.values()),
                    sum(n for p, n in links.items() if holds[p] == most[p[0]]), sum(n * holds[p] for p, n in links.items()),
                    hashlib.sha256(shown.encode()).hexdigest() if sides else ""))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(token_align.op13_token_align(spark, SMALL), *NAMES) == brute(docs)


TANGLED = ["a▁b", "   " * 700, "\n" * 500 + "   x", "é" * 300 + "中文🎉" * 50, "<s>x</s><unk><|endoftext|><0x0A>", "aaaa" * 900, "a \x00b\x1c", "1234567890" * 80]


def test_edges_and_small_blocks(edge, clashing, spark):
    want = brute(EDGE)
    assert rows(token_align.align_documents(edge, A, B), *NAMES) == want
    assert rows(token_align.align_documents(clashing, A, B, block_bytes=200), *NAMES) == want
    docs = spark.createDataFrame(list(enumerate(TANGLED)), "doc_id int, text string")
    got = token_align.align_documents(docs, A, B, block_bytes=1)
    assert rows(got, *NAMES) == brute(enumerate(TANGLED)) and dict(got.dtypes)["doc_id"] == "int"
    named = docs.select(F.col("doc_id").cast("string").alias("block"), F.col("text").alias("pair"))
    assert rows(token_align.align_documents(named, A, B, "block", "pair"), *NAMES[1:]) == sorted((r[1:] for r in brute(enumerate(TANGLED))), key=str)


def test_empty(empty):
    assert token_align.align_documents(empty, A, B).count() == 0


def test_documents_without_tokens_only(edge):
    got = token_align.align_documents(edge.where("text is null or text = ''"), A, B).collect()
    assert len(got) == 2 and all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "") for r in got)


@pytest.mark.parametrize("lane", [1, 2, 7, 256])
def test_lanes_and_wide_groups(lane, monkeypatch):
    a, b = token_align.encoder(A), token_align.encoder(B)
    texts = [*TANGLED, LONG]
    want = token_align.align_texts(a, b, texts, lane=1 << 30)
    counted = lambda x: Counter({k: n for k, n in _sum(x).items()})
    got = token_align.align_texts(a, b, texts, lane=lane)
    assert (got[0] == want[0]).all() and got[1] == want[1] and counted(got[2]) == counted(want[2])
    monkeypatch.setattr(token_align, "WIDE", 2)
    got = token_align.align_texts(a, b, texts, lane=lane)
    assert got[1] == want[1] and counted(got[2]) == counted(want[2])


def _sum(links):
    out = Counter()
    for d, x, y, n in zip(*(c.tolist() for c in links), strict=True):
        out[d, x, y] += n
    return out


ends = st.lists(st.integers(1, 5), min_size=1, max_size=30)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(ends, ends), min_size=1, max_size=6), st.integers(1, 5))
def test_links_of_any_ends(docs, lane):
    """Links and groups of documents with random token lengths, in lanes of any size."""
    size_a, size_b, n_a, n_b = [], [], [], []
    for a, b in docs:
        short, gap = (a, b) if sum(a) < sum(b) else (b, a), abs(sum(a) - sum(b))
        a, b = list(a), list(b)
        if gap:
            (a if short[0] == a else b).append(gap)
        size_a, size_b = size_a + a, size_b + b
        n_a.append(len(a)), n_b.append(len(b))
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    place_a, place_b = np.arange(len(end_a)), np.arange(len(end_b))
    cut_a, cut_b, in_a, in_b, la, lb, place, times = token_align.align(place_a, place_b, end_a, end_b, np.array(n_a), lane)
    both = sorted(set(end_a.tolist()) & set(end_b.tolist()))
    group = lambda at: np.searchsorted(both, at)
    want = {(i, j) for i in place_a for j in place_b if group(end_a[i]) == group(end_b[j])}
    assert len(la) == len(want) and set(zip(la.tolist(), lb.tolist())) == want and (times == 1).all() and (place == la).all()
    assert end_a[cut_a].tolist() == both and in_a.sum() == len(end_a) and in_b.sum() == len(end_b)
