"""The registered queries against SQL or the libraries, and the pipeline against a brute-force version."""

import hashlib
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.conftest import SMALL
from visitlens.llm import order_minhash, queries, secrets


def table(name):
    return duckdb.sql(f"SELECT * FROM '{SMALL}/{name}.parquet'").df()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "labels", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SMALL).toPandas(), con.sql(queries.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    key = sorted(got.columns)
    assert Counter(map(tuple, got[key].astype(str).values)) == Counter(map(tuple, want[key].astype(str).values))


def test_tokenizers(spark):
    docs = dict(table("documents")[["doc_id", "text"]].values.tolist())
    word, byte = (Tokenizer.from_file(public_tokenizers.path(f"{n}.json")) for n in ("word_bpe_49k", "byte_bpe_50k"))
    for r in queries.QUERIES["op1_lexicon_bpe"](spark, SMALL).collect():
        ids = word.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(word.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    for r in queries.QUERIES["op7_token_count"](spark, SMALL).collect():
        n = len(byte.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(docs[r.doc_id].encode()), n > 1024)


def test_fingerprint_query(spark):
    docs = dict(table("documents")[["doc_id", "text"]].values.tolist())
    ids = sorted(docs, reverse=True)
    got = {r.doc_id: r for r in queries.QUERIES["op5_order_minhash"](spark, SMALL).collect()}
    f = {i: order_minhash.fingerprint(docs[i]) for i in ids}
    for i, j in zip(ids, ids[1:] + ids[:1], strict=True):
        text = docs[i]
        half = len(text) // 2
        edited = text[: len(text) - half] + docs[j][:half]
        g = order_minhash.fingerprint(edited)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(text)
        assert got[i].fingerprint == order_minhash.shown(f[i]) and got[i].edited_fingerprint == order_minhash.shown(g)
        assert (got[i].near_edited, got[i].near_next) == (order_minhash.likeness(f[i], g), order_minhash.likeness(f[i], f[j]))


def test_shard_query(spark):
    docs = dict(table("documents")[["doc_id", "text"]].values.tolist())
    got = queries.QUERIES["op8_sharding"](spark, SMALL).toPandas().set_index("doc_id")
    assert all(got.loc[i, "size"] == len(t.encode()) + 8 and got.loc[i, "text_crc32"] == zlib.crc32(t.encode()) for i, t in docs.items())
    by = got.groupby("shard")["size"].sum()
    assert by.max() - by.min() <= 2 * got["size"].max()
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))


@pytest.mark.parametrize("name, score, label, least", [("op4_compression_quality", "score", "quality", 0.95), ("op3_toxicity_chain", "p_toxic", "toxic", 0.8)])
def test_held_out_ranking(spark, name, score, label, least):
    sf = "/root/testdata/sf0.01"
    labels = duckdb.sql(f"SELECT * FROM '{sf}/labels.parquet'").df().rename(columns={"toxic": "y_toxic", "quality": "y_quality"})
    got = queries.QUERIES[name](spark, sf).toPandas().merge(labels, on="doc_id")
    held = got[got.held_out]
    good, bad = held[held[f"y_{label}"] == 1][score].values, held[held[f"y_{label}"] == 0][score].values
    assert np.mean(good[:, None] > bad[None, :]) >= least
    assert set(held.doc_id) == {d for d in got.doc_id if zlib.crc32(str(d).encode()) % 5 == 0}


def test_pipeline_equals_brute_force(spark):
    """Each stage's decisions, replayed on plain Python values."""
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    step = spark.read.parquet(f"{SMALL}/documents.parquet")
    (_, good), (_, distinct), (_, leaks), (_, redact), (_, encode) = corpus_pipeline.STAGES
    kept = good(spark, step, SMALL)
    scores = {r.doc_id: r.predicted for r in queries.QUERIES["op4_compression_quality"](spark, SMALL).collect()}
    alive = {r.doc_id for r in kept.collect()}
    assert alive == {d for d, p in scores.items() if p == 1} and kept.columns == step.columns

    def grams(text):
        w = text.lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {d: grams(docs[d].text) for d in alive}
    root = {d: d for d in alive}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sorted(alive):
        for b in sorted(alive):
            if a < b and (docs[a].text == docs[b].text or (sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    one = distinct(spark, kept, SMALL)
    alive = {d for d in alive if find(d) == d}
    assert {r.doc_id for r in one.collect()} == alive
    leaked = {r.doc_id for r in queries.QUERIES["op6_decontaminate"](spark, SMALL).collect()}
    clean = leaks(spark, one, SMALL)
    alive -= leaked
    assert {r.doc_id for r in clean.collect()} == alive
    spans = {r.doc_id: r.spans for r in secrets.scan(step).collect()}
    hidden = {}
    for d in alive:
        text, at = "", 0
        for start, _, end in spans[d]:
            if start >= at:
                text += docs[d].text[at:start] + "[SECRET]"
            at = max(at, end)
        hidden[d] = text + docs[d].text[at:]
    safe = redact(spark, clean, SMALL)
    assert {r.doc_id: (r.text, r.n_chars) for r in safe.collect()} == {d: (t, len(t)) for d, t in hidden.items()}
    word = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {d: word.encode(t, add_special_tokens=False).ids for d, t in hidden.items()}
    assert {r.doc_id: r.ids for r in encode(spark, safe, SMALL).collect()} == want
    assert {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SMALL).collect()} == want
