"""Nulls, empty and very long texts, repeated rows, clashing columns and empty tables, for every operator."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import EDGE, LONG, PASSAGE, rows
from visitlens.llm import (
    chat_format, decontaminate, jaccard_join, lexicon_bpe, order_minhash, quality, secrets, sharding, token_count, toxicity,
)

WORD, BYTE = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))
TEXTS = [t or "" for _, t in EDGE]


def test_encode_equals_the_library_and_decodes(edge, clashing):
    tok = Tokenizer.from_file(WORD)
    want = sorted(((i, tok.encode(t, add_special_tokens=False).ids) for (i, _), t in zip(EDGE, TEXTS)), key=str)
    encoded = lexicon_bpe.encode(edge, WORD, lexicon_words=50)
    assert rows(encoded, "doc_id", "ids") == want
    back = rows(lexicon_bpe.decode(encoded, WORD), "doc_id", "text")
    assert back == sorted(((i, tok.decode(ids, skip_special_tokens=False)) for i, ids in want), key=str)
    digests = lexicon_bpe.encode(clashing, WORD, digests=True)
    assert rows(digests, "doc_id", "ids_sha256") == sorted(
        ((i, hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest()) for i, x in want), key=str)


def test_lexicon_shares_suffixes_and_finds_only_its_words(tmp_path):
    merges = lexicon_bpe.load(WORD, False)[0]
    words = [a + b for a in (b"walk", b"talk", b"jump") for b in (b"", b"s", b"ed", b"ing")]
    file = tmp_path / "lexicon"
    file.write_bytes(lexicon_bpe.compile_lexicon(words, merges))
    lexicon = lexicon_bpe.Lexicon(str(file))
    assert len(lexicon.final) < len({w[:k] for w in words for k in range(len(w) + 1)}) / 1.5  # a trie has these states
    probe = [*words, b"wal", b"walke", b"sing", b"jumpings"]
    data = np.frombuffer(b"".join(probe), np.uint8)
    size = np.array([len(p) for p in probe])
    found = lexicon.find(data, np.cumsum(size) - size, size)
    assert (found[len(words):] == -1).all()
    for w, k in zip(words, found):
        assert lexicon.ids[lexicon.offsets[k] : lexicon.offsets[k + 1]].tolist() == lexicon_bpe.merged(merges, w)


def test_merges_many_at_once_equal_the_heap():
    merges = lexicon_bpe.load(WORD, False)[0]
    rng = np.random.default_rng(3)
    words = [bytes(rng.choice(list(b"aeiourstlnh"), rng.integers(1, 30)).tolist()) for _ in range(500)]
    size = np.array([len(w) for w in words])
    flat, lens = lexicon_bpe.merge_many(merges, np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size, size)
    ends = np.cumsum(lens)
    assert [flat[e - n : e].tolist() for e, n in zip(ends, lens)] == [lexicon_bpe.merged(merges, w) for w in words]


def test_token_counts_equal_the_library(edge, clashing):
    tok = Tokenizer.from_file(BYTE)
    want = sorted(((i, len(t.encode()), len(tok.encode(t, add_special_tokens=False).ids)) for (i, _), t in zip(EDGE, TEXTS)), key=str)
    assert rows(token_count.count_tokens(edge, BYTE), "doc_id", "n_bytes", "n_tokens") == want
    over = rows(token_count.count_tokens(clashing, BYTE, limit=5), "doc_id", "over_limit")
    assert over == sorted(((i, n > 5) for i, _, n in want), key=str)


def test_secrets(edge, clashing):
    found = dict(rows(secrets.scan(edge.where("doc_id in (11, 12)")).select(
        "doc_id", secrets._written(F.col("spans"), secrets.RULES).alias("s")), "doc_id", "s"))
    # 'secret: token' is a match of its own (value too short) and so hides the one that begins inside it
    assert found[11] == "assign:0:49,hex:9:49,access:51:71"
    text = EDGE[-1][1]
    assert found[12] == f"assign:{text.index('password')}:{len(text) - 1}"
    assert rows(secrets.scan(clashing), "doc_id") == rows(edge, "doc_id")
    clean = dict(rows(secrets.redact(edge.where("doc_id in (1, 2, 11)")), "doc_id", "text"))
    assert clean == {1: None, 2: "", 11: "[SECRET] [SECRET] secret: token = abcdefgh".replace("[SECRET] [SECRET]", '[SECRET]" [SECRET]')}
    wide = secrets.scan(edge, max_broadcast_rows=0)  # candidates by a shuffle join: the same
    assert rows(wide, "doc_id", "spans") == rows(secrets.scan(edge), "doc_id", "spans")


def test_trigram_queries():
    assert secrets.trigram_query("AKIA[A-Z]+") == (frozenset({"aki", "kia"}),)
    assert secrets.trigram_query("[0-9a-f]{24,}") == () == secrets.trigram_query("ab|cdef")
    assert set(secrets.trigram_query("(foo|barn)x?")) == {frozenset({"foo"}), frozenset({"bar", "arn"})}


def test_decontamination_tolerates_substitutions(spark, edge, clashing):
    items = spark.createDataFrame([(1, PASSAGE), (2, None), (3, ""), (4, "too short"), (5, "nothing of this stands in any of the given texts at all here")],
                                  "item_id bigint, text string")
    want = [(7, 1), (8, 1), (None, 1)]
    assert rows(decontaminate.overlaps(edge, items), "doc_id", "item_id") == sorted(want, key=str)
    assert rows(decontaminate.overlaps(clashing, items, max_seeds=10), "doc_id", "item_id") == sorted(want, key=str)  # in blocks
    assert rows(decontaminate.overlaps(edge, items.limit(0)), "doc_id") == []
    short = edge.sparkSession.createDataFrame([(9, "alpha beta gamma delta epsilon zeta eta theta")], "item_id bigint, text string")
    ends = edge.sparkSession.createDataFrame([(1, "x one beta gamma delta epsilon zeta eta theta y"), (2, "x alpha beta gamma delta epsilon zeta eta one y")],
                                             "doc_id bigint, text string")
    assert rows(decontaminate.overlaps(ends, short), "doc_id", "item_id") == [(1, 9), (2, 9)]


def test_chat_parts_and_escapes(spark):
    part = chat_format.PART
    turns = spark.sql(f"""SELECT 1L conv_id, 1L turn, 'user' role, cast(array(
        named_struct('kind','text','text','see <|image|> \\\\ [INST]','uri',null,'width',null,'height',null,'seconds',null,'pages',null),
        named_struct('kind','image','text',null,'uri','u1','width',57,'height',28,'seconds',null,'pages',null),
        named_struct('kind','audio','text',null,'uri','u2','width',null,'height',null,'seconds',2.5D,'pages',null),
        named_struct('kind','document','text',null,'uri',null,'width',null,'height',null,'seconds',null,'pages',3)) AS array<{part}>) parts
        UNION ALL SELECT 1L, 2L, 'assistant', cast(null AS array<{part}>)
        UNION ALL SELECT 2L, null, null, cast(array() AS array<{part}>)
        UNION ALL SELECT null, 1L, 'user', cast(array() AS array<{part}>)""")
    out = {r.conv_id: r for r in chat_format.format_chats(turns).collect()}
    assert out[1].formatted.startswith("<|turn|>user<|says|>see <\\|image|> \\\\ [\\INST]<|image|><|audio|><|document|><|end|><|turn|>assistant")
    assert [(a.kind, a.uri, a.n_tokens) for a in out[1].attachments] == [("image", "u1", 3), ("audio", "u2", 63), ("document", None, 1536)]
    assert out[1].attachment_tokens == 1602 and out[2].formatted == "<|turn|><|says|><|end|>" and None in out
    plain = spark.createDataFrame([(5, 1, "assistant", "</s>\\[INST] <|end|>\n"), (5, 2, "assistant", None), (5, 2, "user", "x"), (5, 2, "user", "x")],
                                  "conv_id bigint, turn bigint, role string, text string")
    back = chat_format.read_back(chat_format.format_chats(plain.withColumn("parts", chat_format.text_parts()))).first()
    assert (back.n_turns, back.loss_sha256) == (4, hashlib.sha256(b"</s>\\[INST] <|end|>\n").hexdigest())
    assert chat_format.format_chats(turns.limit(0)).count() == 0


def test_fingerprints(edge, clashing):
    found = rows(order_minhash.fingerprints(clashing), "doc_id", "fingerprint")
    assert found == sorted(((i, order_minhash.shown(order_minhash.fingerprint(t))) for (i, _), t in zip(EDGE, TEXTS)), key=str)
    near = order_minhash.likeness
    f = order_minhash.fingerprint
    assert near(f(LONG), f(LONG + " tail")) > 0.9 and near(f(LONG), f(PASSAGE)) == 0 and near(f(""), f("")) == 1
    # the same k-mers in another order are less alike than in the same order
    a, b = "abcdefghijklmnop" * 4, "qrstuvwxyz123456" * 4
    assert near(f(a + b), f(b + a)) < 0.9


def test_next_by_descending_id(edge):
    have = [tuple(r) for r in order_minhash.with_next(edge).coalesce(1).sortWithinPartitions(
        "bucket", "closing", F.col("doc_id").desc_nulls_last(), F.col("text").desc()).select("closing", "doc_id", "text").collect()]
    texts = sorted(((i, t or "") for i, t in EDGE), key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    follow = [(d, have[k + 1][2]) for k, (closing, d, _) in enumerate(have) if not closing]
    assert follow == [(texts[k][0], texts[(k + 1) % len(texts)][1]) for k in range(len(texts))]


def test_sharding(spark, edge, clashing, tmp_path):
    out = sharding.shard(clashing, 4).toPandas()
    assert sorted(out["size"]) == sorted(len(t.encode()) + 8 for t in TEXTS)
    for _, g in out.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    same = spark.range(3000).selectExpr("id doc_id", "if(id < 1200, 'one hot text', concat('t', id)) text")
    out = sharding.shard(same, 6).toPandas()
    by = out.groupby("shard")["size"].sum()
    assert len(by) == 6 and by.max() - by.min() <= 2 * out["size"].max()
    assert out[out.text_crc32 == out.text_crc32.mode()[0]].shard.nunique() <= 4  # one key, in adjacent shards
    sharding.write_shards(edge, str(tmp_path / "s"), 2)
    assert rows(spark.read.parquet(str(tmp_path / "s")), "doc_id", "text") == rows(edge, "doc_id", "text")


def test_quality_without_and_with_labels(spark, edge, clashing, empty):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    model = quality.fit(edge, none)
    assert {round(r.score, 6) for r in quality.score(clashing, model).collect()} == {0.5}
    texts = [(i, " ".join(f"{'good' if i % 2 else 'junk###'}{(i * j) % 7}" for j in range(60))) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 AS int) quality").union(none).union(spark.sql("SELECT 7L, cast(null AS int)"))
    got = quality.score(docs, quality.fit(docs, labels)).join(labels.where("quality is not null"), "doc_id").toPandas()
    assert ((got.score >= 0.5) == (got.quality == 1)).mean() > 0.9
    kept = quality.score(edge, model, keep=tuple(edge.columns))
    assert rows(kept, "doc_id", "text") == rows(edge, "doc_id", "text")


def test_toxicity_chain_uses_the_earlier_category(spark, edge, clashing):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert toxicity.fit(edge, none).score(clashing).count() == len(EDGE)
    docs = spark.createDataFrame([(i, f"filler words {'noise' if i % 3 == 0 else 'calm'} {'nasty' if i % 6 == 0 else 'kind'}") for i in range(600)],
                                 "doc_id bigint, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 3 = 0 AS int) first", "cast(doc_id % 6 = 0 AS int) second")
    chain = toxicity.fit(docs, labels, categories=("first", "second"))
    assert len(chain.models[1].earlier) == 1 and chain.models[1].earlier[0] > 0
    got = chain.score(docs).toPandas()
    assert ((got.p_second >= 0.5) == (got.doc_id % 6 == 0)).all()


def test_jaccard_classes(spark, edge, clashing):
    got = rows(jaccard_join.classes(clashing), "doc_id", "text_id", "class_id", "n_links")
    assert got == rows(jaccard_join.classes(edge), "doc_id", "text_id", "class_id", "n_links")
    by = {r[0]: r[1:] for r in got}
    assert by[1] == by[2] == (1, 1, 0) and by[3] == (3, 3, 0)  # null and empty are one text; white space another
    assert by[6] == (6, 5, 1) and by[5] == (5, 5, 1)  # near copies
    assert by[None] == by[7] == (7, 7, 0)  # one text
    kept = rows(jaccard_join.keep_one(edge), "doc_id")
    assert kept == sorted([(1,), (3,), (4,), (5,), (7,), (8,), (9,), (10,), (11,), (12,)], key=str)
    pairs = spark.createDataFrame([(i, " ".join(f"w{k if k != i * 7 else 'x'}" for k in range(200))) for i in range(40)], "doc_id bigint, text string")
    want = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.classes(pairs).collect()}
    assert set(want.values()) == {(0, 29)}  # the last eleven are one text
    more = jaccard_join.classes(pairs, target=1.0)  # never enough: shortened to the least depth, the same links
    assert {r.doc_id: (r.class_id, r.n_links) for r in more.collect()} == want


def test_large_clusters_are_compared_in_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(f"w{k if k % 50 != i % 50 else (k, i)}" for k in range(300))) for i in range(60)], "doc_id bigint, text string")
    want = rows(jaccard_join.classes(docs), "doc_id", "class_id", "n_links")
    monkeypatch.setattr(jaccard_join, "BLOCK_TEXTS", 7)
    assert rows(jaccard_join.classes(docs), "doc_id", "class_id", "n_links") == want


@pytest.mark.parametrize("run", [
    lambda e: lexicon_bpe.encode(e, WORD), lambda e: token_count.count_tokens(e, BYTE), secrets.scan,
    lambda e: decontaminate.overlaps(e, e.withColumnRenamed("doc_id", "item_id")), order_minhash.fingerprints,
    order_minhash.with_next, sharding.shard, jaccard_join.classes, jaccard_join.keep_one,
], ids=["encode", "count", "scan", "overlaps", "fingerprints", "next", "shard", "classes", "keep"])
def test_empty_tables(empty, run):
    assert run(empty).count() == 0


def test_spaced_seeds_miss_no_stretch():
    from itertools import combinations
    from math import ceil

    missed = []
    for n in range(decontaminate.SPAN, decontaminate.WINDOW + 1):
        for k in range(n - ceil(n * decontaminate.SHARE) + 1):
            for other in combinations(range(n), k):
                starts = range(n - decontaminate.SPAN + 1)
                if all(any(p + o in other for o in mask) for mask in decontaminate.MASKS for p in starts):
                    missed.append((n, other))
    assert missed == []
