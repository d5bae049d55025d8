"""From raw documents to token ids: quality, near duplicates, benchmark leaks, secrets, encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the
columns of ``docs``. ``run`` writes every stage's rows as Parquet below the session's checkpoint folder and
reads them again, so a lost executor costs one stage at most. An empty table passes through every stage. Columns beyond
those of ``documents`` are carried by all stages but the last, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm import decontaminate, jaccard_join, lexicon_bpe, quality, secrets
from visitlens.llm.common import cut, number_of, numbered, small
from visitlens.session import checkpoint_dir
from visitlens.sources.tables import read_table, table_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. Every row is judged by its own text: null and empty texts have a
    score too, repeated rows stay or go together, ties and ids play no part in it."""
    model = quality.fit(docs, spark.read.parquet(table_path(sf_dir, "labels")))
    held = numbered(docs)
    kept = quality.score(held, model, keep=tuple(held.columns), text=number_of(docs, "text"))
    return kept.where(F.col("score") >= quality.THRESHOLD).select(*held.columns).toDF(*docs.columns)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates. Null and empty texts are one class; of repeated rows and of rows
    without an id one stays."""
    return jaccard_join.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage. The decision is by text, so ids may repeat or be null."""
    items = spark.read.parquet(table_path(sf_dir, "benchmark"))
    held, text = numbered(docs), number_of(docs, "text")
    items = items.select("item_id", F.col("text").alias(text))
    marked = held.withColumn("key", jaccard_join.node(text))
    leaks = cut(decontaminate.overlaps(marked, items, doc="key", text=text).select(F.col("doc_id").alias("key")).distinct())
    return marked.join(small(leaks, leaks.count()), "key", "left_anti").select(*held.columns).toDF(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret replaced by a mark, ``n_chars`` counted anew (null for a null text)."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*[f"`{c}`" for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every remaining text."""
    import public_tokenizers

    return lexicon_bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_distinct),
    ("benchmark decontamination", drop_leaks),
    ("secret scans", redact_secrets),
    ("BPE encoding", encode),
]

# Compression and merges are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    base = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
