"""Toxicity by a classifier chain of linear models.

The categories are predicted one after the other. Each is a logistic regression on the presence of selected
words, and from the second on the probabilities of the earlier categories are inputs too. While training,
those inputs are out-of-fold predictions: for a row of fold k they come from a model whose words were selected
and whose weights were fitted without fold k, so a later model learns from probabilities as uncertain as those
it will get.

The fit reads at most ``FIT_DOCS`` labelled documents, chosen by hash order, so their ids can be broadcast and
no text of the others is shuffled. Spark counts their words; for each category and fold the ``WORDS`` words that
differ most (in standard errors) between the labels are selected, and weights are fitted on their presence.
Every whole text is scored, in JVM expressions.

Defined cases: a null or empty text has no words and is scored from the offsets alone; repeated labels of a
document count by their maximum; rows with a null label in any category are not learnt from; a category with
one label only (or none) is predicted at its smoothed share; rows are independent; a null id stays null; empty
tables give no rows; further columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import body, cut
from visitlens.sources.tables import read_table, table_path

CATEGORIES = ("quality", "toxic")
FIT_DOCS = 20_000
FOLDS = 3
WORDS = 256
LEAST_DOCS = 5  # a word seen in fewer labelled documents is not selected
PENALTY = 1.0
THRESHOLD = 0.2  # labels miss some toxic texts, and toxic texts are few


@dataclass(frozen=True)
class Linear:
    """Offset, weight of each word, weights of the earlier categories' probabilities."""

    offset: float
    words: dict[str, float]
    earlier: tuple[float, ...]

    def summed(self, seen: str, names: list[str]) -> Column:
        """Offset and the weights of the words at the ordinals in ``seen``."""
        weights = F.array(*[F.lit(self.words.get(w, 0.0)) for w in names]).cast("array<double>")
        return F.aggregate(seen, F.lit(self.offset), lambda s, k: s + F.get(weights, k))


@dataclass(frozen=True)
class Chain:
    categories: tuple[str, ...]
    models: tuple[Linear, ...]

    def score(self, docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
        """``keep`` columns and ``p_<category>`` for every whole text."""
        names = sorted(set().union(*(m.words for m in self.models)))
        df = docs.select(*keep, present(names, text).alias("_seen"))
        for i, (category, model) in enumerate(zip(self.categories, self.models, strict=True)):
            logit = model.summed("_seen", names)
            for c, weight in zip(self.categories[:i], model.earlier, strict=True):
                logit = logit + F.col(f"p_{c}") * F.lit(weight)
            df = df.withColumn(f"p_{category}", F.lit(1.0) / (F.lit(1.0) + F.exp(-logit)))
        return df.drop("_seen")


def words_of(text: str = "text") -> Column:
    return F.array_distinct(F.array_remove(F.split(F.lower(body(text)), r"[^\p{L}]+"), ""))


def present(names: list[str], text: str = "text") -> Column:
    """Ordinals in ``names`` of the words that a text holds, ascending."""
    if not names:
        return F.array().cast("array<int>")
    listed = F.array(*[F.lit(w) for w in names])
    return F.array_sort(F.transform(F.array_intersect(words_of(text), listed),
                                    lambda w: (F.array_position(listed, w) - 1).cast("int")))


def select_words(known: DataFrame, categories: tuple[str, ...]) -> dict[tuple[str, int], list[str]]:
    """For each category and left-out fold (FOLDS: none) the words that tell its labels apart best."""
    n_of = lambda c, y, k: F.sum(((F.col(c) == y) & (F.col("fold") != k)).cast("long"))
    cells = [(c, y, k) for c in categories for y in (0, 1) for k in range(FOLDS + 1)]
    totals = known.agg(*[n_of(*x).alias(f"{x[0]}_{x[1]}_{x[2]}") for x in cells]).first()
    seen = known.select("fold", *categories, F.explode(words_of()).alias("word"))
    counts = cut(seen.groupBy("word").agg(F.count(F.lit(1)).alias("n"), *[n_of(*x).alias(f"{x[0]}_{x[1]}_{x[2]}") for x in cells])
                 .where(F.col("n") >= LEAST_DOCS))
    out = {}
    for c in categories:
        for k in range(FOLDS + 1):
            n0, n1 = (totals[f"{c}_{y}_{k}"] or 0 for y in (0, 1))
            if not n0 or not n1:
                out[c, k] = []
                continue
            a, b = F.col(f"{c}_1_{k}"), F.col(f"{c}_0_{k}")
            error = F.sqrt((a + b + 1) / F.lit(n0 + n1) * F.lit(1 / n0 + 1 / n1))
            z = F.abs(a / F.lit(n1) - b / F.lit(n0)) / error
            out[c, k] = [r[0] for r in counts.orderBy(F.desc(z), "word").limit(WORDS).select("word").collect()]
    return out


def train(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Offset and weights of a logistic regression with a quadratic penalty, by Newton steps."""
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return np.concatenate(([np.log(share / (1 - share))], np.zeros(x.shape[1])))
    x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    pull = np.full(x.shape[1], PENALTY)
    pull[0] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x.T * np.maximum(p * (1 - p), 1e-6)) @ x + np.diag(pull)
        step = np.linalg.solve(hess, x.T @ (p - y) + pull * w)
        w -= step / max(1.0, abs(step).max() / 4)
        if abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES, doc: str = "doc_id",
        text: str = "text") -> Chain:
    known = labels.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (doc, *categories)]))
    known = known.groupBy(F.col(doc).alias("id")).agg(*[F.max(c).alias(c) for c in categories])
    known = cut(known.orderBy(F.xxhash64("id", F.lit(43)), "id").limit(FIT_DOCS))
    rows = docs.select(F.col(doc).alias("id"), body(text).alias("text")).join(F.broadcast(known), "id")
    fold = F.pmod(F.xxhash64("id", F.lit(47)), F.lit(FOLDS)).alias("fold")
    chosen = select_words(rows.select("text", *categories, fold), categories)

    names = sorted(set().union(*map(set, chosen.values())))
    column = {w: k for k, w in enumerate(names)}
    sample = rows.select("id", fold, *categories, present(names).alias("seen"))
    sample = sample.orderBy("id").collect()
    x = np.zeros((len(sample), len(names)), np.float32)
    for i, r in enumerate(sample):
        x[i, r["seen"]] = 1
    folds = np.array([r["fold"] for r in sample], int)
    models: list[Linear] = []
    earlier = np.zeros((len(sample), 0))
    for i, c in enumerate(categories):
        y = np.array([r[c] for r in sample], float)

        def design(k: int, rows_: np.ndarray, c: str = c, earlier: np.ndarray = earlier) -> np.ndarray:
            return np.concatenate([x[rows_][:, [column[w] for w in chosen[c, k]]], earlier[rows_]], axis=1)

        every = np.ones(len(sample), bool)
        w = train(design(FOLDS, every), y)
        n = len(chosen[c, FOLDS])
        models.append(Linear(float(w[0]), dict(zip(chosen[c, FOLDS], map(float, w[1 : n + 1]), strict=True)),
                             tuple(map(float, w[n + 1 :]))))
        if i + 1 < len(categories):
            out = np.zeros(len(sample))
            for k in range(FOLDS):
                own = folds == k
                v = train(design(k, ~own), y[~own])
                out[own] = 1 / (1 + np.exp(-(v[0] + design(k, own) @ v[1:])))
            earlier = np.concatenate([earlier, out[:, None]], axis=1)
    return Chain(categories, tuple(models))


def op3_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the chain's probabilities; learnt outside the held-out fifth of the ids."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = spark.read.parquet(table_path(sf_dir, "labels"))
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    chain = fit(docs, labels.where(~held_out))
    return chain.score(docs).select("doc_id", held_out.alias("held_out"), *[f"p_{c}" for c in CATEGORIES],
                                    (F.col("p_toxic") >= THRESHOLD).cast("int").alias("toxic"))
