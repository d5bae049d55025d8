"""Benchmark decontamination with spaced seeds (DataFrame functions only).

Words are runs of letters and digits, lower case. A mask names the offsets of a window that are hashed; the
others may differ, so a substitution under a gap keeps the hit. Seeds of the test items and of every document
position are joined on the hash; around each hit document and item are laid side by side and the hit counts
when some stretch of ``window`` item words (or the whole item, if shorter) agrees in at least ``share`` of
its words. That check also removes hash collisions. With the default window and share the masks miss no such
stretch of 8 to 13 words, wherever its substitutions stand (all placements counted in the tests).

The test side is split into blocks of at most ``max_seeds`` seeds (counted first) and each block is
broadcast, so documents are never shuffled; hits are verified in the row that found them and only
(document, item) sums are exchanged.

Items shorter than a mask (1 to 7 words) have no spaced seed: their seed is the hash of the whole item, joined with the
hashes of the documents' runs of just these lengths, and found where all words agree. Where no item is that short
(counted first) nothing is done for them.

Defined cases: null or empty texts have no words and no result; documents shorter than the stretch cannot hold it; repeated rows of one id add up;
equal items are reported each; a null doc_id is reported as null; an empty table on either side gives no
rows; further columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import body
from visitlens.sources.tables import read_table, table_path

MASKS = ((0, 1, 3, 6, 7), (0, 2, 3, 5, 7), (0, 1, 4, 5, 7), (1, 2, 3, 5, 6))
SPAN = 8
WINDOW = 13
SHARE = 0.8
MAX_SEEDS = 200_000


def words(text: str = "text") -> Column:
    return F.array_remove(F.split(F.lower(body(text)), r"[^\p{L}\p{N}]+"), "")


def seeds(df: DataFrame, keep: list[str]) -> DataFrame:
    """A row for each window and mask: ``keep``, pos, and the hash ``seed`` of the words under the mask."""
    at = df.select(*keep, "w", F.posexplode("w").alias("pos", "_word")).where(F.col("pos") + SPAN <= F.size("w"))
    hashes = [F.xxhash64(F.lit(k), *[F.get("w", F.col("pos") + o) for o in mask]) for k, mask in enumerate(MASKS)]
    return at.select(*keep, "w", "pos", F.explode(F.array(*hashes)).alias("seed"))


def short_overlaps(docs: DataFrame, test: DataFrame, lengths: list[int]) -> DataFrame:
    """(doc_id, item_id, pos, last) for each place where a document holds a whole item of one of ``lengths`` words."""
    run = lambda at, n: F.xxhash64(F.lit(-n), *[F.get("w", at + o) for o in range(n)])
    zero = F.lit(0)
    item = F.coalesce(*[F.when(F.size("w") == n, run(zero, n)) for n in lengths])
    keyed = test.where(F.size("w").isin(lengths)).select("item_id", F.col("w").alias("iw"), item.alias("seed"))
    at = docs.select("doc_id", "w", F.posexplode("w").alias("pos", "_word"))
    runs = F.array(*[F.when(F.col("pos") + n <= F.size("w"), run(F.col("pos"), n)) for n in lengths])
    hit = at.select("doc_id", "w", "pos", F.explode(runs).alias("seed")).join(F.broadcast(keyed), "seed")
    last = F.col("pos") + F.size("iw") - 1
    return hit.where(F.slice("w", F.col("pos") + 1, F.size("iw")) == F.col("iw")).select("doc_id", "item_id", "pos", last.alias("last"))


def overlaps(docs: DataFrame, items: DataFrame, doc: str = "doc_id", item: str = "item_id", text: str = "text",
             window: int = WINDOW, share: float = SHARE, max_seeds: int = MAX_SEEDS) -> DataFrame:
    """(doc_id, item_id, n_hits, first_word, last_word) for each document that holds a stretch of an item."""
    reach = window - 1
    test = items.select(F.col(item).alias("item_id"), words(text).alias("w"))
    size = F.size("w")
    n_seeds, *n_short = test.select(F.sum(F.greatest(size - SPAN + 1, F.lit(0)) * len(MASKS)),
                                    *[F.count_if(size == n) for n in range(1, SPAN)]).first()
    n_blocks = max(1, -(-int(n_seeds or 0) // max_seeds))
    lengths = [n for n in range(1, SPAN) if n_short[n - 1]]
    plain, text_words = test, docs.select(F.col(doc).alias("doc_id"), words(text).alias("w"))
    low = F.greatest(F.col("pos") - reach, F.lit(0))
    test = seeds(test, ["item_id"]).select(
        "item_id", "seed", F.least(F.size("w"), F.lit(window)).alias("need_n"), (F.col("pos") - low).alias("back"),
        F.slice("w", low + 1, F.col("pos") - low + SPAN + reach).alias("iw"))
    every = seeds(text_words, ["doc_id"])

    # Lay both sides along the same words: cut what one side lacks before and behind the hit.
    cut_front = F.greatest(F.col("back") - F.col("pos"), F.lit(0))
    side = F.slice("w", F.col("pos") - F.col("back") + cut_front + 1, F.size("iw") - cut_front)
    same = F.zip_with("side", F.slice("iw", F.col("cut") + 1, F.size("side")), lambda a, b: (a == b).cast("int"))
    need = F.ceil(F.col("need_n") * F.lit(share)).cast("int")
    agrees = F.exists(
        F.sequence(F.lit(1), F.size("same") - F.col("need_n") + 1),
        lambda s: F.aggregate(F.slice("same", s, F.col("need_n")), F.lit(0), lambda a, b: a + b) >= need)

    def block(b: int) -> DataFrame:
        part = test if n_blocks == 1 else test.where(F.pmod("seed", F.lit(n_blocks)) == b)
        hit = every.join(F.broadcast(part), "seed")
        laid = hit.select("doc_id", "item_id", "pos", "need_n", "iw", cut_front.alias("cut"), side.alias("side"))
        flags = laid.select("doc_id", "item_id", "pos", "need_n", same.alias("same"))
        ok = F.when(F.size("same") >= F.col("need_n"), agrees).otherwise(F.lit(False))
        place = F.when(ok, F.col("pos"))
        return flags.select("doc_id", "item_id", place.alias("pos"), (place + SPAN - 1).alias("last"))

    # The check is counted, not filtered on: as a filter it would move into the join's condition, where its
    # lambdas end code generation and every position is copied out with its document's words.
    parts = [block(b) for b in range(n_blocks)]
    if lengths:
        n_blocks_short = max(1, -(-sum(n_short) // max_seeds))
        of = F.pmod(F.xxhash64("item_id", "w"), F.lit(n_blocks_short))
        parts += [short_overlaps(text_words, plain.where(of == b), lengths) for b in range(n_blocks_short)]
    found = reduce(DataFrame.unionAll, parts)
    return found.groupBy("doc_id", "item_id").agg(
        F.count("pos").alias("n_hits"), F.min("pos").cast("long").alias("first_word"),
        F.max("last").cast("long").alias("last_word")).where("n_hits > 0")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) with a substitution-tolerant overlap."""
    items = spark.read.parquet(table_path(sf_dir, "benchmark")).select("item_id", "text")
    return overlaps(read_table(spark, sf_dir, "documents").select("doc_id", "text"), items)


def _sql_seeds(table: str, key: str) -> str:
    masks = ", ".join(f"'{k}' || " + " || ".join(f"' ' || w[p + {o + 1}]" for o in mask)
                      for k, mask in enumerate(((0, 1, 3, 6, 7), (0, 2, 3, 5, 7), (0, 1, 4, 5, 7), (1, 2, 3, 5, 6))))
    return f"SELECT {key}, p, w, unnest([{masks}]) AS seed FROM (SELECT {key}, w, unnest(range(0, len(w) - 7)) AS p FROM {table})"


ORACLE = f"""
WITH dw AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\pL\\pN]+'), lambda x: x <> '') AS w FROM documents),
iw AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\pL\\pN]+'), lambda x: x <> '') AS w FROM benchmark),
ds AS ({_sql_seeds("dw", "doc_id")}),
bs AS ({_sql_seeds("iw", "item_id")}),
h AS (
  SELECT doc_id, item_id, ds.p AS p, least(len(bs.w), 13) AS n,
    list_transform(range(greatest(-12, -bs.p, -ds.p), least(20, len(bs.w) - bs.p, len(ds.w) - ds.p)),
                   lambda o: (ds.w[ds.p + o + 1] = bs.w[bs.p + o + 1])::INT) AS f
  FROM ds JOIN bs USING (seed)),
lengths AS (SELECT DISTINCT len(w) AS n FROM iw WHERE len(w) BETWEEN 1 AND 7),
runs AS (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS p FROM dw JOIN lengths ON n <= len(w)),
found AS (
  SELECT doc_id, item_id, p, p + 7 AS last FROM h WHERE len(f) >= n AND len(list_filter(range(1, len(f) - n + 2),
    lambda s: list_sum(f[s:s + n - 1]) >= ceil(n * 0.8))) > 0
  UNION ALL
  SELECT doc_id, item_id, p, p + n - 1 FROM (SELECT doc_id, n, p, array_to_string(w[p + 1:p + n], ' ') AS t FROM runs) r
  JOIN (SELECT item_id, len(w) AS k, array_to_string(w, ' ') AS u FROM iw WHERE len(w) BETWEEN 1 AND 7) i ON i.u = r.t AND i.k = r.n)
SELECT doc_id, item_id, count(*)::BIGINT AS n_hits, min(p)::BIGINT AS first_word, max(last)::BIGINT AS last_word
FROM found GROUP BY doc_id, item_id
"""
