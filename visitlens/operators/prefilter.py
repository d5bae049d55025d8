"""Bloom filter of session ids as a small table, applied to the actions before they are shuffled.

A word is 64 bits; a session id picks one word and ``BITS`` bits in it. The filter is the table of the words that any
id touched: an ordinary aggregate (``bit_or``) with at most ``words`` rows, so it can be broadcast, and the test is a
broadcast semi join on the word number with the bits as its condition. All of it is generated code.

A row that fails the test belongs to no session of the filter. A row that passes may still belong to none, so the exact
join stays; it only gets fewer rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.plans.physical import MAX_BROADCAST_ROWS, broadcast_if_bounded

BITS = 4
MAX_WORDS = 1 << 19  # rows of the filter at most; below MAX_BROADCAST_ROWS
IDS_PER_WORD = 4  # ids for each word that ``words_for`` aims at: about 3 % of foreign rows pass


def words_for(ids: int) -> int | None:
    """A power of two of words for ``ids`` ids; None where so many would not fit ``MAX_WORDS`` and the filter would
    let most rows pass."""
    need = max(1, -(-ids // IDS_PER_WORD))
    words = 1 << (need - 1).bit_length()
    return words if words <= MAX_WORDS else MAX_WORDS if need <= 4 * MAX_WORDS else None


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words).cast("bigint"))


def _mask(key: Column) -> Column:
    """``BITS`` bits of a word, from a second hash of the id."""
    spread = F.xxhash64(key, F.lit(1))
    out = None
    for k in range(BITS):
        place = F.shiftrightunsigned(spread, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
        out = bit if out is None else out.bitwiseOR(bit)
    return out


def bloom_words(ids: DataFrame, words: int = MAX_WORDS, key: str = "session_id") -> DataFrame:
    """The filter of all ids: (word, bits), only words that an id touched, at most ``words`` rows.

    Null ids are in no filter. Partial aggregation keeps each map task's output within ``words`` rows.
    """
    if not 0 < words <= MAX_BROADCAST_ROWS:
        raise ValueError(f"words must lie between 1 and {MAX_BROADCAST_ROWS}")
    held = ids.where(F.col(key).isNotNull()).select(_word(F.col(key), words).alias("word"), _mask(F.col(key)).alias("bits"))
    return held.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def might_contain(rows: DataFrame, bloom: DataFrame, words: int = MAX_WORDS, key: str = "session_id") -> DataFrame:
    """Rows whose ``key`` may be in the filter made with the same number of ``words``.

    A semi join, so no column is added; Catalyst does not move the exact semi join that follows below it.
    """
    bloom = broadcast_if_bounded(bloom.select(F.col("word").alias("__word"), F.col("bits").alias("__bits")), words)
    mask = _mask(rows[key])
    return rows.join(bloom, (_word(rows[key], words) == F.col("__word")) & (F.col("__bits").bitwiseAND(mask) == mask), "left_semi")
