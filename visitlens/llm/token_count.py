"""Token counts without identifiers: initial symbols minus merges.

Each distinct word is merged on a heap and a linked list (lowest-rank adjacent pair first), once as long as
a worker remembers it;
its count is its number of bytes minus the number of merges, and a text's count is the sum over its words
plus one for every special string. Texts are worked in chunks of about 2 MB, a longer text by itself.

Defined cases: a null or empty text has 0 bytes and 0 tokens; rows are independent, so repeated rows repeat
their counts; a null id stays null; an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import body, ship_package
from visitlens.llm.merges import Merges, load
from visitlens.llm.pretoken import chunks
from visitlens.sources.tables import read_table


REMEMBERED = 300_000


class Counts(dict):
    """Token count of a word; remembers the words of about the last chunks, within a fixed size."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges, self.older = merges, {}

    def __missing__(self, word: bytes) -> int:
        n = self.older.get(word)
        if n is None:
            n = len(word) - self.merges.run(self.merges.symbols(word))
        if len(word) <= 64:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[word] = n
        return n


@lru_cache(maxsize=2)
def _counts(path: str) -> Counts:
    return Counts(load(path, True)[0])


def count_chunk(path: str, texts: list[str]) -> np.ndarray:
    _, splitter = load(path, True)
    words, codes, per_text = splitter.split(texts)
    counts = np.fromiter(map(_counts(path).__getitem__, words.to_pylist()), np.int64, len(words))
    each = np.ones(len(codes), np.int64)  # a special string is one token
    known = codes >= 0
    each[known] = counts[codes[known]]
    total = np.concatenate(([0], np.cumsum(each)))
    ends = np.concatenate(([0], np.cumsum(per_text)))
    return total[ends[1:]] - total[ends[:-1]]


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(doc).alias("doc_id"), body(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [count_chunk(path, texts) for _, _, texts in chunks(batch.column("text"))]
            n = np.concatenate(n) if n else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.binary_length(batch.column("text")).cast(pa.int64()), pa.array(n, pa.int64()),
                 pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(work, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")


def op7_token_count(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Token counts of all documents in the byte-level vocabulary."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return count_tokens(read_table(spark, sf_dir, "documents"), path)
