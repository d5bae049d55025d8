"""Byte-pair merges of a public tokenizer file: rank tables, and the heap over a linked list."""

from __future__ import annotations

import json
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np

from visitlens.llm.pretoken import SYMBOLS, Splitter

SHIFT = 17  # symbols are below 2**17, so a pair is one integer
NONE = np.int64(1 << 40)  # rank of a pair that never merges


class Merges:
    """Vocabulary and merge ranks. ``pairs``: left << SHIFT | right -> rank; ``made``: rank -> merged symbol;
    ``ids``: symbol -> id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        self.tokens = {i: t for t, i in vocab.items()}
        # Symbols while merging: a byte is its own value, every other token counts on from 256.
        own = {s: b for b, s in enumerate(SYMBOLS)}
        rest = (t for t in vocab if t not in own)
        number = own | {t: 256 + k for k, t in enumerate(rest)}
        self.ids = np.zeros(len(number), np.int64)
        for token, n in number.items():
            self.ids[n] = vocab.get(token, 0)
        self.pairs, self.made = {}, []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs.setdefault(number[a] << SHIFT | number[b], rank)
            self.made.append(number[a + b])
        self.final_list = [number[s + end] for s in SYMBOLS]
        self.final = np.array(self.final_list, np.int64)
        self._table()

    def _table(self) -> None:
        """The pairs as an open-addressed table that numpy looks up for many pairs at once."""
        bits = max(4, int(len(self.pairs) * 8).bit_length())
        self.drop = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NONE, np.int64)
        keys = np.fromiter(self.pairs, np.int64, len(self.pairs))
        ranks = np.fromiter(self.pairs.values(), np.int64, len(keys))
        self.probes, slot, left = 0, self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slot[left]] < 0
            put = left[free]
            _, one = np.unique(slot[put], return_index=True)
            put = put[one]
            self.keys[slot[put]], self.ranks[slot[put]] = keys[put], ranks[put]
            left = np.setdiff1d(left, put)
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)
            self.probes += 1
        self.made_ids = np.array(self.made, np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.drop).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << SHIFT | right
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.ranks[slot], NONE)
        open_ = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] >= 0))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            seen = self.keys[slot[open_]]
            hit = seen == keys[open_]
            out[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (seen >= 0)]
        return out

    def symbols(self, word: bytes) -> list[int]:
        out = list(word)
        if out:
            out[-1] = self.final_list[out[-1]]
        return out

    def run(self, sym: list[int]) -> int:
        """Merge ``sym`` in place, lowest rank first and leftmost among equals; returns the number of merges.

        The symbols are a doubly linked list; merged-away places hold -1. A heap entry is rank and place; it
        is stale when the pair at its place no longer has that rank.
        """
        n = len(sym)
        get, made = self.pairs.get, self.made
        heap = []
        for i in range(n - 1):
            r = get(sym[i] << SHIFT | sym[i + 1])
            if r is not None:
                heap.append(r << 32 | i)
        if not heap:
            return 0
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = 0
        while heap:
            entry = heappop(heap)
            i, r = entry & 0xFFFFFFFF, entry >> 32
            j = after[i]
            if sym[i] < 0 or j >= n or get(sym[i] << SHIFT | sym[j]) != r:
                continue
            merges += 1
            sym[i] = new = made[r]
            sym[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                r = get(new << SHIFT | sym[k])
                if r is not None:
                    heappush(heap, r << 32 | i)
            h = before[i]
            if h >= 0:
                r = get(sym[h] << SHIFT | new)
                if r is not None:
                    heappush(heap, r << 32 | h)
        return merges


@lru_cache(maxsize=4)
def load(path: str, spaced: bool) -> tuple[Merges, Splitter]:
    """Tables of one tokenizer file, read once in each Python worker."""
    return Merges(path), Splitter(path, spaced)
