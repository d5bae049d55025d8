"""Splitting whole texts into tokenizer words, vectorised over a chunk of documents.

The two word patterns of the public tokenizers are applied to the chunk's UTF-8 bytes at once: a table gives
each character's class (letter, number, space, other) and a word begins where the pattern would begin one.
That covers texts whose characters are below U+0180, where letter case and classes are the same for every
Unicode version; other texts go through the tokenizer's own normalizer and pre-tokenizer, one by one.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
CHUNK_BYTES = 2 << 20


def _classes() -> np.ndarray:
    out = np.full(0x180, OTHER, np.uint8)
    for c in range(0x180):
        kind = unicodedata.category(chr(c))[0]
        out[c] = LETTER if kind == "L" else NUMBER if kind == "N" else OTHER
    out[[9, 10, 11, 12, 13, 0x20, 0x85, 0xA0]] = SPACE
    return out


_CLASS = _classes()
_ODD = re.compile("[^\x00-\u012f\u0131-\u017f]")


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


SYMBOLS = byte_symbols()
_TO_BYTE = {s: b for b, s in enumerate(SYMBOLS)}


def to_bytes(word: str) -> bytes:
    return bytes(map(_TO_BYTE.__getitem__, word))


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, list[str]]]:
    """Runs [a, b) of a text column of about ``limit`` bytes, and their texts; a longer text is a run by itself."""
    sizes = pc.binary_length(column).to_pylist()
    a = size = 0
    for b, n in enumerate(sizes):
        if b > a and size + n > limit:
            yield a, b, column.slice(a, b - a).to_pylist()
            a, size = b, 0
        size += n
    if a < len(sizes):
        yield a, len(sizes), column.slice(a).to_pylist()


def plain(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")  # the quickest test that most texts pass
        return True
    except UnicodeEncodeError:
        return not _ODD.search(text)


def split_plain(texts: list[str], spaced: bool) -> tuple[pa.Array, np.ndarray]:
    """Words of plain texts as bytes, in order, and the number of words of each text.

    ``spaced``: a blank before a word belongs to it and other white space is kept (byte-level vocabulary);
    otherwise white space is dropped and each digit stands alone (word-end vocabulary, text in lower case).
    """
    data = [t.encode() for t in texts]
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    raw = np.frombuffer(b"".join(data), np.uint8)
    if not len(raw):
        return pa.array([], pa.binary()), np.zeros(len(texts), np.int64)
    at = np.flatnonzero((raw & 0xC0) != 0x80)  # first byte of each character
    char = raw[at].astype(np.uint16)
    two = np.flatnonzero(char >= 0x80)
    char[two] = ((char[two] & 0x1F) << 6) | (raw[at[two] + 1] & 0x3F)
    kind = _CLASS[char]
    first = np.zeros(len(at) + 1, bool)  # characters that begin a text, and the end
    ends = np.cumsum(sizes)
    first[np.searchsorted(at, np.concatenate(([0], ends)))] = True
    new = first[:-1].copy()
    new[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    if spaced:
        blank = np.zeros(len(at), bool)  # a blank stands right before, in the same text
        blank[1:] = (char[:-1] == 0x20) & ~first[1:-1]
        start = np.where(space, new, new & ~blank)
        last = np.zeros(len(at), bool)  # the last white space before a word begins a piece of its own
        last[:-1] = space[:-1] & ~space[1:] & ~first[1:-1]
        start |= last
    else:
        start = new | (kind == NUMBER)
    quote = np.flatnonzero((char == 0x27) & start)
    if len(quote):
        get = lambda i: np.where((i < len(at)) & ~first[np.minimum(i, len(at))], char[np.minimum(i, len(at) - 1)], 0)
        one, two = get(quote + 1), get(quote + 2)
        two = np.where(one == 0, 0, two)
        short = np.isin(one, [ord(c) for c in "stmd"])
        pair = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        for where, n in ((quote[short], 2), (quote[pair & ~short], 3)):
            for k in range(1, n):
                start[where + k] = False
            after = where + n
            after = after[after < len(at)]
            start[after] |= ~space[after] if not spaced else kind[after] == LETTER
    if not spaced:
        start &= ~space
    begin = np.flatnonzero(start)
    n_words = np.diff(np.searchsorted(at[begin], np.concatenate(([0], ends))))
    if spaced:
        offsets, kept = np.append(at[begin], len(raw)), raw
    else:
        keep = np.repeat(~space, np.diff(np.append(at, len(raw))))
        kept = raw[keep]
        offsets = np.append(np.concatenate(([0], np.cumsum(keep)))[at[begin]], len(kept))
    words = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(kept))])
    return words, n_words


class Splitter:
    """Words of a chunk of texts, special strings kept apart, for one public tokenizer file."""

    def __init__(self, path: str, spaced: bool):
        from tokenizers import Tokenizer

        self.tok, self.spaced = Tokenizer.from_file(path), spaced
        self.special = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self.marks = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))))

    def _pieces(self, text: str) -> list[str | int]:
        """The text with every special string replaced by its id (leftmost first, then longest)."""
        out: list[str | int] = []
        at = 0
        for mark in self.marks.finditer(text):
            out += [text[at:mark.start()], self.special[mark.group()]]
            at = mark.end()
        return [*out, text[at:]]

    def _slow(self, text: str) -> list[bytes]:
        if self.tok.normalizer is not None:
            text = self.tok.normalizer.normalize_str(text)
        return [to_bytes(w) for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(text)]

    def split(self, texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct words; the number of the word at each place (special strings: -1 - id); the number of
        places of each text."""
        pieces: list[str | int] = []
        owner = []
        for k, t in enumerate(texts):
            own = self._pieces(t) if any(s in t for s in self.special) else [t]
            pieces += own
            owner += [k] * len(own)
        flat = [p if isinstance(p, str) and plain(p) else "" for p in pieces]
        words, n = split_plain(flat if self.spaced else [p.lower() for p in flat], self.spaced)
        odd = {i: p for i, p in enumerate(pieces) if not isinstance(p, str) or not plain(p)}
        extra = {i: self._slow(p) for i, p in odd.items() if isinstance(p, str)}
        if extra:
            words = pa.concat_arrays([words, pa.array([w for ws in extra.values() for w in ws], pa.binary())])
        coded = words.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if odd:  # put what was split apart back in its place
            ends = np.cumsum(n)
            parts, done, spare = [], 0, int(n.sum())
            for i, p in odd.items():
                parts.append(codes[done:ends[i]])
                done = int(ends[i])
                if isinstance(p, int):
                    parts.append(np.array([-1 - p]))
                    n[i] = 1
                else:
                    k = len(extra[i])
                    parts.append(codes[spare:spare + k])
                    spare, n[i] = spare + k, k
            codes = np.concatenate([*parts, codes[done:int(ends[-1]) if len(ends) else 0]])
        per_text = np.bincount(np.array(owner, np.int64), weights=n, minlength=len(texts)).astype(np.int64)
        return coded.dictionary, codes, per_text
