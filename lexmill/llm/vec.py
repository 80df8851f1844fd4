"""Vectorised words: whole Arrow batches of text become numpy arrays of word hashes.

A word is a maximal run of letters and digits of the lower-cased text.  Work is
done in blocks of about ``BLOCK_CHARS`` code points and at most ``BLOCK_DOCS``
texts, so memory doesn't depend on the batch; a longer text is a block by itself.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

BLOCK_CHARS = 1_000_000
BLOCK_DOCS = 1000
U64 = np.uint64
_P = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_P_INV = pow(_P, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers with well spread bits (the finaliser of SplitMix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@functools.cache
def alnum_table() -> np.ndarray:
    return np.fromiter((chr(i).isalnum() for i in range(0x110000)), dtype=bool, count=0x110000)


@functools.cache
def char_table() -> np.ndarray:
    return mix(np.arange(1, 0x110001, dtype=U64) * U64(0xD1342543DE82EF95))


_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_P, _P_INV)):
            step = np.full(max(n, BLOCK_CHARS + 1), base, U64)
            step[0] = 1
            _powers[k] = np.cumprod(step, dtype=U64)
    return _powers[0][:n], _powers[1][:n]


@dataclass
class Words:
    """The words of a block of texts; arrays have one entry per word, ``first`` one per text and one more."""

    cp: np.ndarray  # code points of the lower-cased block; texts are parted by NUL
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def blocks(texts: list[str], chars: int = BLOCK_CHARS, docs: int = BLOCK_DOCS) -> Iterator[tuple[int, int]]:
    """Ranges of texts, each a block."""
    lo, total = 0, 0
    for i, t in enumerate(texts):
        if i > lo and (total + len(t) > chars or i - lo >= docs):
            yield lo, i
            lo, total = i, 0
        total += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def code_points(texts: list[str]) -> np.ndarray:
    """Code points of the lower-cased texts, each text ended by NUL."""
    if any("\0" in t for t in texts):
        texts = [t.replace("\0", " ") for t in texts]
    joined = "\0".join(texts).lower() + "\0"
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def words(texts: list[str]) -> Words:
    cp = code_points(texts)
    is_word = alnum_table()[cp]
    edge = np.flatnonzero(np.diff(is_word.view(np.int8), prepend=np.int8(0)))
    start, end = edge[::2], edge[1::2]  # the last code point is NUL, so every word has an end
    pw, inv = powers(len(cp) + 1)
    total = np.zeros(len(cp) + 1, U64)
    np.cumsum(char_table()[cp] * pw[: len(cp)], out=total[1:])
    ids = mix((total[end] - total[start]) * inv[start] + (end - start).astype(U64))
    ends = np.flatnonzero(cp == 0)
    first = np.zeros(len(texts) + 1, np.int64)
    first[1:] = np.searchsorted(start, ends)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(cp, start, end, doc, ids, first)


def shingles(w: Words, k: int, bits: int = 48) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of k words per text: (text, hash of ``bits`` bits), ordered by text and hash."""
    n = len(w.hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    h = w.hash[:n].copy()
    for j in range(1, k):
        h *= U64(_P)
        h += w.hash[j : n + j]
    h = mix(h) >> U64(64 - bits)
    keep = w.doc[:n] == w.doc[k - 1 :]
    key = (w.doc[:n][keep].astype(U64) << U64(bits)) | h[keep]
    key.sort()
    if len(key):
        key = key[np.concatenate(([True], key[1:] != key[:-1]))]
    return (key >> U64(bits)).astype(np.int64), key & U64((1 << bits) - 1)
