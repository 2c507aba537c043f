"""Words of many texts at once, as positions and 64-bit hashes, with numpy.

An Arrow array keeps its texts in one byte buffer.  Word borders are found on that
buffer by a table of byte classes, and a word's hash is a difference of running sums
of ``value(byte) * BASE**position``, so no Python object is made per word but a very long one.  Texts are
taken in slices of about a megabyte; memory follows the slice, or the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Letters, digits and everything outside ASCII.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True
#: Everything but white space.
GRAPHIC = np.ones(256, bool)
GRAPHIC[[32, *range(9, 14)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit changes about half of the output bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64))


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            have = np.cumprod(np.r_[U(1), np.full(max(n, SLICE_BYTES + 1024), U(base))], dtype=np.uint64)
        _powers[base] = have
    return have[:n]


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the offsets of its texts; null is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    wide = pa.types.is_large_string(array.type)
    if len(array) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, budget: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``budget`` bytes, or of one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + budget, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


class Words(NamedTuple):
    hash: np.ndarray      # uint64 of each word
    first: np.ndarray     # index of the first word of each text, and the end
    start: np.ndarray     # byte borders within the slice
    end: np.ndarray
    text: np.ndarray      # the lower-cased bytes of the slice

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def span_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span of ``values`` (one uint64 per place)."""
    n = len(values)
    with np.errstate(over="ignore"):
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values * powers(_BASE, n), out=sums[1:])
        return mix((sums[end] - sums[start]) * powers(_BASE_INVERSE, n + 1)[start] + (end - start).astype(np.uint64))


#: Words of more bytes are hashed by a digest: sums of powers modulo 2**64 tell no two words of some patterns of 1,024 signs apart.
LONG_BYTES = 256


def word_hash(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word of ``text`` (bytes)."""
    found = span_hash(BYTE_VALUE[text], start, end)
    for i in np.flatnonzero(end - start > LONG_BYTES):
        digest = hashlib.blake2b(text[start[i] : end[i]].tobytes(), digest_size=8).digest()
        found[i] = int.from_bytes(digest, "little")
    return found


def borders(raw: np.ndarray, offsets: np.ndarray, kind: np.ndarray = WORD):
    """(lower-cased bytes, start and end of each word, first word of each text and the end)."""
    text = LOWER[raw]
    inside = np.zeros(len(text) + 1, bool)
    inside[:-1] = kind[text]
    before = np.r_[False, inside[:-1]]
    before[offsets[:-1]] = False
    start = np.flatnonzero(inside & ~before)
    stop = inside[1:].copy()
    cut = offsets[1:] - 1
    stop[cut[cut >= 0]] = False
    end = np.flatnonzero(inside[:-1] & ~stop) + 1
    return text, start, end, np.searchsorted(start, offsets)


def strings(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The spans of ``text`` as strings."""
    length = end - start
    to = np.r_[0, np.cumsum(length)]
    at = np.arange(to[-1]) + np.repeat(start - to[:-1], length)
    return pa.LargeStringArray.from_buffers(len(length), pa.py_buffer(to.astype(np.int64)), pa.py_buffer(text[at]))


def find(raw: np.ndarray, offsets: np.ndarray, kind: np.ndarray = WORD) -> Words:
    """Words of the texts in ``raw`` whose borders are ``offsets``; A-Z are lower-cased."""
    text, start, end, first = borders(raw, offsets, kind)
    return Words(word_hash(text, start, end), first, start, end, text)


def each_slice(array: pa.Array, kind: np.ndarray = WORD, budget: int = SLICE_BYTES):
    """(first text, end text, Words) of each slice of a string array."""
    raw, offsets = text_bytes(array)
    for i, j in slices(offsets, budget):
        yield i, j, find(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], kind)


def grams(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words that lie in one text, and where each begins."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    at = np.arange(n)
    left = np.repeat(first[1:], np.diff(first))[:n]
    at = at[at + k <= left]
    return span_hash(hashes, at, at + k), at


def count_within(first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Borders, per text, of the ascending word places ``at``."""
    return np.searchsorted(at, first)
