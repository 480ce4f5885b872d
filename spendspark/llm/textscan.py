"""Vectorised scanning of text columns inside tasks.

An Arrow text column is one byte buffer with offsets. Everything here works on that buffer with
NumPy: no Python object per word, and memory in proportion to one slice of a batch. Hashes have
64 bits; equal words or shingles have equal hashes, and two different ones agree with a chance
of about 5e-20, for ``hashes`` unless they are made to (polynomials modulo 2**64 have such words).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Tasks get these helpers by value and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of text that are scanned at once; a longer document is a slice of its own.
SLICE_BYTES = 1 << 20
# Bytes that are hashed at once.
PIECE_BYTES = 1 << 18

_MULTIPLIER = 0x9E3779B97F4A7C15
_WORD_PRIME = 0x100000001B3


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit numbers by rule."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_MULTIPLIER) + np.uint64(seed)) | np.uint64(1)


def byte_table(chars: str) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chars.encode())] = True
    return table


# The six characters that separate words, and the byte classes.
SPACES = " \t\n\x0b\x0c\r"
IS_SPACE = byte_table(SPACES)
IS_BREAK = byte_table("\n")
IS_UPPER = byte_table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
IS_LOWER = byte_table("abcdefghijklmnopqrstuvwxyz")
IS_DIGIT = byte_table("0123456789")
IS_HIGH = np.arange(256) >= 128
IS_LETTER = IS_UPPER | IS_LOWER | IS_HIGH
IS_CONTINUATION = (np.arange(256) & 0xC0) == 0x80

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BYTE_VALUES = constants(256, 11)
_FOLDED_VALUES = _BYTE_VALUES[_FOLD]
_SHINGLE_FACTORS = constants(16, 23)
# Places of a byte in a run that have numbers of their own; further ones are mixed with their block.
PLACES_APART = 32
_PLACED_VALUES = constants(256 * PLACES_APART, 37).reshape(PLACES_APART, 256)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the word prime and of its inverse modulo 2**64, made when first needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n, PIECE_BYTES)
            self.up = _powers(_WORD_PRIME, size)
            self.down = _powers(pow(_WORD_PRIME, -1, 1 << 64), size)
        return self.up, self.down


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offset of each row; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, or of one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


class Runs:
    """Maximal runs of bytes outside ``separator``, none crossing a document's edge."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
        n = len(data)
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        word = inside[data]
        before = np.empty(n, dtype=bool)
        before[:1] = False
        before[1:] = word[:-1]
        self.start = np.flatnonzero(word & (edge[:n] | ~before))
        after = np.empty(n, dtype=bool)
        after[-1:] = False
        after[:-1] = word[1:]
        self.end = np.flatnonzero(word & (edge[1:] | ~after)) + 1
        self.data, self.docs = data, len(offsets) - 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.docs), self.count)

    def hashes(self, fold: bool = True) -> np.ndarray:
        """A hash of each run's bytes; ``fold`` lower-cases A-Z first."""
        values = _FOLDED_VALUES if fold else _BYTE_VALUES
        out, lo, powers = np.empty(len(self.start), dtype=np.uint64), 0, _POWERS
        while lo < len(out):
            begin = self.start[lo]
            hi = max(lo + 1, int(np.searchsorted(self.start, begin + PIECE_BYTES)))
            length = int(self.end[hi - 1] - begin)
            up, down = powers.upto(length)
            sums = np.zeros(length + 1, dtype=np.uint64)
            np.cumsum(values[self.data[begin : begin + length]] * up[:length], out=sums[1:])
            s, e = self.start[lo:hi] - begin, self.end[lo:hi] - begin
            out[lo:hi] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(_MULTIPLIER)
            lo = hi
        return mix(out)

    def strong_hashes(self) -> np.ndarray:
        """A hash of each run's bytes, A-Z lower-cased, in which every byte counts by its place.

        Each byte adds a random number for itself and its place in the run; no power of a base is involved,
        so there are no words made to agree, as there are for polynomials modulo 2**64.
        """
        out, lo = np.empty(len(self.start), dtype=np.uint64), 0
        while lo < len(out):
            hi = max(lo + 1, int(np.searchsorted(self.start, self.start[lo] + PIECE_BYTES)))
            start, size = self.start[lo:hi], self.end[lo:hi] - self.start[lo:hi]
            first = np.cumsum(size) - size
            place = np.arange(first[-1] + size[-1]) - np.repeat(first, size)
            numbers = _PLACED_VALUES[place % PLACES_APART, _FOLD[self.data[np.repeat(start, size) + place]]]
            # Only bytes of further blocks: a word's hash must not follow from the words it is hashed with.
            if len(far := np.flatnonzero(place >= PLACES_APART)):
                numbers[far] = mix(numbers[far] + (place[far] // PLACES_APART).astype(np.uint64) * np.uint64(_MULTIPLIER))
            out[lo:hi] = np.add.reduceat(numbers, first) + size.astype(np.uint64) * np.uint64(_MULTIPLIER)
            lo = hi
        return mix(out)

    def sums(self, per_run: np.ndarray) -> np.ndarray:
        """Per document, the sum over its runs."""
        total = np.zeros(len(per_run) + 1, dtype=np.float64)
        np.cumsum(per_run, out=total[1:])
        ends = np.append(self.first[:-1], len(per_run))
        return total[ends[1:]] - total[ends[:-1]]


_POWERS = _Powers()


def class_counts(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> np.ndarray:
    """Per document, the number of bytes of a class."""
    return range_counts(member[data], offsets[:-1], offsets[1:])


def range_counts(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[end] - total[start]


def shingles(runs: Runs, hashes: np.ndarray, k: int, whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every window of k words; with ``whole``, fewer words make one shingle."""
    doc = runs.doc
    n = len(hashes) - k + 1
    if n > 0:
        inside = doc[:n] == doc[k - 1 :]
        value = hashes[:n] * _SHINGLE_FACTORS[0]
        for i in range(1, k):
            value += hashes[i : i + n] * _SHINGLE_FACTORS[i]
        docs, values = doc[:n][inside], mix(value[inside])
    else:
        docs, values = doc[:0], hashes[:0]
    if not whole:
        return docs, values
    short = np.flatnonzero((runs.count > 0) & (runs.count < k))
    if not len(short):
        return docs, values
    at, size = runs.first[:-1][short], runs.count[short]
    value = size.astype(np.uint64) * np.uint64(_MULTIPLIER)
    for i in range(k - 1):
        has = size > i
        value[has] += hashes[at[has] + i] * _SHINGLE_FACTORS[i]
    return np.concatenate([docs, short]), np.concatenate([values, mix(value)])


def distinct(docs: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, value) pairs, sorted."""
    order = np.lexsort((values, docs))
    docs, values = docs[order], values[order]
    new = np.ones(len(docs), dtype=bool)
    new[1:] = (docs[1:] != docs[:-1]) | (values[1:] != values[:-1])
    return docs[new], values[new]
