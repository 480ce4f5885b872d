"""Byte-pair encoding of many short words at once, in NumPy.

Texts are cut before every run of white space. Distinct units of up to 24 bytes are found by their
bytes as three whole numbers; those that consist of letters, with a space before them and marks
after them, are encoded together: each round merges the leftmost pair of the lowest rank in every
word, and only the pairs beside a merge are looked up again. Other units are left to the caller.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NONE = np.int32((1 << 31) - 1)
# No id, within a word and beside one.
GONE, OUTSIDE = np.int32(-1), np.int32((1 << 31) - 1)
LONGEST = 24
# Words are merged together with others of up to so many bytes.
WIDTHS = [4, 6, 8, 10, 12, 16, LONGEST]
MARKS = b",.;:!?*$%&#|"
IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
IS_LETTER = np.isin(np.arange(256) | 0x20, np.arange(ord("a"), ord("z") + 1)) & (np.arange(256) < 128)
IS_MARK = np.isin(np.arange(256), list(MARKS))
# Second bytes of the letters from U+00C0 to U+00FE, whose first byte is 0xC3.
LATIN = 0xC3
IS_LATIN = np.isin(np.arange(256), np.delete(np.arange(0x80, 0xBF), [0x17, 0x37]))
# First and second bytes of white space beyond ASCII; some other characters begin alike.
WIDE_SPACES = [(0xC2, 0x85), (0xC2, 0xA0), (0xE1, 0x9A), (0xE2, 0x80), (0xE2, 0x81), (0xE3, 0x80)]
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def has_wide_space(data: np.ndarray) -> bool:
    """Whether there may be white space beyond ASCII."""
    return any(((data[:-1] == a) & (data[1:] == b)).any() for a, b in WIDE_SPACES)


class Merges:
    """Ranks and results of pairs of ids, by two tables of hashed places."""

    def __init__(self, pairs: np.ndarray, results: np.ndarray):
        self.keys = (pairs[:, 0].astype(np.uint64) << np.uint64(32)) | pairs[:, 1].astype(np.uint64)
        self.results = results.astype(np.int32)
        ranks, self.tables = np.arange(len(pairs)), []
        while len(ranks):
            # What falls on a taken place goes to another table, with another factor.
            factor = _FACTORS[len(self.tables) % 3] + np.uint64(2 * len(self.tables))
            table = np.full(1 << 20, len(pairs), dtype=np.int32)
            place = self._place(self.keys[ranks], factor)
            table[place[::-1]] = ranks[::-1]
            self.tables.append((factor, table))
            ranks = ranks[table[place] != ranks]
        self.keys = np.append(self.keys, np.uint64(0xFFFFFFFFFFFFFFFF))

    @staticmethod
    def _place(keys: np.ndarray, factor: np.uint64) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(29))) * factor) >> np.uint64(44)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NONE where it does not merge."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        out = np.full(len(keys), NONE, dtype=np.int32)
        for factor, table in self.tables:
            found = table[self._place(keys, factor)]
            hit = self.keys[found] == keys
            out[hit] = found[hit]
        return out

    def encode(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lengths) of words after all merges; words are runs of ``ids`` from ``starts`` on, none empty."""
        length = np.diff(np.append(starts, len(ids)))
        count, place = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        merged, held, low = [], 0, 0
        for width in WIDTHS:
            chosen = np.flatnonzero((length > low) & (length <= width))
            low = width
            if len(chosen):
                cells = starts[chosen][:, None] + np.arange(width)
                inside = np.arange(width) < length[chosen][:, None]
                words = np.where(inside, ids[np.minimum(cells, len(ids) - 1)], GONE).astype(np.int32)
                found, n = self._merge(words, inside)
                count[chosen], place[chosen] = n, held + np.cumsum(n) - n
                merged.append(found)
                held += len(found)
        if not merged:
            return np.zeros(0, np.int32), count
        return np.concatenate(merged)[_runs(place, count)], count

    def _merge(self, words: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ids, each filled up with GONE, after all merges."""
        n, width = words.shape
        end = n * width  # the cell beside the first and the last id of every row
        ids = np.append(words.reshape(-1), OUTSIDE)
        cell = np.arange(end + 1, dtype=np.int32)
        after, before = cell + np.int32(1), cell - np.int32(1)
        after[:end].reshape(n, width)[np.arange(n), inside.sum(axis=1) - 1] = end
        before[:end:width] = end
        rank = np.full(end + 1, NONE, dtype=np.int32)
        pairs = np.flatnonzero(inside.reshape(-1) & (after[:end] < end))
        rank[pairs] = self.ranks(ids[pairs], ids[pairs + 1])
        table, rows = rank[:end].reshape(n, width), np.arange(n)
        while len(rows):
            # The leftmost pair of the lowest rank.
            now = table[rows]
            at = now.argmin(axis=1)
            best = now[np.arange(len(rows)), at]
            some = best < NONE
            rows, best = rows[some], best[some]
            left = rows * width + at[some]
            right = after[left]
            follower, leader = after[right], before[left]
            ids[left], ids[right], rank[right] = self.results[best], GONE, NONE
            after[left], before[follower] = follower, left
            rank[left] = self.ranks(ids[left], ids[follower])
            rank[leader] = self.ranks(ids[leader], ids[left])
        stays = ids[:end] != GONE
        return ids[:end][stays], stays.reshape(n, width).sum(axis=1)


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of runs, one after the other."""
    at = np.append(0, np.cumsum(lengths))
    return np.arange(at[-1]) + np.repeat(starts - at[:-1], lengths)


def _next(mask: np.ndarray) -> np.ndarray:
    """For every place and the end, the next place from there on where ``mask`` holds, or the end."""
    n = len(mask)
    at = np.append(np.where(mask, np.arange(n, dtype=np.int32), np.int32(n)), np.int32(n))
    return np.minimum.accumulate(at[::-1])[::-1]


class Words:
    """Ids of whole texts by the ids of their units."""

    def __init__(self, merges: Merges, first: np.ndarray, last: np.ndarray, spaced: bool, other: Callable[[str], bytes]):
        """``first`` has the id of each byte, ``last`` that of a byte at the end of a word; -1 for none.

        ``spaced``: a space before a word belongs to it; else it is dropped and the word lower-cased.
        """
        self.merges, self.first, self.last, self.spaced, self.other = merges, first, last, spaced, other

    def _plain(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which units are words of plain letters with marks after them, and how many letter bytes, space included, they have."""
        letter = IS_LETTER[data]
        second = np.append(False, data[:-1] == LATIN) & IS_LATIN[data]
        letter |= second
        letter[:-1] |= second[1:]
        begin = starts + (data[starts] == 32)
        # Letters from the beginning on, then marks up to the end.
        word_end = np.minimum(_next(~letter)[begin], ends)
        mark_end = _next(~IS_MARK[data])[word_end]
        return (word_end > begin) & (mark_end >= ends), word_end

    def _encode_plain(self, data: np.ndarray, starts: np.ndarray, word_ends: np.ndarray, ends: np.ndarray):
        """(ids, lengths) of plain units."""
        begin = starts if self.spaced else starts + (data[starts] == 32)
        # A word, and marks where there are any.
        from_, to = np.stack([begin, word_ends], 1).reshape(-1), np.stack([word_ends, ends], 1).reshape(-1)
        some = to > from_
        unit = np.repeat(np.arange(len(starts)), 2)[some]
        from_, to = from_[some], to[some]
        length = to - from_
        at = np.append(0, np.cumsum(length))
        flat = data[_runs(from_, length)]
        if not self.spaced:
            upper = (IS_LETTER[flat] & (flat < 97)) | ((np.append(0, flat[:-1]) == LATIN) & (flat >= 0x80) & (flat < 0x9F))
            flat = flat + np.where(upper, 32, 0).astype(np.uint8)
        ids = self.first[flat]
        ids[at[1:] - 1] = self.last[flat[at[1:] - 1]]
        ids, n = self.merges.encode(ids, at[:-1])
        return ids, np.bincount(unit, weights=n, minlength=len(starts)).astype(np.int64)

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, the place where each text begins and the last ends); no wide spaces in them."""
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        space = IS_SPACE[data]
        cut = space & ~np.append(False, space[:-1])
        cut[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(cut)
        length = np.diff(np.append(starts, len(data)))
        # The bytes of short units as whole numbers.
        padded = np.append(data, np.zeros(LONGEST, np.uint8))
        eight = np.ndarray(len(data) + LONGEST - 7, "<u8", padded, strides=(1,))
        parts, mixed = [], length.astype(np.uint64)
        for i in range(LONGEST // 8):
            bits = 8 * np.clip(length - 8 * i, 0, 8)
            mask = np.where(bits >= 64, ~np.uint64(0), (np.uint64(1) << (bits % 64).astype(np.uint64)) - np.uint64(1))
            part = eight[starts + np.minimum(8 * i, LONGEST - 8)] & mask
            mixed = (mixed ^ part) * _FACTORS[i]
            mixed ^= mixed >> np.uint64(31)
            parts.append(part)
        short = np.flatnonzero(length <= LONGEST)
        _, one, which = np.unique(mixed[short], return_index=True, return_inverse=True)
        one = short[one]
        # Units whose numbers agree by chance only are encoded by themselves, as long ones are.
        same = np.ones(len(short), dtype=bool)
        for part in (*parts, length):
            same &= part[short] == part[one[which]]
        alone = np.setdiff1d(np.arange(len(starts)), short[same], assume_unique=True)
        units = np.concatenate([one, alone])
        kind = np.empty(len(starts), dtype=np.int64)
        kind[short] = which
        kind[alone] = len(one) + np.arange(len(alone))
        unit_starts, unit_ends = starts[units], starts[units] + length[units]
        plain, word_ends = self._plain(data, unit_starts, unit_ends)
        plain[len(one):] = False
        ids, n = self._encode_plain(data, unit_starts[plain], word_ends[plain], unit_ends[plain])
        rest = np.flatnonzero(~plain)
        raw = data.tobytes()
        left = [raw[a:b] for a, b in zip(unit_starts[rest].tolist(), unit_ends[rest].tolist(), strict=True)]
        if not self.spaced:
            left = [unit.strip() for unit in left]
        others = [self.other(unit.decode()) if unit else b"" for unit in left]
        count = np.zeros(len(units), dtype=np.int64)
        count[plain], count[rest] = n, [len(x) // 4 for x in others]
        table = np.concatenate([ids.astype("<u4"), np.frombuffer(b"".join(others), "<u4")])
        order = np.concatenate([np.flatnonzero(plain), rest])
        place = np.empty(len(units), dtype=np.int64)
        place[order] = np.cumsum(count[order]) - count[order]
        each = count[kind]
        at = np.append(0, np.cumsum(each))
        return table[_runs(place[kind], each)], at[np.searchsorted(starts, offsets)]
