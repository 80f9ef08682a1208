"""A compressed FM-index over word numbers, with vectorised backward search.

The Burrows-Wheeler transform is held in a wavelet tree: for each bit of the
word numbers, from the highest, one packed bit vector with a count for every 64
bits, so a rank is a table look-up and a population count.  Of the suffix array
only the entries of every SAMPLE-th text place are kept; other places are found
by steps back through the transform.  The text itself is not kept.  All queries
take each step together.
"""

from __future__ import annotations

import numpy as np


#: Every so many places of the text, the suffix array is kept.
SAMPLE = 16


def suffix_order(tokens: np.ndarray) -> np.ndarray:
    """All suffixes in order; the sorted prefix doubles each round, and only suffixes that tie are sorted again."""
    n = len(tokens)
    order = np.argsort(tokens, kind="stable")
    first = np.concatenate(([True], np.diff(tokens[order]) != 0))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    have = 1
    while True:
        last = np.append(first[1:], True)
        tied = np.flatnonzero(~(first & last))
        if not len(tied):
            return order
        at = order[tied]
        beyond = at + have
        after = np.where(beyond < n, rank[np.minimum(beyond, n - 1)], -1)
        by = np.lexsort((after, rank[at]))
        at, after = at[by], after[by]
        group = rank[at]
        order[tied] = at
        first[tied[1:]] = (group[1:] != group[:-1]) | (after[1:] != after[:-1])
        first[tied[0]] = True
        rank[at] = np.maximum.accumulate(np.where(first[tied], tied, 0))
        have *= 2


class BitVector:
    """Packed bits with ranks."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64))).astype(np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Set bits before each place i."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class WaveletTree:
    """Ranks of word numbers, level by level (the pointerless form: zeros of a level go first)."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels: list[tuple[int, BitVector, int]] = []
        for shift in range(bits - 1, -1, -1):
            bit = (values >> shift) & 1 == 1
            self.levels.append((shift, BitVector(bit), int((~bit).sum())))
            values = np.concatenate((values[~bit], values[bit]))

    def ranks(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each symbol before lo and before hi, as places of the last level (their difference counts; their base is the symbol's first place)."""
        for shift, vector, zeros in self.levels:
            one = (symbol >> shift) & 1 == 1
            a, b = vector.rank(lo), vector.rank(hi)
            lo = np.where(one, zeros + a, lo - a)
            hi = np.where(one, zeros + b, hi - b)
        return lo, hi


    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol at each place, its place in the last level)."""
        symbol = np.zeros(len(i), np.int64)
        for shift, vector, zeros in self.levels:
            before = vector.rank(i)
            one = vector.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1) == 1
            symbol |= one.astype(np.int64) << shift
            i = np.where(one, zeros + before, i - before)
        return symbol, i


class FMIndex:
    """tokens: word numbers from 1 on, 0 after each text. Inside, all are one higher, and a single 0 ends them."""

    def __init__(self, tokens: np.ndarray):
        tokens = np.append(tokens + 1, 0)
        sa = suffix_order(tokens)
        bits = max(1, int(tokens.max()).bit_length())
        self.n = len(tokens)
        self.tree = WaveletTree(tokens[sa - 1], bits)
        counts = np.bincount(tokens)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        # where each symbol starts in the tree's last level
        zero = np.zeros(len(counts), np.int64)
        self.base, _ = self.tree.ranks(np.arange(len(counts)), zero, zero)
        sampled = sa % SAMPLE == 0
        self.marked = BitVector(sampled)
        self.samples = sa[sampled].astype(np.int32 if self.n < 2**31 else np.int64)

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with symbol put before them."""
        a, b = self.tree.ranks(symbol, lo, hi)
        shift = self.first[symbol] - self.base[symbol]
        return a + shift, b + shift

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text place of the suffix of each row: back through the transform to the next kept entry."""
        out, row, open_ = np.zeros(len(rows), np.int64), rows.copy(), np.arange(len(rows))
        for steps in range(SAMPLE):
            if not len(open_):
                break
            at = row[open_]
            kept = self.marked.words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1) == 1
            out[open_[kept]] = self.samples[self.marked.rank(at[kept])] + steps
            open_, at = open_[~kept], at[~kept]
            symbol, place = self.tree.access(at)
            row[open_] = self.first[symbol] + place - self.base[symbol]
        return out

    def matching_statistics(self, stream: np.ndarray, limit: int, least: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(length, lo, hi) for each place of a streamed text: of the words that end there, the longest run of at most `limit` that the index has `least` times, and its interval.

        stream: word numbers of the index; 0 ends a text, and no match goes over it.
        lo and hi hold for the places that reach the limit.
        """
        length, lo, hi = (np.zeros(len(stream), np.int64) for _ in range(3))
        stream = np.where((stream > 0) & (stream < len(self.first) - 2), stream + 1, 0)  # 0: in no text of the index
        live = np.flatnonzero(stream)
        lo[live], hi[live] = self.first[stream[live]], self.first[stream[live] + 1]
        live = live[hi[live] - lo[live] >= least]
        length[live] = 1
        for k in range(1, limit):
            live = live[live >= k]
            live = live[stream[live - k] > 0]
            if not len(live):
                break
            a, b = self.extend(stream[live - k], lo[live], hi[live])
            enough = b - a >= least
            live = live[enough]
            lo[live], hi[live] = a[enough], b[enough]
            length[live] += 1
        return length, lo, hi
