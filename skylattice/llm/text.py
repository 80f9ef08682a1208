"""Vectorised text primitives over Arrow batches, shared by the operators.

A batch of texts becomes one array of words by numpy masks over its UTF-8
bytes (every separator used here is an ASCII byte, so no character is cut) and
one dictionary encoding, so that Python touches each *distinct* word of a batch
once and no word of the running text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

#: Stands for a null id inside operators that order documents; it sorts first.
NULL_ID = -(2**63)

#: Separators of ``[^\x20\x09-\x0D]+``.
WHITESPACE = np.zeros(256, bool)
WHITESPACE[[9, 10, 11, 12, 13, 32]] = True
#: Separators of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
NOT_ALNUM = np.zeros(256, bool)
for _lo, _hi in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
    NOT_ALNUM[_lo : _hi + 1] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string array; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64)[texts.offset : texts.offset + n + 1]
    lo, hi = int(offsets[0]), int(offsets[-1])
    return (np.frombuffer(data, np.uint8)[lo:hi] if hi > lo else np.zeros(0, np.uint8)), offsets - lo


@dataclass
class Words:
    """The words of some texts. first: index of each text's first word, one more at the end."""

    words: pa.Array
    first: np.ndarray

    def encoded(self) -> tuple[np.ndarray, pa.Array]:
        """(index of each word among the distinct words, distinct words)."""
        if not len(self.words):
            return np.zeros(0, np.int64), self.words
        d = self.words.dictionary_encode()
        return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data)))


def split_words(texts: pa.Array, separators: np.ndarray = WHITESPACE, lower: bool = False) -> Words:
    """Maximal runs of non-separator bytes of each text; lower: A-Z are lower-cased first."""
    data, offsets = raw(texts)
    if not len(data):
        return Words(pa.array([], pa.large_string()), np.zeros(len(offsets), np.int64))
    if lower:
        data = LOWER[data]
    word = ~separators[data]
    starts = np.flatnonzero(_edges(word, offsets[:-1]))
    ends = np.flatnonzero(_edges(word[::-1], len(data) - offsets[1:])[::-1])
    lengths = ends - starts + 1
    clean = data[word]
    first = np.searchsorted(starts, offsets)
    return Words(_strings(clean, np.concatenate(([0], np.cumsum(lengths)))), first)


def _edges(word: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where a run of word bytes starts; a run never goes over the positions at."""
    edge = word.copy()
    edge[1:] &= ~word[:-1]
    at = at[at < len(word)]
    edge[at] = word[at]
    return edge


def by_frequency(idx: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same words, numbered from the most frequent on (of equally frequent ones by hash): both arrays then compress well."""
    order = np.lexsort((hashes, -np.bincount(idx, minlength=len(hashes))))
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    return number[idx], hashes[order]


def hashed(words: pa.Array, seed: int = 0) -> np.ndarray:
    """XXH64 of each of the (distinct) words."""
    data, offsets = raw(words)
    blob, off, h = data.tobytes(), offsets.tolist(), xxhash.xxh64_intdigest
    return np.fromiter((h(blob[a:b], seed) for a, b in zip(off, off[1:])), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of SplitMix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of the concatenation of what left and right stand for; not symmetric."""
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right + np.uint64(0x632BE59BD9B4E019))


def window_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive items, by doubling: log2(k) passes."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    out, have = mix(h), 1
    while have < k:
        step = min(have, k - have)
        out = pair_hash(out[: len(out) - step], out[step:])
        have += step
    return out


def ids(column: pa.Array) -> np.ndarray:
    """Ids as int64 with NULL_ID for null."""
    return column.cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False)


def id_array(values: np.ndarray) -> pa.Array:
    """The reverse of ids()."""
    return pa.array(values, pa.int64(), mask=values == NULL_ID)


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches cut or joined to about limit bytes of the text column (a longer text stays whole)."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = raw(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            n = int(np.searchsorted(offsets, offsets[at] + (limit - size), "right")) - 1 - at
            if n <= 0 and held:
                yield _joined(held)
                held, size = [], 0
                continue
            n = max(1, n)
            held.append(batch.slice(at, n))
            size += int(offsets[min(at + n, batch.num_rows)] - offsets[at])
            at += n
            if size >= limit:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(held) == 1:
        return held[0]
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenation of the ranges [start, start + length)."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = starts - (np.cumsum(lengths) - lengths)
    return np.repeat(shift, lengths) + np.arange(total)
