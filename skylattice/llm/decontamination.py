"""Benchmark decontamination by suffix arrays of the training shards.

A shard is some megabytes of documents.  Its suffix array holds the suffixes
whose first words all occur in the benchmark (others can match nothing), sorted
by packed word numbers and refined only where suffixes still tie, never deeper
than the longest benchmark item.  Every suffix of every benchmark item is
binary-searched in it, all at once: the neighbours of the insertion place give
its longest verbatim match and where that is.  A suffix whose longest match has
a whole window (10 words; a shorter item's whole text) marks the window at every
place that the interval of its first words lists.  Shards are independent, so
the corpus is read once and nothing is shuffled.

The benchmark is a stated query set of any size.  It is written to the shared
folder in slices of bounded size, and a task reads slice after slice for each
shard, so neither the driver nor a task ever holds more than a few slices.

Nulls and empties: null or empty texts have no words, no hits and no windows.  A
null item_id still marks words but is not listed.  Repeated rows are judged one
by one.  An empty benchmark hits nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage, text

#: Text of a shard and of a slice of the benchmark, in bytes.
SHARD_BYTES = 6_000_000
SLICE_BYTES = 2_000_000
#: Slices that a worker keeps from shard to shard.
KEPT_SLICES = 8
_kept: dict[str, "Slice"] = {}


@dataclass
class Slice:
    """Benchmark items as word numbers (from 1; 0 ends an item), and all their suffixes."""

    vocabulary: dict[str, int]
    tokens: np.ndarray
    item_ids: list
    starts: np.ndarray  # where each suffix starts
    lengths: np.ndarray  # words of each suffix
    item: np.ndarray  # index of the item of each suffix
    at: np.ndarray  # the suffix's place in its item
    window: np.ndarray  # words that a match needs to count
    marking: np.ndarray  # indices of the suffixes that have so many

    @classmethod
    def of(cls, item_ids: list, texts: pa.Array, window: int) -> "Slice":
        w = text.split_words(texts, text.NOT_ALNUM, lower=True)
        idx, distinct = w.encoded()
        n = np.diff(w.first)
        tokens = np.insert(idx + 1, w.first[1:], 0)
        item = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(idx)) - w.first[:-1][item]
        least = np.minimum(window, n)[item]
        lengths = n[item] - at
        return cls({u: i for i, u in enumerate(distinct.to_pylist(), 1)}, tokens, item_ids, np.arange(len(idx)) + item, lengths, item, at, least, np.flatnonzero(lengths >= least))


class SuffixArray:
    """Suffixes of a shard's word numbers (0 ends a document) that start with at least `least` benchmark words."""

    def __init__(self, tokens: np.ndarray, least: int, depth: int, vocabulary: int):
        self.tokens = np.concatenate((tokens, np.zeros(depth + 64, np.int64)))
        self.bits = max(1, int(vocabulary).bit_length())
        self.per_key = 62 // self.bits
        self.ends = np.flatnonzero(self.tokens == 0)
        place = np.arange(len(tokens))
        self.sa = place[self.ends[np.searchsorted(self.ends, place)] - place >= least]
        order = self.sa
        if not len(order):
            return
        rank = self.key(order, 0)
        by = np.argsort(rank, kind="stable")
        order, rank = order[by], rank[by]
        at = self.per_key
        while at < depth:  # only suffixes that tie so far are looked at again
            new = np.concatenate(([True], rank[1:] != rank[:-1]))
            group = np.cumsum(new)
            size = np.bincount(group)[group]
            tied = np.flatnonzero(size > 1)
            if not len(tied):
                break
            k = self.key(order[tied], at)
            by = np.lexsort((k, group[tied]))
            order[tied] = order[tied][by]
            changed = np.zeros(len(order), bool)
            g, kk = group[tied][by], k[by]
            changed[tied[1:]] = (g[1:] == g[:-1]) & (kk[1:] != kk[:-1])
            rank = np.cumsum(new | changed)
            if not kk.any():
                break
            at += self.per_key
        self.sa = order

    def key(self, begin: np.ndarray, at: int) -> np.ndarray:
        """Words at, at + 1, ... of suffixes, packed in one number; what follows the document's end is 0."""
        end = self.ends[np.searchsorted(self.ends, begin)]
        out = np.zeros(len(begin), np.int64)
        for k in range(at, at + self.per_key):
            p = np.minimum(begin + k, len(self.tokens) - 1)
            out = (out << self.bits) | np.where(p < end, self.tokens[p], 0)
        return out

    def bound(self, query: np.ndarray, starts: np.ndarray, lengths: np.ndarray, upper: bool) -> np.ndarray:
        """For each query, the place of the first suffix that is not below it (upper: that does not start with it either, or is above)."""
        lo, hi = np.zeros(len(starts), np.int64), np.full(len(starts), len(self.sa), np.int64)
        for _ in range(int(len(self.sa)).bit_length() + 1):
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) // 2
            below = self._below(self.sa[mid], query, starts[open_], lengths[open_], upper)
            lo[open_[below]] = mid[below] + 1
            hi[open_[~below]] = mid[~below]
        return lo

    def _below(self, places: np.ndarray, query: np.ndarray, starts: np.ndarray, lengths: np.ndarray, upper: bool) -> np.ndarray:
        """Is each suffix below its query? A suffix that starts with the whole query is below only if upper."""
        out = np.full(len(places), upper)
        left = np.arange(len(places))
        t = 0
        while len(left):
            left = left[t < lengths[left]]
            a, b = self.tokens[places[left] + t], query[starts[left] + t]
            out[left[a != b]] = a[a != b] < b[a != b]
            left = left[a == b]
            t += 1
        return out

    def common(self, places: np.ndarray, query: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Length of the common start of each suffix and its query."""
        out = np.zeros(len(places), np.int64)
        left, t = np.arange(len(places)), 0
        while len(left):
            left = left[t < lengths[left]]
            left = left[self.tokens[places[left] + t] == query[starts[left] + t]]
            out[left] += 1
            t += 1
        return out


def _shard(batch: pa.RecordBatch) -> text.Words:
    return text.split_words(batch.column(batch.schema.get_field_index("text")), text.NOT_ALNUM, lower=True)


def _tokens(w: text.Words, idx: np.ndarray, names: list[str], part: Slice) -> np.ndarray:
    get = part.vocabulary.get
    number = np.fromiter((get(u, 0) for u in names), np.int64, len(names))
    found = number[idx] if len(idx) else np.zeros(0, np.int64)
    return np.insert(found, w.first[1:], 0)


def matched(array: SuffixArray, part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """(length of the longest verbatim match, a place of it) of each benchmark suffix."""
    at = array.bound(part.tokens, part.starts, part.lengths, upper=False)
    best, place = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    for side in (at - 1, at):  # the neighbours of the insertion place
        near = array.sa[np.clip(side, 0, len(array.sa) - 1)]
        n = array.common(near, part.tokens, part.starts, part.lengths)
        place, best = np.where(n > best, near, place), np.maximum(n, best)
    return best, place


def _array(w: text.Words, idx: np.ndarray, names: list[str], part: Slice) -> SuffixArray | None:
    """The shard's suffix array for a slice; None if it has no suffix that could match."""
    if not len(part.starts):
        return None
    array = SuffixArray(_tokens(w, idx, names, part), int(part.window.min()), int(part.lengths.max()), len(part.vocabulary))
    return array if len(array.sa) else None


def _hits(w: text.Words, parts: Iterable[Slice]) -> tuple[np.ndarray, list[set]]:
    """(words of each document that a window covers, items of each document)."""
    n_docs = len(w.first) - 1
    idx, distinct = w.encoded()
    names = distinct.to_pylist()
    first = w.first + np.arange(n_docs + 1)  # with an end after each document
    cover = np.zeros(int(first[-1]) + 1, np.int32)
    items: list[set] = [set() for _ in range(n_docs)]
    for part in parts:
        array = _array(w, idx, names, part)
        if array is None:
            continue
        longest, _ = matched(array, part)
        hit = part.marking[longest[part.marking] >= part.window[part.marking]]
        if not len(hit):
            continue
        lo = array.bound(part.tokens, part.starts[hit], part.window[hit], upper=False)
        hi = array.bound(part.tokens, part.starts[hit], part.window[hit], upper=True)
        # equal windows have one interval, which is listed once
        interval, of = np.unique(np.stack((lo, hi, part.window[hit]), 1), axis=0, return_inverse=True)
        lo, hi, size = interval.T
        n = hi - lo
        places = array.sa[text.ragged(lo, n)]
        window = np.repeat(np.arange(len(n)), n)
        np.add.at(cover, places, 1)
        np.add.at(cover, places + size[window], -1)
        owner, item = np.divmod(np.unique(of.ravel() * len(part.item_ids) + part.item[hit]), len(part.item_ids))
        edges = np.searchsorted(owner, np.arange(len(n) + 1))
        doc = np.searchsorted(first, places, "right") - 1
        for pair in np.unique(doc * len(n) + window).tolist():
            k = pair % len(n)
            items[pair // len(n)].update(part.item_ids[i] for i in item[edges[k] : edges[k + 1]].tolist())
    hit = np.concatenate(([0], np.cumsum(np.cumsum(cover[:-1]) > 0)))
    return hit[first[1:]] - hit[first[:-1]], items


class Slices:
    """The benchmark in the shared folder, a folder for each slice of bounded size."""

    def __init__(self, benchmark: DataFrame, window: int):
        self.folder = storage.work_dir(benchmark.sparkSession, "benchmark")
        self.window = window
        rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
        self.n = max(1, -(-storage.column_bytes(rows, "text") // SLICE_BYTES))
        storage.save(rows.withColumn("slice", F.pmod(F.xxhash64("item_id", "text"), F.lit(self.n))).repartition("slice"), self.folder, "slice")

    def __iter__(self) -> Iterator[Slice]:
        from pyarrow import fs, parquet

        for k in range(self.n):
            name = f"{self.folder}/slice={k}"
            if name not in _kept:
                where, root = fs.FileSystem.from_uri(name) if "://" in name or name.startswith("file:") else (fs.LocalFileSystem(), name)
                found = where.get_file_info(fs.FileSelector(root, allow_not_found=True))
                tables = [parquet.read_table(f.path, filesystem=where, partitioning=None) for f in sorted(found, key=lambda f: f.path) if f.path.endswith(".parquet")]
                while len(_kept) >= KEPT_SLICES:
                    _kept.pop(next(iter(_kept)))
                rows = pa.concat_tables(tables) if tables else pa.table({"item_id": pa.array([], pa.int64()), "text": pa.array([], pa.string())})
                _kept[name] = Slice.of(rows.column("item_id").to_pylist(), rows.column("text"), self.window)
            yield _kept[name]


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each document."""
    held = Slices(benchmark, window)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.blocks(batches, "text", SHARD_BYTES):
            w = _shard(batch)
            hit, items = _hits(w, held)
            names = [sorted(str(i) for i in s if i is not None) for s in items]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "n_words": pa.array(np.diff(w.first)), "n_hit": pa.array(hit.astype(np.int64)), "n_items": pa.array([len(x) for x in names], pa.int64()),
                "items_sha256": pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names], pa.string()), "contaminated": pa.array(hit > 0),
            })

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(match, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def remove(documents: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents, with all their columns, in which no window occurs."""
    held = Slices(benchmark, window)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.blocks(batches, "text", SHARD_BYTES):
            hit, _ = _hits(_shard(batch), held)
            yield batch.filter(pa.array(hit == 0))

    return documents.mapInArrow(keep, documents.schema)


def longest_matches(documents: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """item_id, item_start, length, doc_id, doc_start: for each benchmark suffix the longest verbatim match in any shard (of at least one window) and one place of it."""
    held = Slices(benchmark, window)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.blocks(batches, "text", SHARD_BYTES):
            w = _shard(batch)
            idx, distinct = w.encoded()
            names, ids = distinct.to_pylist(), text.ids(batch.column(0))
            first = w.first + np.arange(len(w.first))
            for part in held:
                array = _array(w, idx, names, part)
                if array is None:
                    continue
                best, place = matched(array, part)
                ok = np.flatnonzero(best >= part.window)
                doc = np.searchsorted(first, place[ok], "right") - 1
                yield pa.RecordBatch.from_pydict({"item_id": pa.array([part.item_ids[k] for k in part.item[ok]], pa.int64()), "item_start": pa.array(part.at[ok]), "length": pa.array(best[ok]), "doc_id": text.id_array(ids[doc]), "doc_start": pa.array(place[ok] - first[doc])})

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.mapInArrow(match, "item_id long, item_start long, length long, doc_id long, doc_start long")
    best = F.max_by(F.struct("length", "doc_id", "doc_start"), F.struct(F.col("length"), -F.col("doc_id"), -F.col("doc_start")))
    return found.groupBy("item_id", "item_start").agg(best.alias("x")).select("item_id", "item_start", "x.*")
