"""Best-fit packing of token sequences by exact-complement hashing.

Only *lengths* decide which pieces share a sequence, and there are at most
``capacity`` of them, so the plan is made on the histogram of lengths: a table
of patterns (which lengths, in which order, how many times) that says nothing
about single pieces and does not grow with the data.  Exact sums come first:
single lengths, pair sums and triple sums are indexed by their value, and for a
length L the gap ``capacity - L`` is looked up among singles, then pairs, then
triples; as many copies are consumed at once as the availability counts allow.  What no sum fills is packed best-fit, longest
first, again many copies at once.  Pieces then find their place by their rank
among the pieces of equal length, counted in salted groups so that a length
that a third of all pieces have is never in one task.

Nulls and empties: a null or empty text is the end id alone (one piece of
length 1).  A null doc_id stays null.  Repeated rows are packed as often as
they occur.  An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import storage, text, tokens

#: Rows of one length in a salt group, about.
GROUP_ROWS = 100_000
BATCH_BYTES = 4_000_000


class SumIndex:
    """Sums of two and of three of some lengths, hashed by their value (up to capacity - 1).

    A bucket of sum s is a slice of arrays that are sorted by the sum: the pairs
    (a, s - a), and for triples the third lengths c for which s - c has a pair.
    """

    def __init__(self, lengths: np.ndarray, capacity: int):
        i, j = np.triu_indices(len(lengths))
        low, total = lengths[i], lengths[i] + lengths[j]
        fit = total < capacity
        order = np.argsort(total[fit], kind="stable")
        self.low, total = low[fit][order], total[fit][order]
        self.pair_at = np.searchsorted(total, np.arange(capacity + 1))
        sums = np.unique(total)
        triple = lengths[:, None] + sums[None]
        c, _ = np.nonzero(triple < capacity)
        triple = triple[triple < capacity]
        order = np.argsort(triple, kind="stable")
        self.third = lengths[c][order]
        self.triple_at = np.searchsorted(triple[order], np.arange(capacity + 1))

    def pairs(self, total: int) -> np.ndarray:
        """The lesser length of each pair with this sum."""
        return self.low[self.pair_at[total] : self.pair_at[total + 1]]

    def thirds(self, total: int) -> np.ndarray:
        """Each length that a pair completes to this sum."""
        return self.third[self.triple_at[total] : self.triple_at[total + 1]]


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence in order, number of such sequences) over all pieces; at most a few patterns a length."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    index = SumIndex(np.flatnonzero(left), capacity)
    out: list[tuple[tuple[int, ...], int]] = []

    def consume(pattern: tuple[int, ...]) -> None:
        """As many of the pattern as the counts allow."""
        need: dict[int, int] = {}
        for x in pattern:
            need[x] = need.get(x, 0) + 1
        n = min(int(left[x]) // k for x, k in need.items())
        if n:
            for x, k in need.items():
                left[x] -= n * k
            out.append((pattern, n))

    def pairs(total: int, most: int) -> list[tuple[int, int]]:
        """Pairs of this sum that are still there, no length above most; the most even ones first."""
        low = index.pairs(total)
        low = low[(left[low] > 0) & (left[total - low] > 0) & (total - low <= most)]
        return [(total - x, x) for x in low[::-1].tolist()]

    for length in range(capacity, 0, -1):
        gap = capacity - length
        if not left[length]:
            continue
        if gap == 0:
            consume((length,))
            continue
        consume((length, gap))  # single
        for a, b in pairs(gap, length):
            if not left[length]:
                break
            consume((length, a, b))
        thirds = index.thirds(gap) if left[length] else np.zeros(0, np.int64)
        for c in thirds[(left[thirds] > 0) & (thirds <= length)][::-1].tolist():
            for a, b in pairs(gap - c, c):  # c is the greatest of the three
                if not left[length] or not left[c]:
                    break
                consume((length, c, a, b))
            if not left[length]:
                break
    return out + best_fit({k: int(left[k]) for k in range(1, capacity + 1) if left[k]}, capacity)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts; equal bins are one entry, split only when a length runs out."""
    bins: dict[int, dict[tuple[int, ...], int]] = {}

    def add(gap: int, pattern: tuple[int, ...], n: int) -> None:
        if n:
            group = bins.setdefault(gap, {})
            group[pattern] = group.get(pattern, 0) + n

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            gap = min((g for g in bins if g >= length and bins[g]), default=None)
            if gap is None:
                break
            pattern, have = next(iter(bins[gap].items()))
            fits = gap // length
            del bins[gap][pattern]
            if n >= fits:  # as many whole bins as can take all that fits
                take = min(have, n // fits)
                add(gap - fits * length, (*pattern, *[length] * fits), take)
                add(gap, pattern, have - take)
                n -= take * fits
            else:
                add(gap - n * length, (*pattern, *[length] * n), 1)
                add(gap, pattern, have - 1)
                n = 0
        if n:
            fits = capacity // length
            add(capacity - fits * length, (length,) * fits, n // fits)
            if n % fits:
                add(capacity - n % fits * length, (length,) * (n % fits), 1)
    return [(p, n) for group in bins.values() for p, n in group.items()]


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For each length, runs of ranks with the sequence of the run's first piece, the step to the next and the offset."""
    used: dict[int, int] = {}
    rows = []
    sequence = 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            at = used.get(length, 0)
            rows.append((length, at, sequence, offset))
            used[length] = at + n
            offset += length
        sequence += n
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return {"key": (table[:, 0] << 48) + table[:, 1], "rank": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def pieces(documents: DataFrame, vocabulary_path: str, units: str, capacity: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece of each document."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(vocabulary_path, units)
        for batch in text.blocks(batches, "text", BATCH_BYTES):
            ids, at = enc.encode(batch.column(1))
            lengths = np.diff(at)
            n = -(-lengths // capacity)
            doc = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            size = np.minimum(capacity, lengths[doc] - start)
            view = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            lo = ((at[doc] + start) * 4).tolist()
            hi = ((at[doc] + start + size) * 4).tolist()
            crc = np.fromiter((zlib.crc32(view[a:b]) for a, b in zip(lo, hi)), np.int64, len(lo))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).take(pa.array(doc)), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()), "length": pa.array(size, pa.int64()), "ids_crc32": pa.array(crc)})

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(encode, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(documents: DataFrame, capacity: int = 2048, vocabulary: str = "word_bpe_49k.json", units: str = "space") -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = documents.sparkSession
    folder = storage.work_dir(spark, "packing")
    made = storage.save(pieces(documents, tokens.vocabulary_path(vocabulary), units, capacity), f"{folder}/pieces")
    # at most `capacity` rows come to the driver
    histogram = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count("*").alias("n")).collect()}
    total = sum(histogram.values())
    salts = 64
    while salts * GROUP_ROWS < total:
        salts *= 2
    table = places(plan(histogram, capacity))

    salted = made.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    groups = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    ranked = salted.withColumn("rank", F.row_number().over(within) - 1).join(groups, ["length", "salt"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            k = np.searchsorted(table["key"], (length << 48) + rank, "right") - 1
            sequence = table["sequence"][k] + rank - table["rank"][k]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(table["offset"][k])], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).cast("long").alias("rank"))
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
