"""SimHash near-duplicates by vantage-point trees over fingerprints.

1. Every text gets a 64-bit fingerprint: of the XXH64 hashes of its word
   shingles, repeats included, a bit is set if more than half have it.
2. Equal fingerprints are one class; from here on only distinct ones move.
3. A pair within distance T differs by at most ``T // 3`` bits in one of three
   segments of the fingerprint, and the Hamming distance over one segment is a
   metric.  So there is a vantage-point tree for each segment: a vantage point
   splits the fingerprints by the median distance, and a fingerprint within the
   segment's radius of the boundary goes to both sides, by the triangle
   inequality: an owner on its own side, a visitor on the other.  The upper
   levels, built from a bounded sample, deal fingerprints out to shards (every
   fingerprint is dealt; the sample only places the boundaries); each shard goes
   on splitting its own part and compares all 64 bits at the leaves.
4. A shard reports a spanning forest of its links, never all pairs of a group,
   and the components of these links are found by distributed star contraction.

Levels that one sample cannot place are dealt in further rounds, each shard by a
tree of its own sample, until shards have the wanted size.  The segments are
pigeonholes and the trees search each of them: both prune.  Where one value of a
segment dominates a shard, its tree goes on over all 64 bits.

``distinct`` (the pipeline's stage) is about sets of shingles: two texts link if
the Jaccard similarity of their sets is high enough, and each link is verified
by it.  Texts with equal sets are one class, of which one text is looked at.
Texts of which too few shingles occur in another class have no partner.  Of the
rest, trees over 128 bits join most; what these leave apart meets in a prefix
join (the rarest shingles of each set, by counts over all), which misses no pair.

Nulls and empties: null and empty texts have fingerprint zero and are linked
like any other.  A null doc_id orders before all others.  For op4, repeated rows
have equal fingerprints and each keeps its row.  For ``distinct`` a row is its
doc_id and its text: rows that repeat both are copies, of which one stays, and
two texts under one doc_id are two documents.  An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import components as cc
from . import exchange, storage, text

BATCH_BYTES = 4_000_000
#: Fingerprints that place the boundaries of the upper levels.
SAMPLE = 16_384
#: Distinct fingerprints of a shard, about, and of a leaf.
SHARD = 16_384
LEAF = 1_024
#: Segments of a 64-bit word, each with its tree.
SEGMENTS = 3
#: Levels that one sample places; more are placed in further rounds.
MOST_LEVELS = 10
#: Levels of a further round (a shard's tree travels with its rows), and fingerprints of a shard, about, that place them.
MORE_LEVELS, SHARD_SAMPLE = 4, 4_096


def joined_words(texts: pa.Array) -> tuple[text.Words, bytes, list[int], list[int]]:
    """Words in lower case; all of them with one space after each; where each starts and ends there."""
    w = text.split_words(texts, lower=True)
    data, offsets = text.raw(w.words)
    n = len(w.words)
    joined = np.full(len(data) + n, 32, np.uint8)
    joined[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets))] = data
    at = offsets + np.arange(n + 1)
    return w, joined.tobytes(), at[:-1].tolist(), (at[1:] - 1).tolist()


def shingle_hashes(texts: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of each shingle of each text; a shingle is one slice of the joined words."""
    w, blob, starts, ends = joined_words(texts)
    h = xxhash.xxh64_intdigest
    for lo, hi in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        step = min(shingle, hi - lo) - 1
        yield np.fromiter((h(blob[a:b], 42) for a, b in zip(starts[lo : hi - step], ends[lo + step : hi])), np.uint64, hi - lo - step) if hi > lo else np.zeros(0, np.uint64)


def fingerprints(texts: pa.Array, shingle: int, wide: bool = False) -> np.ndarray:
    """The fingerprint of each text, as unsigned 64-bit numbers; wide: of its distinct shingles, a second column, of the hashes scrambled, and a third, of the whole set."""
    out = np.zeros((len(texts), 3), np.uint64)
    for k, hashes in enumerate(shingle_hashes(texts, shingle)):
        if len(hashes):
            hashes = np.unique(hashes) if wide else hashes
            out[k, 0] = majority(hashes)
            if wide:
                out[k, 1], out[k, 2] = majority(text.mix(hashes)), xxhash.xxh64_intdigest(hashes.tobytes())
    return out


def majority(hashes: np.ndarray) -> np.uint64:
    """Bits that more than half of the hashes have."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65_536):
        counts += np.unpackbits(hashes[i : i + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0]


#: All bits of a word.
WHOLE = np.uint64(2**64 - 1)


def segments(m: int) -> list[np.uint64]:
    """Masks of m segments of the 64 bits."""
    edges = [64 * k // m for k in range(m + 1)]
    return [np.uint64(((1 << b) - 1) ^ ((1 << a) - 1)) for a, b in zip(edges, edges[1:])]


def distance(a: np.ndarray, b: np.ndarray, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((a ^ b) & mask)


def build(sample: np.ndarray, mask: np.uint64, levels: int, seed: int) -> list[tuple[int, int]]:
    """(vantage point, median distance) of each inner node, in heap order."""
    rng = np.random.default_rng(seed)
    nodes: list[tuple[int, int]] = []
    parts = [sample]
    for _ in range(levels):
        below = []
        for part in parts:
            if len(part) < 2:
                nodes.append((0, 64))
                below += [part, part[:0]]
                continue
            best = None
            for v in rng.choice(part, min(4, len(part)), replace=False):  # the most even split of a few
                d = distance(part, v, mask)
                mu = int(np.median(d))
                left = int((d <= mu).sum())
                if best is None or abs(2 * left - len(part)) < best[0]:
                    best = (abs(2 * left - len(part)), int(v), mu, d)
            nodes.append((best[1], best[2]))
            below += [part[best[3] <= best[2]], part[best[3] > best[2]]]
        parts = below
    return nodes


def route(points: np.ndarray, nodes: list[tuple[int, int]], levels: int, mask: np.uint64, radius: int, owner: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the point, shard, owner) of each place that a point goes to. owner: which points are owners above (default: all).

    A pair on two sides of a boundary must meet once: the point on the left
    visits the right.  Visitors go on to every side that their ball reaches.
    """
    index, node, owner = np.arange(len(points)), np.zeros(len(points), np.int64), np.ones(len(points), bool) if owner is None else owner.copy()
    vantage, median = np.array([n[0] for n in nodes], np.uint64), np.array([n[1] for n in nodes], np.int64)
    for _ in range(levels):
        d = distance(points[index], vantage[node], mask).astype(np.int64)
        mu = median[node]
        left = d <= mu
        near_right = left & (d + radius > mu)  # its ball reaches over the boundary
        near_left = ~left & ~owner & (d - radius <= mu)
        over = near_right | near_left
        index = np.concatenate((index, index[over]))
        side = np.where(left, 1, 2)
        node = np.concatenate((2 * node + side, 2 * node[over] + 3 - side[over]))
        owner = np.concatenate((owner, np.zeros(int(over.sum()), bool)))
    return index, node - (2**levels - 1), owner


class Links:
    """Union of points by label; what it is given as pairs is kept only as a forest."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while True:
            a, b = label[i], label[j]
            open_ = a != b
            if not open_.any():
                return
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            lo, hi = np.minimum(a, b), np.maximum(a, b)
            # each label joins the least label that it meets: one link for each
            order = np.lexsort((lo, hi))
            first = np.concatenate(([True], hi[order][1:] != hi[order][:-1]))
            pick = order[first]
            self.a.append(i[pick])
            self.b.append(j[pick])
            to = np.arange(len(label))
            to[hi[pick]] = lo[pick]
            while True:
                nxt = to[to]
                if np.array_equal(nxt, to):
                    break
                to = nxt
            label[:] = to[label]


class Search:
    """All links of a shard, at least one end an owner.

    Two points link if the first words differ in `most` bits at most and both
    words together in `most_wide` at most (where that is given).
    """

    def __init__(self, points: np.ndarray, owner: np.ndarray, mask: np.uint64, radius: int, near: int, most: int, most_wide: int | None = None, earlier: list[tuple[int, np.uint64]] = ()):
        """earlier: (word, mask) of the trees that already find a pair within the radius there."""
        self.p, self.wide, self.owner = np.ascontiguousarray(points[:, 0]), np.ascontiguousarray(points[:, 1]), owner
        self.mask, self.radius, self.near, self.most, self.most_wide, self.earlier = mask, radius, near, most, most_wide, earlier
        self.links = Links(len(points))
        self.far: list[tuple[np.ndarray, np.ndarray]] = []
        self.met = np.zeros(len(points), bool)

    def run(self) -> "Search":
        own = np.flatnonzero(self.owner)
        by_segment = (self.mask, self.radius)
        stack = [(own, None, by_segment), (own, np.flatnonzero(~self.owner), by_segment)]
        while stack:
            stack += self._step(*stack.pop())
        return self

    def _step(self, a: np.ndarray, b: np.ndarray | None, metric: tuple[np.uint64, int]) -> list:
        """One vantage point: the pairs of parts that remain, each with its metric (mask, radius)."""
        if not len(a) or b is not None and not len(b):
            return []
        mask, r = metric
        if b is None and len(a) <= LEAF or b is not None and len(a) * len(b) <= LEAF * LEAF:
            self._compare(a, b)
            return []
        larger = a if b is None or len(a) >= len(b) else b
        v = self.p[larger[len(larger) // 2]]
        da = distance(self.p[a], v, mask).astype(np.int64)
        db = None if b is None else distance(self.p[b], v, mask).astype(np.int64)
        d = da if larger is a else db
        mu = int(np.median(d))
        if mu == int(d.max()):
            mu -= 1
        left, right = da <= mu, da > mu
        even = left if larger is a else db <= mu
        if mu < int(d.min()) or b is not None and min(even.sum(), len(even) - even.sum()) * 20 < len(even):
            # (nearly) all at one distance: nothing to prune here, so the whole word is the metric from here on
            if mask != WHOLE:
                return [(a, b, (WHOLE, self.most))]
            self._compare(a, b)
            return []
        if b is None:
            return [(a[left], None, metric), (a[right], None, metric), (a[left & (da + r > mu)], a[right & (da - r <= mu)], metric)]
        bl, br = db <= mu, db > mu
        return [(a[left], b[bl], metric), (a[right], b[br], metric), (a[left & (da + r > mu)], b[br & (db - r <= mu)], metric), (a[right & (da - r <= mu)], b[bl & (db + r > mu)], metric)]

    def _compare(self, a: np.ndarray, b: np.ndarray | None) -> None:
        """All 64 bits, block by block."""
        other = a if b is None else b
        for i in range(0, len(a), 512):
            x = a[i : i + 512]
            for j in range(0 if b is not None else i, len(other), 4096):
                y = other[j : j + 4096]
                d = np.bitwise_count(self.p[x][:, None] ^ self.p[y][None, :])
                r, c = np.nonzero(d <= self.most)
                u, v, d = x[r], y[c], d[r, c].astype(np.int64)
                ok = u != v
                if self.most_wide is not None:
                    d += np.bitwise_count(self.wide[u] ^ self.wide[v])
                    ok &= d <= self.most_wide
                for word, mask in self.earlier:
                    a_word = self.p if word == 0 else self.wide
                    ok &= (distance(a_word[u], a_word[v], mask) > self.radius) | (distance(a_word[u], a_word[v], WHOLE) > self.most)
                u, v, d = u[ok], v[ok], d[ok]
                if self.near < 0:  # nothing joins: the points are enough, the pairs are not kept
                    self.met[u] = self.met[v] = True
                    continue
                close = d <= self.near
                self.links.add(u[close], v[close])
                apart = ~close & (self.links.label[u] != self.links.label[v])
                if apart.any():
                    self.far.append((u[apart], v[apart]))

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        """Links that join what links at `near` bits or fewer join."""
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *self.links.a]), np.concatenate([none, *self.links.b])

    def open(self) -> np.ndarray:
        """Points with a link further off to a point that the forest leaves apart."""
        label, none = self.links.label, np.zeros(0, np.int64)
        return np.unique(np.concatenate([np.flatnonzero(self.met), none, *(x[label[u] != label[v]] for u, v in self.far for x in (u, v))]))


POINTS = "tree int, shard long, node long, fp long, wide long, owner boolean"
LINKS = "tree int, shard long, a long, b long, label long, fp long, wide long, owner boolean"


def _routed(batch: pa.RecordBatch, tree: int, shard: int, points: np.ndarray, nodes: list[tuple[int, int]], levels: int, mask: np.uint64, radius: int, owner: np.ndarray) -> pa.RecordBatch:
    """Rows (node, fp, wide) of a batch at their places below a shard."""
    index, below, owns = route(points, nodes, levels, mask, radius, owner)
    taken = pa.array(index)
    rows = [batch.column(batch.schema.get_field_index(c)).take(taken) for c in ("node", "fp", "wide")]
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(index), tree, np.int32)), pa.array((shard << levels) + below), *rows, pa.array(owns)], names=["tree", "shard", "node", "fp", "wide", "owner"])


def dealt(classes: DataFrame, trees_of: list[tuple[int, np.uint64]], radius: int, folder: str) -> DataFrame:
    """Every fingerprint (node, fp, wide) at its places: tree, shard, owner."""
    n = classes.count()
    levels = 0
    while SHARD << levels < n:
        levels += 1
    now = min(levels, MOST_LEVELS)
    chosen = classes.orderBy(F.xxhash64("fp")).limit(SAMPLE if levels else 0).select("fp", "wide").collect()
    sample = np.array([tuple(r) for r in chosen], np.int64).reshape(-1, 2).view(np.uint64)
    trees = [build(sample[:, w], mask, now, k) for k, (w, mask) in enumerate(trees_of)]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, ((w, mask), tree) in enumerate(zip(trees_of, trees)):
                yield _routed(batch, k, 0, batch.column(1 + w).to_numpy(zero_copy_only=False).view(np.uint64), tree, now, mask, radius, np.ones(batch.num_rows, bool))

    def grow(step: int):
        def of_sample(group: pa.Table) -> pa.Table:
            k = group.column("tree")[0].as_py()
            w, mask = trees_of[k]
            nodes = build(group.column("fp" if w == 0 else "wide").to_numpy().view(np.uint64), mask, step, k)
            return pa.table({"tree": group.column("tree")[:1], "shard": group.column("shard")[:1], "nodes": pa.array([np.array(nodes, object).astype(np.uint64).tobytes()], pa.binary())})

        def deal_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                tree, shard = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                for k, at in np.unique(np.stack((tree.astype(np.int64), shard), 1), axis=0).tolist():
                    part = batch.filter(pa.array((tree == k) & (shard == at)))
                    w, mask = trees_of[k]
                    nodes = np.frombuffer(part.column(6)[0].as_py() or b"", np.uint64).reshape(-1, 2)
                    nodes = [(int(v), int(mu)) for v, mu in nodes] or [(0, 64)] * (2**step - 1)
                    yield _routed(part, k, at, part.column(3 + w).to_numpy(zero_copy_only=False).view(np.uint64), nodes, step, mask, radius, part.column(5).to_numpy(zero_copy_only=False))

        return of_sample, deal_on

    out = classes.select("node", "fp", "wide").mapInArrow(deal, POINTS)
    while now < levels:
        step = min(levels - now, MORE_LEVELS)
        out = storage.save(out, f"{folder}/dealt-{now}")
        share = max(1, n // (SHARD_SAMPLE << now))
        of_sample, deal_on = grow(step)
        nodes = out.where(F.col("owner") & (F.pmod(F.xxhash64("fp", "wide"), F.lit(share)) == 0)).groupBy("tree", "shard").applyInArrow(of_sample, "tree int, shard long, nodes binary")
        nodes = storage.save(nodes, f"{folder}/nodes-{now}")
        out = out.join(nodes, ["tree", "shard"], "left").select("tree", "shard", "node", "fp", "wide", "owner", "nodes").mapInArrow(deal_on, POINTS)
        now += step
    return out


def links(classes: DataFrame, near: int, most: int, radius: int, folder: str, most_wide: int | None = None) -> DataFrame:
    """A forest (a, b: nodes) of the links at `near` bits or fewer; rows with NULL b are points, by tree and shard, with links further off that it leaves apart (with near = -1 all points with a link).

    classes: node, fp, wide; a row for each distinct fingerprint.  There is a
    tree for each segment (of both words, where most_wide is given).  With near
    = -1 a pair counts in the first tree that can find it and in no other.
    """
    trees_of = [(w, mask) for w in range(1 if most_wide is None else 2) for mask in segments(SEGMENTS)]

    def search(group: pa.Table) -> pa.Table:
        k = group.column("tree")[0].as_py()
        w, mask = trees_of[k]
        words = [group.column(c).to_numpy().view(np.uint64) for c in ("fp", "wide")]
        earlier = [(0 if x == w else 1, m) for x, m in trees_of[:k]] if near < 0 else []
        found = Search(np.stack([words[w], words[1 - w]], 1), group.column("owner").to_numpy(), mask, radius, near, most, most_wide, earlier).run()
        (a, b), open_ = found.forest(), found.open()
        node = group.column("node").to_numpy()
        forest = pa.table({"a": pa.array(node[a]), "b": pa.array(node[b])})
        rest = group.take(pa.array(open_)).append_column("label", pa.array(node[found.links.label[open_]]))
        both = pa.concat_tables([forest, rest.rename_columns(["tree", "shard", "a", "fp", "wide", "owner", "label"])], promote_options="default")
        return both.select(["tree", "shard", "a", "b", "label", "fp", "wide", "owner"])

    return dealt(classes, trees_of, radius, folder).groupBy("tree", "shard").applyInArrow(search, LINKS)


def fingerprinted(documents: DataFrame, shingle: int, folder: str, wide: bool = False) -> DataFrame:
    """doc_id (NULL_ID for null), tag (hash of the text), fp, wide, same of each row, written once.

    wide: of each distinct set of shingles; same then is the hash of the whole set.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.blocks(batches, "text", BATCH_BYTES):
            fp = fingerprints(batch.column(1), shingle, wide).view(np.int64)
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(text.ids(batch.column(0))), "tag": batch.column(2), **{name: pa.array(fp[:, k].copy()) for k, name in enumerate(("fp", "wide", "same"))}})

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tag"))
    return storage.save(rows.mapInArrow(scan, "doc_id long, tag long, fp long, wide long, same long"), f"{folder}/fingerprints")


def components(documents: DataFrame, shingle: int = 4, most: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable by links of `most` bits or fewer)."""
    folder = storage.work_dir(documents.sparkSession, "simhash")
    rows = fingerprinted(documents, shingle, folder)
    # a node is a distinct fingerprint; its order is that of its smallest doc_id, which two fingerprints may share
    classes = storage.save(rows.groupBy("fp").agg(F.min("doc_id").alias("least")).select(F.col("fp").alias("node"), "fp", F.lit(0).cast("long").alias("wide"), "least"), f"{folder}/classes")
    found = cc.components(storage.save(links(classes, most, most, most // SEGMENTS, folder).select("a", "b"), f"{folder}/links"), folder)
    member = storage.save(classes.join(found, "node", "left").select("fp", "least", F.coalesce("component", "node").alias("a")), f"{folder}/members")
    smallest = member.groupBy("a").agg(F.count("*").alias("n"), F.min("least").alias("m"))
    member = cc.told(member, smallest, max(cc.HOT_EDGES, member.count() // 1000)).select("fp", F.col("m").alias("component_id"))
    real = lambda c: F.when(F.col(c) != F.lit(text.NULL_ID), F.col(c)).alias(c)
    return rows.join(member, "fp").select(real("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), real("component_id"))


#: For similarity 0.8 of word shingles, fingerprints of 128 bits differ in 19.4 bits, give or take 4.1, and a word of
#: 64 bits in 9.7, give or take 2.9: links are sought up to more than two deviations above, and each is verified.
MOST, MOST_WIDE = 16, 30
#: Some one of the six segments (of 21 or 22 bits) then differs in 2 bits or fewer in 93 of 100 pairs at 0.8, in 98 at 0.85
#: and in practically all from 0.9 on. At this radius the trees still prune. What they miss, the prefix join finds.
SEGMENT_RADIUS = 2
#: Bits of a shingle's hash by which it is looked for in other texts: a chance hit only keeps a text as a candidate.
SHORT = 36
#: Up to so many points with a shingle, pairs are held against each other; beyond, all points of it at once.
SMALL_GROUP = 6


def verify(group: pa.Table, similarity: float) -> pa.Table:
    """Links (a, b) among the open points of a shard (or of a meeting, without fingerprints) whose sets of shingles are similar enough; of each component as many as join it.

    A point is held against all its partners at once: its shingles are marked,
    and the marks in each partner's set are counted.  Pairs that are joined
    already need no test.
    """
    node, label = group.column("a").to_numpy(), np.unique(group.column("label").to_numpy(), return_inverse=True)[1]
    by_bits = "fp" in group.column_names
    if by_bits:
        p, wide, owner = group.column("fp").to_numpy().view(np.uint64), group.column("wide").to_numpy().view(np.uint64), group.column("owner").to_numpy()
    sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in group.column("s")]
    size = np.array([len(x) for x in sets])
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
    first = np.cumsum(size) - size
    mark = np.zeros(int(flat.max(initial=-1)) + 1, bool)
    a, b = [], []
    for i in range(len(node)):
        ok = (label[i + 1 :] != label[i]) & (np.minimum(size[i], size[i + 1 :]) >= similarity * np.maximum(size[i], size[i + 1 :]) - 1e-6)
        if by_bits:
            near = np.bitwise_count(p[i] ^ p[i + 1 :]).astype(np.int64)
            ok &= (near + np.bitwise_count(wide[i] ^ wide[i + 1 :]) <= MOST_WIDE) & (owner[i] | owner[i + 1 :])
        j = np.flatnonzero(ok) + i + 1
        if not len(j):
            continue
        own = flat[first[i] : first[i] + size[i]]
        mark[own] = True
        hits = np.concatenate(([0], np.cumsum(mark[flat[text.ragged(first[j], size[j])]])))
        mark[own] = False
        ends = np.cumsum(size[j])
        both = hits[ends] - hits[ends - size[j]]
        joined, first_of = np.unique(label[j := j[both >= similarity * (size[i] + size[j] - both)]], return_index=True)
        if len(joined):
            label[np.isin(label, joined)] = label[i]
            a += [node[i]] * len(joined)
            b += node[j[first_of]].tolist()
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def least_common(size: np.ndarray, similarity: float) -> np.ndarray:
    """Shingles that a set of this size has in common with any that is similar enough."""
    return np.ceil(similarity * size - 1e-9).astype(np.int64)


def shared(texts: DataFrame, shingle: int, similarity: float, folder: str) -> DataFrame:
    """a: the nodes of texts (node, text) of which enough shingles occur in another text.

    A text similar to another has at least `similarity` of its shingles in
    common with it, so the others have no partner.  Blocks send their shingles
    to buckets, and a bucket answers each block how many of each text's
    shingles it has from other texts too.  A block's nodes and sizes travel with
    what it sends to one of the buckets.
    """
    buckets = exchange.buckets_for(exchange.text_bytes(texts))
    low = np.uint64(64 - SHORT)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        for k, batch in enumerate(text.blocks(batches, "text", exchange.BLOCK_BYTES)):
            sets = [np.unique(h) for h in shingle_hashes(batch.column(1), shingle)]
            size = np.array([len(x) for x in sets])
            key, doc = np.concatenate(sets) >> low << low, np.repeat(np.arange(len(sets)), size)
            order = np.argsort(key, kind="stable")
            key, doc = key[order], doc[order].astype(np.uint32)
            head = exchange.pack_parts(batch.column(0).to_numpy().tobytes(), size.astype(np.int64).tobytes())
            edges = np.searchsorted(exchange.bucket_of(key, buckets), np.arange(buckets + 1))
            # the same name when a lost task runs again: what was sent before still fits
            name = f"{TaskContext.get().partitionId()}-{k}"
            home = k % buckets
            sent = [b for b in range(buckets) if edges[b + 1] > edges[b] or b == home]
            for b in sent:
                lo, hi = edges[b], edges[b + 1]
                data = exchange.pack_parts(exchange.squeeze_hashes(key[lo:hi]), exchange.squeeze(doc[lo:hi]), head if b == home else b"")
                yield pa.RecordBatch.from_pydict({"block": pa.array([name]), "bucket": pa.array([b], pa.int32()), "data": pa.array([data], pa.binary())})

    def answer(group: pa.Table) -> pa.Table:
        sent = [exchange.parts_of(d.as_buffer().to_pybytes()) for d in group.column("data")]
        keys = [exchange.expand_hashes(p[0]) for p in sent]
        _, inverse, times = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        again, at = (times > 1)[inverse], np.cumsum([0, *map(len, keys)])
        data = [exchange.squeeze(np.bincount(exchange.expand(p[1], np.uint32)[again[lo:hi]]).astype(np.uint32)) for p, lo, hi in zip(sent, at, at[1:])]
        return pa.table({"block": group.column("block"), "said": pa.array(data, pa.binary()), "head": pa.array([p[2] or None for p in sent], pa.binary())})

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for head, said in zip(batch.column(0), batch.column(1).to_pylist()):
                nodes, size = (np.frombuffer(p, np.int64) for p in exchange.parts_of(head.as_py()))
                total = np.zeros(len(nodes), np.int64)
                for data in said:
                    n = exchange.expand(data, np.uint32)
                    total[: len(n)] += n
                yield pa.RecordBatch.from_pydict({"a": pa.array(nodes[(size > 0) & (total >= least_common(size, similarity))])})

    replies = texts.mapInArrow(make, "block string, bucket int, data binary").groupBy("bucket").applyInArrow(answer, "block string, said binary, head binary")
    replies = storage.save(replies, f"{folder}/replies")
    by_block = replies.groupBy("block").agg(F.max("head").alias("head"), F.collect_list("said").alias("said"))
    out = storage.save(by_block.select("head", "said").mapInArrow(add_up, "a long"), f"{folder}/shared")
    storage.drop(texts.sparkSession, f"{folder}/replies")
    return out


def parity(hashes: np.ndarray) -> np.ndarray:
    """One bit for each of some 4 to 8 times as many cells as there are hashes: does an odd number of them fall there?

    Each element that only one of two sets has turns one bit over, so two sets
    differ by at least as many elements as their parities differ in bits.
    """
    cells = max(256, 1 << (4 * len(hashes)).bit_length())
    return np.packbits(np.bincount((hashes & np.uint64(cells - 1)).astype(np.int64), minlength=cells).astype(np.uint8) & 1, bitorder="little")


def sets_of(texts: DataFrame, shingle: int) -> DataFrame:
    """a, s, p: the sorted distinct shingle hashes of texts (node, text), and their parity."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.blocks(batches, "text", BATCH_BYTES):
            found = [np.unique(h) for h in shingle_hashes(batch.column(1), shingle)]
            yield pa.RecordBatch.from_pydict({"a": batch.column(0), "s": pa.array([x.tobytes() for x in found], pa.binary()), "p": pa.array([parity(x).tobytes() for x in found], pa.binary())})

    return texts.select("node", "text").mapInArrow(sets, "a long, s binary, p binary")


def postings(sets: DataFrame, similarity: float, folder: str) -> DataFrame:
    """token, a, label, size, place: of each set the prefix, rarest shingles first, in which it meets all that are similar enough.

    Shingles of one set alone meet nothing and only take their places.
    """
    size = sets.agg(F.sum(F.octet_length("s")).alias("b")).head()["b"] or 0
    buckets = exchange.buckets_for(size)
    fan = exchange.fan(buckets)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                flat = [np.frombuffer(v.as_buffer(), np.uint64) for v in part.column(2)]
                keys, counts = np.unique(np.concatenate(flat), return_counts=True)
                ids, label, n = (np.asarray(x, np.int64).tobytes() for x in (part.column(0).to_numpy(), part.column(1).to_numpy(), [len(x) for x in flat]))
                name = uuid.uuid4().hex
                for kind, b, data in [(0, -1, exchange.pack_parts(ids, label, n, np.concatenate(flat).tobytes())), *((1, b, d) for b, d in exchange.sends(keys, [counts], fan))]:
                    yield pa.RecordBatch.from_pydict({"kind": pa.array([kind], pa.int32()), "block": pa.array([name]), "bucket": pa.array([b], pa.int32()), "data": pa.array([data], pa.binary())})

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, said in zip(batch.column(0), batch.column(1).to_pylist()):
                parts = exchange.parts_of(data.as_py())
                ids, label, n = (np.frombuffer(p, np.int64) for p in parts[:3])
                flat, who = np.frombuffer(parts[3], np.uint64), np.repeat(np.arange(len(n)), n)
                times = exchange.reply_array(said, np.uint32)[np.unique(flat, return_inverse=True)[1]]
                order = np.lexsort((flat, times, who))
                flat, times = flat[order], times[order]
                place = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
                ok = (times > 1) & (place <= (n - least_common(n, similarity))[who])
                yield pa.RecordBatch.from_pydict({"token": pa.array(flat[ok].view(np.int64)), "a": pa.array(ids[who[ok]]), "label": pa.array(label[who[ok]]), "size": pa.array(n[who[ok]]), "place": pa.array(place[ok])})

    table = storage.save(sets.select("a", "label", "s").mapInArrow(make, exchange.SCHEMA), f"{folder}/sets", "kind")
    replies = storage.save(exchange.totals(table.where("kind = 1"), lambda keys, total: ([total.astype(np.uint32)], b""), [np.uint32], buckets, folder), f"{folder}/set-totals")
    storage.drop(sets.sparkSession, f"{folder}/sets/kind=1")
    blocks = sets.sparkSession.read.schema(exchange.SCHEMA).parquet(f"{folder}/sets").where("kind = 0")
    return exchange.answered(blocks, replies).mapInArrow(prefixes, "token long, a long, label long, size long, place long")


def meetings(group: pa.Table, similarity: float) -> pa.Table:
    """meeting, a, label: points that share a shingle of their prefixes, have different labels and sizes and places that allow the similarity."""
    token, a, label, size, place = (group.column(c).to_numpy() for c in ("token", "a", "label", "size", "place"))
    order = np.lexsort((a, token))
    token, a, label, size, place = (x[order] for x in (token, a, label, size, place))
    first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    ends = np.append(first[1:], len(token))
    several = np.flatnonzero(np.minimum.reduceat(label, first) != np.maximum.reduceat(label, first))
    seen, names, members = set(), [], []
    for lo, hi in zip(first[several].tolist(), ends[several].tolist()):
        if hi - lo <= SMALL_GROUP:
            i, j = (lo + x for x in np.triu_indices(hi - lo, 1))
            most = np.minimum(size[i] - place[i], size[j] - place[j])  # shingles in common, if none before is
            ok = (label[i] != label[j]) & (most >= similarity / (1 + similarity) * (size[i] + size[j]) - 1e-6)
            met = list(zip(i[ok].tolist(), j[ok].tolist()))
        else:
            met = [range(lo, hi)]
        for m in met:
            who = a[list(m)]
            name = xxhash.xxh64_intdigest(who.tobytes())
            if name not in seen:
                seen.add(name)
                names += [name] * len(who)
                members += m
    at = np.array(members, np.int64)
    return pa.table({"meeting": pa.array(np.array(names, np.uint64).view(np.int64)), "a": pa.array(a[at]), "label": pa.array(label[at])})


def _by_meeting(group: pa.Table) -> tuple[pa.Table, list[tuple[int, int]]]:
    """The rows in order of their meetings, and where each meeting begins and ends."""
    group = group.take(pa.array(np.argsort(group.column("meeting").to_numpy(), kind="stable")))
    name = group.column("meeting").to_numpy()
    first = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
    return group, list(zip(first.tolist(), [*first[1:].tolist(), len(name)]))


def plausible(size: np.ndarray, label: np.ndarray, bits: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which points of a meeting have a partner of another label whose parity allows the similarity."""
    out, width = np.zeros(len(size), bool), np.array([len(x) for x in bits])
    most = (1 - similarity) / (1 + similarity)
    for w in np.unique(width):
        a = np.flatnonzero(width == w)
        # a set that is similar enough has at most 1.25 times as many elements: the same width, or the next one, folded
        b = np.flatnonzero((width == w) | (width == 2 * w))
        narrow = np.stack([(bits[k] if width[k] == w else bits[k][:w] ^ bits[k][w:]).view(np.uint64) for k in b])
        own = np.searchsorted(b, a)
        step = max(1, 4_000_000 // (len(b) * narrow.shape[1]))
        for i in range(0, len(a), step):
            x = a[i : i + step]
            d = np.bitwise_count(narrow[own[i : i + step], None] ^ narrow[None]).sum(2, dtype=np.int64)
            r, c = np.nonzero((d <= most * (size[x][:, None] + size[b][None]) + 1e-6) & (label[x][:, None] != label[b][None]))
            out[x[r]] = out[b[c]] = True
    return out


def joined(points: DataFrame, sets: DataFrame, similarity: float, folder: str) -> DataFrame:
    """Links a, b by the exact similarity between sets (a, label, s, p) with different labels, by a prefix join; of each meeting as many as join it.

    Meetings are thinned by the sets' parities, a sixteenth to an eighth of their
    size, which rule out nothing that is similar enough; only then sets travel.
    """
    spark = sets.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = points.withColumn("part", F.pmod(F.xxhash64("token"), F.lit(8 * parts)))
    met = met.groupBy("part").applyInArrow(lambda g: meetings(g, similarity), "meeting long, a long, label long").dropDuplicates(["meeting", "a"])
    met = storage.save(met, f"{folder}/meetings")

    def thin(group: pa.Table) -> pa.Table:
        group, edges = _by_meeting(group)
        size, label = (group.column(c).to_numpy() for c in ("size", "label"))
        bits = [np.frombuffer(v.as_buffer(), np.uint8) for v in group.column("p")]
        keep = np.concatenate([plausible(size[lo:hi], label[lo:hi], bits[lo:hi], similarity) for lo, hi in edges])
        return group.select(["meeting", "a", "label"]).filter(pa.array(keep))

    def check(group: pa.Table) -> pa.Table:
        group, edges = _by_meeting(group)
        return pa.concat_tables([verify(group.slice(lo, hi - lo), similarity) for lo, hi in edges])

    part = F.pmod(F.xxhash64("meeting"), F.lit(8 * parts)).alias("part")
    rows = met.join(sets.select("a", (F.octet_length("s") / 8).cast("long").alias("size"), "p"), "a").select("*", part)
    met = storage.save(rows.groupBy("part").applyInArrow(thin, "meeting long, a long, label long"), f"{folder}/thinned")
    return met.join(sets.select("a", "s"), "a").select("*", part).groupBy("part").applyInArrow(check, "a long, b long")


def distinct(documents: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """The documents, with all their columns, of which one of each group of near-duplicates stays (the one of least doc_id)."""
    spark = documents.sparkSession
    folder = storage.work_dir(spark, "near")
    done = lambda *names: [storage.drop(spark, f"{folder}/{name}") for name in names]
    rows = fingerprinted(documents, shingle, folder, wide=True)
    # a class is a distinct set of shingles, named by its hash; its first text stands for it
    classes = rows.groupBy(F.col("same").alias("node")).agg(F.first("fp").alias("fp"), F.first("wide").alias("wide"), F.min(F.struct("doc_id", "tag")).alias("x"))
    classes = storage.save(classes.select("node", "fp", "wide", "x.doc_id", "x.tag"), f"{folder}/classes")
    counted = rows.agg(F.count("*").alias("n"), F.count_distinct("doc_id", "tag").alias("d")).head()
    key = [F.coalesce(documents["doc_id"].cast("long"), F.lit(text.NULL_ID)).alias("_doc"), F.xxhash64(documents["text"]).alias("_tag")]
    named = lambda df: df.select("node", F.col("doc_id").alias("_doc"), F.col("tag").alias("_tag"))
    texts = documents.select(*key, F.col("text")).join(named(classes).hint("shuffle_hash"), ["_doc", "_tag"]).select("node", "text")
    if counted["d"] < counted["n"]:
        texts = texts.dropDuplicates(["node"])
    texts = storage.save(texts, f"{folder}/texts")
    able = shared(texts, shingle, similarity, folder)
    texts = texts.join(able.withColumnRenamed("a", "node").hint("shuffle_hash"), "node", "left_semi")
    sets = storage.save(sets_of(texts, shingle), f"{folder}/known")
    done("texts", "fingerprints")
    able = storage.save(classes.join(able, classes["node"] == able["a"], "left_semi").select("node", "fp", "wide"), f"{folder}/able")
    found = storage.save(links(able, -1, MOST, SEGMENT_RADIUS, folder, MOST_WIDE), f"{folder}/links")
    near = found.join(sets.select("a", "s"), "a").groupBy("tree", "shard").applyInArrow(lambda group: verify(group, similarity), "a long, b long")
    near = storage.save(near, f"{folder}/near")
    done("links", "able", "shared")
    labels = cc.components(near, f"{folder}/labels")
    labelled = sets.join(labels, sets["a"] == labels["node"], "left").select("a", F.coalesce("component", "a").alias("label"), "s")
    rest = storage.save(joined(postings(labelled, similarity, folder), sets, similarity, folder), f"{folder}/rest")
    done("known", "sets", "set-totals", "meetings", "thinned")
    of = cc.components(near.unionByName(rest), f"{folder}/all")
    grouped = classes.join(of, "node", "left").groupBy(F.coalesce("component", "node").alias("component")).agg(F.min(F.struct("doc_id", "tag")).alias("x"))
    kept = storage.save(grouped.select(F.col("x.doc_id").alias("_doc"), F.col("x.tag").alias("_tag")), f"{folder}/kept")
    done("near", "rest", "labels", "all", "classes")
    whole = documents.select(F.struct(*(documents[c] for c in documents.columns)).alias("_row"), *key)
    out = whole.join(kept.hint("shuffle_hash"), ["_doc", "_tag"], "left_semi")
    if counted["d"] < counted["n"]:
        out = out.dropDuplicates(["_doc", "_tag"])
    return out.select("_row.*")
