"""Substring deduplication with a compressed FM-index per shard.

Every word covered by a window of ``window`` words whose sequence also starts
earlier (smaller doc_id, or earlier in the same document) is removed.

1. A window's *anchor* is the least-hashed of its k-word grams, so equal windows
   have equal anchors.  Blocks of documents count the distinct anchors by the
   packed exchange; an anchor that occurs once in all data rules its windows out.
2. Each run of windows with one repeated anchor is a segment.  Equal segments
   are one class, first within a block, then in a shard; all but the earliest
   member of a class are repeats as they stand.
3. Classes go to shards by their anchor; where very many documents share an
   anchor, window by window and by the window's own hash, so that no key gathers
   more than what has equal text, and that is one class.  A shard builds an
   FM-index over its classes, in document order, with a sampled suffix array.
   The classes stream through it for their matching statistics up to the window
   length; where those reach it, the places of the interval are located, and a
   window is reported if the least place is an earlier start.
4. The removed intervals of each document meet its text by a shuffled hash join
   on doc_id and the hash of the text.

Words are compared by 64-bit hashes.  Nulls and empties: null or empty texts
have no words and stay as they are.  A null doc_id sorts first.  Rows of one
doc_id and equal text are one document met twice: neither is earlier, both get
the same result.  Different texts under one doc_id are different documents, and
the one whose text has the lesser hash counts as earlier.  An empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange, storage, text
from .fm_index import FMIndex

#: Words of an anchor.
ANCHOR = 8
#: An anchor that more segments have is dealt by window.
HOT = 256
#: Text for each shard, in bytes: if every word of the input were in classes, about three times over, an index would have half a million.
SHARD_BYTES = 1_000_000
BATCH_BYTES = 6_000_000
UNIQUE, REPEATED, COMMON = 0, 1, 2
SPANS = "doc_id long, tag long, lo long, hi long"


class Block:
    """Word hashes of some documents, which their ids and the hashes of their texts name."""

    def __init__(self, ids: np.ndarray, tags: np.ndarray, first: np.ndarray, idx: np.ndarray, hashes: np.ndarray):
        self.ids, self.tags, self.first, self.idx, self.hashes = ids, tags, first, idx, hashes

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> "Block":
        w = text.split_words(batch.column(1))
        idx, distinct = w.encoded()
        return cls(text.ids(batch.column(0)), batch.column(2).to_numpy(), w.first, *text.by_frequency(idx, text.hashed(distinct)))

    def dump(self) -> bytes:
        return exchange.pack_parts(self.ids.tobytes(), self.tags.tobytes(), self.first.astype(np.int64).tobytes(), exchange.squeeze(self.idx.astype(np.uint32)), exchange.squeeze_hashes(self.hashes))

    @classmethod
    def load(cls, data: bytes) -> "Block":
        p = exchange.parts_of(data)
        return cls(*(np.frombuffer(x, np.int64) for x in p[:3]), exchange.expand(p[3], np.uint32).astype(np.int64), exchange.expand_hashes(p[4]))

    def segments(self, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first window, number of windows, anchor) of each run of windows with one anchor; the words' hashes."""
        words = self.hashes[self.idx]
        none = np.zeros(0, np.int64)
        if len(words) < window:
            return none, none, np.zeros(0, np.uint64), words
        grams = text.window_hash(words, gram)
        value, place = grams, np.arange(len(grams))
        have, width = 1, window - gram + 1
        while have < width:  # the least of each `width` grams, the first one where they tie
            step = min(have, width - have)
            a, b = value[: len(value) - step], value[step:]
            later = b < a
            value, place = np.where(later, b, a), np.where(later, place[step:], place[: len(place) - step])
            have += step
        # windows do not go over the end of a document
        inside = np.zeros(len(value) + 1, bool)
        for lo, hi in zip(self.first[:-1].tolist(), self.first[1:].tolist()):
            if hi - lo >= window:
                inside[lo : hi - window + 1] = True
        at = np.flatnonzero(inside[:-1])
        if not len(at):
            return none, none, np.zeros(0, np.uint64), words
        new = np.concatenate(([True], (np.diff(at) != 1) | (place[at[1:]] != place[at[:-1]])))
        run = at[new]
        n = np.diff(np.append(np.flatnonzero(new), len(at)))
        return run, n, grams[place[run]], words


def _merged(doc: np.ndarray, tag: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of each document, sorted, with those that meet or overlap joined."""
    if not len(doc):
        return doc, tag, lo, hi
    order = np.lexsort((lo, tag, doc))
    doc, tag, lo, hi = doc[order], tag[order], lo[order], hi[order]
    change = np.concatenate(([True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])))
    group = np.cumsum(change) - 1
    # a running maximum within each document: lift each document above the one before
    lift = group * (int(hi.max()) + 1)
    reach = np.maximum.accumulate(hi + lift) - lift
    new = change.copy()
    new[1:] |= lo[1:] > reach[:-1]
    start = np.flatnonzero(new)
    return doc[start], tag[start], lo[start], np.maximum.reduceat(hi, start)


def _spans(*columns: np.ndarray) -> pa.Table:
    return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("doc_id", "tag", "lo", "hi"), _merged(*columns))})


def _earliest(content: np.ndarray, doc: np.ndarray, tag: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the earliest member of each class, members that start later than it)."""
    order = np.lexsort((at, tag, doc, content))
    new = np.concatenate(([True], content[order][1:] != content[order][:-1]))
    first = order[new]
    least = first[np.cumsum(new) - 1]
    later = (doc[order] != doc[least]) | (tag[order] != tag[least]) | (at[order] != at[least])
    return first, order[later]


def _classes(data: bytes, said: list, window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """kind 1: classes of a block for the shards; kind 0: removed intervals that the block shows by itself."""
    block = Block.load(data)
    run, n, anchor, words = block.segments(window, gram)
    if not len(run):
        return
    distinct, inverse = np.unique(anchor, return_inverse=True)
    flag = exchange.reply_array(said, np.uint8)[inverse]
    run, n, anchor, flag = (x[flag > UNIQUE] for x in (run, n, anchor, flag))
    if not len(run):
        return
    whole = text.window_hash(words, window)
    common = flag == COMMON
    each = text.ragged(run[common], n[common])  # window by window
    begin = np.concatenate((run[~common], each))
    size = np.concatenate((n[~common], np.ones(len(each), np.int64)))
    key = np.concatenate((anchor[~common], whole[each]))
    content = text.pair_hash(text.pair_hash(whole[begin], whole[begin + size - 1]), size.astype(np.uint64))
    k = np.searchsorted(block.first, begin, "right") - 1
    doc, tag, at = block.ids[k], block.tags[k], begin - block.first[k]
    keep, later = _earliest(content, doc, tag, at)
    spans = _spans(doc[later], tag[later], at[later], at[later] + size[later] + window - 1)
    m = spans.num_rows
    if m:
        zero = pa.array(np.zeros(m, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(m, np.int32)), zero, zero, *(spans.column(c).combine_chunks() for c in ("doc_id", "tag", "lo", "hi")), pa.array([b""] * m, pa.binary())], names=["kind", "key", "content", "doc_id", "tag", "lo", "hi", "words"])
    for i in range(0, len(keep), 20_000):
        part = keep[i : i + 20_000]
        length = size[part] + window - 1
        flat = words[text.ragged(begin[part], length)].tobytes()
        offsets = np.concatenate(([0], np.cumsum(8 * length))).astype(np.int32)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.ones(len(part), np.int32)), pa.array(key[part].view(np.int64)), pa.array(content[part].view(np.int64)), pa.array(doc[part], pa.int64()), pa.array(tag[part], pa.int64()), pa.array(at[part], pa.int64()), pa.array(size[part], pa.int64()),
            pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(offsets), pa.py_buffer(flat)]),
        ], names=["kind", "key", "content", "doc_id", "tag", "lo", "hi", "words"])


def search_shard(group: pa.Table, window: int) -> pa.Table:
    """Removed intervals (doc_id, tag, lo, hi) of a shard: those of kind 0 as they are, and what is found among the classes (kind 1: doc_id, tag, lo: first word, hi: number of windows, words)."""
    known = group.filter(pc.equal(group.column("kind"), 0))
    group = group.filter(pc.equal(group.column("kind"), 1))
    out = [tuple(known.column(c).to_numpy() for c in ("doc_id", "tag", "lo", "hi"))]
    if not group.num_rows:
        return _spans(*out[0])
    content, doc, tag, at, n = (group.column(c).to_numpy() for c in ("content", "doc_id", "tag", "lo", "hi"))
    keep, later = _earliest(content, doc, tag, at)
    out.append((doc[later], tag[later], at[later], at[later] + n[later] + window - 1))
    # in document order: an earlier start then has a lesser place in the index
    keep = keep[np.lexsort((at[keep], tag[keep], doc[keep]))]
    doc, tag, at, n = doc[keep], tag[keep], at[keep], n[keep]
    blob = group.column("words").take(pa.array(keep)).combine_chunks().cast(pa.large_binary())
    offsets = np.frombuffer(blob.buffers()[1], np.int64)[blob.offset : blob.offset + len(keep) + 1]
    words = np.frombuffer(blob.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].copy().view(np.uint64)
    length = n + window - 1
    first = np.cumsum(length) - length
    stream = np.insert(np.unique(words, return_inverse=True)[1] + 1, np.append(first[1:], len(words)), 0)
    index = FMIndex(stream)
    matched, lo, hi = index.matching_statistics(stream, window, least=2)
    ends = np.flatnonzero(matched == window)
    if len(ends):
        # equal windows have one interval: its places are located once
        left, inverse = np.unique(lo[ends], return_inverse=True)
        right = np.zeros(len(left), np.int64)
        right[inverse] = hi[ends]
        places = index.locate(text.ragged(left, right - left))
        least = np.minimum.reduceat(places, np.cumsum(right - left) - (right - left))
        start = ends - window + 1
        start = start[start > least[inverse]]
        begin = first + np.arange(len(first))
        k = np.searchsorted(begin, start, "right") - 1
        lo = at[k] + start - begin[k]
        out.append((doc[k], tag[k], lo, lo + window))
    return _spans(*(np.concatenate(x) for x in zip(*out)))


def repeats(documents: DataFrame, window: int, folder: str) -> DataFrame:
    """doc_id (NULL_ID for null), tag (hash of the text), lo, hi: intervals of words to remove; they may overlap."""
    spark = documents.sparkSession
    gram = min(ANCHOR, window)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tag"))
    size = exchange.text_bytes(rows)
    buckets, shards = exchange.buckets_for(size), max(1, -(-size // SHARD_BYTES))
    fan = exchange.fan(buckets)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.blocks(batches, "text", exchange.BLOCK_BYTES):
            block, name = Block.of(batch), uuid.uuid4().hex
            anchors, counts = np.unique(block.segments(window, gram)[2], return_counts=True)
            out = [(0, -1, block.dump()), *((1, b, d) for b, d in exchange.sends(anchors, [counts], fan))]
            yield pa.RecordBatch.from_pydict({"kind": pa.array([x[0] for x in out], pa.int32()), "block": [name] * len(out), "bucket": pa.array([x[1] for x in out], pa.int32()), "data": pa.array([x[2] for x in out], pa.binary())})

    def answer(keys: np.ndarray, total: np.ndarray) -> tuple[list[np.ndarray], bytes]:
        return [np.where(total > HOT, COMMON, np.where(total > 1, REPEATED, UNIQUE)).astype(np.uint8)], b""

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, said in zip(batch.column(0), batch.column(1).to_pylist()):
                yield from _classes(data.as_buffer().to_pybytes(), said, window, gram)

    table = storage.save(rows.mapInArrow(make, exchange.SCHEMA), f"{folder}/blocks", "kind")
    replies = storage.save(exchange.totals(table.where("kind = 1"), answer, [np.uint8], buckets, folder), f"{folder}/totals")
    storage.drop(spark, f"{folder}/blocks/kind=1")
    blocks = spark.read.schema(exchange.SCHEMA).parquet(f"{folder}/blocks").where("kind = 0")
    # written, so that the blocks and the join's shuffle are gone before the classes are dealt
    both = storage.save(exchange.answered(blocks, replies), f"{folder}/answered")
    storage.drop(spark, f"{folder}/blocks")
    storage.drop(spark, f"{folder}/totals")
    made = both.mapInArrow(classes, "kind int, key long, content long, doc_id long, tag long, lo long, hi long, words binary")
    # intervals that need no search travel with the classes, by their document
    shard = F.pmod(F.when(F.col("kind") == 1, F.xxhash64("key")).otherwise(F.xxhash64("doc_id")), F.lit(shards))
    dealt = made.select(shard.alias("shard"), "kind", "content", "doc_id", "tag", "lo", "hi", "words")
    spans = storage.save(dealt.groupBy("shard").applyInArrow(lambda group: search_shard(group, window), SPANS), f"{folder}/spans")
    storage.drop(spark, f"{folder}/answered")
    return spans


def _with_spans(documents: DataFrame, window: int) -> DataFrame:
    """documents' columns and, as the last two, the removed intervals of each row: arrays of first words and of ends."""
    folder = storage.work_dir(documents.sparkSession, "substring")
    spans = repeats(documents, window, folder)
    each = spans.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    key = F.coalesce(documents["doc_id"].cast("long"), F.lit(text.NULL_ID))
    joined = documents.join(each.hint("shuffle_hash"), (key == each["doc_id"]) & (F.xxhash64(documents["text"]) == each["tag"]), "left")
    return joined.select(*(documents[c] for c in documents.columns), each["spans"]["lo"].alias("_lo"), each["spans"]["hi"].alias("_hi"))


def _gone(batch: pa.RecordBatch, w: text.Words) -> np.ndarray:
    """Of each word of a batch, is it removed?"""
    change = np.zeros(len(w.words) + 1, np.int64)
    for lists, sign in ((batch.column(batch.num_columns - 2), 1), (batch.column(batch.num_columns - 1), -1)):
        n = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
        at = np.minimum(lists.flatten().to_numpy(zero_copy_only=False) + np.repeat(w.first[:-1], n), np.repeat(w.first[1:], n))
        np.add.at(change, at.astype(np.int64), sign)
    return np.cumsum(change[:-1]) > 0


def digest(documents: DataFrame, window: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each document."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.blocks(batches, "text", BATCH_BYTES):
            w = text.split_words(batch.column(1))
            gone = _gone(batch, w)
            data, offsets = text.raw(w.words.filter(pa.array(~gone)))
            kept = np.concatenate(([0], np.cumsum(~gone)))[w.first]
            # one space after each kept word
            n = len(offsets) - 1
            joined = np.full(len(data) + n, 32, np.uint8)
            joined[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets))] = data
            view, at = memoryview(joined), (offsets + np.arange(n + 1))[kept].tolist()
            sha = [hashlib.sha256(view[a : max(a, b - 1)]).hexdigest() for a, b in zip(at, at[1:])]
            total = np.diff(w.first)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "n_words": pa.array(total), "n_removed": pa.array(total - np.diff(kept)), "kept_sha256": pa.array(sha, pa.string())})

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _with_spans(rows, window).mapInArrow(count, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def clean(documents: DataFrame, window: int = 50) -> DataFrame:
    """The documents, with all their columns: text without its repeated words (white space between kept words stays), n_chars to match; a document of which nothing is left is dropped."""
    schema = documents.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.blocks(batches, "text", BATCH_BYTES):
            where = schema.names.index("text")
            texts = batch.column(where)
            w = text.split_words(texts)
            gone = _gone(batch, w)
            out = texts.to_pylist()
            lost = np.add.reduceat(np.append(gone, False).astype(np.int64), w.first[:-1]) * (np.diff(w.first) > 0)
            for k in np.flatnonzero(lost):
                out[k] = _without(out[k], gone[w.first[k] : w.first[k + 1]])
            columns = list(batch.columns[: len(schema)])
            columns[where] = pa.array(out, texts.type)
            if "n_chars" in schema.names:
                i = schema.names.index("n_chars")
                n = pa.array([columns[i][k].as_py() if not lost[k] else len(out[k]) for k in range(len(out))], columns[i].type)
                columns[i] = n
            yield pa.RecordBatch.from_arrays(columns, names=schema.names).filter(pa.array((lost == 0) | (lost < np.diff(w.first))))

    return _with_spans(documents, window).mapInArrow(cut, schema)


def _without(value: str, gone: np.ndarray) -> str:
    """value without its removed words and the white space before them."""
    data = np.frombuffer(value.encode(), np.uint8)
    space = text.WHITESPACE[data]
    start = ~space
    start[1:] &= space[:-1]
    number = np.cumsum(start) - 1
    number = np.where(space, number + 1, number)  # white space goes with the word after it
    keep = np.append(~gone, True)[number]
    return data[keep].tobytes().decode().strip(" \t\n\x0b\f\r") if not gone.all() else ""
