"""Counts of 64-bit hashes over all data, in packed form.

Counting n-grams or anchors row by row would shuffle a row for each of them.
Here a block of documents sends, for each bucket of the hash space, *one* row
with its distinct hashes, sorted and delta-coded, and their counts; a bucket
adds up what all blocks sent and answers each of them with one row of totals in
the same order.  So a hash crosses the network once a block, in about six bytes,
however often the block has it: a key that a third of all data has costs a
bucket one entry a block.  Buckets are ranges of the hash space, their number
follows the input's bytes, and a bucket's size does not depend on any one key.

A block sends to FAN buckets at most, so rows grow with the input and not with
its square.  Where more buckets are needed, the messages of many blocks to one
range are first merged (bounded groups of them), the merged ones are sent on to
the parts of the range, and answers come back the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage

#: Rows of a block table: kind 0 is the block itself, kind 1 what it sends to a bucket.
SCHEMA = "kind int, block string, bucket int, data binary"
#: Text bytes of a block, and text bytes for each bucket.
BLOCK_BYTES = 6_000_000
BUCKET_BYTES = 8_000_000
#: Buckets that one message is split over, and bytes of messages that are merged in one group.
FAN = 2_048
MERGE_BYTES = 64_000_000


def squeeze(values: np.ndarray) -> bytes:
    """Any numbers, byte planes apart, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def expand(data: bytes, dtype: type) -> np.ndarray:
    """The reverse of squeeze."""
    size = np.dtype(dtype).itemsize
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(flat.reshape(size, -1).T).view(dtype).ravel()


def squeeze_hashes(hashes: np.ndarray) -> bytes:
    """Hashes that ascend for long stretches, as differences (modulo 2^64)."""
    return squeeze(np.diff(hashes, prepend=np.uint64(0)))


def expand_hashes(data: bytes) -> np.ndarray:
    return np.cumsum(expand(data, np.uint64), dtype=np.uint64)


def pack_parts(*parts: bytes) -> bytes:
    head = np.array([len(parts), *map(len, parts)], np.int64).tobytes()
    return head + b"".join(parts)


def parts_of(data: bytes) -> list[bytes]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    sizes = np.frombuffer(data, np.int64, n, 8).tolist()
    out, at = [], 8 * (n + 1)
    for s in sizes:
        out.append(data[at : at + s])
        at += s
    return out


def buckets_for(text_bytes: int) -> int:
    return max(4, -(-text_bytes // BUCKET_BYTES))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the hash space: sorted keys are in the order of their buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def fan(buckets: int) -> int:
    """Buckets that a block's message is split over."""
    return min(buckets, FAN)


def sends(keys: np.ndarray, counts: list[np.ndarray], buckets: int) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed hashes and counts, of one or more kinds) of sorted distinct keys."""
    edges = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)).tolist():
        lo, hi = edges[b], edges[b + 1]
        yield b, pack_parts(squeeze_hashes(keys[lo:hi]), *(squeeze(c[lo:hi].astype(np.uint64)) for c in counts))


def _added(sent: list[list[bytes]]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """(distinct keys, their totals of each kind, the place of each sent key among them, where each message starts)."""
    keys = [expand_hashes(p[0]) for p in sent]
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = [np.bincount(inverse, np.concatenate([expand(p[k], np.uint64) for p in sent]), len(distinct)).astype(np.int64) for k in range(1, len(sent[0]))]
    return distinct, total, inverse, np.cumsum([0, *map(len, keys)])


MESSAGE = "block string, bucket int, data binary"


def _messages(rows: list[tuple]) -> pa.Table:
    block, bucket, data = zip(*rows) if rows else ((), (), ())
    return pa.table({"block": pa.array(block, pa.string()), "bucket": pa.array(bucket, pa.int32()), "data": pa.array(data, pa.binary())})


def totals(table: DataFrame, answer: Callable[..., tuple[list[np.ndarray], bytes]], dtypes: list[type], buckets: int, folder: str) -> DataFrame:
    """block, bucket, data: for each block (of table: block, bucket, data) the answers about what it sent, in the same order.

    answer(keys, *totals) gets a bucket's sorted keys with their totals of each
    kind and returns an array of each of dtypes, with a number for each key, and
    a note; the note is a row with an empty block.
    """

    def add_up(group: pa.Table) -> pa.Table:
        distinct, total, inverse, at = _added([parts_of(d.as_buffer().to_pybytes()) for d in group.column("data")])
        said, note = answer(distinct, *total)
        bucket = group.column("bucket")[0].as_py()
        data = [(name, bucket, pack_parts(*(squeeze(x[inverse[a:b]]) for x in said))) for name, a, b in zip(group.column("block").to_pylist(), at, at[1:])]
        return _messages([*data, ("", bucket, note)])

    table = table.select("block", "bucket", "data")
    if buckets <= FAN:
        return table.groupBy("bucket").applyInArrow(add_up, MESSAGE)
    parts = -(-buckets // FAN)
    table = storage.save(table, f"{folder}/sent")  # read three times
    size = table.agg(F.sum(F.octet_length("data")).alias("b")).head()["b"] or 0
    groups = max(1, -(-size // (FAN * MERGE_BYTES)))
    table = table.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(groups)))

    def merge(group: pa.Table) -> pa.Table:
        bucket, part = group.column("bucket")[0].as_py(), group.column("part")[0].as_py()
        distinct, total, _, _ = _added([parts_of(d.as_buffer().to_pybytes()) for d in group.column("data")])
        edges = np.searchsorted(bucket_of(distinct, FAN * parts), bucket * parts + np.arange(parts + 1))
        return _messages([(f"{bucket}-{part}", bucket * parts + k, pack_parts(squeeze_hashes(distinct[a:b]), *(squeeze(t[a:b].astype(np.uint64)) for t in total))) for k, (a, b) in enumerate(zip(edges, edges[1:])) if b > a])

    def pass_on(group: pa.Table, replies: pa.Table) -> pa.Table:
        if not group.num_rows:
            return _messages([])
        _, _, inverse, at = _added([parts_of(d.as_buffer().to_pybytes()) for d in group.column("data")])
        said = [reply_array(replies.select(["bucket", "data"]).to_pylist(), t, k) for k, t in enumerate(dtypes)]
        bucket = group.column("bucket")[0].as_py()
        return _messages([(name, bucket, pack_parts(*(squeeze(x[inverse[a:b]]) for x in said))) for name, a, b in zip(group.column("block").to_pylist(), at, at[1:])])

    merged = storage.save(table.groupBy("bucket", "part").applyInArrow(merge, MESSAGE), f"{folder}/merged")
    replies = storage.save(merged.groupBy("bucket").applyInArrow(add_up, MESSAGE), f"{folder}/merged-totals")
    name = F.split("block", "-")
    back = replies.where("block <> ''").select(name[0].cast("int").alias("range"), name[1].cast("long").alias("part"), "bucket", "data")
    down = table.groupBy("bucket", "part").cogroup(back.groupBy("range", "part")).applyInArrow(pass_on, MESSAGE)
    return down.unionByName(replies.where("block = ''"))


def answered(blocks: DataFrame, replies: DataFrame) -> DataFrame:
    """data, replies (array of structs with bucket and data) of each block. A block gets at most one reply a bucket."""
    each = replies.where("block <> ''").groupBy("block").agg(F.collect_list(F.struct("bucket", "data")).alias("replies"))
    return blocks.select("block", "data").join(each, "block", "left").select("data", "replies")


def reply_array(replies: list | None, dtype: type, kind: int = 0) -> np.ndarray:
    """A block's replies (their array of one kind) as one array in the order of its sorted keys."""
    parts = [expand(parts_of(r["data"])[kind], dtype) for r in sorted(replies or [], key=lambda r: r["bucket"])]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def text_bytes(documents: DataFrame) -> int:
    return storage.column_bytes(documents, "text")
