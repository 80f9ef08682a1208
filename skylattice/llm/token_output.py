"""Token-ID output: fixed-width bit packing with block offsets.

A shard file holds the ids of consecutive documents, in ascending doc_id
order, each id in the fewest bits that hold the vocabulary:

    magic 8 bytes | bits u32 | block_ids u32 | n_ids u64 | n_docs u64 | n_blocks u64
    block offsets u64 [n_blocks + 1]   bytes from the start of the payload
    doc ids i64 [n_docs] | doc starts u64 [n_docs + 1]   ids from the start of the shard
    payload: blocks of block_ids ids, little-endian bits, each block byte-aligned

so that any id range is one seek to its block and one vectorised unpack.  A
manifest table lists the shards that belong to the output with the count of ids
before each; files of lost or repeated task attempts are never listed in it.

Nulls and empties: a null or empty text is the end id alone; a null doc_id
sorts first and stays null.  Repeated rows are written as often as they occur.
An empty table gives an empty manifest and no file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import storage, text, tokens

MAGIC = b"SKYTOK01"
HEAD = struct.Struct("<8sIIQQQ")
#: Ids in a block: what one random access unpacks.
BLOCK_IDS = 4096
#: Texts of a batch, in bytes; ids of one shard file at most (more go to a further file).
BATCH_BYTES = 4_000_000
SHARD_IDS = 16_000_000


def width(vocabulary: int) -> int:
    """Fewest bits that hold ids below vocabulary."""
    return max(1, int(vocabulary - 1).bit_length())


def pack_block(ids: np.ndarray, bits: int) -> bytes:
    """ids, bits each, least significant bit first."""
    ids = np.ascontiguousarray(ids, "<u4")
    if bits == 16:
        return ids.astype("<u2").tobytes()
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    planes = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(planes.ravel(), bitorder="little").tobytes()


def unpack_block(data: bytes | memoryview, bits: int, n: int) -> np.ndarray:
    """The reverse of pack_block for n ids."""
    if bits == 16:
        return np.frombuffer(data, "<u2", n).astype(np.uint32)
    planes = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = planes
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


def shard_bytes(doc_ids: np.ndarray, starts: np.ndarray, ids: np.ndarray, bits: int, block_ids: int = BLOCK_IDS) -> bytes:
    """A whole shard file."""
    payload = [pack_block(ids[i : i + block_ids], bits) for i in range(0, len(ids), block_ids)]
    offsets = np.concatenate(([0], np.cumsum([len(b) for b in payload]))).astype("<u8")
    head = HEAD.pack(MAGIC, bits, block_ids, len(ids), len(doc_ids), len(payload))
    return b"".join([head, offsets.tobytes(), np.asarray(doc_ids, "<i8").tobytes(), np.asarray(starts, "<u8").tobytes(), *payload])


class Shard:
    """Random access to a shard file's bytes."""

    def __init__(self, data: bytes):
        magic, self.bits, self.block_ids, self.n_ids, self.n_docs, n_blocks = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = HEAD.size
        self.offsets = np.frombuffer(data, "<u8", n_blocks + 1, at)
        at += self.offsets.nbytes
        self.doc_ids = np.frombuffer(data, "<i8", self.n_docs, at)
        at += self.doc_ids.nbytes
        self.starts = np.frombuffer(data, "<u8", self.n_docs + 1, at)
        self.payload = memoryview(data)[at + self.starts.nbytes :]

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo to hi of the shard: unpacks the blocks that hold them and no other."""
        if hi <= lo:
            return np.zeros(0, np.uint32)
        first, last = lo // self.block_ids, (hi - 1) // self.block_ids
        parts = []
        for b in range(first, last + 1):
            n = min(self.block_ids, self.n_ids - b * self.block_ids)
            parts.append(unpack_block(self.payload[int(self.offsets[b]) : int(self.offsets[b + 1])], self.bits, n))
        return np.concatenate(parts)[lo - first * self.block_ids : hi - first * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


def _put(folder: str, name: str, data: bytes) -> None:
    """Writes a file in a shared folder, whole or not at all."""
    from pyarrow import fs

    where, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    where.create_dir(root, recursive=True)
    with where.open_output_stream(f"{root}/.{name}") as out:
        out.write(data)
    where.move(f"{root}/.{name}", f"{root}/{name}")


def write(documents: DataFrame, folder: str, vocabulary_path: str, units: str, vocabulary: int, id_column: str = "doc_id", text_column: str = "text", block_ids: int = BLOCK_IDS) -> DataFrame:
    """Encodes documents into shard files under folder; returns the manifest (partition, part, file, n_ids, n_docs, base)."""
    bits = width(vocabulary)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part = tokens.encoder(vocabulary_path, units).encode, 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, part
            ids = np.concatenate([h[2] for h in held])
            lengths = np.concatenate([np.diff(h[1]) for h in held])
            starts = np.concatenate(([0], np.cumsum(lengths)))
            name = f"tokens-{TaskContext.get().partitionId():06d}-{part:04d}-{uuid.uuid4().hex[:12]}.bin"
            _put(folder, name, shard_bytes(np.concatenate([h[0] for h in held]), starts, ids, bits, block_ids))
            row = pa.RecordBatch.from_pydict({"partition": pa.array([TaskContext.get().partitionId()], pa.int32()), "part": pa.array([part], pa.int32()), "file": [name], "n_ids": [len(ids)], "n_docs": [len(lengths)]})
            held, size, part = [], 0, part + 1
            return row

        for batch in text.blocks(batches, "text", BATCH_BYTES):
            ids, starts = encode(batch.column(1))
            held.append((text.ids(batch.column(0)), starts, ids.astype(np.uint16 if bits <= 16 else np.uint32)))
            size += len(ids)
            if size >= SHARD_IDS:
                yield flush()
        if held:
            yield flush()

    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    made = storage.save(ordered.mapInArrow(shards, "partition int, part int, file string, n_ids long, n_docs long"), f"{folder}/manifest")
    # one row a shard: a running sum over file names, not over documents
    before = Window.orderBy("partition", "part").rowsBetween(Window.unboundedPreceding, -1)
    return made.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))


def read(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Reads the shards back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard = Shard(data.as_buffer().to_pybytes())
                starts = shard.starts.astype(np.int64)
                crc = np.empty(shard.n_docs, np.int64)
                at = 0
                while at < shard.n_docs:  # some millions of ids at a time
                    to = max(at + 1, int(np.searchsorted(starts, starts[at] + 4_000_000, "right")) - 1)
                    ids = memoryview(np.ascontiguousarray(shard.ids(starts[at], starts[to]), "<u4")).cast("B")
                    lo = starts[at]
                    for k in range(at, to):
                        crc[k] = zlib.crc32(ids[4 * (starts[k] - lo) : 4 * (starts[k + 1] - lo)])
                    at = to
                yield pa.RecordBatch.from_pydict({"doc_id": text.id_array(shard.doc_ids.astype(np.int64)), "start": pa.array(starts[:-1] + base), "n_tokens": pa.array(np.diff(starts)), "ids_crc32": pa.array(crc)})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "tokens-*.bin").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    listed = files.join(F.broadcast(manifest.select("file", "base")) if manifest.count() <= 100_000 else manifest.select("file", "base"), "file")
    return listed.select("base", "content").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(documents: DataFrame, vocabulary: str = "byte_bpe_50k.json", units: str = "lead", size: int = 50_257) -> DataFrame:
    """Writes documents as token shards in a new shared folder and reads them back."""
    spark = documents.sparkSession
    folder = storage.work_dir(spark, "tokens")
    manifest = write(documents, folder, tokens.vocabulary_path(vocabulary), units, size)
    if not manifest.head(1):
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read(spark, folder, manifest)
