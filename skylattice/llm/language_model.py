"""Language-model scores by deleted interpolation.

P(w | v) mixes three maximum-likelihood estimates, bigram, unigram and uniform,
with weights for each class of context frequency (powers of two of the count of
v).  The weights come from expectation-maximisation on held-out counts: one
sixth of the training documents (fold EM_FOLD) is set apart, its n-grams are
predicted from the counts of the other training documents, and the weights that
make them likeliest are used with the counts of all training documents.

All counts are over all training tokens, without a cap or a floor: blocks of
documents send their distinct n-grams to buckets and get totals back (see
exchange).  A round of EM is one pass over the held-out n-grams (context class,
both estimates and a count, a packed row a block) that returns a row a class.

Nulls and empties: a null or empty text is the end token alone.  A null doc_id
counts as the empty id.  Repeated rows count as often as they occur.  Without
training rows, all counts are 0 and scores are uniform.  An empty table gives an
empty result.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange, storage, text

#: Hashes of the token before a text and of the token after it.
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
#: Classes of context counts: 0, 1, 2-3, 4-7, ...
CLASSES = 48
#: The fold that is no training.
HELD_OUT = 2
#: Training documents that the weights are learned on.
EM_FOLD = 3
#: EM ends when no weight moves by more than this in a round, or after so many rounds.
EM_STEP, EM_ROUNDS = 1e-3, 40
SALT = np.uint64(0xA5A5A5A5A5A5A5A5)
#: N-grams are counted by 56-bit keys; the last byte tells unigrams (0) from bigrams (1).
KEY_BITS = ~np.uint64(0xFF)


def fold_of(doc_id: int | None) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7


def unigram_keys(hashes: np.ndarray) -> np.ndarray:
    return text.mix(hashes ^ SALT) & KEY_BITS


class Block:
    """Tokens of some documents as numbers of their distinct hashes, and the n-grams in them."""

    def __init__(self, ids: np.ndarray, fold: np.ndarray, n: np.ndarray, idx: np.ndarray, hashes: np.ndarray):
        self.ids, self.fold, self.n, self.idx, self.hashes = ids, fold, n, idx, hashes
        self.out, self.apart = fold == HELD_OUT, fold == EM_FOLD

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> "Block":
        w = text.split_words(batch.column(1), lower=True)
        idx, distinct = w.encoded()
        idx, hashes = text.by_frequency(idx, text.hashed(distinct))
        hashes = np.insert(hashes, 0, END)  # number 0 ends a text
        ids = batch.column(0).to_pylist()
        idx = np.insert(idx + 1, w.first[1:], 0)
        return cls(text.ids(batch.column(0)), np.array([fold_of(i) for i in ids], np.int8), np.diff(w.first) + 1, idx, hashes)

    def dump(self) -> bytes:
        return exchange.pack_parts(self.ids.tobytes(), self.fold.tobytes(), self.n.tobytes(), exchange.squeeze(self.idx.astype(np.uint32)), exchange.squeeze_hashes(self.hashes))

    @classmethod
    def load(cls, data: bytes) -> "Block":
        p = exchange.parts_of(data)
        return cls(np.frombuffer(p[0], np.int64), np.frombuffer(p[1], np.int8), np.frombuffer(p[2], np.int64), exchange.expand(p[3], np.uint32).astype(np.int64), exchange.expand_hashes(p[4]))

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(sorted distinct keys of unigrams and bigrams; the key's place for each token, its context and its bigram)."""
        unigram = unigram_keys(self.hashes)
        start = unigram_keys(np.array([START]))
        token = self.hashes[self.idx]
        previous = np.empty_like(token)
        previous[1:] = token[:-1]
        first = np.cumsum(self.n) - self.n
        previous[first] = START
        bigram = text.pair_hash(previous, token) & KEY_BITS | np.uint64(1)
        words = np.append(unigram, start)
        distinct, inverse = np.unique(np.concatenate((words, bigram)), return_inverse=True)
        of_word, of_bigram = inverse[: len(words)], inverse[len(words) :]
        of_token = of_word[self.idx]
        of_context = np.empty_like(of_token)
        of_context[1:] = of_token[:-1]
        of_context[first] = of_word[-1]
        return distinct, of_token, of_context, of_bigram

    def counts(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Sorted keys with their counts in training documents (0 for what only held-out documents have), and in those set apart."""
        distinct, of_token, _, of_bigram = self.keys()
        start, kinds = np.searchsorted(distinct, unigram_keys(np.array([START]))[0]), []
        for which in (~self.out, self.apart):
            of = np.repeat(which, self.n)
            counts = np.bincount(of_token[of], minlength=len(distinct)) + np.bincount(of_bigram[of], minlength=len(distinct))
            counts[start] = int(which.sum())
            kinds.append(counts)
        return distinct, kinds


def _answer(keys: np.ndarray, counts: np.ndarray, apart: np.ndarray) -> tuple[list[np.ndarray], bytes]:
    """Totals of both kinds; as a note the number of distinct training words, of training tokens and of those set apart."""
    start = unigram_keys(np.array([START]))
    word = (keys & np.uint64(1) == 0) & (keys != start[0])
    note = np.array([int((counts[word] > 0).sum()), int(counts[word].sum()), int(apart[word].sum())], np.int64)
    return [counts.astype(np.uint64), apart.astype(np.uint64)], note.tobytes()


def classes(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(np.log2(context + 1.0)), CLASSES - 1).astype(np.int64)


def grouped(k: np.ndarray, two: np.ndarray, one: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Equal (class, bigram estimate, unigram estimate) as one, with their number."""
    order = np.lexsort((one, two, k))
    k, two, one = k[order], two[order], one[order]
    new = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (two[1:] != two[:-1]) | (one[1:] != one[:-1])))) if len(k) else np.zeros(0, np.int64)
    return k[new], two[new], one[new], np.diff(np.append(new, len(k)))


def expected(weights: np.ndarray, k: np.ndarray, two: np.ndarray, one: np.ndarray, n: np.ndarray, uniform: float) -> np.ndarray:
    """A row a class: expected numbers of n-grams from each estimate, and their number."""
    share = weights[k] * np.stack((two, one, np.full(len(two), uniform)), 1)
    total = share.sum(1)
    share *= (n / total)[:, None]
    return np.stack([*(np.bincount(k, share[:, j], CLASSES) for j in range(3)), np.bincount(k, n, CLASSES)], 1)


def fit(expect: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Weights (bigram, unigram, uniform) of each context class by EM; expect(weights) is a pass over all held-out n-grams."""
    weights = np.full((CLASSES, 3), 1 / 3)
    for _ in range(EM_ROUNDS):
        before, sums = weights, expect(weights)
        weights = (sums[:, :3] + 1e-3) / (sums[:, :3] + 1e-3).sum(1, keepdims=True)
        if np.abs(weights - before).max() < EM_STEP:
            break
    seen = np.flatnonzero(sums[:, 3])
    if not len(seen):
        return weights
    # a class without n-grams has the weights of the next one below that has some, the lowest ones those of the first that has
    return weights[seen[np.maximum(np.searchsorted(seen, np.arange(CLASSES), "right") - 1, 0)]]


def score(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each document."""
    spark = documents.sparkSession
    folder = storage.work_dir(spark, "lm")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    buckets = exchange.buckets_for(exchange.text_bytes(rows))
    fan = exchange.fan(buckets)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.blocks(batches, "text", exchange.BLOCK_BYTES):
            yield pa.RecordBatch.from_pydict({"block": pa.array([uuid.uuid4().hex]), "data": pa.array([Block.of(batch).dump()], pa.binary())})

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                for b, d in exchange.sends(*Block.load(data.as_buffer().to_pybytes()).counts(), fan):
                    yield pa.RecordBatch.from_pydict({"block": pa.array([name]), "bucket": pa.array([b], pa.int32()), "data": pa.array([d], pa.binary())})

    # what blocks send goes straight into the shuffle: a lost task reads its blocks, and their names, again
    blocks = storage.save(rows.mapInArrow(make, "block string, data binary"), f"{folder}/blocks")
    sent = blocks.mapInArrow(send, exchange.MESSAGE)
    replies = storage.save(exchange.totals(sent, _answer, [np.uint64, np.uint64], buckets, folder), f"{folder}/totals")
    notes = replies.where("block = ''").select("data")
    found = np.array([np.frombuffer(r["data"], np.int64) for r in notes.toLocalIterator()], np.int64).reshape(-1, 3).sum(0)  # one small row a bucket
    v, n, n_apart = map(int, found)
    uniform = 1.0 / (v + 1)
    both = exchange.answered(blocks, replies)

    def load(data: bytes, said: list, kind: int = 0) -> tuple[Block, list[np.ndarray]]:
        """A block and, of each token, the totals of one kind of the token, its context and its bigram."""
        block = Block.load(data)
        total = exchange.reply_array(said, np.uint64, 0).astype(np.float64)
        if kind:  # the counts without those set apart
            total -= exchange.reply_array(said, np.uint64, 1)
        _, *places = block.keys()
        return block, [total[p] for p in places]

    def set_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, said in zip(batch.column(0), batch.column(1).to_pylist()):
                block, counts = load(data.as_buffer().to_pybytes(), said, 1)
                if not block.apart.any():
                    continue
                of = np.repeat(block.apart, block.n)
                token, context, bigram = (c[of] for c in counts)
                k, two, one, number = grouped(classes(context), bigram / np.maximum(context, 1), token / max(n - n_apart, 1))
                packed = exchange.pack_parts(exchange.squeeze(k.astype(np.int64)), exchange.squeeze(two), exchange.squeeze(one), exchange.squeeze(number.astype(np.int64)))
                yield pa.RecordBatch.from_pydict({"data": pa.array([packed], pa.binary())})

    cells = storage.save(both.mapInArrow(set_apart, "data binary"), f"{folder}/apart")

    def expect(weights: np.ndarray) -> np.ndarray:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((CLASSES, 4))
            for batch in batches:
                for data in batch.column(0):
                    parts = exchange.parts_of(data.as_buffer().to_pybytes())
                    k, two, one, number = (exchange.expand(p, t) for p, t in zip(parts, (np.int64, np.float64, np.float64, np.int64)))
                    sums += expected(weights, k, two, one, number, uniform)
            yield pa.RecordBatch.from_pydict({"k": pa.array(np.arange(CLASSES)), **{f"s{j}": pa.array(sums[:, j].copy()) for j in range(4)}})

        rows = cells.mapInArrow(add, "k long, s0 double, s1 double, s2 double, s3 double")
        out = np.zeros((CLASSES, 4))
        for r in rows.groupBy("k").agg(*(F.sum(f"s{j}") for j in range(4))).collect():
            out[r[0]] = r[1:]
        return out

    weights = fit(expect)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, said in zip(batch.column(0), batch.column(1).to_pylist()):
                block, (token, context, bigram) = load(data.as_buffer().to_pybytes(), said)
                w = weights[classes(context)]
                two = np.where(context > 0, bigram / np.maximum(context, 1), 0.0)
                # an unseen context gives its bigram weight to the others
                rest = np.where(context > 0, 1.0, 1.0 / np.maximum(w[:, 1] + w[:, 2], 1e-12))
                p = w[:, 0] * two + rest * (w[:, 1] * token / max(n, 1) + w[:, 2] * uniform)
                first = np.cumsum(block.n) - block.n
                sums = lambda x: np.add.reduceat(x, first)  # noqa: E731  every document has a token
                yield pa.RecordBatch.from_pydict({
                    "doc_id": text.id_array(block.ids), "held_out": pa.array(block.out), "n_tokens": pa.array(block.n), "n_known": pa.array(sums((token > 0).astype(np.int64))),
                    "train_tokens": pa.array(np.full(len(block.n), n)), "base_score": pa.array(sums(np.log10((token + 1) / (n + v + 1)))), "score": pa.array(sums(np.log10(p))),
                })

    return both.mapInArrow(rate, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
