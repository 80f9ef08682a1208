"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled documents of good quality; the unlabelled set is
web text as it comes: all texts of the training folds.  A logistic model over
character and word statistics of the whole text minimises the non-negative
unbiased risk (Kiryo et al., 2017)

    pi R_p+  +  max(0, R_u-  -  pi R_p-)

with the class prior pi estimated by the share of good ones among the labelled
rows of the training folds.  For the logistic loss the unbiased risk is convex,
so it is minimised by Newton steps; a step that would bring the second part
below 0, where the estimate overfits, is halved until it does not.  Features are
extracted once and written; a step is one pass over them that returns sums only,
so every training text counts, at any size.

Nulls and empties: a null or empty text has all-zero features and gets a score
like any other.  A null doc_id counts as the empty id for the folds.  A label that
is null or repeated is no fault: null ones are skipped.  Repeated rows count as
often as they occur.  Without labelled positives in the training folds every
document gets score 1.  An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import storage, text

THRESHOLD = 0.3
#: Passes over the training features at most, weight of the penalty, and the gain of the risk that ends the steps.
MOST_PASSES, PENALTY, LEAST_GAIN = 30, 1e-3, 1e-5
BATCH_BYTES = 6_000_000

#: Classes of bytes: each ASCII sign is its own; letters, digits, space, other control characters and non-ASCII are groups.
CLASS = np.zeros(256, np.int64)
CLASS[48:58] = 1
CLASS[65:91] = 2
CLASS[97:123] = 3
CLASS[128:] = 4
CLASS[32] = 5
CLASS[10] = 6
_signs = [b for b in range(33, 127) if not chr(b).isalnum()]
CLASS[_signs] = np.arange(7, 7 + len(_signs))
N_CLASSES = 7 + len(_signs)
N_WORD = 6
N_FEATURES = N_CLASSES + N_WORD


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0


def features(texts: pa.Array) -> np.ndarray:
    """A row for each text: square roots of class shares, and word statistics."""
    data, offsets = text.raw(texts)
    n = len(offsets) - 1
    size = np.diff(offsets)
    doc = np.repeat(np.arange(n), size)
    shares = np.bincount(doc * N_CLASSES + CLASS[data], minlength=n * N_CLASSES).reshape(n, N_CLASSES) / np.maximum(size, 1)[:, None]
    w = text.split_words(texts, lower=True)
    idx, distinct = w.encoded()
    words = np.diff(w.first)
    some = np.maximum(words, 1)
    owner = np.repeat(np.arange(n), words)
    pair, count = np.unique(owner * (len(distinct) + 1) + idx, return_counts=True)
    pair_owner = pair // (len(distinct) + 1)
    most = np.zeros(n)
    np.maximum.at(most, pair_owner, count)
    again = np.zeros(len(idx), bool)
    again[1:] = (idx[1:] == idx[:-1]) & (owner[1:] == owner[:-1])
    length = np.bincount(owner, np.diff(text.raw(w.words)[1]), n) if len(idx) else np.zeros(n)
    stats = np.stack([
        np.log1p(words) / 5, length / some / 10, np.bincount(pair_owner, minlength=n) / np.sqrt(some) / 5,
        most / some, np.bincount(owner[again], minlength=n) / some, np.sqrt(np.bincount(owner[again], minlength=n) / some),
    ], 1)
    return np.concatenate((np.sqrt(shares), stats), 1)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    mean: np.ndarray
    scale: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def sums_of(x: np.ndarray, positive: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sums over rows (standardised, with a last column of ones) at the weights w.

    Unlabelled: number, softplus(f), gradient, Hessian; positives: number, f, softplus(f), features.
    """
    f = x @ w
    s = 1 / (1 + np.exp(-np.clip(f, -500, 500)))
    p = x[positive]
    return np.concatenate(([len(x), np.logaddexp(0, f).sum()], x.T @ s, ((x * (s * (1 - s))[:, None]).T @ x).ravel(), [len(p), f[positive].sum(), np.logaddexp(0, f[positive]).sum()], p.sum(0)))


def fit(sums: Callable[[np.ndarray], np.ndarray], size: int, prior: float) -> np.ndarray:
    """Weights of least non-negative risk; sums(w) is a pass over all training rows (see sums_of)."""
    penalty = np.append(np.full(size - 1, PENALTY), 0.0)

    def at(w: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
        """(risk with penalty, its second part, gradient, Hessian)."""
        v = sums(w)
        n, loss, grad, hessian = v[0], v[1], v[2 : 2 + size], v[2 + size : 2 + size + size * size].reshape(size, size)
        n_p, f_p, loss_p, x_p = (*v[2 + size + size * size :][:3], v[2 + size + size * size + 3 :])
        risk = loss / n - prior * f_p / n_p + 0.5 * (penalty * w * w).sum()
        return risk, loss / n - prior * loss_p / n_p, grad / n - prior * x_p / n_p + penalty * w, hessian / n + np.diag(penalty + 1e-9)

    w = np.zeros(size)
    risk, _, gradient, hessian = at(w)
    step, scale = np.linalg.solve(hessian, -gradient), 1.0
    for _ in range(MOST_PASSES - 1):
        new = w + scale * step
        found = at(new)
        if found[0] > risk or found[1] < 0:
            scale /= 2
            if scale < 1 / 32:
                break
            continue
        gain, w, scale = risk - found[0], new, 1.0
        risk, _, gradient, hessian = found
        step = np.linalg.solve(hessian, -gradient)
        if gain < LEAST_GAIN:
            break
    return w


def featured(documents: DataFrame, folder: str) -> DataFrame:
    """doc_id, x (features as float32 bytes) of each row, written once."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.blocks(batches, "text", BATCH_BYTES):
            x = features(batch.column(1)).astype(np.float32)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "x": pa.array(list(map(bytes, x)), pa.binary())})

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return storage.save(rows.mapInArrow(extract, "doc_id long, x binary"), f"{folder}/features")


def matrix(column: pa.Array) -> np.ndarray:
    """The features of a batch, a row each."""
    return np.frombuffer(b"".join(v.as_buffer() for v in column), np.float32).reshape(-1, N_FEATURES).astype(np.float64)


def total(rows: DataFrame, part: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum of part(batch), a vector, over all batches: added up in each task, then by place."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                v = part(batch.slice(at, 20_000))
                out = v if out is None else out + v
        if out is not None:
            yield pa.RecordBatch.from_pydict({"k": pa.array(np.arange(len(out))), "v": pa.array(out)})

    found = rows.mapInArrow(add, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).orderBy("k").collect()  # a row a place
    return np.array([r["v"] for r in found])


def _training(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 != 0


def train(rows: DataFrame, labels: DataFrame, folder: str) -> Model | None:
    """A model from the training folds of featured rows, or None without positives there."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").where(_training(F.col("doc_id")) & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    prior = known.agg(F.avg((F.col("quality") == 1).cast("double")).alias("p"), F.count("*").alias("n")).head()
    if not prior["n"] or not prior["p"]:
        return None
    good = known.where("quality = 1").select("doc_id").distinct().withColumn("good", F.lit(True))
    rows = rows.where(_training(F.col("doc_id"))).join(good, "doc_id", "left").select("x", F.coalesce("good", F.lit(False)).alias("good"))
    rows = storage.save(rows, f"{folder}/training")

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x = matrix(batch.column(0))
        return np.concatenate(([len(x), batch.column(1).to_numpy(zero_copy_only=False).sum()], x.sum(0), (x * x).sum(0)))

    v = total(rows, moments)
    if not len(v) or not v[1]:
        return None
    mean = v[2 : 2 + N_FEATURES] / v[0]
    scale = np.sqrt(np.maximum(v[2 + N_FEATURES :] / v[0] - mean * mean, 0)) + 1e-3

    def sums(w: np.ndarray) -> np.ndarray:
        def part(batch: pa.RecordBatch) -> np.ndarray:
            x = np.clip((matrix(batch.column(0)) - mean) / scale, -8, 8)
            return sums_of(np.hstack((x, np.ones((len(x), 1)))), batch.column(1).to_numpy(zero_copy_only=False).astype(bool), w)

        return total(rows, part)

    w = fit(sums, N_FEATURES + 1, float(np.clip(prior["p"], 0.05, 0.95)))
    return Model(w[:-1], float(w[-1]), mean, scale)


def score(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of each document."""
    folder = storage.work_dir(documents.sparkSession, "quality")
    rows = featured(documents, folder)
    model = train(rows, labels, folder)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.ones(batch.num_rows) if model is None else model.score(matrix(batch.column(1)))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "held_out": pa.array([held_out(i) for i in batch.column(0).to_pylist()], pa.bool_()), "score": pa.array(s), "predicted": pa.array((s >= threshold).astype(np.int32))})

    return rows.mapInArrow(rate, "doc_id long, held_out boolean, score double, predicted int")


def keep(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, that score at least threshold."""
    folder = storage.work_dir(documents.sparkSession, "quality")
    model = train(featured(documents, folder), labels, folder)

    def accept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.blocks(batches, "text", BATCH_BYTES):
            x = features(batch.column(batch.schema.get_field_index("text"))).astype(np.float32).astype(np.float64)
            yield batch if model is None else batch.filter(pa.array(model.score(x) >= threshold))

    return documents.mapInArrow(accept, documents.schema)
