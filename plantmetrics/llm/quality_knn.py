"""Quality classifier: similarity-weighted votes of the nearest labelled texts in a latent space.

A text becomes shares of hashed three-byte strings and a few signs of form (words equal to the word before, capitals, digits,
line ends), as square roots weighted by inverse document frequency. A truncated singular value decomposition of at most
`max_labelled` labelled texts gives the latent space. All their vectors, at most max_labelled * (rank + 1) numbers, go to every
task with the projection; a batch of texts is compared with them exactly, by one matrix product per block, and the labels of the
`neighbours` nearest are averaged with weights (1 + cosine) / 2 to the power `sharpness`.

Only the sample of labelled texts is bounded: the labelled ids whose xxhash64 is smallest. Every text is scored whole.

Defined cases: a null or empty text, and every text if there is no labelled one, gets the mean label (0.5 without labels); labels
that repeat an id are averaged; null ids and null labels teach nothing; null ids are scored; ties among neighbours go to the
earlier vector in hash order; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmetrics.llm.words import _buffers, shingle_hashes, word_hashes

SLOTS = 2048
FORMS = 6
_FORM_WEIGHT = 2.0
_PIECE = 1 << 20


@dataclass(frozen=True)
class Model:
    """Inverse document frequencies, projection, unit vectors of labelled texts and their labels."""

    weights: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float
    neighbours: int
    sharpness: float


def features(texts: pa.Array) -> np.ndarray:
    """(len, SLOTS + FORMS) shares of every text, float32, rows of zeros for texts without a byte."""
    data, offsets = _buffers(texts)
    out = np.zeros((len(texts), SLOTS + FORMS), np.float32)
    words, word_offsets = word_hashes(texts, lower=False)
    upper, digit, end, mark = (np.zeros(256, bool) for _ in range(4))
    upper[ord("A"):ord("Z") + 1] = True
    digit[ord("0"):ord("9") + 1] = True
    end[ord("\n")] = True
    mark[list(b"!#$%&*<>|{}[]\\^~_=+")] = True
    for row in range(len(texts)):
        begin, stop = offsets[row], offsets[row + 1]
        size = stop - begin
        if not size:
            continue
        counts = np.zeros(SLOTS)
        forms = np.zeros(FORMS)
        for at in range(begin, stop, _PIECE):
            piece = data[at:min(at + _PIECE + 2, stop)].astype(np.uint32)
            grams = piece[:-2] * np.uint32(0x9E3779B1) + piece[1:-1] * np.uint32(0x85EBCA6B) + piece[2:] * np.uint32(0xC2B2AE35)
            counts += np.bincount((grams ^ (grams >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(21), minlength=SLOTS)
            own = data[at:min(at + _PIECE, stop)]
            for k, table in enumerate((upper, digit, end, mark)):
                forms[k] += np.count_nonzero(table[own])
        spoken = words[word_offsets[row]:word_offsets[row + 1]]
        forms[:4] /= size
        if len(spoken) > 1:
            forms[4] = np.mean(spoken[1:] == spoken[:-1])
            threes = shingle_hashes(spoken, 3)
            forms[5] = 1 - len(np.unique(threes)) / len(threes)
        out[row, :SLOTS] = np.sqrt(counts / max(counts.sum(), 1))
        out[row, SLOTS:] = _FORM_WEIGHT * np.sqrt(forms)
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _directions(rows: np.ndarray, rank: int, rounds: int = 12) -> np.ndarray:
    """First right singular vectors, by subspace iteration from fixed random ones."""
    rank = min(rank, *rows.shape)
    found = np.random.default_rng(3).standard_normal((rows.shape[1], min(rank + 16, *rows.shape))).astype(np.float32)
    for _ in range(rounds):
        found, _ = np.linalg.qr(rows.T @ (rows @ found))
    _, _, turned = np.linalg.svd(rows @ found, full_matrices=False)
    return np.ascontiguousarray((found @ turned.T)[:, :rank]).astype(np.float32)


def _labelled(labels: DataFrame, key: str, label: str, max_labelled: int) -> DataFrame:
    rows = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    one = rows.groupBy(F.col(key).alias("key")).agg(F.avg(F.col(label).cast("double")).alias("label"))
    return one.orderBy(F.xxhash64("key"), "key").limit(max_labelled)


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", max_labelled: int = 4000,
    rank: int = 64, neighbours: int = 25, sharpness: float = 60.0,
) -> Model:
    """Model from the texts of at most `max_labelled` labelled ids; at most that many feature rows reach the driver."""
    known = F.broadcast(_labelled(labels, key, label, max_labelled))  # max_labelled rows of two numbers
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(known, "key")

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                found = features(part.column("text")).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("label"), pa.array([r.tobytes() for r in found], pa.binary())], ["key", "label", "found"]
                )

    kind = f"key {dict(rows.dtypes)['key']}, label double, found binary"
    taught = rows.mapInArrow(described, kind).orderBy(F.xxhash64("key"), "key", "found").limit(max_labelled).toArrow()
    if not taught.num_rows:
        empty = np.zeros((0, rank), np.float32)
        return Model(np.ones(SLOTS + FORMS, np.float32), np.zeros((SLOTS + FORMS, rank), np.float32), empty, np.zeros(0), 0.5, neighbours, sharpness)
    found = np.stack([np.frombuffer(r.as_py(), np.float16) for r in taught.column("found")]).astype(np.float32)
    marks = taught.column("label").to_numpy()
    weights = np.log((1 + len(found)) / (1 + np.count_nonzero(found, axis=0))).astype(np.float32) + 1
    weighted = _unit(found * weights)
    projection = _directions(weighted, rank)
    return Model(weights, projection, _unit(weighted @ projection), marks, float(marks.mean()), neighbours, sharpness)


def votes(model: Model, found: np.ndarray, block: int = 512) -> np.ndarray:
    """Score of every feature row: mean label of its nearest labelled vectors, weighted by similarity."""
    out = np.full(len(found), model.prior)
    if not len(model.vectors):
        return out
    k = min(model.neighbours, len(model.vectors))
    for at in range(0, len(found), block):
        rows = found[at:at + block]
        cosine = _unit((rows * model.weights) @ model.projection) @ model.vectors.T
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = ((1 + np.take_along_axis(cosine, near, 1).astype(np.float64)) / 2).clip(1e-9, 1) ** model.sharpness
        score = (weight * model.labels[near]).sum(1) / weight.sum(1)
        out[at:at + block] = np.where(rows.any(axis=1), score, model.prior)
    return out.clip(0, 1)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row; the model travels as one broadcast variable of bounded size."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(votes(shared.value, features(part.column("text"))))], ["key", "score"])

    return rows.mapInArrow(scored, f"key {dict(rows.dtypes)['key']}, score double").withColumnRenamed("key", key)


def keep_good(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """Rows whose score is at least `least`, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at_text = docs.columns.index(text)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                yield part.filter(pa.array(votes(shared.value, features(part.column(at_text))) >= least))

    return docs.mapInArrow(kept, docs.schema)
