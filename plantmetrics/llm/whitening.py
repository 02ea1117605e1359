"""Embedding whitening: covariance of the distinct vectors, its leading components, and every vector projected on them.

An entry c becomes the whole number y = floor(scale * c) (the contract's x is y plus a constant, which centring removes). The fit list
is each distinct y vector once: a vector is coded as bytes of the smallest width that holds it, so equal vectors are equal codes, and
copies meet in a grouped count with map-side combine. The list is stored once and read three times: sums per dimension (exact),
centred covariance, and the covariance of the whitened list, which measures the result. A task hands on one set of partial sums;
Spark adds them, and d * (d + 1) / 2 numbers reach the driver, where d is the dimension. There Householder reflections, Sturm counts
and inverse iteration give the components (`symmetric.py`), at most `components` * d numbers that go to every task.

Defined cases: rows whose vector is null, or holds a null, a non-finite entry or one that is no long after scaling are left out; so are
vectors of another length than the commonest one among distinct vectors (ties: the longer); components whose eigenvalue is zero to
working precision do not exist (so one distinct vector has none, and no rows); null ids and repeated ids are kept; an empty table gives
no rows; an exact deviation beyond the range of a long is null; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmetrics.functions.sizing import stored
from plantmetrics.llm.symmetric import leading

SCALE = 64
_WIDTHS = (1, 2, 4, 8)
_BLOCK = 4096
_LONG = 2.0**62


@dataclass(frozen=True)
class Model:
    """Number of distinct vectors, exact sums, components (columns), their eigenvalues and shares, and the measured error."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float


def whole_numbers(column: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(floor(scale * entry) of all entries, offsets of the rows, whether a row is usable) of a list column."""
    column = column.cast(pa.large_list(pa.float64()))
    offsets = np.asarray(column.offsets)
    entries = column.values.to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(entries * scale)
        fits = np.isfinite(entries) & (np.abs(scaled) < _LONG)
    bad = np.concatenate([[0], np.cumsum(~fits)])
    usable = (bad[offsets[1:]] == bad[offsets[:-1]]) & np.asarray(column.is_valid())
    return np.where(fits, scaled, 0).astype(np.int64), offsets, usable


def _codes(column: pa.Array, scale: int) -> list[bytes]:
    """A usable row as a width byte and its numbers in that many bytes each."""
    numbers, offsets, usable = whole_numbers(column, scale)
    over = [np.concatenate([[0], np.cumsum((numbers < -(1 << 8 * w - 1)) | (numbers >= 1 << 8 * w - 1))]) for w in _WIDTHS[:-1]]
    width = 1 + sum((o[offsets[1:]] > o[offsets[:-1]]).astype(int) * step for o, step in zip(over, (1, 2, 4), strict=True))
    return [
        bytes([w]) + numbers[begin:end].astype(f"<i{w}").tobytes()
        for begin, end, w, good in zip(offsets[:-1], offsets[1:], width.tolist(), usable, strict=True) if good
    ]


def _rows(codes: pa.Array, dimension: int) -> np.ndarray:
    """Decoded vectors, one per row."""
    whole = codes.to_pylist()
    out = np.empty((len(whole), dimension), np.int64)
    widths = np.array([code[0] for code in whole], np.uint8)
    for width in _WIDTHS:
        at = np.flatnonzero(widths == width)
        if len(at):
            out[at] = np.frombuffer(b"".join(whole[i][1:] for i in at), f"<i{width}").reshape(len(at), dimension)
    return out


def _blocks(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, len(batch), _BLOCK):
            yield _rows(batch.column(0).slice(at, _BLOCK), dimension)


def _centred(numbers: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """Rows less their mean: the whole part of the mean exactly, then the rest."""
    whole = [s // n for s in sums]
    rest = np.array([(s - w * n) / n for s, w in zip(sums, whole, strict=True)])
    return (numbers - np.array(whole, np.int64)) - rest


def distinct_vectors(vectors: DataFrame, vector: str = "embedding", scale: int = SCALE) -> tuple[DataFrame, int]:
    """(code) of each distinct usable vector of the commonest length, stored, and that length (0 if there is none)."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), _BLOCK):
                yield pa.RecordBatch.from_arrays([pa.array(_codes(batch.column(0).slice(at, _BLOCK), scale), pa.binary())], ["code"])

    codes = stored(vectors.select(vector).mapInArrow(coded, "code binary").distinct(), "vectors")
    width = F.conv(F.hex(F.substring("code", 1, 1)), 16, 10).cast("int")
    sized = codes.select("code", ((F.octet_length("code") - 1) / width).cast("int").alias("size"))
    lengths = sized.groupBy("size").agg(F.count("*").alias("n"))
    top = lengths.agg(F.max(F.struct("n", "size")).alias("top")).first().top
    dimension = top.size if top else 0
    return sized.filter(F.col("size") == dimension).select("code"), dimension


def _sums(codes: DataFrame, dimension: int) -> tuple[int, tuple[int, ...]]:
    """Number of vectors and exact sum per dimension."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dimension, object)
        for block in _blocks(batches, dimension):
            n += len(block)
            small = np.abs(block).max(initial=0) < 1 << 48
            total = total + (block.sum(axis=0) if small else block.astype(object).sum(axis=0))
        if n:
            exact = pa.array([Decimal(int(t)) for t in total] + [Decimal(n)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dimension + 1)), exact], ["place", "total"])

    found = codes.mapInArrow(summed, "place long, total decimal(38,0)").groupBy("place").agg(F.sum("total").alias("total"))
    totals = {row.place: int(row.total) for row in found.collect()}  # dimension + 1 rows
    return totals.get(dimension, 0), tuple(totals.get(i, 0) for i in range(dimension))


def _gram(codes: DataFrame, dimension: int, columns: int, n: int, turned) -> np.ndarray:
    """Sum of outer products of `turned(block)` over the list, divided by n. One upper triangle a task; Spark adds them."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros((columns, columns)), False
        for block in _blocks(batches, dimension):
            part = turned(block)
            total += part.T @ part
            any_rows = any_rows or len(block) > 0
        if any_rows:
            rows = [total[i, i:] for i in range(columns)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(columns)), pa.array(rows, pa.list_(pa.float64()))], ["i", "row"])

    parts = codes.mapInArrow(products, "i long, row array<double>").select("i", F.posexplode("row").alias("j", "value"))
    found = parts.groupBy("i", "j").agg(F.sum("value").alias("value")).toArrow()  # columns * (columns + 1) / 2 rows
    out = np.zeros((columns, columns))
    i, j = found.column("i").to_numpy(), found.column("j").to_numpy()
    out[i, i + j] = out[i + j, i] = found.column("value").to_numpy()
    return out / n


def fit(vectors: DataFrame, vector: str = "embedding", components: int = 16, scale: int = SCALE) -> Model | None:
    """Model of the distinct vectors, or None where there is no usable vector."""
    codes, dimension = distinct_vectors(vectors, vector, scale)
    if not dimension:
        return None
    n, sums = _sums(codes, dimension)
    covariance = _gram(codes, dimension, dimension, n, lambda block: _centred(block, n, sums))
    values, found = leading(covariance, components)
    real = values > 64 * dimension * np.finfo(float).eps * max(values.max(initial=0.0), 0.0)
    values, found = values[real], found[:, real]
    error = 0.0
    if len(values):
        scaled = found / np.sqrt(values)
        whitened = _gram(codes, dimension, len(values), n, lambda block: _centred(block, n, sums) @ scaled)
        error = float(np.abs(whitened - np.eye(len(values))).max())
    trace = float(np.trace(covariance))
    return Model(n, sums, found, values, values / trace if trace else values, error)


def deviations(numbers: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Exact sum of (n * y - sum)^2 over the dimensions of each row; None beyond the range of a long."""
    peak = n * int(np.abs(numbers).max(initial=0)) + max(map(abs, sums), default=0)
    if peak >= 1 << 62:
        exact = [sum((int(y) * n - s) ** 2 for y, s in zip(row, sums, strict=True)) for row in numbers]
        return [e if e < 1 << 63 else None for e in exact]
    away = numbers * n - np.array(sums, np.int64)
    far = np.abs(away).max(axis=1, initial=0) >= 1 << 32
    away[far] = 0
    high, low = away >> 16, away & 0xFFFF  # No sum of these products leaves 64 bits, their weighted sum may.
    parts = zip((high * high).sum(axis=1).tolist(), (high * low).sum(axis=1).tolist(), (low * low).sum(axis=1).tolist(), far.tolist(), strict=True)
    exact = [1 << 63 if beyond else (a << 32) + (b << 17) + c for a, b, c, beyond in parts]
    return [e if e < 1 << 63 else None for e in exact]


def project(vectors: DataFrame, model: Model | None, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(key, deviation, whitened): every usable vector with its exact deviation and its whitened numbers, one per component."""
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    schema = f"key {dict(rows.dtypes)['key']}, deviation long, whitened array<double>"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        dimension, turn = len(m.sums), m.components / np.sqrt(m.values)
        for batch in batches:
            for at in range(0, len(batch), _BLOCK):
                part = batch.slice(at, _BLOCK)
                numbers, offsets, usable = whole_numbers(part.column("vector"), scale)
                good = np.flatnonzero(usable & (np.diff(offsets) == dimension))
                block = numbers[offsets[good][:, None] + np.arange(dimension)]
                whitened = _centred(block, m.n, m.sums) @ turn
                yield pa.RecordBatch.from_arrays([
                    part.column("key").take(pa.array(good)), pa.array(deviations(block, m.n, m.sums), pa.int64()),
                    pa.array(list(whitened), pa.list_(pa.float64())),
                ], ["key", "deviation", "whitened"])

    return rows.mapInArrow(projected, schema).withColumnRenamed("key", key)


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 16, scale: int = SCALE) -> DataFrame:
    """A row per usable vector and component: key, component, n, deviation, whitened, explained, identity_error."""
    model = fit(vectors, vector, components, scale)
    shares = F.array(*[F.lit(float(e)) for e in model.explained]) if model and len(model.explained) else F.array().cast("array<double>")
    rows = project(vectors, model, key, vector, scale).select(key, "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return rows.select(
        key, (F.col("place") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("place") + 1).alias("explained"), F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )
