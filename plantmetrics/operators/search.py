"""Exact top-k search through cells of near vectors.

The corpus is stored by cell, each with its centre and its radius, the greatest angle between the centre and a vector in it. For a
query at angle t from the centre no vector of the cell is nearer than t - radius, so a cell whose bound lies below the query's k-th
best score so far cannot hold an answer and is not opened: its files are not read. Filters only take rows away, so the bound holds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmetrics.functions.sizing import stored
from plantmetrics.operators.ordered import top_n_per_key
from plantmetrics.operators.retrieval import BROADCAST_BYTES, best_rows, topk_similar
from plantmetrics.session import scratch_path

MOST_CELLS = 1024
SAMPLE = 5000
_SLACK = 1e-9
_DIGITS = 12  # Scores are rounded here, so that equal vectors tie whatever block they are multiplied in.
_SLICE = 2048


@dataclass(frozen=True)
class CellIndex:
    """Where the vectors lie (a folder per cell), and centre, radius and rows of every cell."""

    path: str
    centres: np.ndarray
    radii: np.ndarray
    rows: np.ndarray
    filters: tuple[str, ...]
    id_type: str


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of a list column as rows, from its flat values; lengths have to be equal."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if len(column) and len(flat) % len(column) or len(np.unique(np.diff(np.asarray(column.offsets)))) > 1:
        raise ValueError("the vectors have different lengths")
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def _centres(rows: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Unit centres of the sample by spherical k-means from spread-out rows; cells that run empty keep their centre."""
    centres = rows[np.linspace(0, len(rows) - 1, cells).astype(int)]
    for _ in range(rounds):
        own = (rows @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, rows)
        centres = np.where(np.any(sums != 0, axis=1)[:, None], _unit(sums), centres)
    return centres


def build_index(
    corpus: DataFrame, corpus_id: str = "id", corpus_vector: str = "embedding", filters: Sequence[str] = (), cells: int | None = None,
    sample: int = SAMPLE, path: str | None = None,
) -> CellIndex:
    """Cells of all corpus vectors. The centres come from at most `sample` of them (smallest hashes of the id); null and zero vectors
    are left out. By default about half the square root of the rows, at most MOST_CELLS cells."""
    spark = corpus.sparkSession
    rows = corpus.select(F.col(corpus_id).alias("c_id"), F.col(corpus_vector).cast("array<double>").alias("c_vec"), *filters)
    rows = rows.filter(F.exists("c_vec", lambda x: x != 0))
    seen = rows.select("c_vec", F.xxhash64("c_id").alias("h")).orderBy("h", "c_vec").limit(sample).toArrow().column("c_vec").combine_chunks()
    taught = _unit(_matrix(seen))
    if not len(taught):
        return CellIndex("", np.zeros((0, 0)), np.zeros(0), np.zeros(0, int), tuple(filters), dict(rows.dtypes)["c_id"])
    wanted = cells or int(rows.count() ** 0.5 / 2)
    centres = _centres(taught, max(1, min(wanted, MOST_CELLS, len(taught))))
    kinds = dict(rows.dtypes)
    schema = ", ".join(["cell int", "angle double", f"c_id {kinds['c_id']}", "c_vec array<double>", *(f"{c} {kinds[c]}" for c in filters)])
    shared = spark.sparkContext.broadcast(centres)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), _SLICE):
                part = batch.slice(at, _SLICE)
                cosine = _unit(_matrix(part.column("c_vec"))) @ shared.value.T
                own = cosine.argmax(axis=1).astype(np.int32)
                angle = np.arccos(np.clip(cosine[np.arange(len(own)), own], -1, 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own), pa.array(angle), *(part.column(c) for c in ("c_id", "c_vec", *filters))], ["cell", "angle", "c_id", "c_vec", *filters]
                )

    where = path or scratch_path(spark, "cells")
    # Ranges of (cell, hash) cut a hot cell into several tasks and files, and give a small one a file of its own.
    spread = rows.mapInArrow(placed, schema).withColumn("_h", F.xxhash64("c_id"))
    spread.repartitionByRange("cell", "_h").drop("_h").write.partitionBy("cell").parquet(where)
    found = {r.cell: r for r in spark.read.parquet(where).groupBy("cell").agg(F.max("angle").alias("radius"), F.count("*").alias("n")).collect()}
    radii = np.array([found[c].radius if c in found else -1.0 for c in range(len(centres))])
    sizes = np.array([found[c].n if c in found else 0 for c in range(len(centres))])
    return CellIndex(where, centres, radii, sizes, tuple(filters), kinds["c_id"])


def bounds(index: CellIndex, unit_queries: np.ndarray) -> np.ndarray:
    """Greatest cosine any vector of a cell can have with a query; -inf for cells without rows."""
    angle = np.arccos(np.clip(unit_queries @ index.centres.T, -1, 1))
    best = np.cos(np.maximum(angle - index.radii, 0)) + _SLACK
    return np.where(index.rows > 0, best, -np.inf)


def _scan(spark: SparkSession, index: CellIndex, asked: pd.DataFrame, unit: np.ndarray, opened: np.ndarray, k: int, filters: Sequence[str]) -> DataFrame:
    """Best k of every opened (query, cell): (q, c_id, score), q the query's place. Only files of opened cells are read."""
    cells = np.flatnonzero(opened.any(axis=0)).tolist()
    shared = spark.sparkContext.broadcast((unit, opened, {f: asked[f].to_numpy(object) for f in filters}))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, open_, wanted = shared.value
        for batch in batches:
            owner = batch.column("cell").to_numpy()
            for cell in np.unique(owner):
                mine = batch.take(pa.array(np.flatnonzero(owner == cell)))
                mine = mine.take(pc.sort_indices(mine.column("c_id")))
                q = np.flatnonzero(open_[:, cell])
                for at in range(0, len(q), _SLICE):
                    some = q[at:at + _SLICE]
                    scores = np.round(_unit(_matrix(mine.column("c_vec"))) @ queries[some].T, _DIGITS)
                    for f in filters:
                        want, have = wanted[f][some], mine.column(f).to_numpy(zero_copy_only=False).astype(object)
                        scores[~(pd.isna(want)[None, :] | (have[:, None] == want[None, :]))] = -np.inf
                    row, column = np.nonzero(best_rows(scores, k))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(some[column].astype(np.int32)), mine.column("c_id").take(pa.array(row)), pa.array(scores[row, column])], ["q", "c_id", "score"]
                    )

    held = spark.read.parquet(index.path).filter(F.col("cell").isin(cells)) if cells else spark.read.parquet(index.path).limit(0)
    return held.select("cell", "c_id", "c_vec", *filters).mapInArrow(scored, f"q int, c_id {index.id_type}, score double")


def plan_cells(index: CellIndex, unit: np.ndarray, k: int) -> np.ndarray:
    """Cells each query opens first: those of greatest bound until they hold k rows."""
    order = np.argsort(-bounds(index, unit), axis=1, kind="stable")
    before = np.cumsum(index.rows[order], axis=1) - index.rows[order]
    opened = np.zeros(order.shape, bool)
    np.put_along_axis(opened, order, (before < k) & (index.rows[order] > 0), axis=1)
    return opened


def search(
    index: CellIndex, queries: DataFrame, k: int = 3, filters: Sequence[str] = (), query_id: str = "id", query_vector: str = "embedding",
    broadcast_bytes: int = BROADCAST_BYTES, opened_out: list | None = None,
) -> DataFrame:
    """Exact top-k cosine of every query: (query_id, corpus_id, score, rank), ties to the smaller corpus id.

    The nearest cells give each query a k-th best score; a second scan opens the cells whose bound reaches it. Queries of more
    than `broadcast_bytes` are matched with the whole corpus shard by shard instead, with the same result. `filters` are equality
    conditions as in `topk_similar`; null and zero query vectors find nothing.
    """
    spark = queries.sparkSession
    q = queries.select(F.col(query_id).alias("q_id"), F.col(query_vector).cast("array<double>").alias("q_vec"), *filters)
    q = stored(q, "queries").filter(F.exists("q_vec", lambda x: x != 0))  # Read three times, and perhaps dear to work out.
    empty = f"query_id {dict(q.dtypes)['q_id']}, corpus_id {index.id_type}, score double, rank int"
    if not len(index.centres):
        return spark.createDataFrame([], empty)
    held = q.agg(F.coalesce(F.sum(F.size("q_vec") + 1), F.lit(0)).alias("numbers")).first()["numbers"] * 8
    if held > broadcast_bytes:
        corpus = spark.read.parquet(index.path)
        return topk_similar(corpus, q, k, filters, "c_id", "c_vec", "q_id", "q_vec", broadcast_bytes)
    table = q.toArrow()
    if not table.num_rows:
        return spark.createDataFrame([], empty)
    asked = table.select(["q_id", *filters]).to_pandas()
    unit = _unit(_matrix(table.column("q_vec").combine_chunks()))
    first = plan_cells(index, unit, k)
    early = top_n_per_key(_scan(spark, index, asked, unit, first, k, filters), ["q"], [F.desc("score"), F.asc("c_id")], k).drop("rank").toArrow()
    worst = np.full(len(unit), -np.inf)  # At most k rows a query have come here; fewer than k rule nothing out.
    full = early.select(["q", "score"]).to_pandas().groupby("q")["score"].agg(["size", "min"])
    full = full[full["size"] >= k]
    worst[full.index.to_numpy(int)] = full["min"].to_numpy()
    second = (bounds(index, unit) >= worst[:, None] - 10.0**-_DIGITS) & ~first & (index.rows > 0)
    if opened_out is not None:
        opened_out.append(first | second)
    both = _scan(spark, index, asked, unit, second, k, filters).unionByName(spark.createDataFrame(early))
    top = top_n_per_key(both, ["q"], [F.desc("score"), F.asc("c_id")], k)
    ids = spark.createDataFrame(pa.table({"q": pa.array(np.arange(len(unit)), pa.int32()), "query_id": table.column("q_id")}))
    return top.join(F.broadcast(ids), "q").select("query_id", F.col("c_id").alias("corpus_id"), "score", "rank")  # ids: one row a query, bounded above
