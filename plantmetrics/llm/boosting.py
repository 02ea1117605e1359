"""Gradient boosting of logistic loss over small binned trees: in numpy for rows at hand, by Spark for counted rows of any number."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmetrics.functions.sizing import stored

BINS = 32
#: Counted rows of a task in a pass, and the parts whose sums the driver adds up itself.
PACKED_ROWS = 1 << 14
_DRIVER_PARTS = 8
#: Slopes are whole numbers of these parts, so that their sums do not depend on the order of rows.
_PARTS = 1 << 20


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: split feature and threshold per inner node, value per leaf; rows above the threshold go right."""

    features: np.ndarray
    thresholds: np.ndarray
    leaves: np.ndarray
    start: float

    def margins(self, rows: np.ndarray) -> np.ndarray:
        """Log-odds of every row."""
        out = np.full(len(rows), self.start)
        depth = int(np.log2(self.leaves.shape[1])) if len(self.leaves) else 0
        every = np.arange(len(rows))
        for features, thresholds, leaves in zip(self.features, self.thresholds, self.leaves, strict=True):
            at = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (rows[every, features[at]] > thresholds[at])
            out += leaves[at - (leaves.size - 1)]
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _edges(column: np.ndarray) -> np.ndarray:
    """Cuts between neighbouring values, at most BINS - 1 of them at equal shares."""
    values = np.unique(column)
    cuts = (values[1:] + values[:-1]) / 2
    return cuts if len(cuts) < BINS else cuts[np.linspace(0, len(cuts) - 1, BINS - 1).astype(int)]


def boost(rows: np.ndarray, labels: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.2, ridge: float = 1.0) -> Trees:
    """Trees fitted one after another to the gradient, each split by the gain of second order; the same rows give the same trees."""
    size, width = rows.shape
    edges = [_edges(rows[:, f]) for f in range(width)]
    binned = np.stack([np.searchsorted(e, rows[:, f], side="left") for f, e in enumerate(edges)], axis=1) if width else np.zeros((size, 0), int)
    share = min(max(float(labels.mean()), 1e-3), 1 - 1e-3) if size else 0.5
    start = float(np.log(share / (1 - share)))
    margin = np.full(size, start)
    inner, ends = 2**depth - 1, 2**depth
    features, thresholds, leaves = np.zeros((rounds, inner), np.int64), np.full((rounds, inner), np.inf), np.zeros((rounds, ends))
    cells = binned + np.arange(width) * BINS
    for r in range(rounds):
        chance = sigmoid(margin)
        slope, bend = labels - chance, np.maximum(chance * (1 - chance), 1e-6)
        node = np.zeros(size, np.int64)
        for level in range(depth):
            first, wide = 2**level - 1, 2**level
            place = ((node - first)[:, None] * width * BINS + cells).ravel()
            g, h = (np.bincount(place, np.repeat(w, width), wide * width * BINS).reshape(wide, width, BINS) for w in (slope, bend))
            left_g, left_h = g.cumsum(axis=2), h.cumsum(axis=2)
            all_g, all_h = left_g[:, :1, -1:], left_h[:, :1, -1:]
            gain = left_g**2 / (left_h + ridge) + (all_g - left_g) ** 2 / (all_h - left_h + ridge) - all_g**2 / (all_h + ridge)
            gain[(left_h < 0.5) | (all_h - left_h < 0.5)] = 0
            best = gain.reshape(wide, -1).argmax(axis=1)
            for k, cell in enumerate(best.tolist()):
                f, b = divmod(cell, BINS)
                if gain[k, f, b] > 1e-6 and b < len(edges[f]):
                    features[r, first + k], thresholds[r, first + k] = f, edges[f][b]
            node = 2 * node + 1 + (rows[np.arange(size), features[r, node]] > thresholds[r, node])
        leaf = node - inner
        leaves[r] = rate * np.bincount(leaf, slope, ends) / (np.bincount(leaf, bend, ends) + ridge)
        margin += leaves[r, leaf]
    return Trees(features, thresholds, leaves, start)


def binned(rows: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Bin of every number: how many of its column's edges lie below it."""
    return np.stack([np.searchsorted(e, rows[:, f], side="left") for f, e in enumerate(edges)], axis=1).astype(np.uint8)


def _cells(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, width)


def _walk(cells: np.ndarray, features: np.ndarray, cuts: np.ndarray, levels: int) -> np.ndarray:
    """Node of every row after so many levels of one tree."""
    node, every = np.zeros(len(cells), np.int64), np.arange(len(cells))
    for _ in range(levels):
        node = 2 * node + 1 + (cells[every, features[node]] > cuts[node])
    return node


def packed(counted: DataFrame) -> DataFrame:
    """The rows stored in as few files as their number asks for, since every pass starts a task for each."""
    return stored(counted.repartition(max(1, -(-counted.count() // PACKED_ROWS))), "packed")


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per model of the parts that meet in a task."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for model, sums in zip(batch.column("model").to_pylist(), batch.column("sums"), strict=True):
            part = np.frombuffer(sums.as_buffer())
            total[model] = total[model] + part if model in total else part.copy()
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(total, pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())], ["model", "sums"]
        )


def boost_counted(
    counted: DataFrame, edges: np.ndarray, folds: int, rounds: int = 60, depth: int = 4, rate: float = 0.2, ridge: float = 1.0
) -> list[Trees]:
    """Trees of all rows but a fold's, for each fold, and behind them those of all rows.

    `counted` has (label, fold, bins, many): every row counts `many` times, whatever their number. A level of a tree is one pass and
    one job, which sums slopes by node, column and bin in each task; only these sums leave the tasks, and those of many tasks are
    added up in _DRIVER_PARTS others first. The same rows give the same trees. `packed` rows take the fewest tasks.
    """
    width, models, inner, ends = len(edges), folds + 1, 2**depth - 1, 2**depth
    totals = {(r.fold, r.label): r.many for r in counted.groupBy("fold", "label").agg(F.sum("many").alias("many")).collect()}
    starts = []
    for m in range(models):
        ones, zeros = (sum(n for (fold, label), n in totals.items() if fold != m and label == side) for side in (True, False))
        share = min(max(ones / (ones + zeros), 1e-3), 1 - 1e-3) if ones + zeros else 0.5
        starts.append(float(np.log(share / (1 - share))))
    features = np.zeros((models, rounds, inner), np.int64)
    cuts, leaves = np.full((models, rounds, inner), BINS), np.zeros((models, rounds, ends))
    many_tasks = counted.rdd.getNumPartitions() > _DRIVER_PARTS

    def slopes(r: int, level: int) -> np.ndarray:
        wide = 2**level
        seen = features[:, :r + 1].copy(), cuts[:, :r + 1].copy(), leaves[:, :r].copy()

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((models, 2, wide * width * BINS))
            for batch in batches:
                cells, fold = _cells(batch, width), batch.column("fold").to_numpy()
                label, many = batch.column("label").to_numpy(zero_copy_only=False).astype(float), batch.column("many").to_numpy()
                for m in range(models):
                    use = np.flatnonzero(fold != m)
                    own, margin = cells[use], np.full(len(use), starts[m])
                    for t in range(r):
                        margin += seen[2][m, t][_walk(own, seen[0][m, t], seen[1][m, t], depth) - inner]
                    chance = sigmoid(margin)
                    slope, bend = np.round((label[use] - chance) * _PARTS), np.maximum(np.round(chance * (1 - chance) * _PARTS), 1)
                    node = _walk(own, seen[0][m, r], seen[1][m, r], level) - (wide - 1)
                    place = ((node * width)[:, None] + np.arange(width)) * BINS + own
                    for k, w in enumerate((slope, bend)):
                        total[m, k] += np.bincount(place.ravel(), np.repeat(w * many[use], width), wide * width * BINS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(models), pa.int32()), pa.array([t.tobytes() for t in total], pa.binary())], ["model", "sums"]
            )

        parts = counted.mapInArrow(summed, "model int, sums binary")
        if many_tasks:
            # Dealt in turn, not by key: a key would spread five rows over all shuffle partitions.
            parts = parts.repartition(_DRIVER_PARTS).mapInArrow(_added, "model int, sums binary")
        out = np.zeros((models, 2 * wide * width * BINS))
        found = parts.toArrow()
        for model, sums in zip(found.column("model").to_pylist(), found.column("sums"), strict=True):
            out[model] += np.frombuffer(sums.as_buffer())
        return out.reshape(models, 2, wide, width, BINS) / _PARTS

    for r in range(rounds):
        for level in range(depth):
            first, wide = 2**level - 1, 2**level
            found = slopes(r, level)
            for m in range(models):
                left_g, left_h = found[m].cumsum(axis=3)
                all_g, all_h = left_g[:, :1, -1:], left_h[:, :1, -1:]
                gain = left_g**2 / (left_h + ridge) + (all_g - left_g) ** 2 / (all_h - left_h + ridge) - all_g**2 / (all_h + ridge)
                gain[(left_h < 0.5) | (all_h - left_h < 0.5)] = 0
                for k, cell in enumerate(gain.reshape(wide, -1).argmax(axis=1).tolist()):
                    f, b = divmod(cell, BINS)
                    split = gain[k, f, b] > 1e-6 and b < len(edges[f])
                    if split:
                        features[m, r, first + k], cuts[m, r, first + k] = f, b
                    if level == depth - 1:
                        g, h = (left_g[k, f, b], left_h[k, f, b]) if split else (all_g[k, 0, 0], all_h[k, 0, 0])
                        leaves[m, r, 2 * k] = rate * g / (h + ridge)
                        leaves[m, r, 2 * k + 1] = rate * (all_g[k, 0, 0] - g) / (all_h[k, 0, 0] - h + ridge)
    ended = np.hstack([edges, np.full((width, 1), np.inf)])
    return [Trees(features[m], ended[features[m], np.minimum(cuts[m], edges.shape[1])], leaves[m], starts[m]) for m in range(models)]
