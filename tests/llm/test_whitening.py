import math

import numpy as np
import pytest

from plantmetrics.llm import symmetric as S
from plantmetrics.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, whitened string, n string"


def brute(rows, components=16):
    """{(id, place): (component, n, deviation, |whitened|, explained)} with whole numbers and a library's eigenvectors."""
    kept = [(k, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    listed = sorted({tuple(x) for _, x in kept})
    n, d = len(listed), len(listed[0])
    sums = [sum(x[i] for x in listed) for i in range(d)]
    centred = np.array([[(n * x - s) / n for x, s in zip(row, sums)] for row in listed])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = []
    for k, x in kept:
        away = [n * a - s for a, s in zip(x, sums)]
        z = (np.array(away) / n) @ vectors / np.sqrt(values)
        out += [(k, c + 1, n, sum(a * a for a in away), z[c], values[c] / np.trace(centred.T @ centred / n)) for c in range(components)]
    return out


def spread(n, d, seed):
    """Vectors with well separated variances along turned axes."""
    random = np.random.default_rng(seed)
    turn, _ = np.linalg.qr(random.standard_normal((d, d)))
    return (random.standard_normal((n, d)) * (8 * 0.8 ** np.arange(d))) @ turn


def test_rows_are_those_of_whole_numbers(frame):
    vectors = spread(400, 20, 1).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(9000 + i, vectors[3].tolist()) for i in range(200)]
    rows += [(7, None), (8, [None] + [0.5] * 19), (9, [float("nan")] * 20), (10, [float("inf")] + [0.0] * 19), (None, vectors[5].tolist())]
    got = W.whiten(frame([(k, v, "x", "y") for k, v in rows], SCHEMA)).collect()
    want = brute(rows)
    assert len(got) == len(want) == 601 * 16 and {r.n for r in got} == {400}
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    signs = {}
    for row, (key, component, n, deviation, z, explained) in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert (row.vec_id, row.component, row.n, row.deviation) == (key, component, n, deviation)
        sign = signs.setdefault(component, math.copysign(1, row.whitened * z)) if abs(z) > 1e-3 else signs.get(component, math.copysign(1, row.whitened * z))
        assert row.whitened == pytest.approx(sign * z, abs=1e-8) and row.explained == pytest.approx(explained, rel=1e-10)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-10


@pytest.mark.parametrize("kind", ["random", "equal", "pairs", "split", "tiny", "one", "two"])
def test_eigenpairs(kind):
    random = np.random.default_rng(4)
    size = {"one": 1, "two": 2}.get(kind, 40)
    turn, _ = np.linalg.qr(random.standard_normal((size, size)))
    values = {
        "equal": np.r_[np.full(12, 5.0), np.linspace(1, 2, 28)], "pairs": np.repeat(np.linspace(1, 3, 20), 2), "tiny": 10.0 ** -np.arange(40) * 1e-100,
    }.get(kind, random.random(size) * 9 - 2)
    matrix = (turn * values) @ turn.T
    if kind == "split":  # Dimensions without variance and blocks that do not touch.
        matrix = np.zeros((40, 40))
        matrix[:10, :10] = matrix[20:30, 20:30] = np.cov(random.standard_normal((10, 50)))
    got, found = S.leading(matrix, 16)
    k = min(16, size)
    norm = np.abs(matrix).max()
    assert np.allclose(got, np.sort(np.linalg.eigvalsh(matrix))[::-1][:k], atol=1e-13 * size * norm, rtol=0)
    assert np.abs(found.T @ found - np.eye(k)).max() < 1e-12
    assert np.abs(matrix @ found - found * got).max() < 1e-13 * size * norm


def test_sturm_counts_are_ranks():
    random = np.random.default_rng(2)
    diagonal, off, _ = S.tridiagonal(np.cov(random.standard_normal((30, 90))))
    matrix = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    values = np.linalg.eigvalsh(matrix)
    at = np.linspace(values[0] - 1, values[-1] + 1, 101)
    assert S.below(diagonal, off, at).tolist() == [(values < x).sum() for x in at]


def test_codes_keep_vectors_of_every_size():
    import pyarrow as pa

    rows = [[0.0, 1.9], [2.0, -2.0], [513.0, 0.1], [1e9, -1e9], [1e15, 3.0], [-2.015625, 0]]
    codes = W._codes(pa.array(rows, pa.list_(pa.float64())), 64)
    assert [c[0] for c in codes] == [1, 2, 4, 8, 8, 2]
    assert W._rows(pa.array(codes), 2).tolist() == [[math.floor(64 * c) for c in row] for row in rows]
    sliced = pa.array([[9.0], None, *rows], pa.list_(pa.float64())).slice(2)
    assert W._codes(sliced, 64) == codes


def test_deviations_are_exact_or_null():
    numbers = np.array([[3, -5, 7], [1 << 40, 0, 0], [0, 0, 0], [30_000, -30_000, 2]])
    for n, sums in ((10**5, (12, -7, 10**6)), (3, (1, 2, 3)), (1 << 25, (5, 5, 5))):
        want = [sum((n * int(y) - s) ** 2 for y, s in zip(row, sums)) for row in numbers]
        assert W.deviations(numbers, n, sums) == [w if w < 1 << 63 else None for w in want]


def test_defined_cases(frame):
    assert W.whiten(frame([], SCHEMA)).count() == 0
    assert W.whiten(frame([(1, None, "", ""), (2, [], "", "")], SCHEMA)).count() == 0
    assert W.whiten(frame([(1, [1.0, 2.0], "", ""), (2, [1.0, 2.001], "", "")], SCHEMA)).count() == 0  # One distinct vector: no variance.
    flat = W.whiten(frame([(1, [1.0, 2.0], "", ""), (2, [3.0, 2.0], "", ""), (3, [4.0], "", ""), (4, [3e38, 1.0], "", "")], SCHEMA)).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in flat) == [(1, 1, 2, 16384, 1.0, 1.0), (2, 1, 2, 16384, 1.0, 1.0)]
