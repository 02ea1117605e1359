"""Leading eigenpairs of a symmetric matrix: Householder tridiagonal form, Sturm counts, inverse iteration."""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """(diagonal, off-diagonal, reflectors) of the similar tridiagonal matrix; a reflector is None where nothing had to be zeroed."""
    a = np.array(matrix, float)
    size = len(a)
    off, reflectors = np.zeros(max(size - 1, 0)), []
    for k in range(size - 2):
        column = a[k + 1:, k]
        length = np.linalg.norm(column)
        if np.abs(column[1:]).max() == 0:
            off[k] = column[0]
            reflectors.append(None)
            continue
        off[k] = -np.copysign(length, column[0])
        v = column.copy()
        v[0] -= off[k]
        v /= np.linalg.norm(v)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        reflectors.append(v)
    if size > 1:
        off[-1] = a[-1, -2]
    return a.diagonal().copy(), off, reflectors


def below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each value of `at`: the negative terms of its Sturm sequence."""
    tiny = np.finfo(float).tiny / _EPS
    squares = np.concatenate([[0.0], off**2])
    count, q = np.zeros(len(at), int), np.ones(len(at))
    for value, square in zip(diagonal, squares, strict=True):
        q = value - at - square / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def largest(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each bisected until no double lies between its bounds."""
    reach = np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])
    room = _EPS * len(diagonal) * (np.abs(diagonal) + reach).max() + np.finfo(float).tiny
    low, high = np.full(k, (diagonal - reach).min() - room), np.full(k, (diagonal + reach).max() + room)
    rank = len(diagonal) - 1 - np.arange(k)  # Of the j-th largest, counted from below.
    while True:
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high)):
            return middle
        above = below(diagonal, off, middle) > rank
        low, high = np.where(above, low, middle), np.where(above, middle, high)


def _factors(diagonal: np.ndarray, off: np.ndarray, shift: float, least: float):
    """Rows of the pivoted triangular factor of T - shift, with the multipliers and swaps that lead to it."""
    size = len(diagonal)
    rows, steps = [], []
    here = [diagonal[0] - shift, off[0] if size > 1 else 0.0, 0.0]
    for i in range(size - 1):
        below_it = [off[i], diagonal[i + 1] - shift, off[i + 1] if i + 2 < size else 0.0]
        swap = abs(below_it[0]) > abs(here[0])
        top, other = (below_it, here) if swap else (here, below_it)
        pivot = top[0] if abs(top[0]) > least else np.copysign(least, top[0])
        factor = other[0] / pivot
        rows.append((pivot, top[1], top[2]))
        steps.append((swap, factor))
        here = [other[1] - factor * top[1], other[2] - factor * top[2], 0.0]
    rows.append((here[0] if abs(here[0]) > least else np.copysign(least, here[0]), 0.0, 0.0))
    return rows, steps


def _solved(rows, steps, right: np.ndarray) -> np.ndarray:
    x = right.copy()
    for i, (swap, factor) in enumerate(steps):
        if swap:
            x[i], x[i + 1] = x[i + 1], x[i]
        x[i + 1] -= factor * x[i]
    for i in range(len(x) - 1, -1, -1):
        pivot, one, two = rows[i]
        x[i] = (x[i] - (one * x[i + 1] if i + 1 < len(x) else 0.0) - (two * x[i + 2] if i + 2 < len(x) else 0.0)) / pivot
        if abs(x[i]) > 1e200:
            x *= 1e-200
    return x


def vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 6) -> np.ndarray:
    """Unit eigenvectors (columns) of falling eigenvalues by inverse iteration.

    Values closer than 0.001 of the norm form a cluster; each vector is orthogonalised against those of its cluster before every
    round, and equal values are set apart by a few units in the last place so that their systems differ.
    """
    size = len(diagonal)
    norm = max((np.abs(diagonal) + np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])).max(), np.finfo(float).tiny)
    out, begin, shift = np.zeros((size, len(values))), 0, np.inf
    random = np.random.default_rng(1)
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            begin = j
        shift = min(value, shift - 10 * _EPS * norm) if j > begin else value
        rows, steps = _factors(diagonal, off, shift, _EPS * norm * 1e-3)
        x = random.standard_normal(size)
        for _ in range(rounds):
            for _ in range(2):
                x -= out[:, begin:j] @ (out[:, begin:j].T @ x)
            x = _solved(rows, steps, x / np.linalg.norm(x))
            x /= np.abs(x).max()
        for _ in range(2):
            x -= out[:, begin:j] @ (out[:, begin:j].T @ x)
        out[:, j] = x / np.linalg.norm(x)
    return out


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(falling eigenvalues, unit eigenvectors as columns) of the k largest; signs make the largest entry of a vector positive."""
    size = len(matrix)
    k = min(k, size)
    scale = np.abs(matrix).max() if size else 0.0
    if not k or scale == 0:
        return np.zeros(k), np.eye(size)[:, :k]
    scaled = (matrix + matrix.T) / (2 * scale)
    diagonal, off, reflectors = tridiagonal(scaled)
    found = vectors(diagonal, off, largest(diagonal, off, k))
    for i in range(len(reflectors) - 1, -1, -1):
        if reflectors[i] is not None:
            found[i + 1:] -= 2 * np.outer(reflectors[i], reflectors[i] @ found[i + 1:])
    values = np.einsum("ij,ij->j", found, scaled @ found)  # Rayleigh quotients: errors of the vectors enter squared.
    order = np.argsort(-values, kind="stable")
    values, found = values[order], found[:, order]
    signs = np.sign(found[np.abs(found).argmax(axis=0), np.arange(k)])
    return values * scale, found * signs
