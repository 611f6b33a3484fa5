"""Largest eigenvalues and eigenvectors of a symmetric matrix by contour integration.

The wanted part of the spectrum is cut into intervals of few eigenvalues each. For an interval, the integral of the
resolvent over the circle above it projects a block of vectors onto the interval's eigenvectors; it is summed at
quadrature points, each a solve with a complex shift. Rayleigh-Ritz on the projected block gives the pairs, which are
projected again until their residuals are as small as rounding allows. Inertia counts say how many eigenvalues each
interval must hold, so a missing one is noticed.
"""

from __future__ import annotations

import numpy as np

#: Eigenvalues looked for together, and quadrature points on the upper half of a circle.
TOGETHER, POINTS = 8, 8
ROUNDS = 30
#: An eigenvalue at most this share of the largest counts as zero.
NOTHING = 1e-11


class Inertia:
    """How many eigenvalues lie above a shift: signs of the pivots of the shifted tridiagonal form."""

    def __init__(self, matrix: np.ndarray):
        a, size = matrix.copy(), len(matrix)
        for k in range(size - 2):
            column = a[k + 1 :, k]
            length = np.linalg.norm(column)
            if length == 0:
                continue
            mirror = column.copy()
            mirror[0] += np.copysign(length, mirror[0])
            mirror /= np.linalg.norm(mirror)
            a[k + 1 :] -= 2 * np.outer(mirror, mirror @ a[k + 1 :])
            a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ mirror, mirror)
        self.diagonal, self.beside = a.diagonal().copy(), a.diagonal(1) ** 2
        reach = np.abs(a.diagonal(1))
        radius = np.concatenate([[0.0], reach]) + np.concatenate([reach, [0.0]])
        self.low, self.high = (self.diagonal - radius).min(), (self.diagonal + radius).max()
        self.tiny = max(abs(self.low), abs(self.high), 1e-300) * np.finfo(float).eps

    def above(self, shift: float) -> int:
        found, pivot = 0, 1.0
        for d, e in zip(self.diagonal, np.concatenate([[0.0], self.beside]), strict=True):
            pivot = d - shift - e / pivot
            if abs(pivot) < self.tiny:
                pivot = -self.tiny
            found += pivot > 0
        return found


def _cut(counts: Inertia, floor: float, high: float, target: int) -> float:
    """A shift with ``target`` eigenvalues above it, or a few more where equal ones stand together, at some distance
    from the next eigenvalue below."""
    low = floor
    while high - low > 1e-11 * abs(high):
        middle = (low + high) / 2
        n = counts.above(middle)
        if n == target:
            left, right = low, middle
            for _ in range(6):
                probe = (left + right) / 2
                left, right = (left, probe) if counts.above(probe) == target else (probe, right)
            return (middle + right) / 2
        low, high = (middle, high) if n > target else (low, middle)
    return floor if low == floor else _cut(counts, floor, low, counts.above(low))


def _interval(matrix: np.ndarray, low: float, high: float, count: int, rng: np.random.Generator):
    """The ``count`` eigenpairs between ``low`` and ``high``; None if they were not reached."""
    size = len(matrix)
    middle, radius = (low + high) / 2, (high - low) / 2
    small = size * np.finfo(float).eps * np.abs(matrix).max() * 8
    at, weight = np.polynomial.legendre.leggauss(POINTS)
    turn = np.exp(1j * np.pi / 2 * (1 - at))
    block, identity = rng.standard_normal((size, min(size, count + max(4, count // 2)))), np.eye(size)
    best, worst = None, np.inf
    for _ in range(ROUNDS):
        projected = np.zeros_like(block)
        for direction, share in zip(turn, weight, strict=True):
            solved = np.linalg.solve((middle + radius * direction) * identity - matrix, block.astype(complex))
            projected += (share / 2) * (radius * direction * solved).real
        basis, _ = np.linalg.qr(projected)
        values, inner = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ inner
        inside = (values > low) & (values <= high)
        if inside.sum() != count:
            continue
        found = block[:, inside]
        residual = np.abs(matrix @ found - found * values[inside]).max()
        if residual >= worst / 2 and worst <= small:
            break
        if residual < worst:
            best, worst = (values[inside], found), residual
    return best if worst <= small else None


def _pairs(matrix: np.ndarray, counts: Inertia, low: float, high: float, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    """All eigenpairs between two shifts; where the circle is too wide for the gaps at its ends, by two smaller ones."""
    above = counts.above(high)
    count = counts.above(low) - above
    if not count:
        return []
    if found := _interval(matrix, low, high, count, rng):
        return [found]
    cut = _cut(counts, low, high, above + max(1, count // 2))
    if cut in (low, high) or counts.above(cut) in (above, above + count):
        raise ArithmeticError(f"the interval {low} to {high} has {count} eigenvalues by its inertia, which were not all found")
    return [*_pairs(matrix, counts, cut, high, rng), *_pairs(matrix, counts, low, cut, rng)]


def largest_components(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    Eigenvalues of (nearly) zero are left out, so a matrix of low rank has fewer.
    """
    scale = np.abs(matrix).max(initial=0.0)
    if scale == 0:
        return np.zeros(0), np.zeros((len(matrix), 0))
    matrix = (matrix + matrix.T) / (2 * scale)
    counts, rng = Inertia(matrix), np.random.default_rng(20)
    top, floor = counts.high * (1 + 1e-9) + counts.tiny, counts.high * NOTHING
    wanted = min(most, counts.above(floor))
    vectors, high, done = [], top, 0
    while done < wanted:
        low = _cut(counts, floor, high, min(done + TOGETHER, wanted))
        vectors += [v for _, v in _pairs(matrix, counts, low, high, rng)]
        high, done = low, counts.above(low)
    if not vectors:
        return np.zeros(0), np.zeros((len(matrix), 0))
    # One more Rayleigh-Ritz step over all intervals makes the vectors orthogonal to each other throughout.
    basis, _ = np.linalg.qr(np.concatenate(vectors, axis=1))
    e, inner = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-e)[:wanted]
    return e[order] * scale, basis @ inner[:, order]
