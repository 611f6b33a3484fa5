"""Many ridge-penalised logistic fits from shared passes over the rows.

Fits that differ in their columns, penalty, held-out fold or label read the same rows. One pass adds up, for every fit still
going on, its loss, gradient and matrix of second derivatives at its current coefficients: a few numbers per pair of
columns from each task. Newton steps on the driver then take all fits on, and a step that made the loss larger is halved.
The number of passes is that of the slowest fit, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.functions.columns import col
from proclivity.schema import TARGET_COLUMN, require_columns

#: A fit ends with the first step whose largest entry, against the largest coefficient, is at most this; Newton steps
#: square the error, so what is left after it is about its square.
SMALL_STEP = 1e-6
TOGETHER = 4096
COUNTS = ("tn", "fp", "fn", "tp")


@dataclass
class Fit:
    """One logistic fit: which columns it uses, its penalty, the fold it leaves out, and what came of it."""

    columns: Sequence[int]
    c: float = 1.0
    held: int | None = None
    intercept: bool = True
    #: Coefficients of ``columns``, then the intercept (0 without one).
    beta: np.ndarray | None = None
    #: Second derivatives of the penalised loss at the last pass, intercept last (left out without one).
    curvature: np.ndarray | None = None
    passes: int = 0
    converged: bool = False
    weights: tuple[float, float] = field(default=(1.0, 1.0))
    #: Place in the features of a 0/1 label that stands for the rows' own; rows with 1 in all of ``unless`` are left out.
    label: int | None = None
    unless: Sequence[int] = ()
    #: Factors of the squared coefficients in the penalty, 1 unless given.
    factors: np.ndarray | None = None

    @property
    def penalties(self) -> np.ndarray:
        """What each coefficient's square is weighed with, the free intercept's last."""
        factors = np.ones(len(self.columns)) if self.factors is None else self.factors
        return np.append(factors / self.c, 0.0)[: len(self.columns) + self.intercept]

    @property
    def coefficients(self) -> np.ndarray:
        return self.beta[:-1]


def training_rows(df: DataFrame, features: list[str], target: str = TARGET_COLUMN, fold: str | None = None) -> DataFrame:
    """``(y, fold, x)``: a 0/1 target, the row's fold (0 without one) and the features as one array."""
    require_columns(df, [*features, target])
    number = col(fold).cast("int") if fold else F.lit(0)
    x = F.array(*[col(c).cast("double") for c in features]) if features else F.array().cast("array<double>")
    return df.where(col(target).isNotNull()).select(col(target).cast("double").alias("y"), number.alias("fold"), x.alias("x"))


def packed(rows: DataFrame) -> DataFrame:
    """``training_rows`` in blocks of many rows, their numbers as bytes: a pass then reads bytes instead of single numbers."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(low, TOGETHER)
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
                columns = [batch.column("y").to_numpy(), batch.column("fold").to_numpy(), x]
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], ["y", "fold", "x"])

    return rows.select("y", "fold", "x").mapInArrow(pack, "y binary, fold binary, x binary")


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(y, fold, x)`` of some rows at a time, from plain or packed rows; ``x`` ends with a column of ones."""
    for whole in batches:
        if pa.types.is_floating(whole.schema.field("y").type):
            for low in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(low, TOGETHER)
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False)
                yield batch.column("y").to_numpy(), batch.column("fold").to_numpy(), _matrix(x, batch.num_rows, width)
            continue
        for y, fold, x in zip(whole.column("y"), whole.column("fold"), whole.column("x"), strict=True):
            y, fold = np.frombuffer(y.as_buffer(), float), np.frombuffer(fold.as_buffer(), np.int32)
            yield y, fold, _matrix(np.frombuffer(x.as_buffer(), float), len(y), width)


def _class_weights(rows: DataFrame, fits: list[Fit], weighting: str | None) -> None:
    """Sets each fit's weights of the two classes, from class sizes outside its held-out fold."""
    sizes = _class_sizes(rows)
    for f in fits:
        n = [sum(k for (fold, y), k in sizes.items() if y == label and (f.held is None or fold != f.held)) for label in (0, 1)]
        if weighting == "balanced":
            present = sum(k > 0 for k in n)
            f.weights = tuple(sum(n) / (present * k) if k else 1.0 for k in n)
        elif weighting == "positive":
            f.weights = (1.0, n[0] / n[1] if n[1] else 1.0)
        elif weighting is not None:
            raise ValueError(f"unknown weighting {weighting!r}")


def _class_sizes(rows: DataFrame) -> dict[tuple[int, int], int]:
    """Number of rows per fold and class."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for y, fold, _ in _blocks(batches, 0):
            kinds, n = np.unique(np.stack([fold, y.astype(int)]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds[0], pa.int32()), pa.array(kinds[1], pa.int32()), pa.array(n, pa.int64())], ["fold", "y", "n"])

    without_x = rows.withColumn("x", F.array().cast("array<double>") if dict(rows.dtypes)["x"] != "binary" else F.lit(b""))
    counted = without_x.select("y", "fold", "x").mapInArrow(count, "fold int, y int, n long").groupBy("fold", "y").agg(F.sum("n").alias("n"))
    return {(r["fold"], r["y"]): r["n"] for r in counted.collect()}


def _matrix(x: np.ndarray, rows: int, width: int) -> np.ndarray:
    x = x.reshape(rows, width)
    if np.isnan(x).any():
        raise ValueError("features have missing values; fill them first")
    return np.hstack([x, np.ones((len(x), 1))])


def _chances(x: np.ndarray, coefficients: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scores, chances of 1)."""
    scores = x @ coefficients
    return scores, 1 / (1 + np.exp(-np.clip(scores, -700, 700)))


def _own_rows(y: np.ndarray, x: np.ndarray, label: int | None, unless: Sequence[int]) -> tuple[np.ndarray, np.ndarray | None]:
    """``(labels, rows that count)`` of a fit in a block; all rows count without ``unless``."""
    kept = None
    if len(unless):
        # As a product, which takes no columns out of the rows.
        given = np.zeros(x.shape[1])
        given[list(unless)] = 1
        kept = x @ given < len(unless)
    return (y if label is None else x[:, label]), kept


def _spread(fits: list[Fit], width: int) -> np.ndarray:
    """Coefficients of all fits over all columns and the intercept."""
    wide = np.zeros((width + 1, len(fits)))
    for k, f in enumerate(fits):
        wide[[*f.columns, width], k] = f.beta
    return wide


def _sums(rows: DataFrame, fits: list[Fit], width: int) -> list[np.ndarray]:
    """For each fit: loss, gradient and second derivatives of the weighted rows at its coefficients, in one pass."""
    wide = _spread(fits, width)
    parts = [(np.array([*f.columns, width] if f.intercept else list(f.columns), int), f.held, f.weights, f.label, f.unless) for f in fits]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(1 + len(own) + len(own) ** 2) for own, *_ in parts]
        for labels, fold, x in _blocks(batches, width):
            scores, chances = _chances(x, wide)
            for k, (own, held, (w0, w1), label, unless) in enumerate(parts):
                y, kept = _own_rows(labels, x, label, unless)
                weight = np.where(y == 1, w1, w0)
                if held is not None:
                    weight = np.where(fold == held, 0.0, weight)
                if kept is not None:
                    weight = np.where(kept, weight, 0.0)
                # Most columns: taking them from the sums is cheaper than taking them from the rows.
                low = own.min(initial=width)
                s, p, most = scores[:, k], chances[:, k], 2 * len(own) > width - low
                mine = x[:, low:] if most else x[:, own]
                # log(1 + exp(s)) - y*s without overflow.
                loss = weight @ (np.maximum(s, 0) + np.log1p(np.exp(-np.abs(s))) - y * s)
                gradient = mine.T @ (weight * (p - y))
                second = mine.T @ (mine * (weight * p * (1 - p))[:, None])
                if most:
                    gradient, second = gradient[own - low], second[np.ix_(own - low, own - low)]
                totals[k] += np.concatenate([[loss], gradient, second.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(totals)), pa.int32()), pa.array(totals, pa.list_(pa.float64()))], ["fit", "sums"])

    def together(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"fit": frame["fit"].head(1), "sums": [np.sum(np.stack(frame["sums"]), axis=0)]})

    schema = "fit int, sums array<double>"
    found = rows.select("y", "fold", "x").mapInArrow(add_up, schema).groupBy("fit").applyInPandas(together, schema).collect()
    empty = [np.zeros(1 + len(own) + len(own) ** 2) for own, *_ in parts]
    for r in found:
        empty[r["fit"]] = np.array(r["sums"])
    return empty


def fit_together(rows: DataFrame, fits: list[Fit], width: int, weighting: str | None = "balanced", max_iter: int = 1000) -> int:
    """Fits all of ``fits`` on ``training_rows`` with ``width`` columns; returns the number of passes.

    Each minimises the weighted log loss plus half the squared coefficients over ``c`` (the intercept is free). Fits that
    come with ``beta`` start there. ``max_iter`` bounds the passes; a fit that has not ended by then is marked so.
    """
    if weighting is not None and any(f.weights == (1.0, 1.0) for f in fits):
        _class_weights(rows, fits, weighting)
    for f in fits:
        f.beta = np.zeros(len(f.columns) + 1) if f.beta is None else np.asarray(f.beta, float).copy()
        f.converged, f.passes = False, 0
    # Where a step came from: (coefficients, loss, step), to halve it if the loss went up.
    last: dict[int, tuple[np.ndarray, float, np.ndarray]] = {}
    passes = 0
    while passes < max_iter and (open_fits := [f for f in fits if not f.converged]):
        passes += 1
        for f, sums in zip(open_fits, _sums(rows, open_fits, width), strict=True):
            f.passes += 1
            size = len(f.columns) + f.intercept
            penalised = f.penalties * f.beta[:size]
            loss = sums[0] + (penalised @ f.beta[:size]) / 2
            before = last.get(id(f))
            if before is not None and loss > before[1] * (1 + 1e-12) + 1e-12:
                start, least, step = before
                last[id(f)] = (start, least, step / 2)
                f.beta = start + step / 2
                f.converged = bool(np.abs(step).max(initial=0) < 1e-14)
                continue
            gradient = sums[1 : 1 + size] + penalised
            f.curvature = sums[1 + size :].reshape(size, size) + np.diag(f.penalties)
            if size == 0:
                f.converged = True
                continue
            try:
                step = -np.linalg.solve(f.curvature, gradient)
            except np.linalg.LinAlgError:
                step = -np.linalg.lstsq(f.curvature, gradient, rcond=None)[0]
            step = np.append(step, np.zeros(len(f.columns) + 1 - size))
            last[id(f)] = (f.beta.copy(), loss, step)
            f.beta = f.beta + step
            f.converged = bool(np.abs(step).max() <= SMALL_STEP * max(1.0, np.abs(f.beta).max()))
    return passes


def without(fit: Fit, gone: list[int]) -> Fit:
    """The fit on the remaining columns, started at the best coefficients that second derivatives foresee.

    ``gone`` are places in ``fit.columns``. Setting some coefficients to zero moves the others along the inverse of the
    second derivatives, so that a step or two are enough afterwards.
    """
    stay = [i for i in range(len(fit.columns)) if i not in set(gone)]
    beta = fit.beta[: len(fit.curvature)]
    inverse = np.linalg.pinv(fit.curvature, hermitian=True)
    rest = [*stay, *range(len(fit.columns), len(beta))]
    moved = beta[rest] - inverse[np.ix_(rest, gone)] @ np.linalg.solve(inverse[np.ix_(gone, gone)], beta[gone])
    if not fit.intercept:
        moved = np.append(moved, 0.0)
    left = fit.curvature[np.ix_(rest, rest)]
    factors = None if fit.factors is None else fit.factors[stay]
    columns = [fit.columns[i] for i in stay]
    return Fit(columns, fit.c, fit.held, fit.intercept, moved, left, weights=fit.weights, label=fit.label, unless=fit.unless, factors=factors)


def moments(rows: DataFrame, fits: list[Fit], width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each fit: sizes of its two classes, and deviations of its columns over the rows that count, in one pass."""
    parts = [(np.array([*f.columns], int), f.label, f.unless) for f in fits]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Each block's sums are around its own means, so that large values lose no digits.
        for labels, _, x in _blocks(batches, width):
            out = []
            for own, label, unless in parts:
                y, kept = _own_rows(labels, x, label, unless)
                y, mine = (y, x[:, own]) if kept is None else (y[kept], x[kept][:, own])
                mean = mine.mean(axis=0) if len(mine) else np.zeros(len(own))
                out.append(np.concatenate([[(y == 0).sum(), (y == 1).sum()], mean, ((mine - mean) ** 2).sum(axis=0)]))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(out)), pa.int32()), pa.array(out, pa.list_(pa.float64()))], ["fit", "sums"])

    def together(frame: pd.DataFrame) -> pd.DataFrame:
        sums = np.stack(frame["sums"])
        columns = (sums.shape[1] - 2) // 2
        n, mean = sums[:, :2].sum(axis=1)[:, None], sums[:, 2 : 2 + columns]
        size = n.sum()
        middle = (n * mean).sum(axis=0) / size if size else np.zeros(columns)
        squares = (sums[:, 2 + columns :] + n * (mean - middle) ** 2).sum(axis=0)
        whole = np.concatenate([sums[:, :2].sum(axis=0), np.sqrt(squares / (size - 1)) if size > 1 else np.zeros(columns)])
        return pd.DataFrame({"fit": frame["fit"].head(1), "sums": [whole]})

    schema = "fit int, sums array<double>"
    found = rows.select("y", "fold", "x").mapInArrow(count, schema).groupBy("fit").applyInPandas(together, schema).collect()
    sums = {r["fit"]: np.array(r["sums"]) for r in found}
    whole = [sums.get(k, np.zeros(2 + len(own))) for k, (own, _, _) in enumerate(parts)]
    return [(s[:2], s[2:]) for s in whole]


def scores_of(rows: DataFrame, fits: list[Fit], width: int) -> DataFrame:
    """``(fit, fold, y, score)``: the chance of 1 by every fit that may score a row.

    A fit without held-out fold scores all rows, the others only those of their fold.
    """
    wide, parts = _spread(fits, width), [(f.held, f.label, f.unless) for f in fits]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for labels, fold, x in _blocks(batches, width):
            _, chances = _chances(x, wide)
            for k, (mine, label, unless) in enumerate(parts):
                y, kept = _own_rows(labels, x, label, unless)
                own = np.full(len(y), True) if mine is None else fold == mine
                own = own if kept is None else own & kept
                columns = [np.full(own.sum(), k, np.int32), fold[own], y[own], chances[own, k]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["fit", "fold", "y", "score"])

    return rows.select("y", "fold", "x").mapInArrow(score, "fit int, fold int, y double, score double")


def confusions(rows: DataFrame, fits: list[Fit], width: int, threshold: float = 0.5) -> list[tuple[int, int, int, int]]:
    """``(tn, fp, fn, tp)`` of every fit over the rows it may score (see ``scores_of``), in one pass without a row per fit."""
    wide, held = _spread(fits, width), [f.held for f in fits]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(held), 4), np.int64)
        for y, fold, x in _blocks(batches, width):
            _, chances = _chances(x, wide)
            kind = (chances > threshold) + 2 * (y == 1)[:, None]
            mine = np.array([np.full(len(y), True) if h is None else fold == h for h in held]).T
            for k in range(4):
                totals[:, k] += ((kind == k) & mine).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(held)), pa.int32()), *(pa.array(t) for t in totals.T)], ["fit", *COUNTS])

    names = ", ".join(f"{c} long" for c in COUNTS)
    counted = rows.select("y", "fold", "x").mapInArrow(count, f"fit int, {names}").groupBy("fit").agg(*[F.sum(c).alias(c) for c in COUNTS])
    found = {r["fit"]: tuple(r[c] for c in COUNTS) for r in counted.collect()}
    return [found.get(k, (0, 0, 0, 0)) for k in range(len(fits))]
