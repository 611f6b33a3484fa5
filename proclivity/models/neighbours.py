"""Exact k-nearest-neighbour vote without a cross join.

Equal vectors are counted first, so groups of copies become single rows. As long as the distinct training vectors fit a
checked size, every task holds them as one matrix and scores its rows in one pass, without a shuffle. Beyond that size
they are cut into smaller parts, and the vectors asked for keep their k nearest so far while they meet one part
after the other. No pair and no copy of a vector is written: the disk holds both sides once and the k nearest of each
vector, the version of the last round until the next one is there.

Inside a task the training vectors lie in leaves of near ones. A leaf is looked at only by the vectors whose distance to
its box does not exceed their k-th distance so far; there one matrix product on the principal axes gives a lower bound of
every distance, below it by more than its rounding, and a distance is computed only where that bound does not exceed the
k-th distance either.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proclivity.functions.columns import col
from proclivity.functions.sqltext import as_double
from proclivity.operators.base import FittedStep, Step
from proclivity.session import Rolling

#: Distinct training vectors up to so many bytes are sent to every task at once.
MATRIX_BYTES = 64_000_000
#: Bytes of the training vectors of a part, which pass through the driver.
PART_BYTES = 32_000_000
#: Distances that are held at once.
HELD = 2_000_000
#: Pairs whose vectors are held at once.
AT_ONCE = 4_096
#: Vectors asked for in a file, at least, where there are many.
QUERY_BLOCK = 70_000
#: Training vectors of a part at most.
TRAIN_CHUNK = 200_000
#: Training vectors of a leaf, and those that give the first k-th distances.
LEAF, FIRST_PART = 256, 2_048
#: Leaves next to a vector that it meets before all others, as long as it has no k-th distance of an earlier part.
FIRST_LEAVES = 2
#: Axes that leaves have boxes on.
BOX_AXES = 8
#: Share of the variance on the axes that bounds are computed on.
HELD_VARIANCE = 0.97
#: Largest entries for which bounds are computed in single and in double precision.
SINGLE, DOUBLE = 1e8, 1e140
#: Distance, rows and positive rows of a neighbour not found yet; sorted behind all others.
NOBODY = (np.nan, np.inf, 0.0)


def _distances(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """Minkowski distances of all rows of ``a`` to all rows of ``b``."""
    out = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        step = np.abs(a[:, i : i + 1] - b[:, i])
        out += step if p == 1 else step**p
    return out if p == 1 else out ** (1.0 / p)


def _pairs(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """Distances between equal columns of both, added up in the order of ``_distances``."""
    out = np.zeros(a.shape[1])
    for x, y in zip(a, b, strict=True):
        step = np.abs(x - y)
        out += step if p == 1 else step**p
    return out if p == 1 else out ** (1.0 / p)


class Known:
    """Training vectors by column, in leaves of near ones, with the rows and positive rows of each.

    Leaves are halves of halves along the first principal axes.
    """

    def __init__(self, vectors: np.ndarray, n: np.ndarray, pos: np.ndarray):
        if np.isnan(vectors).any():
            raise ValueError("features have missing values; fill them first")
        self.size, self.width = vectors.shape
        self.largest = np.abs(vectors).max(initial=0)
        self.bounded = bool(self.size and self.width and self.largest < DOUBLE)
        order = np.arange(self.size)
        if self.bounded:
            self.centre = vectors.mean(axis=0)
            centred = vectors - self.centre
            share, axes = np.linalg.eigh(centred.T @ centred)
            held = np.cumsum(np.maximum(share[::-1], 0))
            self.axes = axes[:, ::-1][:, : 1 + int(np.searchsorted(held, HELD_VARIANCE * held[-1]))].copy()
            on_axes = centred @ self.axes[:, :BOX_AXES]
            del centred
            order = _leaf_order(on_axes)
        self.columns = np.ascontiguousarray(vectors.T[:, order])
        self.counts = np.column_stack([n, pos])[order].astype(float)

    def bounds(self, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The right side of the matrix product, and the least and largest entries of each leaf on each axis."""
        if kind not in self.__dict__.setdefault("_bounds", {}):
            m = self.axes.shape[1]
            right = np.ones((m + 2, self.size), kind)
            for at in range(0, self.size, FIRST_PART):
                b = self.axes.T @ (self.columns[:, at : at + FIRST_PART] - self.centre[:, None])
                right[:m, at : at + FIRST_PART] = b
                right[m, at : at + FIRST_PART] = _less(m, kind) * (b * b).sum(axis=0)
            starts = np.arange(0, self.size, LEAF)
            boxes = [f.reduceat(right[: min(m, BOX_AXES)], starts, axis=1) for f in (np.minimum, np.maximum)]
            self._bounds[kind] = (right, *boxes)
        return self._bounds[kind]


def _less(axes: int, kind) -> float:
    """What is left of the squares, so that the product stays below the distance whatever it rounds."""
    return 1 - 4 * (axes + 8) * np.finfo(kind).eps


def _leaf_order(x: np.ndarray) -> np.ndarray:
    """Rows in the order of their leaves, all but the last of ``LEAF`` rows."""
    parts, open_ = [], [np.arange(len(x))]
    while open_:
        rows = open_.pop()
        if len(rows) <= LEAF:
            parts.append(rows)
            continue
        here = x[rows]
        along = here[:, here.var(axis=0).argmax()]
        half = max(LEAF, len(rows) // 2 // LEAF * LEAF)
        split = np.argpartition(along, half)
        open_ += [rows[split[half:]], rows[split[:half]]]
    return np.concatenate(parts)


def _nobody(rows: int, k: int) -> np.ndarray:
    return np.tile(np.array(NOBODY), (rows, k, 1))


def _limits(near: np.ndarray) -> np.ndarray:
    last = near[:, -1, 0]
    return np.where(np.isnan(last), np.inf, last)


def _merge(near: np.ndarray, rows: np.ndarray, found: np.ndarray) -> None:
    """Put candidates among the nearest; at one distance those of fewer rows, then of fewer positives come first."""
    k = near.shape[1]
    touched = np.zeros(len(near), bool)
    touched[rows] = True
    at = np.flatnonzero(touched)
    number = np.cumsum(touched) - 1
    rows = np.r_[np.repeat(np.arange(len(at)), k), number[rows]]
    found = np.vstack([near[at].reshape(-1, 3), found])
    order = np.lexsort((found[:, 2], found[:, 1], found[:, 0], rows))
    sizes = np.bincount(rows, minlength=len(at))
    starts = np.cumsum(sizes) - sizes
    near[at] = found[order[starts[:, None] + np.arange(k)]]


def _search(asked: np.ndarray, near: np.ndarray, known: Known, p: int) -> None:
    """Put the training vectors that belong there among the nearest of each row asked for."""
    largest = max(np.abs(asked).max(initial=0), known.largest)
    bounded = known.bounded and largest < DOUBLE
    step = max(1, HELD // (-(-known.size // LEAF) if bounded else max(1, known.size)))
    for low in range(0, len(asked) if known.size else 0, step):
        part = slice(low, low + step)
        if bounded:
            _search_leaves(asked[part], near[part], known, p, largest)
        else:
            _search_all(asked[part], near[part], known, p)


def _search_all(asked: np.ndarray, near: np.ndarray, known: Known, p: int) -> None:
    d = _distances(asked, known.columns.T, p)
    last = min(near.shape[1], known.size) - 1
    limit = np.partition(d, last, axis=1)[:, last : last + 1]
    rows, found = np.nonzero(~(d > limit))
    _merge(near, rows, np.column_stack([d[rows, found], known.counts[found]]))


def _search_leaves(asked: np.ndarray, near: np.ndarray, known: Known, p: int, largest: float) -> None:
    k, kind = near.shape[1], np.float32 if largest < SINGLE else np.float64
    right, least, most = known.bounds(kind)
    m, by_column = len(right) - 2, asked.T.copy()
    a = (asked - known.centre) @ known.axes
    squares = (a * a).sum(axis=1)
    # |a|^2 + |b|^2 - 2ab as one product; the shares taken off the squares exceed the rounding of entries and product.
    left = np.column_stack([-2 * a, np.ones(len(a)), _less(m, kind) * squares]).astype(kind)
    # Centring and turning round against the size of the plain entries; boxes hold entries rounded to the kind.
    eps = np.finfo(kind).eps
    rounding = 8 * np.finfo(float).eps * known.width**2 * largest
    rounding += eps * (np.sqrt(squares.max()) + np.sqrt(right[m].max()))
    # A distance of order p is at least that of order 2 by this factor.
    stretch = known.width ** max(0.0, 0.5 - 1.0 / p)
    limit = _limits(near)

    def reach() -> np.ndarray:
        # Finite, so that leaves already met, which get an infinite gap, stay out.
        wide = (limit * stretch + rounding) ** 2 * (1 + 1e-6 + 4 * (m + 8) * eps)
        return np.minimum(wide, np.finfo(kind).max).astype(kind)

    first = bool(np.isinf(limit).any())
    if first and k <= known.size:
        # Any k training vectors bound the k-th distance.
        some = np.linspace(0, known.size - 1, min(known.size, max(FIRST_PART, k))).astype(int)
        sample, step = right[:, some].copy(), max(1, HELD // len(some))
        for low in range(0, len(asked), step):
            part = slice(low, low + step)
            at = some[np.argpartition(left[part] @ sample, k - 1, axis=1)[:, :k]]
            for_all = np.max([_pairs(by_column[:, part], known.columns[:, j], p) for j in at.T], axis=0)
            limit[part] = np.minimum(limit[part], for_all)
    gaps = np.zeros((least.shape[1], len(asked)), kind)
    gap, other = np.empty_like(gaps), np.empty_like(gaps)
    for x, lo, hi in zip(a.T[: len(least)].astype(kind), least, most, strict=True):
        np.subtract(lo[:, None], x, out=gap)
        np.subtract(x, hi[:, None], out=other)
        np.maximum(gap, other, out=gap)
        np.maximum(gap, 0, out=gap)
        np.multiply(gap, gap, out=gap)
        gaps += gap
    del gap, other
    within, rows, found = reach(), [], []

    def take() -> None:
        nonlocal limit, within
        if rows:
            r, c = np.concatenate(rows), np.concatenate(found)
            pairs = [slice(at, at + AT_ONCE) for at in range(0, len(r), AT_ONCE)]
            d = np.concatenate([_pairs(by_column[:, r[at]], known.columns[:, c[at]], p) for at in pairs])
            use = d <= limit[r]
            _merge(near, r[use], np.column_stack([d[use], known.counts[c[use]]]))
            limit = np.minimum(limit, _limits(near))
            within = reach()
            rows.clear(), found.clear()

    def visit(leaf: int, who: np.ndarray) -> None:
        start = leaf * LEAF
        bound = left[who] @ right[:, start : start + LEAF]
        some = np.flatnonzero(bound.min(axis=1) <= within[who])
        if len(some):
            who = who[some]
            r, c = np.nonzero(bound[some] <= within[who, None])
            rows.append(who[r])
            found.append(c + start)

    if first:
        for _ in range(min(FIRST_LEAVES, len(gaps))):
            nearest = gaps.argmin(axis=0)
            order = np.argsort(nearest, kind="stable")
            for who in np.split(order, np.flatnonzero(np.diff(nearest[order])) + 1):
                visit(nearest[who[0]], who)
            gaps[nearest, np.arange(len(asked))] = np.inf
            take()
    for leaf, to in enumerate(gaps):
        who = np.flatnonzero(to <= within)
        if len(who):
            visit(leaf, who)
            if sum(map(len, rows)) > HELD // 16:
                take()
    take()


def _nearest(asked: np.ndarray, known: np.ndarray, k: int, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``known`` and distances of the k nearest of each row asked for; at one distance the first places."""
    k = min(k, len(known))
    near = _nobody(len(asked), k)
    if near.size:
        _search(asked, near, Known(known, np.zeros(len(known)), np.arange(len(known))), p)
    return near[:, :, 2].astype(int), near[:, :, 0]


def _array(column, width: int) -> np.ndarray:
    """Vectors of an Arrow column as one matrix; gaps become NaN."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(column), width)


def _packed(rows: np.ndarray) -> pa.Array:
    """One binary value a row."""
    rows = np.ascontiguousarray(rows, float)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.nbytes // max(1, len(rows)))
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


def _unpacked(column: pa.Array, *shape: int) -> np.ndarray:
    """What ``_packed`` was given."""
    if not len(column):
        return np.empty((0, *shape))
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    values = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    return values.copy().view(float).reshape(len(column), *shape)


def _vectors(df: DataFrame, features: list[str]) -> DataFrame:
    # A negative zero is turned into zero, so that equal vectors are equal keys.
    return df.withColumn("__v", F.expr("array(" + ", ".join(f"{as_double(c)} + 0D" for c in features) + ")"))


class NearestNeighbours(Step):
    """``k`` neighbours, ``weights`` uniform or by inverse distance, ``p`` 1 or 2.

    When the k-th neighbour lies in a group of equal vectors, the group counts with its share.
    """

    def __init__(
        self, features: list[str], k: int = 5, weights: str = "uniform", p: int = 2, label="label", matrix_bytes: int = MATRIX_BYTES
    ):
        super().__init__()
        self.matrix_bytes = matrix_bytes
        if k < 1 or p < 1 or weights not in ("uniform", "distance"):
            raise ValueError("k and p start at 1; weights are uniform or distance")
        self.features = features
        self.k, self.weights, self.p, self.label = k, weights, p, label

    def _fit(self, df: DataFrame) -> NeighboursModel:
        counted = (
            _vectors(df.where(col(self.label).isNotNull()), self.features)
            .groupBy("__v")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(col(self.label).cast("long")).alias("pos"))
        )
        table = Rolling(df.sparkSession, "neighbours")
        counted = table.write(counted.select("__v", "n", "pos"))
        state = {"features": self.features, "k": self.k, "weights": self.weights, "p": self.p}
        size, one = counted.count(), 8 * (len(self.features) + 2)
        if size * one <= self.matrix_bytes:
            return NeighboursModel({**state, "matrix": True}, counted)
        parts = -(-size // max(1, min(TRAIN_CHUNK, PART_BYTES // one)))
        # Each file holds few parts, in order, so that a part is read without the others.
        cut = counted.withColumn("part", F.pmod(F.xxhash64("__v"), F.lit(parts)).cast("int"))
        cut = cut.repartition(parts, "part").sortWithinPartitions("part")
        return NeighboursModel({**state, "parts": parts}, table.write(cut))


class NeighboursModel(FittedStep):
    """Adds ``score`` and ``prediction``."""

    parts = ("train",)

    def __init__(self, state: dict, train: DataFrame):
        super().__init__(state)
        self.train = train

    def _known(self, rows: DataFrame) -> Known:
        known = rows.select("__v", "n", "pos").toArrow()
        vectors = _array(known.column("__v"), len(self.state["features"]))
        return Known(vectors, known.column("n").to_numpy(), known.column("pos").to_numpy())

    def _transform(self, df: DataFrame) -> DataFrame:
        return self._by_matrix(df) if self.state.get("matrix") else self._by_parts(df)

    def _by_matrix(self, df: DataFrame) -> DataFrame:
        """Every row against the whole matrix, which the fit has found small enough."""
        s = self.state
        k, p, by_distance = s["k"], s["p"], s["weights"] == "distance"
        shared = df.sparkSession.sparkContext.broadcast(self._known(self.train))
        names = [f"c{i}" for i in range(len(df.columns))]
        rows = _vectors(df, s["features"]).select(*[col(c).alias(n) for c, n in zip(df.columns, names, strict=True)], "__v")
        added = [T.StructField("score", T.DoubleType()), T.StructField("prediction", T.DoubleType())]
        fields = [T.StructField(n, f.dataType) for n, f in zip(names, df.schema.fields, strict=True)]

        def score(batches):
            known = shared.value
            for batch in batches:
                own = _array(batch.column(len(names)), known.width)
                found = np.full(batch.num_rows, np.nan)
                whole = ~np.isnan(own).any(axis=1)
                if known.size and whole.any():
                    near = _nobody(int(whole.sum()), k)
                    _search(own[whole], near, known, p)
                    found[whole] = _votes(near, by_distance)
                scores = pa.array(found, from_pandas=True)
                hits = pa.array(np.where(np.isnan(found), np.nan, found > 0.5), from_pandas=True)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], scores, hits], [*names, "score", "prediction"])

        scored = rows.mapInArrow(score, T.StructType([*fields, *added]))
        return scored.select(*[F.col(n).alias(c) for c, n in zip(df.columns, names, strict=True)], "score", "prediction")

    def _by_parts(self, df: DataFrame) -> DataFrame:
        """The distinct rows against one part of the training vectors after the other."""
        context, s = df.sparkSession.sparkContext, self.state
        k, p, width, by_distance = s["k"], s["p"], len(s["features"]), s["weights"] == "distance"
        keyed = _vectors(df, s["features"])
        asked = keyed.select("__v").where("NOT exists(__v, x -> x IS NULL OR isnan(x))").distinct()
        table = Rolling(df.sparkSession, "asked")
        asked = table.write(asked)
        many = context.defaultParallelism
        many *= max(1, asked.count() // (many * QUERY_BLOCK))

        def begin(batches):
            for batch in batches:
                own = _array(batch.column(0), width)
                yield _batch(own, _nobody(len(own), k))

        def meet(shared):
            def go(batches):
                for batch in batches:
                    own, near = _unpacked(batch.column(0), width), _unpacked(batch.column(1), k, 3)
                    _search(own, near, shared.value, p)
                    yield _batch(own, near)

            return go

        def end(batches):
            for batch in batches:
                scores = pa.array(_votes(_unpacked(batch.column(1), k, 3), by_distance), from_pandas=True)
                own = pa.array(_unpacked(batch.column(0), width).ravel())
                offsets = pa.array(np.arange(batch.num_rows + 1) * width, pa.int32())
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, own), scores], ["__v", "score"])

        packed = "v binary, near binary"
        asked = table.write(asked.repartition(many, "__v").mapInArrow(begin, packed))
        for part in range(s["parts"]):
            shared = context.broadcast(self._known(self.train.where(F.col("part") == part)))
            asked = table.write(asked.mapInArrow(meet(shared), packed))
            shared.destroy()
        votes = table.write(asked.mapInArrow(end, "__v array<double>, score double"))
        return (
            keyed.join(votes, "__v", "left")
            .withColumn("prediction", (F.col("score") > 0.5).cast("double"))
            .select(*[col(c) for c in df.columns], "score", "prediction")
        )


def _batch(own: np.ndarray, near: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_packed(own), _packed(near)], ["v", "near"])


def _votes(near: np.ndarray, by_distance: bool) -> np.ndarray:
    """Share of positives among the first k rows of the nearest, in their order."""
    distances, n, pos = near[:, :, 0], near[:, :, 1], near[:, :, 2]
    there = np.isfinite(n)
    n = np.where(there, n, 0.0)
    taken = np.clip(near.shape[1] - (np.cumsum(n, axis=1) - n), 0, n)
    if by_distance:
        exact = distances[:, :1] == 0
        with np.errstate(divide="ignore"):
            weights = np.where(exact, distances == 0, 1 / np.where(exact, 1.0, distances))
        taken = np.where(there, taken * weights, 0.0)
    return (taken * pos / np.where(there, n, 1.0)).sum(axis=1) / taken.sum(axis=1)
