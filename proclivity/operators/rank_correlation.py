"""Spearman correlation of all pairs of columns, with nulls dropped pair by pair.

A column's ranks depend on which rows its partner leaves. Columns with nulls in exactly the same rows leave the same
rows, so there are as many rankings of a column as there are distinct sets of gaps, not as many as partners. Rows are
counted once per (column, value) and gap set; running counts over the values give the average ranks of all rankings.
Ranks are then put to the rows, and each task reduces its rows to one matrix of products of centred ranks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.functions.columns import col
from proclivity.functions.sqltext import as_double
from proclivity.operators.correlation import null_overlaps
from proclivity.operators.running import running_sums
from proclivity.schema import numeric_columns
from proclivity.session import written

#: A table of ranks up to so many bytes is sent to all tasks; a larger one is joined to the rows.
LOOKUP_BYTES = 64_000_000
#: Rows whose ranks are held at once.
TOGETHER = 2_000


def gap_sets(df: DataFrame, columns: list[str]) -> list[int]:
    """For each column the number of its set of null rows; columns with nulls in the same rows share one."""
    if len(columns) < 2:
        return [0] * len(columns)
    same: dict[str, str] = {}
    # One row per pair of columns.
    for r in null_overlaps(df, columns).where("nulls_a = nulls_b AND nulls_a = both").collect():
        a, b = sorted((r["feature_a"], r["feature_b"]), key=columns.index)
        same[b] = min(same.get(b, a), a, key=columns.index)
    first = [same.get(c, c) for c in columns]
    numbers = {c: i for i, c in enumerate(dict.fromkeys(first))}
    return [numbers[c] for c in first]


def _rank_table(values: DataFrame, sets: int) -> DataFrame:
    """``(feature, value, counts, ranks)``: rows with this value and the average rank, for each gap set.

    ``values`` has (feature, value, there): which gap sets' columns the row has.
    """
    names = [f"n{g}" for g in range(sets)]
    counts = values.groupBy("feature", "value").agg(*[F.sum(F.get("there", F.lit(g)).cast("long")).alias(n) for g, n in enumerate(names)])
    upto = running_sums(counts, ["feature"], "value", names)
    ranks = [F.col(f"{n}_upto") - (F.col(n) - 1) / 2 for n in names]
    return upto.select(
        "feature", "value", F.array(*[F.col(n).cast("double") for n in names]).alias("counts"), F.array(*ranks).alias("ranks")
    )


class _Products:
    """Adds up products of centred ranks, gap set by gap set."""

    def __init__(self, of: np.ndarray, means: np.ndarray):
        self.of, self.means, width = of, means, len(of)
        self.members = [np.flatnonzero(of == g) for g in range(means.shape[1])]
        self.total = np.zeros((width, width))

    def add(self, ranks: np.ndarray) -> None:
        """``ranks``: row, column, gap set; NaN where the column is null."""
        there = ~np.isnan(ranks[:, [m[0] for m in self.members], 0])
        centred = np.nan_to_num(ranks - self.means)
        for g, own in enumerate(self.members):
            for h, others in enumerate(self.members):
                left = centred[:, own, h] * there[:, h, None]
                self.total[np.ix_(own, others)] += left.T @ (centred[:, others, g] * there[:, g, None])

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([self.total.ravel()], pa.list_(pa.float64()))], ["products"])


def _by_lookup(frame: DataFrame, table: DataFrame, of: np.ndarray, means: np.ndarray) -> DataFrame:
    """Products with the ranks looked up in a table of checked size that every task holds."""
    width, sets = means.shape
    lookup = table.select("feature", "value", "ranks").orderBy("feature", "value").toArrow()
    feature = lookup.column("feature").to_numpy()
    value, ranks = lookup.column("value").to_numpy(), lookup.column("ranks").combine_chunks().flatten().to_numpy().reshape(-1, sets)
    cut = np.searchsorted(feature, np.arange(width + 1))
    shared = frame.sparkSession.sparkContext.broadcast((value, ranks, cut))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value, ranks, cut = shared.value
        products = _Products(of, means)
        for whole in batches:
            for low in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(low, TOGETHER)
                found = np.full((batch.num_rows, width, sets), np.nan)
                for i in range(width):
                    x = batch.column(i).to_numpy(zero_copy_only=False)
                    known = ~np.isnan(x)
                    own = slice(cut[i], cut[i + 1])
                    found[known, i] = ranks[own][np.searchsorted(value[own], x[known])]
                products.add(found)
        yield products.batch()

    return frame.mapInArrow(run, "products array<double>")


def _by_join(frame: DataFrame, table: DataFrame, of: np.ndarray, means: np.ndarray) -> DataFrame:
    """Products with the ranks joined to the values of numbered rows, which then come together again."""
    width, sets = means.shape
    # Numbers are drawn before the shuffle and written, so a repeated task sees the same ones.
    with_values = frame.select("row", F.posexplode(F.array(*[F.col(f"c{i}") for i in range(width)])).alias("feature", "value"))
    placed = with_values.where(F.col("value").isNotNull()).join(table.select("feature", "value", "ranks"), ["feature", "value"])
    rows = placed.groupBy("row").agg(F.collect_list(F.struct("feature", "ranks")).alias("found")).select("found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = _Products(of, means)
        for whole in batches:
            for low in range(0, whole.num_rows, TOGETHER):
                lists = whole.slice(low, TOGETHER).column(0)
                inner = lists.flatten()
                row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                found = np.full((len(lists), width, sets), np.nan)
                found[row, inner.field("feature").to_numpy()] = inner.field("ranks").flatten().to_numpy().reshape(-1, sets)
                products.add(found)
        yield products.batch()

    return rows.mapInArrow(run, "products array<double>")


def spearman_matrix(df: DataFrame, columns: list[str] | None = None, lookup_bytes: int = LOOKUP_BYTES) -> DataFrame:
    """``(feature_a, feature_b, n, correlation)`` for all ordered pairs, nulls (and NaN) dropped pair by pair.

    Ties have average ranks. A pair without common rows, or with a side without spread in them, has a null correlation.
    The table of ranks has a row per distinct value of a column; up to ``lookup_bytes`` it is held by every task, beyond
    that it is joined to the rows, where a value that most rows share is split like any skewed join key.
    """
    names = numeric_columns(df, columns)
    width, spark = len(names), df.sparkSession
    schema = "feature_a string, feature_b string, n bigint, correlation double"
    if not names:
        return spark.createDataFrame([], schema)
    # A negative zero counts as zero.
    plain = {c: f"CASE WHEN NOT isnan({as_double(c)}) THEN {as_double(c)} + 0D END" for c in names}
    given = df.selectExpr(*[f"{e} AS c{i}" for i, e in enumerate(plain.values())])
    with written(given.withColumn("row", F.monotonically_increasing_id()), "ranked-rows") as frame:
        cells = [f"c{i}" for i in range(width)]
        of = np.array(gap_sets(frame, cells))
        sets = int(of.max()) + 1
        heads = [cells[int(np.flatnonzero(of == g)[0])] for g in range(sets)]
        there = F.array(*[col(c).isNotNull() for c in heads])
        values = frame.select(there.alias("there"), F.posexplode(F.array(*[F.col(c) for c in cells])).alias("feature", "value"))
        with written(_rank_table(values.where(F.col("value").isNotNull()), sets), "ranks") as table:
            # Per column and gap set: rows, and the sum of squares of their centred ranks.
            each = table.select("feature", F.posexplode(F.arrays_zip("counts", "ranks")).alias("set", "x"))
            sizes = each.groupBy("feature", "set").agg(F.sum("x.counts").alias("n"))
            n = np.zeros((width, sets))
            for r in sizes.collect():
                n[r["feature"], r["set"]] = r["n"]
            means = (n + 1) / 2
            centre = F.get(F.array(*[F.lit(float(m)) for m in means.ravel()]), F.col("feature") * sets + F.col("set"))
            spread = np.zeros((width, sets))
            squares = F.sum(F.col("x.counts") * F.pow(F.col("x.ranks") - centre, 2))
            for r in each.groupBy("feature", "set").agg(squares.alias("s")).collect():
                spread[r["feature"], r["set"]] = r["s"]
            small = table.count() * (8 * sets + 16) <= lookup_bytes
            products = _by_lookup(frame.select(*cells), table, of, means) if small else _by_join(frame, table, of, means)
            summed = products.select(F.posexplode("products").alias("cell", "p")).groupBy("cell").agg(F.sum("p").alias("p"))
            total = np.zeros(width * width)
            for r in summed.collect():
                total[r["cell"]] = r["p"]
    total = total.reshape(width, width)
    common, of_a = n[:, of], spread[:, of]
    below = np.sqrt(of_a * of_a.T)
    rows = [
        (names[i], names[j], int(common[i, j]), float(total[i, j] / below[i, j]) if below[i, j] > 0 else None)
        for i in range(width)
        for j in range(width)
    ]
    return spark.createDataFrame(rows, schema)
