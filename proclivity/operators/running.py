"""Running totals over an order without sending a whole group to one task.

A plain window over an unpartitioned or heavily skewed order sorts everything in one task.
Here the order is cut into ranges at approximate quantiles, totals per range are added up over
the few ranges, and the exact running total is formed inside each range on top of the total of
the ranges before it. The result is exact; only the cut points are approximate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from proclivity.functions.columns import col
from proclivity.functions.sqltext import ident
from proclivity.session import materialize, written

RANGES = 256
COARSE = 16
SMALL_GROUP = 100_000


def running_sums(
    df: DataFrame,
    group: list[str],
    order: str,
    sums: list[str],
    descending: bool = False,
    bounded_groups: bool = True,
    small_group: int = SMALL_GROUP,
) -> DataFrame:
    """Add ``<name>_upto`` (running total including the row) for each name in ``sums``.

    ``df`` holds one row per (group, order value); null order values are not allowed.
    Groups of at most ``small_group`` rows form a single range. ``bounded_groups`` states that the
    number of groups is bounded by the schema or by classes, so that the cut points (at most
    ``RANGES`` numbers a group) may be broadcast; otherwise Spark picks the join by size.
    """
    by = [col(g) for g in group]
    hint = F.broadcast if bounded_groups else (lambda frame: frame)

    probs = F.array(*[F.lit(i / RANGES) for i in range(1, RANGES)])
    cuts = (
        df.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("__rows"),
            F.percentile_approx(order, probs, 10 * RANGES).alias("__cuts"),
        )
        .where(F.col("__rows") > small_group)
        .select(
            *by,
            F.struct(
                F.col("__cuts").alias("all"),
                F.expr(f"filter(__cuts, (c, i) -> i % {COARSE} = {COARSE - 1})").alias("coarse"),
            ).alias("__cut"),
        )
    )
    if group:
        with_cuts = _join_by(df, hint(cuts), group)
    else:
        with_cuts = df.withColumn("__cut", cuts.scalar())
    # The range is the number of cuts below the value: first among every sixteenth, then in between.
    value = col(order)
    block = F.size(F.filter("__cut.coarse", lambda cut: cut < value)) * COARSE
    nearby = F.slice("__cut.all", F.col("__block") + 1, COARSE)
    rest = F.size(F.filter(nearby, lambda cut: cut < value))
    placed = (
        with_cuts.withColumn("__block", F.when(F.col("__cut").isNotNull(), block))
        .withColumn("__range", F.coalesce(F.col("__block") + rest, F.lit(0)))
        .drop("__cut", "__block")
    )
    # At most RANGES rows per group.
    direction = F.col("__range").desc() if descending else F.col("__range").asc()
    before = Window.partitionBy(*by).orderBy(direction).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        placed.groupBy(*by, "__range")
        .agg(*[F.sum(s).alias(f"__t_{s}") for s in sums])
        .select(
            *by,
            "__range",
            *[F.coalesce(F.sum(f"__t_{s}").over(before), F.lit(0)).alias(f"__o_{s}") for s in sums],
        )
    )
    inside = (
        Window.partitionBy(*by, "__range")
        .orderBy(value.desc() if descending else value.asc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    out = _join_by(placed, hint(offsets), [*group, "__range"])
    for s in sums:
        out = out.withColumn(f"{s}_upto", F.sum(s).over(inside) + F.col(f"__o_{s}"))
    return out.select(*[col(c) for c in df.columns], *[f"{s}_upto" for s in sums])


def _join_by(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys where null equals null: a null group is a group."""
    names = [f"__key_{k}" for k in range(len(keys))]
    other = right.withColumnsRenamed(dict(zip(keys, names, strict=True)))
    return left.join(other, [left[ident(k)].eqNullSafe(other[n]) for k, n in zip(keys, names, strict=True)], "left").drop(*names)


def order_statistics(
    df: DataFrame, group: list[str], value: str, probs: list[float], bounded_groups: bool = False
) -> DataFrame:
    """Exact interpolated quantiles of ``value`` for each group, as columns ``q0, q1, …``.

    One scan makes a mergeable sketch per group, which brackets each quantile; a second counts what lies below each
    bracket and how often each value in it occurs. Rows are not shuffled: only counts and the few values inside brackets
    are. Should a bracket miss its quantile, which the sketch's bound rules out, rows are counted per (group, value) instead.
    Groups may be many; ``bounded_groups`` states that their cut points may be broadcast in that last case.
    """
    rows = df.where(col(value).isNotNull()).select(*[col(g) for g in group], col(value).cast("double").alias("__v"))
    if not group or not probs:
        return _counted_statistics(rows, group, probs, bounded_groups)
    with written(_brackets(rows, group, probs), "brackets") as brackets:
        with written(_bracketed(rows, group, brackets, len(probs)), "bracketed") as counts:
            found = _picked(counts, brackets, group, probs)
            table = materialize(found, "quantiles")
    missed = " OR ".join(f"q{i} IS NULL" for i in range(len(probs)))
    return table if table.where(missed).isEmpty() else _counted_statistics(rows, group, probs, bounded_groups)


#: A sketch places a quantile within this share of a group's rows.
SKETCH = 1000


def _brackets(rows: DataFrame, group: list[str], probs: list[float]) -> DataFrame:
    """``(group…, __total, __low, __high)``: arrays with a bracket per quantile, twice as wide as the sketch's error."""
    reach = 2 / SKETCH
    ends = [[F.lit(float(max(0.0, p - reach))) for p in probs], [F.lit(float(min(1.0, p + reach))) for p in probs]]
    low, high = (F.percentile_approx("__v", F.array(*e), SKETCH) for e in ends)
    sketched = rows.groupBy(*[col(g) for g in group]).agg(
        F.count(F.lit(1)).alias("__total"), low.alias("__low"), high.alias("__high"), F.min("__v").alias("__min"), F.max("__v").alias("__max")
    )
    # A bracket that reaches an end of the group goes to its smallest or largest value.
    lows = [F.col("__min") if p <= reach else F.get("__low", F.lit(i)) for i, p in enumerate(probs)]
    highs = [F.col("__max") if p >= 1 - reach else F.get("__high", F.lit(i)) for i, p in enumerate(probs)]
    return sketched.select(*[col(g) for g in group], "__total", F.array(*lows).alias("__low"), F.array(*highs).alias("__high"))


def _bracketed(rows: DataFrame, group: list[str], brackets: DataFrame, quantiles: int) -> DataFrame:
    """``(group…, __i, __v, __n)``: rows per value inside the bracket of quantile __i, and below it (null __v)."""
    names = [f"__key_{k}" for k in range(len(group))]
    right = brackets.select(*[col(g).alias(n) for g, n in zip(group, names, strict=True)], "__low", "__high")
    same = [col(g).eqNullSafe(F.col(n)) for g, n in zip(group, names, strict=True)]
    v = F.col("__v")
    place = [
        F.when(v < F.get("__low", F.lit(i)), F.struct(F.lit(i).alias("i"), F.lit(None).cast("double").alias("v"))).when(
            v <= F.get("__high", F.lit(i)), F.struct(F.lit(i).alias("i"), v.alias("v"))
        )
        for i in range(quantiles)
    ]
    # The table of brackets is written, so its size is known: Spark sends it to the rows while it is small.
    placed = rows.join(right, same).select(*[col(g) for g in group], F.explode(F.array_compact(F.array(*place))).alias("p"))
    return placed.groupBy(*[col(g) for g in group], F.col("p.i").alias("__i"), F.col("p.v").alias("__v")).agg(F.count(F.lit(1)).alias("__n"))


def _picked(counts: DataFrame, brackets: DataFrame, group: list[str], probs: list[float]) -> DataFrame:
    """The quantiles from the counted values; null where a bracket does not hold one."""
    by = [col(g) for g in group]
    held = counts.groupBy(*by, "__i").agg(
        F.coalesce(F.sum(F.when(F.col("__v").isNull(), F.col("__n"))), F.lit(0)).alias("__below"),
        F.array_sort(F.collect_list(F.when(F.col("__v").isNotNull(), F.struct("__v", "__n")))).alias("__values"),
    )
    names = [f"__key_{k}" for k in range(len(group))]
    right = brackets.select(*[col(g).alias(n) for g, n in zip(group, names, strict=True)], "__total")
    same = [col(g).eqNullSafe(F.col(n)) for g, n in zip(group, names, strict=True)]
    p = F.get(F.array(*[F.lit(float(x)) for x in probs]), F.col("__i"))
    placed = held.join(right, same).withColumn("__position", (F.col("__total") - 1) * p)

    def at(rank):
        """The value at a rank, counted from 0, among the bracket's."""
        start = F.struct(F.col("__below").alias("seen"), F.lit(None).cast("double").alias("found"))
        step = lambda s, x: F.struct(
            (s["seen"] + x["__n"]).alias("seen"), F.when((s["seen"] <= rank) & (rank < s["seen"] + x["__n"]), x["__v"]).otherwise(s["found"]).alias("found")
        )
        return F.aggregate("__values", start, step, lambda s: s["found"])

    low, high = at(F.floor("__position")), at(F.ceil("__position"))
    one = placed.select(*by, "__i", low.alias("low"), high.alias("high"), (F.col("__position") - F.floor("__position")).alias("part"))
    value = F.col("low") + (F.col("high") - F.col("low")) * F.col("part")
    return one.groupBy(*by).agg(*[F.max(F.when(F.col("__i") == i, value)).alias(f"q{i}") for i in range(len(probs))])


def _counted_statistics(rows: DataFrame, group: list[str], probs: list[float], bounded_groups: bool) -> DataFrame:
    """``order_statistics`` from counts per (group, value): the two neighbours of each position by the running count."""
    by = [col(g) for g in group]
    counts = rows.groupBy(*by, "__v").agg(F.count(F.lit(1)).alias("__n"))
    upto = running_sums(counts, group, "__v", ["__n"], bounded_groups=bounded_groups)
    totals = counts.groupBy(*by).agg(F.sum("__n").alias("__total"))
    if group:
        joined = _join_by(upto, F.broadcast(totals) if bounded_groups else totals, group)
    else:
        joined = upto.withColumn("__total", totals.scalar())
    picks = []
    for i, p in enumerate(probs):
        position = (F.col("__total") - 1) * F.lit(float(p))
        low = F.floor(position)
        for side, rank in ((f"l{i}", low), (f"h{i}", F.ceil(position))):
            holds = (F.col("__n_upto") > rank) & (F.col("__n_upto") - F.col("__n") <= rank)
            picks.append(F.max(F.when(holds, F.col("__v"))).alias(side))
        picks.append(F.max(position - low).alias(f"f{i}"))
    quantiles = [
        (F.col(f"l{i}") + (F.col(f"h{i}") - F.col(f"l{i}")) * F.col(f"f{i}")).alias(f"q{i}")
        for i in range(len(probs))
    ]
    return joined.groupBy(*by).agg(*picks).select(*by, *quantiles)
