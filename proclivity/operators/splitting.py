"""Stratified splits, folds and class weights.

Rows are ordered by the MD5 of key and seed, which is random to the data yet the same on every
run. An exact split needs the hash at given ranks of each class. Those are found from counts per
hash prefix (a table of fixed size) and from the rows of the few prefixes that hold a wanted rank;
the split itself is then a comparison with one cut per class, so no wide row is ever shuffled.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proclivity.functions.columns import col
from proclivity.schema import ID_COLUMN, TARGET_COLUMN

PREFIX_DIGITS = 4
MAX_CLASSES = 1_000


def split_hash(key: str, seed: int) -> Column:
    """MD5 of ``<key>:<seed>`` as text."""
    return F.md5(F.concat(col(key).cast("string"), F.lit(f":{seed}")))


def split_share(key: str, seed: int) -> Column:
    """The same hash as a number in [0, 1)."""
    head = F.conv(F.substring(split_hash(key, seed), 1, 8), 16, 10).cast("double")
    return head / F.lit(4294967296.0)


def hash_cuts(
    df: DataFrame, key: str, target: str, ranks: list, seed: int, prefix: int = PREFIX_DIGITS
) -> DataFrame:
    """``(class, cuts)``: for each class the hashes at the given ranks, ascending.

    ``ranks`` are functions from the class size column to a 1-based rank column; rank 0 means
    that no row lies at or below the cut. The number of classes is checked first, as everything
    per class is broadcast afterwards.
    """
    _class_sizes(df, target, required=True)
    hashed = df.select(col(target).alias("__class"), split_hash(key, seed).alias("__hash"))
    head = F.substring("__hash", 1, prefix)
    by_prefix = hashed.groupBy("__class", head.alias("__head")).agg(F.count(F.lit(1)).alias("n"))
    in_class = Window.partitionBy("__class")
    upto = in_class.orderBy("__head").rowsBetween(Window.unboundedPreceding, 0)
    placed = by_prefix.select(
        "__class",
        "__head",
        "n",
        F.sum("n").over(upto).alias("upto"),
        F.sum("n").over(in_class).alias("size"),
    )
    wanted = F.array(
        *[F.struct(F.lit(i).alias("i"), r(F.col("size")).cast("bigint").alias("rank")) for i, r in enumerate(ranks)]
    )
    holders = (
        placed.select("*", F.inline(wanted))
        .where((F.col("rank") > F.col("upto") - F.col("n")) & (F.col("rank") <= F.col("upto")))
        .select("__class", "__head", "i", (F.col("rank") - F.col("upto") + F.col("n")).alias("local"))
    )
    # At most one prefix per class and rank.
    rows = hashed.withColumn("__head", head).join(F.broadcast(holders), ["__class", "__head"])
    order = Window.partitionBy("__class", "i").orderBy("__hash")
    cuts = (
        rows.withColumn("__row", F.row_number().over(order))
        .where(F.col("__row") == F.col("local"))
        .groupBy("__class")
        .agg(F.array_sort(F.collect_list(F.struct("i", "__hash"))).alias("found"))
    )
    classes = by_prefix.select("__class").distinct()
    found = F.coalesce(F.col("found"), F.array().cast("array<struct<i:int,__hash:string>>"))
    return classes.join(cuts, "__class", "left").select(
        "__class", F.transform(found, lambda s: s["__hash"]).alias("cuts")
    )


def _with_cuts(df: DataFrame, cuts: DataFrame, target: str) -> DataFrame:
    # One row per class, and their number was checked.
    side = F.broadcast(cuts.withColumnRenamed("__class", "__cut_class"))
    return df.join(side, col(target).eqNullSafe(F.col("__cut_class")), "left")


def stratified_split(
    df: DataFrame,
    share: float = 0.7,
    target: str = TARGET_COLUMN,
    key: str = ID_COLUMN,
    seed: int = 5,
    column: str = "split",
) -> DataFrame:
    """Add ``train``/``val`` so that round(share · size) rows of every class are in train."""
    if not 0 < share < 1:
        raise ValueError("share must lie between 0 and 1")
    # As a decimal, since 0.7 of a class can be an exact half that binary fractions miss.
    exact = F.lit(Decimal(str(share)))
    cuts = hash_cuts(df, key, target, [lambda size: F.round(size * exact)], seed)
    inside = F.coalesce(split_hash(key, seed) <= F.get("cuts", 0), F.lit(False))
    return (
        _with_cuts(df, cuts, target)
        .withColumn(column, F.when(inside, "train").otherwise("val"))
        .select(*[col(c) for c in df.columns], column)
    )


def approximate_split(
    df: DataFrame, share: float = 0.7, key: str = ID_COLUMN, seed: int = 5, column: str = "split"
) -> DataFrame:
    """The same split with shares met only on average: a projection, no statistics."""
    return df.withColumn(
        column, F.when(split_share(key, seed) < F.lit(share), "train").otherwise("val")
    )


def stratified_folds(
    df: DataFrame,
    folds: int = 5,
    target: str = TARGET_COLUMN,
    key: str = ID_COLUMN,
    seed: int = 1,
    column: str = "fold",
) -> DataFrame:
    """Add a fold number 0…folds-1; within a class the fold sizes differ by one at most."""
    if folds < 2:
        raise ValueError("at least two folds are needed")

    def last_rank(i: int):
        return lambda size: F.floor(size * F.lit(i) / F.lit(folds))

    cuts = hash_cuts(df, key, target, [last_rank(i) for i in range(1, folds)], seed)
    me = split_hash(key, seed)
    # Classes smaller than the number of folds have fewer cuts; the last folds take their rows.
    passed = F.size(F.filter("cuts", lambda cut: cut < me))
    missing = F.lit(folds - 1) - F.size("cuts")
    return (
        _with_cuts(df, cuts, target)
        .withColumn(column, (passed + missing).cast("int"))
        .select(*[col(c) for c in df.columns], column)
    )


def _class_sizes(df: DataFrame, target: str, required: bool = False) -> dict:
    """Rows by class; with ``required`` a row without class is an error."""
    rows = (
        df.groupBy(col(target).alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
        .limit(MAX_CLASSES + 1)
        .collect()
    )
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{target} has more than {MAX_CLASSES} classes")
    if required and any(r["label"] is None for r in rows):
        raise ValueError(f"rows without {target} cannot be split by class; fill or remove them first")
    return {r["label"]: r["n"] for r in rows if r["label"] is not None}


def positive_weight(df: DataFrame, target: str = TARGET_COLUMN, column: str = "weight", sizes: dict | None = None) -> DataFrame:
    """Add a weight of negatives/positives for positive rows and 1 for the others; ``sizes`` are the rows by class if known."""
    sizes = _class_sizes(df, target) if sizes is None else sizes
    ratio = sizes.get(0, 0) / sizes[1] if sizes.get(1) else 1.0
    return df.withColumn(column, F.when(col(target) == 1, F.lit(float(ratio))).otherwise(F.lit(1.0)))


def balanced_weight(df: DataFrame, target: str = TARGET_COLUMN, column: str = "weight", sizes: dict | None = None) -> DataFrame:
    """Add a weight of rows / (classes · class size); ``sizes`` are the rows by class if known."""
    sizes = _class_sizes(df, target) if sizes is None else sizes
    total = sum(sizes.values())
    weight = F.lit(1.0)
    for label, n in sizes.items():
        weight = F.when(col(target) == label, F.lit(total / (len(sizes) * n))).otherwise(weight)
    return df.withColumn(column, weight)
