"""Bottom-k sketches of word shingles.

A text's shingles (five lower-cased words; a shorter text is one shingle) are hashed to 64 bits and the k
smallest distinct hashes are its sketch. Sketches of two parts merge into the sketch of their union, and two
sketches estimate resemblance, containment and the number of distinct shingles. Everything is a column
expression: nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Workspace, binary_search, let, text_or_empty

K = 128
WORDS = 5
#: Bounds of key ranges are binary-searched in an array of this many entries at most.
RANGE_STEPS = 12


def sketch(text: Column, k: int = K, words: int = WORDS) -> Column:
    """The k smallest distinct shingle hashes, ascending; a text without words has one hash, of no words."""
    hashes = F.transform(
        F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != ""), lambda w: F.xxhash64(w)
    )

    def shingled(h: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(h) - (words - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(h, i, words)))

    return F.slice(F.sort_array(F.array_distinct(let(hashes, shingled))), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all: common ones among the k smallest of the union."""
    return let(
        merged(a, b, k), lambda u: F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u)
    )


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact while the sketch is not full."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has: resemblance times the size of the union, over a's size."""
    common = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.least(F.lit(1.0), common / distinct_shingles(a, k))


def as_text(a: Column) -> Column:
    """The sketch as text: 16 hexadecimal digits for each hash, ascending."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def merge_groups(sketches: DataFrame, by: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One merged sketch per group. Each task keeps k hashes per group before the shuffle (top-k window)."""
    hashes = sketches.select(*by, F.explode(column).alias("_hash")).distinct()
    ranked = hashes.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy("_hash")))
    return ranked.where(F.col("_rank") <= k).groupBy(*by).agg(F.sort_array(F.collect_list("_hash")).alias(column))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, words: int = WORDS) -> DataFrame:
    """The key columns of ``docs`` with (n_chars, sketch); null text is the empty text."""
    whole = text_or_empty(text)
    return docs.select(F.col(key), F.length(whole).cast("long").alias("n_chars"), sketch(whole, k, words).alias("sketch"))


def with_next(docs: DataFrame, carried: list[Column], key: str = "doc_id") -> DataFrame:
    """Each row's ``carried`` columns and, as struct ``next``, those of the row after it.

    The order is descending key, nulls last, rows with one key by the carried columns; after the last row
    comes the first. ``carried`` must be orderable and named.

    The order is cut into key ranges at approximate quantiles, each range is one window partition, and the
    first row of every range is added once more at the end of the range before. So each row crosses the
    network once and no window spans the table.
    """
    ws = Workspace(docs.sparkSession, "next")
    lowest = F.lit(-(2**63))
    rows = docs.select(F.coalesce(F.col(key), lowest).alias("_at"), F.col(key).alias("_key"), F.struct(*carried).alias("row"))
    spark = docs.sparkSession
    wanted = min(2**RANGE_STEPS, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = rows.select("_at").agg(
        F.percentile_approx("_at", [i / wanted for i in range(1, wanted)], 100 * wanted)
    ).first()[0]
    bounds = sorted(set(bounds or []))
    steps = max(1, len(bounds).bit_length())
    padded = bounds + [2**63 - 1] * (2**steps - 1 - len(bounds))
    table = F.lit(padded)
    ranged = rows.withColumn("_range", binary_search(table, steps, F.col("_at")))
    firsts = sorted(
        (r._range, r.top) for r in ranged.groupBy("_range").agg(F.max("_at").alias("top")).collect()
    )
    if not firsts:
        return ranged.select(F.col("_key").alias(key), "row", F.col("row").alias("next"))
    # The range above continues with this range's first row; the lowest range with the very first row.
    follows = {firsts[i][1]: firsts[(i + 1) % len(firsts)][0] for i in range(len(firsts))}
    target = F.create_map(*[F.lit(x) for pair in follows.items() for x in pair])
    heads = ranged.where(F.col("_at").isin(list(follows)))
    heads = ws.write(
        heads.groupBy("_at").agg(F.min("row").alias("row")).withColumn("_range", F.element_at(target, F.col("_at"))),
        "heads",
    )
    everything = ranged.withColumn("_extra", F.lit(False)).unionByName(
        heads.select("_at", F.lit(None).cast(rows.schema["_key"].dataType).alias("_key"), "row", "_range", F.lit(True).alias("_extra"))
    )
    order = Window.partitionBy("_range").orderBy("_extra", F.col("_at").desc(), "row")
    ahead = everything.withColumn("next", F.lead("row").over(order)).where(~F.col("_extra"))
    return ahead.select(F.col("_key").alias(key), "row", "next")


def edited(text: Column, following: Column) -> Column:
    """The last half of the code points replaced by as many first ones of ``following`` (or all of it)."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - half), F.substr(following, F.lit(1), half))
