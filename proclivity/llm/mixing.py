"""Mixing sources to target weights by Poisson replication.

Each document has a uniform number from a hash of the seed and its key; inverting the Poisson distribution whose
mean is its source's repetition rate gives its number of copies; a large rate is drawn as a sum of independent smaller ones. Documents are exploded by that number and
put in the order of a second hash, so the mixture is shuffled globally. The same seed gives the same mixture,
whatever the partitioning and however often a task is run again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Workspace, free, let

#: Beyond about this mean the first probability is no normal double any more; larger rates are sums of such draws.
MAX_RATE = 600.0
#: Rates of up to so many sources (a name and a number each) are sent to every task; more are joined by a shuffle.
BROADCAST_SOURCES = 100_000
#: Copies of one document that are exploded at once.
COPIES = 10_000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of a hash of the parts, joined by '|'; null counts as ''."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(2.0**52)


def poisson_count(u: Column, rate: Column) -> Column:
    """The smallest n whose cumulative Poisson probability exceeds u.

    The search stops where less than 1e-16 of the probability is left (u is below 1 - 2e-16 at most).
    """
    most = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("below"), F.lit(0).alias("n"))

    def step(s: Column, i: Column) -> Column:
        p = s["p"] * rate / i
        later = F.struct(p.alias("p"), (s["below"] + p).alias("below"), (s["n"] + 1).alias("n"))
        return F.when(u < s["below"], s).otherwise(later)

    return F.aggregate(F.sequence(F.lit(1), most), start, step, lambda s: s["n"])


def poisson_draw(rate: Column, *parts: Column) -> Column:
    """A Poisson number of any mean from hashes of the parts: the sum of as many equal draws as ``MAX_RATE`` asks for."""
    n = F.greatest(F.ceil(rate / F.lit(MAX_RATE)), F.lit(1).cast("long"))
    share = rate / n
    more = F.aggregate(
        F.sequence(F.lit(1).cast("long"), n - 1),
        F.lit(0).cast("long"),
        lambda total, i: total + let(uniform(*parts, F.lit("draw"), i), lambda u: poisson_count(u, share)),
    )
    return poisson_count(uniform(*parts), share) + F.when(n > 1, more).otherwise(F.lit(0).cast("long"))


def repetition_rates(docs: DataFrame, weights: dict[str | None, float] | None = None, power: float = 0.5, source: str = "source") -> DataFrame:
    """(source, n, rate): mean copies per document so that the mixture has as many documents as the input.

    ``weights`` gives target shares by source (normalised here; a source without weight gets no copies).
    Without it, shares follow the source's size to ``power``. A null source is a source of its own.
    """
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weighted = counts.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(power)))
    else:
        wanted = docs.sparkSession.createDataFrame(
            [(k, float(v)) for k, v in weights.items()], "name string, w double"
        )
        weighted = counts.join(wanted, F.col("source").eqNullSafe(F.col("name")), "left").select(
            "source", "n", F.coalesce("w", F.lit(0.0)).alias("w")
        )
    totals = weighted.agg(F.sum("w").alias("w"), F.sum("n").alias("n")).first()
    return weighted.select(
        "source", "n", (F.col("w") / F.lit(totals.w) * F.lit(float(totals.n or 0)) / F.col("n")).alias("rate")
    )


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, power: float = 0.5, seed: int = 0, key: str = "doc_id", source: str = "source") -> DataFrame:
    """All columns of ``docs`` with (copy, shuffle_key), each document as often as drawn, in shuffled order.

    Rows with the same key are drawn alike. Existing columns named ``copy`` or ``shuffle_key`` are replaced.
    The rows lie in ranges of ``shuffle_key`` (60 random bits), sorted inside each. Empty input gives none.
    """
    spark = docs.sparkSession
    kept = docs.drop("copy", "shuffle_key")
    its_source, rate, count, low = free(kept.columns, "_source", "_rate", "_copies", "_low")
    rates = repetition_rates(docs, weights, power, source).select(F.col("source").alias(its_source), F.col("rate").alias(rate))
    rates = Workspace(spark, "mixing").write(rates, "rates")
    # Whole texts need not meet by source while the sources are few.
    few = rates.count() <= BROADCAST_SOURCES
    drawn = kept.join(F.broadcast(rates) if few else rates, F.col(source).eqNullSafe(F.col(its_source)))
    drawn = drawn.withColumn(count, poisson_draw(F.col(rate), F.lit(seed), F.col(key)))
    runs = drawn.where(F.col(count) > 0).withColumn(low, F.explode(F.sequence(F.lit(1).cast("long"), F.col(count), F.lit(COPIES).cast("long"))))
    run = F.sequence(F.col(low), F.least(F.col(low) + F.lit(COPIES - 1), F.col(count)))
    copies = runs.withColumn("copy", F.explode(run.cast("array<int>")))
    bits = F.substring(F.md5(F.concat_ws("|", F.lit(f"order{seed}"), F.coalesce(F.col(key).cast("string"), F.lit("")), F.col("copy").cast("string"))), 1, 15)
    keyed = copies.withColumn("shuffle_key", F.conv(bits, 16, 10).cast("long"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.floor(F.col("shuffle_key") / F.lit(math.ceil(2**60 / parts))).cast("int")
    return (
        keyed.repartitionById(parts, place)
        .sortWithinPartitions("shuffle_key", key, "copy")
        .select(*kept.columns, "copy", "shuffle_key")
    )
