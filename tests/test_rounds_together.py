"""Rounds of an elimination share their passes; the ranks are those of one round after another."""

from pyspark.sql import functions as F

from proclivity.models.newton import packed, training_rows
from proclivity.operators import model_selection

NAMES = [f"x{i}" for i in range(10)]


def test_rounds_fitted_together_rank_as_one_by_one(spark):
    noise = lambda k: F.expr(f"pmod(hash(id, {k}), 2000) / 1000D - 1")
    # Neighbours are alike, so that a round changes the coefficients of the next.
    rows = spark.range(0, 800, 1, 2).select("id", *[noise(i).alias(f"n{i}") for i in range(11)])
    rows = rows.select("id", *[F.expr(f"n{i} + 0.8 * n{i + 1}").alias(f"x{i}") for i in range(10)])
    wish = " + ".join(f"{(-1) ** i * (i % 5)} * x{i}" for i in range(10))
    rows = rows.withColumn("TARGET_B", (F.expr(wish) + noise(99) * 4 > 1).cast("int"))
    rows = packed(training_rows(rows, NAMES)).localCheckpoint()
    single, passes = model_selection._eliminate(rows, NAMES, 1, 1000, ahead=1)
    together, fewer = model_selection._eliminate(rows, NAMES, 1, 1000)
    assert together == single and fewer < 0.6 * passes
