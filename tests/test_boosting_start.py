"""Boosting starts wherever balanced trees are better than chance by their own weights."""

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from proclivity.models.boosting import SammeBoost


def test_boosting_starts_where_balanced_trees_miss_most_rows(spark):
    """One row in ten is positive; balanced, x > 0 foretells it, though most rows with x > 0 are negative."""
    rows = spark.range(1000).select((F.col("id") % 10 == 0).cast("double").alias("label"), (F.col("id") % 100).alias("i"))
    x = F.when(F.col("label") == 1, F.lit(1.0)).otherwise((F.col("i") > 30).cast("double"))
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows.withColumn("x", x))
    frame = rows.withColumn("weight", F.when(F.col("label") == 1, 5.0).otherwise(1000 / 1800))
    model = SammeBoost({"n_estimators": 3, "max_depth": 1}).fit(frame)
    assert model.trees and model.state["alphas"][0] > 0
    scores = {r.x: r.score for r in model.transform(frame).select("x", "score").distinct().collect()}
    assert scores[1.0] > 0.5 > scores[0.0]
