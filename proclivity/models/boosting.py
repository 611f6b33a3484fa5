"""AdaBoost (SAMME) over weighted decision trees."""

from __future__ import annotations

import math

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.operators.base import FittedStep, Step
from proclivity.session import Rolling


class SammeBoost(Step):
    """Each round fits a tree on the current weights and raises the weights of its misses.

    The frame has ``features``, ``label`` and optionally ``weight`` (class weights the trees see
    on top). A tree that balances classes may miss half of all rows while it is better than chance by those weights; if the
    first one does, the boosting weights start as the class weights, so that errors are measured as the trees are grown. A round writes its rows with the misses of its tree, once, and the files of the round before are deleted: a
    round's plan reads one table, whatever the number of rounds, and a lost executor costs a re-read.
    """

    def __init__(self, params: dict | None = None, seed: int = 14):
        super().__init__()
        p = params or {}
        self.rounds = p.get("n_estimators", 50)
        self.rate = p.get("learning_rate", 1.0)
        self.depth = p.get("max_depth", 1)
        self.leaf = p.get("min_samples_leaf", 1)
        self.seed = seed

    def _fit(self, df: DataFrame) -> SammeModel:
        class_weight = F.col("weight") if "weight" in df.columns else F.lit(1.0)
        start = df.select("features", "label", class_weight.alias("__class"))
        trees, alphas = self._boost(start.withColumn("__w", F.lit(1.0 / df.count())))
        if not trees and "weight" in df.columns:
            total = df.agg(F.sum("weight")).first()[0]
            weights = {"__w": F.col("__class") / F.lit(total), "__class": F.lit(1.0)}
            trees, alphas = self._boost(start.withColumns(weights))
        if not trees:
            raise ValueError("the first tree is no better than chance; boosting cannot start")
        return SammeModel(trees, alphas)

    def _boost(self, start: DataFrame) -> tuple[list, list[float]]:
        """Trees and factors; none if the first tree is no better than chance."""
        table = Rolling(start.sparkSession, "boost")
        current = table.write(start)
        trees, alphas = [], []
        try:
            for i in range(self.rounds):
                weighted = current.withColumn("__fit", F.col("__w") * F.col("__class"))
                tree = DecisionTreeClassifier(
                    maxDepth=self.depth,
                    minInstancesPerNode=self.leaf,
                    weightCol="__fit",
                    seed=self.seed + i,
                ).fit(weighted)
                missed = (F.col("prediction") != F.col("label")).alias("__miss")
                rows = table.write(tree.transform(current).select("features", "label", "__class", "__w", missed))
                sums = rows.agg(
                    F.sum("__w").alias("all"), F.sum(F.when(F.col("__miss"), F.col("__w"))).alias("missed")
                ).first()
                error = (sums["missed"] or 0.0) / sums["all"]
                if error <= 0:
                    trees, alphas = [*trees, tree], [*alphas, 1.0]
                    break
                if error >= 0.5:
                    break
                alpha = self.rate * math.log((1 - error) / error)
                trees.append(tree)
                alphas.append(alpha)
                raised = F.when(F.col("__miss"), F.col("__w") * math.exp(alpha)).otherwise(F.col("__w"))
                current = rows.withColumn("__w", raised / F.lit(sums["all"])).drop("__miss")
        finally:
            table.close()
        return trees, alphas


class SammeModel(FittedStep):
    """Weighted vote of the trees; the probability is the logistic of the mean vote."""

    parts = ("trees",)

    def __init__(self, trees, alphas: list[float]):
        super().__init__({"alphas": alphas})
        self.trees = trees

    def _transform(self, df: DataFrame) -> DataFrame:
        alphas = self.state["alphas"]
        names = df.columns
        out = df.withColumn("__vote", F.lit(0.0))
        for tree, alpha in zip(self.trees, alphas, strict=True):
            voted = F.col("__vote") + F.lit(alpha) * (2 * F.col("prediction") - 1)
            out = tree.transform(out).select(*[F.col(c) for c in names], voted.alias("__vote"))
        mean = F.col("__vote") / F.lit(sum(alphas))
        return out.withColumns(
            {"score": 1 / (1 + F.exp(-mean)), "prediction": (mean > 0).cast("double")}
        ).drop("__vote")
