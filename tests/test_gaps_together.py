"""The fits behind the gap analysis share their passes and areas, and equal separate fits."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from proclivity.operators import missingness


def test_gaps_are_fitted_together_as_one_by_one(spark, monkeypatch):
    noise = lambda k: F.expr(f"pmod(hash(id, {k}), 200) / 50D")
    rows = spark.range(600).select("id", *[noise(k).alias(c) for k, c in enumerate("abcd")])
    holes = {"a": F.when((F.col("b") + noise(9) > 6) | (F.col("id") < 5), None).otherwise(F.col("a")), "c": F.when((F.col("a") > 3) | (F.col("id") < 5), None).otherwise(F.col("c"))}
    # The first five rows know nothing.
    empty = {c: F.when(F.col("id") >= 5, F.col(c)) for c in "bd"}
    df = rows.withColumns(holes | empty).withColumn("flat", F.when(F.col("id") >= 5, F.lit(2.0))).drop("id").localCheckpoint()
    calls, together = [], missingness.fit_together
    monkeypatch.setattr(missingness, "fit_together", lambda *a, **k: calls.append(len(a[1])) or together(*a, **k))
    got = {r.variable: r for r in missingness.analyse_mnar(df).collect()}
    # Gaps of the others never occur among rows that know something.
    assert calls == [2] and set(got) == {"a", "c"}

    medians = {c: df.agg(F.median(c)).first()[0] for c in df.columns}
    for c in got:
        others = [p for p in df.columns if p != c]
        known = df.where(" OR ".join(f"{p} IS NOT NULL" for p in others)).withColumn("label", F.col(c).isNull().cast("double"))
        frame = VectorAssembler(inputCols=others, outputCol="features").transform(known.fillna(medians))
        model = LogisticRegression(regParam=1 / frame.count(), maxIter=1000, tol=1e-12).fit(frame)
        area = BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=0).evaluate(model.transform(frame))
        assert got[c].auc == pytest.approx(area, abs=1.01e-4)
        spread = [df.fillna(medians).agg(F.stddev(p)).first()[0] for p in others]
        strength = np.abs(model.coefficients.toArray()) * spread
        assert got[c].top_predictors == ", ".join(others[i] for i in np.argsort(-strength, kind="stable")[:3])
