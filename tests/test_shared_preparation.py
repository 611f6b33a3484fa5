"""Imputers and encoders are fitted once for all families."""

from pyspark.sql import functions as F

from proclivity.operators.imputation import IndicatorImputer
from proclivity.plans import experiments


def _people(spark):
    return spark.range(80).select(
        F.col("id").alias("CONTROL_NUMBER"),
        (F.col("id") % 3 == 0).cast("int").alias("TARGET_B"),
        F.when(F.col("id") % 7 != 0, (F.col("id") * 37 % 41).cast("double")).alias("A"),
        (F.col("id") % 4).cast("double").alias("INCOME_GROUP"),
        F.when(F.col("id") % 5 != 0, F.concat(F.lit("t"), (F.col("id") % 3).cast("string"))).alias("TOWN"),
    )


def test_families_share_their_preparation(spark, monkeypatch):
    df = _people(spark)
    alone = {f: experiments.prepared_pair(df, df, f) for f in ("linear", "tree")}
    fitted, fit = [], IndicatorImputer._fit
    monkeypatch.setattr(IndicatorImputer, "_fit", lambda self, frame: fitted.append(1) or fit(self, frame))
    got = experiments.prepared_families(df, df, {"linear", "tree"})
    assert len(fitted) == 2  # medians and modes
    for family, (model, *parts) in alone.items():
        assert got[family][0].outputs == model.outputs
        for mine, other in zip(got[family][1:], parts, strict=True):
            assert mine.columns == other.columns
            assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, other.collect()))
    assert sorted(got["linear"][1].collect()) != sorted(got["tree"][1].collect())
