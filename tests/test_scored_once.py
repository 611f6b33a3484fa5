"""Curves and areas work a score out once per row, and leave out rows without one."""

import pytest
from pyspark.sql import functions as F

from proclivity.operators.evaluation import best_f1_threshold, evaluate_thresholds, probability_metrics

ROWS = 200


@pytest.mark.parametrize("report", [probability_metrics, best_f1_threshold, evaluate_thresholds])
def test_scores_are_worked_out_once(spark, report):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def score(i):
        calls.add(1)
        return None if i % 10 == 0 else (i * 37 % 101) / 101

    rows = spark.range(ROWS).select((F.col("id") % 3 == 0).cast("int").alias("TARGET_B"), score("id").alias("score"))
    got = report(rows).collect()
    assert calls.value == ROWS
    plain = spark.range(ROWS).where("id % 10 <> 0").selectExpr("CAST(id % 3 = 0 AS INT) AS TARGET_B", "CAST(id * 37 % 101 AS DOUBLE) / 101 AS score")
    assert got == report(plain).collect()
