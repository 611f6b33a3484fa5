"""Passes over packed rows give the sums of plain rows and read far fewer values."""

import numpy as np
from pyspark.sql import functions as F

from proclivity.models.newton import Fit, confusions, fit_together, packed, scores_of, training_rows


def test_packed_rows_give_the_same_fits(spark):
    df = spark.range(0, 500, 1, 3).select(
        F.expr("pmod(hash(id, 1), 100) / 50D - 1").alias("a"),
        F.expr("pmod(hash(id, 2), 100) / 50D - 1").alias("b"),
        (F.expr("pmod(hash(id, 3), 10)") < 3).cast("int").alias("TARGET_B"),
        (F.col("id") % 3).alias("f"),
    )
    plain = training_rows(df, ["a", "b"], fold="f")
    blocks = packed(plain)
    assert blocks.count() == 3 and packed(plain.limit(0)).count() == 0
    fits = [[Fit([0, 1]), Fit([1], held=1), Fit([0], held=2, intercept=False)] for _ in range(2)]
    for rows, many in zip((plain, blocks), fits, strict=True):
        fit_together(rows, many, 2)
    for one, two in zip(*fits, strict=True):
        assert one.weights == two.weights and np.allclose(one.beta, two.beta, rtol=0, atol=1e-12)
    assert confusions(plain, fits[0], 2) == confusions(blocks, fits[0], 2)
    assert scores_of(plain, fits[0], 2).exceptAll(scores_of(blocks, fits[0], 2)).isEmpty()
