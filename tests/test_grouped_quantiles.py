"""Grouped quantiles by sketches equal plain ones; rows are not shuffled; hot and null groups."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from proclivity.operators import running
from proclivity.operators.running import order_statistics

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.fixture(scope="module")
def rows(spark):
    """One group with most rows, one of ties, small ones, a null one, and a column pair as key."""
    v = F.expr("CASE WHEN g = 'ties' THEN pmod(id, 3) WHEN pmod(id, 97) = 5 THEN NULL ELSE pmod(hash(id), 100003) / 7D END")
    g = F.expr("CASE WHEN id % 3 > 0 THEN 'hot' WHEN id % 7 = 0 THEN 'ties' WHEN id % 11 = 0 THEN NULL ELSE concat('g', id % 50) END")
    return spark.range(60_000).select("id", g.alias("g"), (F.col("id") % 2).alias("h")).withColumn("v", v.cast("double"))


@pytest.mark.parametrize("group", [["g"], ["g", "h"]])
def test_equal_to_plain(rows, group):
    got = order_statistics(rows, group, "v", PROBS).toPandas()
    data = rows.toPandas().dropna(subset=["v"])
    want = data.groupby(group, dropna=False)["v"].quantile(PROBS).unstack()
    assert len(got) == len(want)
    got = got.set_index(group)
    for key, row in want.iterrows():
        own = got[got.index.isna()] if key != key else got.loc[[key]] if len(group) == 1 else got[[all(a == b or (a != a and b != b) or (a is None and b != b) for a, b in zip(i, key)) for i in got.index]]
        assert np.allclose(own[[f"q{i}" for i in range(len(PROBS))]].to_numpy()[0], row.to_numpy(), rtol=1e-12), key


def test_rows_are_not_shuffled(spark, rows, tmp_path):
    """The second scan joins the brackets by broadcast and adds up before its shuffle."""
    plain = rows.where("v is not null").select("g", F.col("v").alias("__v"))
    running._brackets(plain, ["g"], [0.5]).write.parquet(str(tmp_path / "b"))
    plan = running._bracketed(plain, ["g"], spark.read.parquet(str(tmp_path / "b")), 1)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    inside = running._bracketed(plain, ["g"], spark.read.parquet(str(tmp_path / "b")), 1).where("g = 'hot' AND __v IS NOT NULL").agg(F.sum("__n")).first()[0]
    assert inside < 0.02 * rows.where("g = 'hot'").count()


def test_a_missed_bracket_is_noticed(rows, monkeypatch):
    want = sorted(map(repr, order_statistics(rows, ["g"], "v", [0.5]).collect()))
    brackets = running._brackets
    monkeypatch.setattr(running, "_brackets", lambda *a: brackets(*a).withColumn("__high", F.col("__low")))
    assert sorted(map(repr, order_statistics(rows, ["g"], "v", [0.5]).collect())) == want


def test_empty_and_single(spark):
    one = spark.createDataFrame([("a", 2.0), ("b", None)], "g string, v double")
    assert [tuple(r) for r in order_statistics(one, ["g"], "v", [0.1, 0.9]).collect()] == [("a", 2.0, 2.0)]
    assert order_statistics(one.limit(0), ["g"], "v", [0.5]).count() == 0
    assert order_statistics(one, [], "v", [0.5]).first()["q0"] == 2.0
