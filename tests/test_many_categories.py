"""Encoders on columns with many categories: codes as sorted ranks, limits by column, stored tables."""

import pytest
from pyspark.sql import functions as F

from proclivity.operators.encoding import OneHotEncoder, OrdinalEncoder, fitted_categories, numbered


@pytest.fixture(scope="module")
def wide(spark):
    """100,000 categories, one of which holds a third of the rows; a column of four; nulls."""
    many = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 150_000).cast("string")))
    few = F.when(F.col("id") % 5 > 0, F.concat(F.lit("v"), (F.col("id") % 5).cast("string")))
    return spark.range(150_000).select("id", many.alias("many"), few.alias("few"))


def test_codes_are_sorted_ranks(spark, wide):
    model = OrdinalEncoder(["many", "few"]).fit(wide)
    assert model.state["tabled"] == ["many"] and model.state["categories"]["few"] == ["v1", "v2", "v3", "v4", None]
    names = sorted({"hot"} | {f"k{i}" for i in range(150_000) if i % 3})
    got = model.transform(wide)
    assert got.columns == wide.columns
    found = wide.select("id", F.col("many").alias("name"), F.col("few").alias("short")).join(got, "id").toPandas()
    rank = {n: float(i) for i, n in enumerate(names)}
    assert len(names) == 100_001 and (found["many"] == found["name"].map(rank)).all()
    assert (found["few"].isna() == found["short"].isna()).all()
    odd = model.transform(spark.createDataFrame([(1, "unseen", "v9"), (2, None, None), (3, "hot", "v1")], wide.schema)).orderBy("id").collect()
    assert [(r.many, r.few) for r in odd] == [(-1.0, -1.0), (None, None), (0.0, 0.0)]


def test_no_task_numbers_everything(wide):
    """The one window is over ranges, not over categories."""
    plan = numbered(wide.select(F.lit("many").alias("feature"), F.col("many").alias("category")).distinct())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Window" in text and "row_number" not in text


def test_both_lookups_agree(spark, wide, tmp_path):
    some = wide.where("id < 600")
    line, table = OrdinalEncoder(["many", "few"], in_line=1000).fit(some), OrdinalEncoder(["many", "few"], in_line=2).fit(some)
    assert line.state["tabled"] == [] and table.state["tabled"] == ["many", "few"]
    assert line.transform(some).exceptAll(table.transform(some)).isEmpty()
    table.save(str(tmp_path / "codes"))
    assert type(table).load(str(tmp_path / "codes")).transform(some).exceptAll(line.transform(some)).isEmpty()


def test_limit_is_per_column(spark, wide):
    some = wide.where("id < 60")
    with pytest.raises(ValueError, match="more than 10 categories"):
        OneHotEncoder(["many", "few"], max_categories=10).fit(some)
    assert len(OneHotEncoder(["many", "few"], max_categories=50).fit(some).outputs) == 41 + 5
    assert fitted_categories(some, [], 1) == {}
