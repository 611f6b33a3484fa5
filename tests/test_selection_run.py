"""A selection run on planted features: every table agrees with the votes, and the written lists with both."""

import pytest
from pyspark.sql import functions as F

from proclivity.operators.selection import SIGNALS
from proclivity.plans.selection_run import select_features
from proclivity.sources.files import read_selection

FEATURES = ["strong", "weak", "copy", "noise", "flat"]


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    noise = lambda k: F.expr(f"pmod(hash(id, {k}), 2000) / 1000D - 1")
    rows = spark.range(900).select(
        (F.col("id") + 1).alias("CONTROL_NUMBER"), noise(1).alias("strong"), noise(2).alias("weak"), noise(3).alias("noise"), F.lit(1.0).alias("flat"), noise(4).alias("e")
    )
    rows = rows.withColumn("copy", F.col("strong") + F.col("e") / 10)
    rows = rows.withColumn("TARGET_B", (F.col("strong") * 2 + F.col("weak") + F.col("e") > 0).cast("int")).drop("e").cache()
    path = str(tmp_path_factory.mktemp("run") / "selected")
    return select_features(rows.where("CONTROL_NUMBER % 3 > 0"), rows.where("CONTROL_NUMBER % 3 = 0"), FEATURES, every=2, trees=20, max_depth=5, path=path), path


def by_method(frame):
    found = {}
    for r in frame.collect():
        found.setdefault(r.method, set()).add(r.feature)
    return found


def test_planted_features_win(run):
    votes = by_method(run[0].votes)
    assert {"strong", "weak"} <= votes["consensus"] and not {"noise", "flat"} & votes["consensus"]


def test_votes_follow_from_signals(run):
    signals, votes = by_method(run[0].signals), by_method(run[0].votes)
    assert votes["filter"] == (signals["Spearman"] | signals["ANOVA"]) & signals["Variance"] and "flat" not in signals["Variance"]
    assert votes["wrapper"] == signals["RFE"] and votes["embedded"] == signals["Lasso"] | signals["Random Forest"]
    named = [f for m in ("filter", "wrapper", "embedded") for f in votes[m]]
    assert votes["consensus"] == {f for f in FEATURES if named.count(f) >= 2}


def test_signals_follow_from_tables(run):
    signals, tables = by_method(run[0].signals), run[0]
    best = max(tables.curve.collect(), key=lambda r: (r.score, -r.n_features)).n_features
    assert signals["RFE"] == {r.feature for r in tables.ranking.collect() if r.ranking <= best}
    assert signals["Lasso"] == {r.feature for r in tables.lasso.collect() if r.coefficient != 0}
    weights = {r.feature: r.importance for r in tables.importances.collect()}
    assert signals["Random Forest"] == {f for f, w in weights.items() if w > sum(weights.values()) / len(weights)}
    assert sorted(r.ranking for r in tables.ranking.collect()) == [1, 2, 3, 4, 5]


def test_matrix_and_file(run):
    signals, votes = by_method(run[0].signals), by_method(run[0].votes)
    rows = {r.feature: r.asDict() for r in run[0].matrix.collect()}
    assert set(rows) == set(FEATURES)
    for f, r in rows.items():
        assert all((r[s] == "Keep") == (f in signals.get(s, ())) for s in SIGNALS)
        assert r["Keep Votes"] == sum(f in signals.get(s, ()) for s in SIGNALS) and (r["Final Decision"] == "Keep") == (f in votes["consensus"])
    spark = run[0].votes.sparkSession
    assert by_method(read_selection(spark, run[1])) == votes
