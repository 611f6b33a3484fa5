"""Fitted steps and chains are stored, loaded (also by another application) and give the same rows again."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from proclivity.models.classifiers import Classifier
from proclivity.operators.base import FittedStep
from proclivity.operators.encoding import OneHotEncoder, OrdinalEncoder, Passthrough
from proclivity.operators.imputation import ColumnImputer, IndicatorImputer, MnarImputer
from proclivity.operators.outliers import OutlierRescaler
from proclivity.operators.preprocessing import Preprocessor
from proclivity.operators.scaling import NumericScaler
from proclivity.plans import scoring
from proclivity.plans.cleaning_chain import CleaningChain
from proclivity.plans.persons import person_frame

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def people(spark, sf):
    return person_frame(spark, sf)


def rows(df):
    return sorted(map(repr, df.collect()))


def again(step, df, path):
    """The step's rows, after storing and loading it, equal those before."""
    want = rows(step.transform(df))
    step.write().overwrite().save(path)
    loaded = type(step).load(path)
    assert loaded.state == json.loads(json.dumps(step.state)) and loaded.uid == step.uid
    assert rows(loaded.transform(df)) == want
    return loaded


@pytest.mark.parametrize("step", [
    ColumnImputer("mean", ["DONOR_AGE"]), ColumnImputer("most_frequent", ["URBANICITY"]), MnarImputer(), IndicatorImputer(["DONOR_AGE", "INCOME_GROUP"]),
    OutlierRescaler(["MEDIAN_HOME_VALUE"], "transform"), OutlierRescaler(None, "binning", bins=4), NumericScaler("robust", ["DONOR_AGE"]),
    OneHotEncoder(["URBANICITY", "SES"]), OrdinalEncoder(["SES"]), Passthrough(), Preprocessor("linear"),
    CleaningChain(encode="onehot"), CleaningChain(outlier_method="split", encode="label"), CleaningChain(outlier_method=None),
], ids=lambda s: type(s).__name__)
def test_steps(people, step, tmp_path):
    again(step.fit(people), people, str(tmp_path / "step"))


@pytest.fixture(scope="module")
def numbers(spark):
    x = [F.expr(f"pmod(hash(id, {k}), 1000) / 100D").alias(f"x{k}") for k in range(3)]
    rows = spark.range(400).select((F.col("id") + 1).alias("CONTROL_NUMBER"), *x)
    return rows.withColumn("TARGET_B", (F.col("x0") + F.col("x1") > 9).cast("int"))


@pytest.mark.parametrize("kind,params", [
    ("LogisticRegression", {}), ("GaussianNB", {}), ("KNeighborsClassifier", {"n_neighbors": 3}), ("AdaBoost", {"n_estimators": 3, "max_depth": 1}),
    ("DecisionTree", {"max_depth": 3}), ("RandomForestClassifier", {"n_estimators": 3}), ("GradientBoosting", {"n_estimators": 2}),
    ("MLPClassifier", {"hidden_layer_sizes": (3,), "max_iter": 5}),
])
def test_classifiers(numbers, kind, params, tmp_path):
    again(Classifier(kind, params, ["x0", "x1", "x2"]).fit(numbers), numbers, str(tmp_path / "model"))


def test_existing_folder_is_kept(people, tmp_path):
    step = ColumnImputer("mean", ["DONOR_AGE"]).fit(people)
    step.save(str(tmp_path / "step"))
    with pytest.raises(Exception, match="already exists"):
        step.save(str(tmp_path / "step"))
    with pytest.raises(Exception, match="class"):
        FittedStep.load(str(tmp_path / "step"))


def test_state_must_survive_json():
    for state in ({1: "a"}, {"a": {2, 3}}, {"a": object()}):
        with pytest.raises(TypeError):
            from proclivity.operators.base import _plain

            _plain(state)


SCORE = """
import sys
from pyspark.sql import SparkSession
from proclivity.plans.scoring import score_unseen
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
score_unseen(sys.argv[1], spark.read.parquet(sys.argv[2])).write.parquet(sys.argv[3])
spark.stop()
"""


def test_another_application_scores_alike(spark, people, tmp_path):
    """A whole chain, age strata table and one-hot categories included, put to rows without target."""
    path, table, out = (str(tmp_path / n) for n in ("chain", "unseen", "scores"))
    seen, unseen = people.where("CONTROL_NUMBER % 4 <> 1"), people.where("CONTROL_NUMBER % 4 = 1").drop("TARGET_B")
    chain = scoring.fit_chain(seen, Classifier("DecisionTree", {"max_depth": 4}), family="linear")
    chain.write().save(path)
    unseen.write.parquet(table)
    env = {**os.environ, "PYTHONPATH": ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")}
    subprocess.run([sys.executable, "-c", SCORE, path, table, out], check=True, env=env, timeout=300, capture_output=True)
    want = rows(scoring.score_unseen(chain, unseen))
    assert rows(spark.read.parquet(out)) == want and len(want) == unseen.count()
    assert spark.read.parquet(out).where("score is null").isEmpty()
    assert rows(scoring.score_unseen(path, unseen)) == want
    assert isinstance(PipelineModel.load(path).stages[0], type(chain.stages[0]))


def test_values_beyond_the_fitted_range(spark):
    """The fitted logarithm takes values past its end as the end: no nulls reach the model."""
    fit = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 500]], "v double")
    low = OutlierRescaler(["v"], "transform").fit(fit)
    assert [r.v for r in low.transform(spark.createDataFrame([(-50.0,), (0.0,), (None,)], "v double")).collect()] == [0.0, 0.0, None]
    mirrored = OutlierRescaler(["v"], "transform").fit(fit.selectExpr("-v AS v"))
    got = [r.v for r in mirrored.transform(spark.createDataFrame([(50.0,), (0.0,), (-1.0,)], "v double")).collect()]
    assert got[0] == got[1] == 0.0 and got[2] < 0
