"""Plans: columns pruned, no cross products, no row-sized work in a single task."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from proclivity.operators.splitting import stratified_split
from proclivity.plans.persons import build_person_frame, person_frame
from proclivity.schema import ID_COLUMN, TARGET_COLUMN
from proclivity.session import scratch_dir

NAMES = [
    "response_by_urbanicity",
    "mnar_flags_and_fills",
    "cleaning_chain",
    "category_target_rates",
    "missing_target_rates",
    "spearman_with_target",
    "group_quantiles_ranged",
    "probability_metrics",
    "pr_curve",
    "threshold_table",
    "best_f1_threshold",
    "stratified_split",
    "stratified_folds",
    "decision_matrix",
    "clipped_histogram",
    "pearson_matrix_lineitem",
]


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_products(spark, sf, name):
    text = plan(entry.queries()[name](spark, sf))
    assert "CartesianProduct" not in text
    assert "NestedLoop" not in text
    assert "BatchEvalPython" not in text


@pytest.mark.parametrize("name", ["spearman_with_target", "pr_curve", "stratified_split", "probability_metrics"])
def test_windows_are_partitioned(spark, sf, name):
    text = plan(entry.queries()[name](spark, sf))
    # The argument list of a window ends with its partition and order keys.
    for found in re.findall(r"\) Window\n(?:.*\n)*?Arguments: (.*)", text):
        # Only the few totals per range may be ordered as a whole.
        assert "__range" in found or not re.search(r", \[\], \[[^\]]*\]$", found), found


def test_scan_reads_only_what_is_needed(spark, sf):
    text = plan(build_person_frame(spark, sf))
    schemas = re.findall(r"ReadSchema: struct<(.*)>", text)
    lines = next(s for s in schemas if "l_orderkey" in s)
    assert {c.split(":")[0] for c in lines.split(",")} == {"l_orderkey", "l_returnflag", "l_shipdate"}


def test_filter_reaches_the_scan(spark, sf):
    df = person_frame(spark, sf).where(F.col("DONOR_AGE") > 50).select(ID_COLUMN)
    text = plan(df)
    assert "GreaterThan(DONOR_AGE,50.0)" in text
    assert re.search(r"ReadSchema: struct<CONTROL_NUMBER:bigint,DONOR_AGE:double>", text)


def test_split_does_not_shuffle_wide_rows(spark, sf):
    text = plan(stratified_split(person_frame(spark, sf)))
    for exchange in re.findall(r"\) Exchange\n(?:.*\n)*?Input \[\d+\]: (.*)\n", text):
        assert "LIFETIME_GIFT_AMOUNT" not in exchange
    assert TARGET_COLUMN in text


class _Session:
    """Just enough of a session to ask for its shared folder."""

    def __init__(self, master, folder):
        self.conf = self
        self.sparkContext = self
        self.master, self.folder, self.applicationId = master, folder, "app"

    def get(self, name, default):
        return self.folder if name == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return None


def test_scratch_folder_follows_the_session(spark):
    assert scratch_dir(spark) == scratch_dir(spark)
    assert scratch_dir(_Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(RuntimeError):
        scratch_dir(_Session("yarn", None))
