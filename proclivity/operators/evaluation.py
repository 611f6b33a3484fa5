"""Metrics of binary scores: thresholds, curves, areas, reports.

Everything starts from rows counted per distinct score (or per threshold), so the row-sized
frame is aggregated once and curves are formed over distinct scores by ranged running totals.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proclivity.functions.columns import col
from proclivity.operators.running import running_sums
from proclivity.schema import TARGET_COLUMN, require_columns
from proclivity.session import materialize

# Thresholds 0.10, 0.15, …, 0.90.
DEFAULT_THRESHOLDS = [round(0.10 + 0.05 * i, 2) for i in range(17)]
METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")
COUNTS = ("tn", "fp", "fn", "tp")


def positive_score(df: DataFrame, column: str) -> Column:
    """The score of the positive class: a number as it is, else the second entry of a vector."""
    kind = df.schema[column].dataType
    if isinstance(kind, VectorUDT):
        return F.get(vector_to_array(col(column)), 1)
    if isinstance(kind, T.ArrayType):
        return F.get(col(column), 1)
    if isinstance(kind, T.NumericType):
        return col(column).cast("double")
    raise ValueError(f"{column} must be a number or a vector of class probabilities")


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def metric_columns(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    """Accuracy, precision, recall and F1 from the four counts; an empty denominator gives 0."""
    return {
        "accuracy": _ratio(tp + tn, tp + tn + fp + fn),
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
    }


def by_score(df: DataFrame, score: str, target: str = TARGET_COLUMN, by: list[str] | None = None) -> DataFrame:
    """``(by…, score, n, pos)`` per distinct score; rows without score or label are left out.

    Written down: the curves read the counts several times, and each time a model would score its rows again.
    """
    keys = [col(b) for b in by or []]
    value = positive_score(df, score)
    counts = (
        df.where(col(target).isNotNull())
        .select(*keys, value.alias("score"), col(target).cast("int").alias("__y"))
        .groupBy(*keys, "score")
        .agg(F.count("score").alias("n"), F.sum("__y").alias("pos"))
    )
    # Missing scores count 0. A condition on the score itself would move below the counting and work the score out twice.
    return materialize(counts.where(F.col("n") > 0), "score-counts")


def probability_metrics(
    df: DataFrame,
    score: str = "score",
    target: str = TARGET_COLUMN,
    threshold: float = 0.5,
    by: list[str] | None = None,
    with_counts: bool = False,
) -> DataFrame:
    """Threshold metrics and the area under the ROC curve, one row or one per ``by`` group.

    The area is null when only one class is present. Groups are models, folds or splits.
    """
    by = by or []
    counts = by_score(df, score, target, by)
    running = running_sums(
        counts.withColumn("neg", F.col("n") - F.col("pos")), by, "score", ["neg"]
    )
    hit = F.col("score") >= F.lit(float(threshold))
    neg_below = F.col("neg_upto") - F.col("neg")
    sums = running.groupBy(*[col(b) for b in by]).agg(
        F.coalesce(F.sum(F.when(~hit, F.col("neg"))), F.lit(0)).alias("tn"),
        F.coalesce(F.sum(F.when(hit, F.col("neg"))), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.when(~hit, F.col("pos"))), F.lit(0)).alias("fn"),
        F.coalesce(F.sum(F.when(hit, F.col("pos"))), F.lit(0)).alias("tp"),
        F.sum(F.col("pos") * (neg_below + F.col("neg") / 2)).alias("wins"),
    )
    tn, fp, fn, tp = (F.col(c) for c in COUNTS)
    metrics = metric_columns(tn, fp, fn, tp)
    area = F.try_divide(F.col("wins"), ((tp + fn).cast("double") * (tn + fp).cast("double")))
    return sums.select(
        *[col(b) for b in by],
        F.lit(float(threshold)).alias("threshold"),
        *[m.alias(name) for name, m in metrics.items()],
        area.alias("roc_auc"),
        *(COUNTS if with_counts else ()),
    )


def roc_auc(
    df: DataFrame, score: str = "score", target: str = TARGET_COLUMN, by: list[str] | None = None
) -> DataFrame:
    """Area under the ROC curve with ties counted half."""
    by = by or []
    return probability_metrics(df, score, target, by=by).select(*[col(b) for b in by], "roc_auc")


def pr_curve(df: DataFrame, score: str = "score", target: str = TARGET_COLUMN) -> DataFrame:
    """``(score, tp, fp, precision, recall)`` at every distinct score taken as threshold."""
    counts = by_score(df, score, target)
    running = running_sums(counts, [], "score", ["n", "pos"], descending=True)
    total = counts.agg(F.sum("pos").alias("positives"))
    joined = running.withColumn("positives", total.scalar())
    tp = F.col("pos_upto")
    return joined.select(
        "score",
        tp.alias("tp"),
        (F.col("n_upto") - tp).alias("fp"),
        _ratio(tp, F.col("n_upto")).alias("precision"),
        _ratio(tp, F.col("positives")).alias("recall"),
    )


def best_f1_threshold(df: DataFrame, score: str = "score", target: str = TARGET_COLUMN) -> DataFrame:
    """``(threshold, f1)`` of the best distinct score, the smallest on ties; 0.5 if there is none."""
    p, r = F.col("precision"), F.col("recall")
    f1 = (2 * p * r) / (p + r + F.lit(1e-12))
    curve = pr_curve(df, score, target).select(F.col("score").alias("threshold"), f1.alias("f1"))
    best = curve.agg(
        F.max(F.struct(F.col("f1"), (-F.col("threshold")).alias("minus"))).alias("best")
    )
    return best.select(
        F.coalesce(-F.col("best.minus"), F.lit(0.5)).alias("threshold"), F.col("best.f1").alias("f1")
    )


def confusion_counts(df: DataFrame, prediction: str, target: str = TARGET_COLUMN) -> DataFrame:
    """One row ``(tn, fp, fn, tp)``."""
    y, p = col(target) == 1, col(prediction) == 1
    return df.where(col(target).isNotNull() & col(prediction).isNotNull()).agg(
        F.count_if(~y & ~p).alias("tn"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(y & p).alias("tp"),
    )


def confusion_matrix(df: DataFrame, prediction: str, target: str = TARGET_COLUMN) -> DataFrame:
    """Long form ``(actual, predicted, count)`` with all four cells."""
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("count"))
            for a, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
        ]
    )
    return confusion_counts(df, prediction, target).select(F.inline(cells))


def evaluate_classification(
    df: DataFrame, prediction: str, target: str = TARGET_COLUMN, score: str | None = None
) -> DataFrame:
    """Metrics and counts of given predictions, with the area when a score column is named.

    The area column is null when only one class is present. Rows without a score count in the decisions; the area is
    that of the rows with one.
    """
    require_columns(df, [prediction, target] + ([score] if score else []))
    if score is None:
        tn, fp, fn, tp = (F.col(c) for c in COUNTS)
        metrics = metric_columns(tn, fp, fn, tp)
        return confusion_counts(df, prediction, target).select(
            *[m.alias(name) for name, m in metrics.items()], *COUNTS
        )
    # Counts per (score, prediction) carry both the decision counts and the curve.
    rows = df.where(col(target).isNotNull()).select(
        positive_score(df, score).alias("score"),
        col(target).cast("int").alias("__y"),
        (col(prediction) == 1).alias("__p"),
    )
    y, p = F.col("__y") == 1, F.col("__p")
    counts = rows.groupBy("score").agg(
        F.count_if(~y & ~p).alias("tn"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(y & p).alias("tp"),
    )
    sized = counts.withColumn("neg", F.col("tn") + F.col("fp")).withColumn("pos", F.col("fn") + F.col("tp"))
    scored = running_sums(sized.where(F.col("score").isNotNull()), [], "score", ["neg"]).select(
        *COUNTS, "neg", "pos", (F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2)).alias("wins")
    )
    unscored = sized.where(F.col("score").isNull()).select(
        *COUNTS, F.lit(0).cast("bigint").alias("neg"), F.lit(0).cast("bigint").alias("pos"), F.lit(0.0).alias("wins")
    )
    sums = scored.unionByName(unscored).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (*COUNTS, "neg", "pos")], F.sum("wins").alias("wins")
    )
    tn, fp, fn, tp = (F.col(c) for c in COUNTS)
    area = F.try_divide(F.col("wins"), F.col("pos").cast("double") * F.col("neg").cast("double"))
    return sums.select(
        *[m.alias(name) for name, m in metric_columns(tn, fp, fn, tp).items()],
        area.alias("roc_auc"),
        *COUNTS,
    )


def evaluate_thresholds(
    df: DataFrame,
    score: str = "score",
    target: str = TARGET_COLUMN,
    thresholds: list[float] | None = None,
) -> DataFrame:
    """Metrics, area and counts at each threshold.

    Each distinct score is placed between two neighbouring thresholds; counts per place are then
    summed from the top. No row meets more than one threshold.
    """
    marks = sorted(set(thresholds or DEFAULT_THRESHOLDS))
    counts = by_score(df, score, target).withColumn("neg", F.col("n") - F.col("pos"))
    running = running_sums(counts, [], "score", ["neg"])
    cuts = F.array(*[F.lit(float(t)) for t in marks])
    place = F.size(F.filter(cuts, lambda t: t <= F.col("score")))
    wins = F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2)
    # One row per place, at most one more than there are thresholds, added up in one array.
    placed = running.groupBy(place.alias("place")).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum(wins).alias("wins")
    )
    whole = placed.agg(
        F.collect_list(F.struct("place", "pos", "neg")).alias("cells"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
        F.sum("wins").alias("wins"),
    )

    def above(index: Column, part: str) -> Column:
        return F.aggregate(
            F.filter("cells", lambda cell: cell["place"] > index),
            F.lit(0).cast("bigint"),
            lambda total, cell: total + cell[part],
        )

    at = whole.select("*", F.posexplode(cuts).alias("index", "threshold"))
    at = at.select(
        "threshold",
        above(F.col("index"), "pos").alias("tp"),
        above(F.col("index"), "neg").alias("fp"),
        "positives",
        "negatives",
        "wins",
    )
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("positives") - tp, F.col("negatives") - fp
    area = F.try_divide(
        F.col("wins"), F.col("positives").cast("double") * F.col("negatives").cast("double")
    )
    return at.select(
        "threshold",
        *[m.alias(name) for name, m in metric_columns(tn, fp, fn, tp).items()],
        area.alias("roc_auc"),
        tn.alias("tn"),
        "fp",
        fn.alias("fn"),
        "tp",
    )


def best_threshold(
    df: DataFrame, score: str = "score", target: str = TARGET_COLUMN, metric: str = "f1"
) -> DataFrame:
    """``(best_threshold, <metric>)``: the first threshold with the largest metric."""
    if metric not in METRICS + COUNTS:
        raise KeyError(f"metric {metric!r} is not in the threshold table")
    return (
        evaluate_thresholds(df, score, target)
        .orderBy(F.desc(metric), "threshold")
        .limit(1)
        .select(F.col("threshold").alias("best_threshold"), metric)
    )


def classification_report(df: DataFrame, prediction: str, target: str = TARGET_COLUMN) -> DataFrame:
    """Rows per class, accuracy, macro and weighted averages: precision, recall, f1, support.

    Only the counts per (actual, predicted) class leave the row-sized frame.
    """
    cells = (
        df.where(col(target).isNotNull() & col(prediction).isNotNull())
        .groupBy(
            col(target).cast("int").cast("string").alias("actual"),
            col(prediction).cast("int").cast("string").alias("predicted"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("actual").alias("label"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("bigint").alias("predicted_n"),
                    F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hits"),
                ),
                F.struct(
                    F.col("predicted").alias("label"),
                    F.lit(0).cast("bigint").alias("support"),
                    F.col("n").alias("predicted_n"),
                    F.lit(0).cast("bigint").alias("hits"),
                ),
            )
        )
    )
    classes = sides.groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("predicted_n").alias("predicted_n"), F.sum("hits").alias("hits")
    )
    p, r = _ratio(F.col("hits"), F.col("predicted_n")), _ratio(F.col("hits"), F.col("support"))
    f1 = _ratio(2 * F.col("hits"), F.col("predicted_n") + F.col("support"))
    per_class = classes.select(
        "label", p.alias("precision"), r.alias("recall"), f1.alias("f1"),
        F.col("support").cast("double").alias("support"), "hits",
    )
    total = F.sum("support")

    def weighted(name: str) -> Column:
        return _ratio(F.sum(F.col(name) * F.col("support")), total)

    accuracy = _ratio(F.sum("hits"), total)
    summary = per_class.agg(
        F.array(
            F.struct(
                F.lit("accuracy").alias("label"),
                accuracy.alias("precision"),
                accuracy.alias("recall"),
                accuracy.alias("f1"),
                accuracy.alias("support"),
            ),
            F.struct(
                F.lit("macro avg").alias("label"),
                F.avg("precision").alias("precision"),
                F.avg("recall").alias("recall"),
                F.avg("f1").alias("f1"),
                total.alias("support"),
            ),
            F.struct(
                F.lit("weighted avg").alias("label"),
                weighted("precision").alias("precision"),
                weighted("recall").alias("recall"),
                weighted("f1").alias("f1"),
                total.alias("support"),
            ),
        ).alias("rows")
    ).select(F.inline("rows"))
    return per_class.drop("hits").unionByName(summary)


def fold_summary(fold_metrics: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """``<metric>_mean`` and ``<metric>_std`` (population) over fold rows."""
    names = metrics or [m for m in METRICS if m in fold_metrics.columns]
    return fold_metrics.agg(
        *[
            f(col(m)).alias(f"{m}_{s}")
            for m in names
            for s, f in (("mean", F.avg), ("std", F.stddev_pop))
        ]
    )


def first_reaching(table: DataFrame, order: str, share: str, threshold: float = 0.95) -> DataFrame:
    """``(component, cumulative_variance, components_needed)``: the first component at which the sum reaches the mark.

    One row per component; the running sum is formed in ranges of the order, so a long table does not meet in
    one task. If the mark is never reached, all components are needed.
    """
    shares = table.select(F.col(order).alias("component"), F.col(share).alias("share"))
    cumulative = running_sums(shares, [], "component", ["share"]).select(
        "component", F.col("share_upto").alias("cumulative_variance")
    )
    reached = F.min(F.when(F.col("cumulative_variance") >= threshold, F.col("component")))
    needed = cumulative.agg(F.coalesce(reached, F.max("component")).alias("components_needed"))
    return cumulative.withColumn("components_needed", needed.scalar())
