"""Queries: metrics, curves, thresholds and reports over a deterministic score."""

from __future__ import annotations

from pyspark.sql import functions as F

from proclivity.catalog.person_sql import with_persons, with_scores
from proclivity.catalog.registry import register
from proclivity.catalog.stages_sql import r6
from proclivity.catalog.support import rounded
from proclivity.functions.columns import decide
from proclivity.operators import evaluation, reshape
from proclivity.operators.splitting import stratified_folds
from proclivity.plans.persons import person_frame, score_frame, table
from proclivity.schema import ID_COLUMN, TARGET_COLUMN

AREA = (
    "areas AS (SELECT {by} sum(pos * (below + neg / 2.0)) / nullif(CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE), 0) AS roc_auc "
    "FROM (SELECT *, coalesce(sum(neg) OVER ({part} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below "
    "FROM (SELECT {by} score, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM scored GROUP BY {by} score)) {group})"
)
PLAIN_AREA = AREA.format(by="", part="", group="")
SCORED = "scored AS (SELECT CONTROL_NUMBER, TARGET_B AS y, score FROM scores)"


def metrics_sql(tn="tn", fp="fp", fn="fn", tp="tp", shown=r6) -> str:
    return (
        f"{shown(f'({tp} + {tn}) / CAST({tp} + {tn} + {fp} + {fn} AS DOUBLE)')} AS accuracy, "
        f"{shown(f'coalesce({tp} / CAST(nullif({tp} + {fp}, 0) AS DOUBLE), 0)')} AS \"precision\", "
        f"{shown(f'coalesce({tp} / CAST(nullif({tp} + {fn}, 0) AS DOUBLE), 0)')} AS recall, "
        f"{shown(f'coalesce(2 * {tp} / CAST(nullif(2 * {tp} + {fp} + {fn}, 0) AS DOUBLE), 0)')} AS f1"
    )


def counts_at(t: str) -> str:
    return (
        f"count(*) FILTER (y = 0 AND score < {t}) AS tn, count(*) FILTER (y = 0 AND score >= {t}) AS fp, "
        f"count(*) FILTER (y = 1 AND score < {t}) AS fn, count(*) FILTER (y = 1 AND score >= {t}) AS tp"
    )


@register(
    "probability_metrics",
    with_scores(
        f"SELECT CAST(0.5 AS DOUBLE) AS threshold, {metrics_sql()}, {r6('roc_auc')} AS roc_auc FROM "
        f"(SELECT {counts_at('0.5')} FROM scored) CROSS JOIN areas",
        SCORED,
        PLAIN_AREA,
    ),
)
def probability_metrics(spark, sf):
    return rounded(evaluation.probability_metrics(score_frame(spark, sf)))


@register(
    "probability_metrics_events",
    f"""WITH scored AS (SELECT CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS y, value AS score, user_id % 4 AS part FROM events),
{AREA.format(by='part,', part='PARTITION BY part', group='GROUP BY part')}
SELECT part, CAST(20 AS DOUBLE) AS threshold, {metrics_sql()}, {r6('roc_auc')} AS roc_auc, tn, fp, fn, tp
FROM (SELECT part, {counts_at('20')} FROM scored GROUP BY part) JOIN areas USING (part)""",
)
def probability_metrics_events(spark, sf):
    scored = table(spark, sf, "events").select(
        (F.col("event_type") == "click").cast("int").alias("y"),
        F.col("value").alias("score"),
        (F.col("user_id") % 4).alias("part"),
    )
    return rounded(
        evaluation.probability_metrics(scored, "score", "y", 20.0, by=["part"], with_counts=True)
    )


@register(
    "roc_auc",
    with_scores(f"SELECT {r6('roc_auc')} AS roc_auc FROM areas", SCORED, PLAIN_AREA),
)
def roc_auc(spark, sf):
    return rounded(evaluation.roc_auc(score_frame(spark, sf)))


CURVE = """curve AS (SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS positives
FROM (SELECT score, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM scored GROUP BY score)
WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@register(
    "best_f1_threshold",
    with_scores(
        f"SELECT {r6('score')} AS threshold, {r6('f1')} AS f1 FROM (SELECT score, 2 * p * r / (p + r + 1e-12) AS f1 FROM ("
        "SELECT score, tp / CAST(tp + fp AS DOUBLE) AS p, tp / CAST(positives AS DOUBLE) AS r FROM curve)) "
        "ORDER BY f1 DESC, score LIMIT 1",
        SCORED,
        CURVE,
    ),
)
def best_f1_threshold(spark, sf):
    return rounded(evaluation.best_f1_threshold(score_frame(spark, sf)))


@register(
    "pr_curve",
    with_scores(
        f"SELECT {r6('score')} AS score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, "
        f"{r6('tp / CAST(tp + fp AS DOUBLE)')} AS \"precision\", {r6('tp / CAST(positives AS DOUBLE)')} AS recall FROM curve",
        SCORED,
        CURVE,
    ),
)
def pr_curve(spark, sf):
    return rounded(evaluation.pr_curve(score_frame(spark, sf)))


@register(
    "pr_curve_labels",
    f"""WITH scored AS (SELECT doc_id, quality AS y, CAST(n_chars AS DOUBLE) AS score FROM labels JOIN documents USING (doc_id)),
{CURVE}
SELECT {r6('score')} AS score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
{r6('tp / CAST(tp + fp AS DOUBLE)')} AS "precision", {r6('tp / CAST(positives AS DOUBLE)')} AS recall FROM curve""",
)
def pr_curve_labels(spark, sf):
    texts = table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    scored = table(spark, sf, "labels").join(texts, "doc_id")
    return rounded(evaluation.pr_curve(scored, "score", "quality"))


@register(
    "confusion_matrix",
    with_scores(
        f"SELECT unnest([0, 0, 1, 1]) AS actual, unnest([0, 1, 0, 1]) AS predicted, unnest([tn, fp, fn, tp]) AS count "
        f"FROM (SELECT {counts_at('0.5')} FROM scored)",
        SCORED,
    ),
)
def confusion_matrix(spark, sf):
    df = score_frame(spark, sf).withColumn("prediction", decide(F.col("score"), 0.5))
    return evaluation.confusion_matrix(df, "prediction")


@register(
    "classification_metrics",
    with_scores(
        f"SELECT {metrics_sql()}, {r6('roc_auc')} AS roc_auc, tn, fp, fn, tp FROM (SELECT {counts_at('0.6')} FROM scored) CROSS JOIN areas",
        SCORED,
        PLAIN_AREA,
    ),
)
def classification_metrics(spark, sf):
    df = score_frame(spark, sf).withColumn("prediction", decide(F.col("score"), 0.6))
    return rounded(evaluation.evaluate_classification(df, "prediction", score="score"))


@register(
    "classification_metrics_one_class",
    with_scores(
        f"SELECT {metrics_sql()}, CAST(NULL AS DOUBLE) AS roc_auc, tn, fp, fn, tp FROM "
        f"(SELECT {counts_at('0.5')} FROM scored WHERE y = 0)",
        SCORED,
    ),
)
def classification_metrics_one_class(spark, sf):
    df = score_frame(spark, sf).where(F.col(TARGET_COLUMN) == 0)
    df = df.withColumn("prediction", decide(F.col("score"), 0.5))
    return rounded(evaluation.evaluate_classification(df, "prediction", score="score"))


@register(
    "score_decisions",
    with_scores("SELECT CONTROL_NUMBER, CASE WHEN score >= 0.35 THEN 1 ELSE 0 END AS decision FROM scores"),
)
def score_decisions(spark, sf):
    return score_frame(spark, sf).select(ID_COLUMN, decide(F.col("score"), 0.35).alias("decision"))


THRESHOLDS = f"""marks AS (SELECT round(0.10 + 0.05 * i, 2) AS threshold FROM range(17) AS r(i)),
cells AS (SELECT threshold, {counts_at('threshold')} FROM scored CROSS JOIN marks GROUP BY threshold),
table_ AS (SELECT CAST(threshold AS DOUBLE) AS threshold, {metrics_sql()}, {r6('roc_auc')} AS roc_auc, tn, fp, fn, tp FROM cells CROSS JOIN areas)"""


@register(
    "threshold_table", with_scores("SELECT * FROM table_", SCORED, PLAIN_AREA, THRESHOLDS)
)
def threshold_table(spark, sf):
    return rounded(evaluation.evaluate_thresholds(score_frame(spark, sf)))


@register(
    "best_threshold_by_f1",
    with_scores(
        "SELECT threshold AS best_threshold, f1 FROM table_ ORDER BY f1 DESC, threshold LIMIT 1",
        SCORED,
        PLAIN_AREA,
        THRESHOLDS,
    ),
)
def best_threshold_by_f1(spark, sf):
    return rounded(evaluation.best_threshold(score_frame(spark, sf), metric="f1"))


@register(
    "best_threshold_by_accuracy",
    with_scores(
        "SELECT threshold AS best_threshold, accuracy FROM table_ ORDER BY accuracy DESC, threshold LIMIT 1",
        SCORED,
        PLAIN_AREA,
        THRESHOLDS,
    ),
)
def best_threshold_by_accuracy(spark, sf):
    return rounded(evaluation.best_threshold(score_frame(spark, sf), metric="accuracy"))


_REPORT = """pred AS (SELECT y, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS p FROM scored),
per AS (SELECT CAST(k AS VARCHAR) AS label, coalesce(h / CAST(nullif(a, 0) AS DOUBLE), 0) AS "precision",
  coalesce(h / CAST(nullif(s, 0) AS DOUBLE), 0) AS recall, coalesce(2 * h / CAST(nullif(a + s, 0) AS DOUBLE), 0) AS f1,
  CAST(s AS DOUBLE) AS support FROM (SELECT k, count(*) FILTER (y = k AND p = k) AS h,
  count(*) FILTER (p = k) AS a, count(*) FILTER (y = k) AS s FROM pred CROSS JOIN (VALUES (0), (1)) AS v(k) GROUP BY k)),
acc AS (SELECT avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END) AS v FROM pred)"""


@register(
    "classification_report",
    with_scores(
        f"""SELECT label, {r6('"precision"')} AS "precision", {r6('recall')} AS recall, {r6('f1')} AS f1, {r6('support')} AS support FROM (
SELECT * FROM per UNION ALL SELECT 'accuracy', v, v, v, v FROM acc
UNION ALL SELECT 'macro avg', avg("precision"), avg(recall), avg(f1), sum(support) FROM per
UNION ALL SELECT 'weighted avg', sum("precision" * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), sum(support) FROM per)""",
        SCORED,
        _REPORT,
    ),
)
def classification_report(spark, sf):
    df = score_frame(spark, sf).withColumn("prediction", decide(F.col("score"), 0.5))
    return rounded(evaluation.classification_report(df, "prediction"))


_FOLDED = (
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY TARGET_B ORDER BY md5(CAST(CONTROL_NUMBER AS VARCHAR) || ':1')) AS r, "
    "count(*) OVER (PARTITION BY TARGET_B) AS n FROM scores), "
    "scored AS (SELECT TARGET_B AS y, score, (SELECT count(*) FROM range(1, 5) AS c(i) WHERE r > floor(n * i / 5)) AS fold FROM ranked)"
)
_FOLD_METRICS = (
    f"folds AS (SELECT fold, {metrics_sql(shown=str)}, roc_auc FROM (SELECT fold, {counts_at('0.5')} FROM scored GROUP BY fold) JOIN areas USING (fold))"
)


@register(
    "fold_metrics_summary",
    with_scores(
        "SELECT "
        + ", ".join(
            f"{r6(f'avg(\"{m}\")')} AS {m}_mean, round(stddev_pop(\"{m}\"), 5) + CAST(0 AS DOUBLE) AS {m}_std"
            for m in evaluation.METRICS
        )
        + " FROM folds",
        _FOLDED,
        AREA.format(by="fold,", part="PARTITION BY fold", group="GROUP BY fold"),
        _FOLD_METRICS,
    ),
)
def fold_metrics_summary(spark, sf):
    folded = stratified_folds(score_frame(spark, sf))
    per_fold = evaluation.probability_metrics(folded, by=["fold"])
    summary = evaluation.fold_summary(per_fold)
    return summary.select(
        *[
            (F.round(c, 5 if c.endswith("_std") else 6) + F.lit(0.0)).alias(c)
            for c in summary.columns
        ]
    )


# Result tables -------------------------------------------------------------------------------

_SPLITS = {"raw": 0, "+FE": 1, "+FE+FS": 2}
_RESULTS = (
    "results AS (SELECT model, scenario, "
    + r6("avg(TARGET_B)") + " AS roc_auc, " + r6("avg(DONOR_AGE / 100)") + " AS train_roc_auc, "
    + r6("avg(PEP_STAR)") + " AS f1, " + r6("avg(CHILDREN / 4)") + " AS train_f1 FROM ("
    "SELECT *, SES AS model, CASE CONTROL_NUMBER % 3 WHEN 0 THEN 'raw' WHEN 1 THEN '+FE' ELSE '+FE+FS' END AS scenario FROM persons) GROUP BY 1, 2)"
)
_GAPPED = (
    "gapped AS (SELECT *, " + r6("train_roc_auc - roc_auc") + " AS gap_roc_auc, " + r6("train_f1 - f1") + " AS gap_f1 FROM results)"
)


def result_frame(spark, sf):
    """A result table by model and scenario, derived from the person table."""
    k = F.col(ID_COLUMN) % 3
    scenario = F.when(k == 0, "raw").when(k == 1, "+FE").otherwise("+FE+FS")
    return rounded(
        person_frame(spark, sf)
        .groupBy(F.col("SES").alias("model"), scenario.alias("scenario"))
        .agg(
            F.avg(TARGET_COLUMN).alias("roc_auc"),
            F.avg(F.col("DONOR_AGE") / 100).alias("train_roc_auc"),
            F.avg("PEP_STAR").alias("f1"),
            F.avg(F.col("CHILDREN") / 4).alias("train_f1"),
        )
    )


@register(
    "train_validation_gaps",
    with_persons("SELECT * FROM gapped", _RESULTS, _GAPPED),
)
def train_validation_gaps(spark, sf):
    return rounded(reshape.with_gaps(result_frame(spark, sf)))


@register(
    "scenario_comparison",
    with_persons(
        "SELECT model, "
        + ", ".join(
            f"max({m}) FILTER (scenario = '{s}') AS \"{s}_{m}\"" for s in _SPLITS for m in reshape.COMPARED
        )
        + " FROM gapped GROUP BY model",
        _RESULTS,
        _GAPPED,
    ),
)
def scenario_comparison(spark, sf):
    gapped = rounded(reshape.with_gaps(result_frame(spark, sf)))
    return reshape.compare_scenarios(gapped)


@register(
    "best_scenario_per_model",
    with_persons(
        "SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY roc_auc DESC, scenario) AS r FROM gapped) WHERE r = 1",
        _RESULTS,
        _GAPPED,
    ),
)
def best_scenario_per_model(spark, sf):
    gapped = rounded(reshape.with_gaps(result_frame(spark, sf)))
    return reshape.best_per_group(gapped, "model", "roc_auc", "scenario")


@register(
    "results_sorted_by_metrics",
    with_persons("SELECT * FROM results ORDER BY roc_auc DESC, f1 DESC, model, scenario", _RESULTS),
)
def results_sorted_by_metrics(spark, sf):
    order = [F.desc("roc_auc"), F.desc("f1"), F.col("model"), F.col("scenario")]
    return result_frame(spark, sf).orderBy(*order)


@register(
    "stacked_results",
    with_persons(
        "SELECT model, roc_auc, NULL AS f1 FROM results WHERE scenario = 'raw' "
        "UNION ALL SELECT model, NULL, f1 FROM results WHERE scenario = '+FE'",
        _RESULTS,
    ),
)
def stacked_results(spark, sf):
    results = result_frame(spark, sf)
    return reshape.stack_results(
        [
            results.where(F.col("scenario") == "raw").select("model", "roc_auc"),
            results.where(F.col("scenario") == "+FE").select("model", "f1"),
        ]
    )


@register(
    "train_and_validation_rows",
    with_persons("SELECT CONTROL_NUMBER, TARGET_B FROM persons"),
)
def train_and_validation_rows(spark, sf):
    df = person_frame(spark, sf).select(ID_COLUMN, TARGET_COLUMN)
    train, val = df.where(F.col(ID_COLUMN) % 10 < 7), df.where(F.col(ID_COLUMN) % 10 >= 7)
    return reshape.stack_results([train, val])
