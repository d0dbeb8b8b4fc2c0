"""Validation, calibration, ranking and comparison queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.rules import performance_grade, threshold_met
from ledgerlark.operators import metrics as m
from ledgerlark.operators import ranking
from ledgerlark.plans.registry import query
from ledgerlark.plans.views import PREDICTIONS
from ledgerlark.sources.accounts import predictions
from ledgerlark.sources.tables import table


def _round(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def report_sql(keys: str, source: str = "predictions", name: str = "report") -> str:
    """Class report CTE of a predictions view with classes 0..2."""
    return f"""
{name} AS (
  SELECT {keys}, class, hits, support, CASE WHEN predicted = 0 THEN 0 ELSE hits::DOUBLE / predicted END AS precision,
    CASE WHEN support = 0 THEN 0 ELSE hits::DOUBLE / support END AS recall,
    CASE WHEN hits = 0 THEN 0 ELSE 2 * (hits::DOUBLE / predicted) * (hits::DOUBLE / support) / (hits::DOUBLE / predicted + hits::DOUBLE / support) END AS f1
  FROM (SELECT {keys}, class, CAST(sum(CASE WHEN label = class AND prediction = class THEN 1 ELSE 0 END) AS BIGINT) AS hits,
      CAST(sum(CASE WHEN label = class THEN 1 ELSE 0 END) AS BIGINT) AS support, CAST(sum(CASE WHEN prediction = class THEN 1 ELSE 0 END) AS BIGINT) AS predicted
    FROM {source}, (SELECT unnest([0, 1, 2]) AS class) GROUP BY ALL) WHERE support > 0 OR predicted > 0)"""


def averages_sql(keys: str, report: str = "report", name: str = "averages") -> str:
    return f"""
{name} AS (
  SELECT {keys}, sum(hits)::DOUBLE / sum(support) AS accuracy, sum(f1 * support) / sum(support) AS f1_weighted, avg(f1) AS f1_macro,
    sum(precision * support) / sum(support) AS precision_weighted, avg(precision) AS precision_macro,
    sum(recall * support) / sum(support) AS recall_weighted, avg(recall) AS recall_macro, CAST(sum(support) AS BIGINT) AS n
  FROM {report} GROUP BY {keys})"""


SCORES = """
scores AS (
  SELECT model, label, 0 AS class, p0 AS score FROM predictions UNION ALL SELECT model, label, 1, p1 FROM predictions
  UNION ALL SELECT model, label, 2, p2 FROM predictions)"""
AUC = f"""{SCORES},
ranks AS (
  SELECT model, class, label, rank() OVER w + (count(*) OVER (PARTITION BY model, class, score) - 1) / 2.0::DOUBLE AS r
  FROM scores WINDOW w AS (PARTITION BY model, class ORDER BY score)),
auc AS (
  SELECT model, class, CAST(sum(CASE WHEN label = class THEN 1 ELSE 0 END) AS BIGINT) AS support,
    (sum(CASE WHEN label = class THEN r ELSE 0 END) - sum(CASE WHEN label = class THEN 1.0::DOUBLE ELSE 0 END) * (sum(CASE WHEN label = class THEN 1.0::DOUBLE ELSE 0 END) + 1) / 2)
    / (sum(CASE WHEN label = class THEN 1.0::DOUBLE ELSE 0 END) * sum(CASE WHEN label = class THEN 0 ELSE 1.0::DOUBLE END)) AS roc_auc
  FROM ranks GROUP BY 1, 2),
auc_weighted AS (SELECT model, sum(roc_auc * support) / sum(support) AS roc_auc FROM auc GROUP BY 1)"""
MODEL_METRICS = f"""{PREDICTIONS}, {report_sql('model')}, {averages_sql('model')}, {AUC},
model_metrics AS (SELECT averages.*, roc_auc FROM averages LEFT JOIN auc_weighted USING (model))"""
GRADE = """CASE WHEN f1_weighted >= 0.85 THEN 'A' WHEN f1_weighted >= 0.75 THEN 'B' WHEN f1_weighted >= 0.65 THEN 'C' WHEN f1_weighted >= 0.50 THEN 'D' ELSE 'F' END"""


@query(f"WITH {PREDICTIONS} SELECT model, label, prediction, count(*) AS n FROM predictions GROUP BY 1, 2, 3")
def confusion(spark: SparkSession, folder: str) -> DataFrame:
    return m.confusion(predictions(spark, folder))


@query(f"""
WITH {PREDICTIONS}, {report_sql('model')}, {averages_sql('model')}
SELECT model, CAST(class AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM report
UNION ALL SELECT model, 'weighted avg', round(precision_weighted, 6), round(recall_weighted, 6), round(f1_weighted, 6), n FROM averages
UNION ALL SELECT model, 'macro avg', round(precision_macro, 6), round(recall_macro, 6), round(f1_macro, 6), n FROM averages
UNION ALL SELECT model, 'accuracy', round(accuracy, 6), round(accuracy, 6), round(accuracy, 6), n FROM averages""")
def class_report(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per class and the three averages, all from one confusion table."""
    report = m.class_report(m.confusion(predictions(spark, folder)))
    means = m.averages(report)

    def line(name: str, suffix: str) -> DataFrame:
        columns = [f"{c}_{suffix}" if suffix else "accuracy" for c in ("precision", "recall", "f1")]
        return means.select("model", F.lit(name).alias("class"), *[F.col(c).alias(n) for c, n in zip(columns, ("precision", "recall", "f1"))], F.col("n").alias("support"))

    rows = report.select("model", F.col("class").cast("string").alias("class"), "precision", "recall", "f1", "support")
    stacked = rows.unionByName(line("weighted avg", "weighted")).unionByName(line("macro avg", "macro")).unionByName(line("accuracy", ""))
    return _round(stacked, 6, "precision", "recall", "f1")


@query(f"""
WITH {PREDICTIONS}, {AUC}
SELECT model, CAST(class AS VARCHAR) AS class, round(roc_auc, 6) AS roc_auc, support FROM auc
UNION ALL SELECT model, 'weighted', round(sum(roc_auc * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM auc GROUP BY model""")
def roc_auc_ovr(spark: SparkSession, folder: str) -> DataFrame:
    by_class = m.roc_auc_by_class(predictions(spark, folder))
    # the per-class rows and their mean from one grouping, so that scores are ranked once
    total = by_class.rollup("model", "class").agg(
        (F.sum(F.col("roc_auc") * F.col("support")) / F.sum("support")).alias("roc_auc"), F.sum("support").alias("support")
    )
    return total.where(F.col("model").isNotNull()).select(
        "model", F.coalesce(F.col("class").cast("string"), F.lit("weighted")).alias("class"), F.round("roc_auc", 6).alias("roc_auc"), "support"
    )


@query(f"""
WITH {PREDICTIONS}, {SCORES}, b AS (SELECT model, class, avg(power(score - CASE WHEN label = class THEN 1 ELSE 0 END, 2)) AS brier FROM scores GROUP BY 1, 2)
SELECT model, CAST(class AS VARCHAR) AS class, round(brier, 6) AS brier FROM b
UNION ALL SELECT model, 'mean', round(avg(brier), 6) FROM b GROUP BY 1""")
def brier(spark: SparkSession, folder: str) -> DataFrame:
    by_class = m.brier(predictions(spark, folder))
    both = by_class.rollup("model", "class").agg(F.avg("brier").alias("brier")).where(F.col("model").isNotNull())
    return both.select("model", F.coalesce(F.col("class").cast("string"), F.lit("mean")).alias("class"), F.round("brier", 6).alias("brier"))


EDGES = " + ".join(f"CASE WHEN score > {i * 0.1!r}::DOUBLE THEN 1 ELSE 0 END" for i in range(1, 10))


@query(f"""
WITH {PREDICTIONS}, {SCORES}
SELECT model, class, CAST({EDGES} AS INTEGER) AS bin, round(avg(score), 6) AS mean_predicted,
  round(avg(CASE WHEN label = class THEN 1.0 ELSE 0.0 END), 6) AS fraction_positive, count(*) AS n FROM scores GROUP BY 1, 2, 3""")
def calibration(spark: SparkSession, folder: str) -> DataFrame:
    return _round(m.calibration(predictions(spark, folder)), 6, "mean_predicted", "fraction_positive")


@query(f"""
WITH {PREDICTIONS}, c AS (SELECT model, greatest(p0, p1, p2) AS c, label = prediction AS ok FROM predictions)
SELECT model, round(avg(c), 6) AS mean, round(stddev_pop(c), 6) AS std, round(min(c), 6) AS min, round(max(c), 6) AS max,
  round(quantile_cont(c, 0.5), 6) AS median, round(quantile_cont(c, 0.25), 6) AS q25, round(quantile_cont(c, 0.75), 6) AS q75,
  round(coalesce(avg(CASE WHEN ok THEN c END), 0), 6) AS correct_mean, round(coalesce(avg(CASE WHEN NOT ok THEN c END), 0), 6) AS incorrect_mean,
  round(coalesce(avg(CASE WHEN ok THEN c END) - avg(CASE WHEN NOT ok THEN c END), 0), 6) AS separation,
  round(100.0::DOUBLE * avg(CASE WHEN c >= 0.8 THEN 1.0 ELSE 0.0 END), 6) AS high_pct,
  round(coalesce(avg(CASE WHEN c >= 0.8 THEN CASE WHEN ok THEN 1.0 ELSE 0.0 END END), 0), 6) AS high_accuracy,
  CAST(sum(CASE WHEN c >= 0.8 THEN 1 ELSE 0 END) AS BIGINT) AS high_count
FROM c GROUP BY 1""")
def confidence_profile(spark: SparkSession, folder: str) -> DataFrame:
    profile = m.confidence_profile(predictions(spark, folder))
    return _round(profile, 6, *[c for c in profile.columns if c not in ("model", "high_count")])


@query(f"""
WITH {PREDICTIONS}, {report_sql('model, fold')}, {averages_sql('model, fold')},
long AS (SELECT model, fold, 'accuracy' AS metric, accuracy AS value FROM averages UNION ALL SELECT model, fold, 'f1_weighted', f1_weighted FROM averages
  UNION ALL SELECT model, fold, 'f1_macro', f1_macro FROM averages UNION ALL SELECT model, fold, 'precision_weighted', precision_weighted FROM averages
  UNION ALL SELECT model, fold, 'recall_weighted', recall_weighted FROM averages)
SELECT model, metric, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, string_agg(printf('%.4f', value), ',' ORDER BY fold) AS scores FROM long GROUP BY 1, 2""")
def cv_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Mean, spread and list of fold scores; all folds of all models from one confusion table."""
    keys = ["model", "fold"]
    folds = m.averages(m.class_report(m.confusion(predictions(spark, folder), keys), keys), keys)
    long = m.metrics_long(folds, keys, ["accuracy", "f1_weighted", "f1_macro", "precision_weighted", "recall_weighted"])
    listed = F.array_sort(F.collect_list(F.struct("fold", "value")))  # one entry per fold
    return long.groupBy("model", "metric").agg(
        F.round(F.avg("value"), 6).alias("mean"),
        F.round(F.stddev_pop("value"), 6).alias("std"),
        F.array_join(F.transform(listed, lambda s: F.format_string("%.4f", s["value"])), ",").alias("scores"),
    )


@query(f"""
WITH {MODEL_METRICS}
SELECT count(*) AS total_models, CAST(sum(CASE WHEN f1_weighted >= 0.65 THEN 1 ELSE 0 END) AS BIGINT) AS models_above_threshold,
  round(avg(CASE WHEN f1_weighted >= 0.65 THEN 1.0 ELSE 0.0 END), 6) AS threshold_success_rate,
  round(avg(f1_weighted), 6) AS f1_mean, round(stddev_pop(f1_weighted), 6) AS f1_std, round(min(f1_weighted), 6) AS f1_min, round(max(f1_weighted), 6) AS f1_max, round(median(f1_weighted), 6) AS f1_median,
  round(avg(accuracy), 6) AS accuracy_mean, round(stddev_pop(accuracy), 6) AS accuracy_std, round(min(accuracy), 6) AS accuracy_min, round(max(accuracy), 6) AS accuracy_max, round(median(accuracy), 6) AS accuracy_median
FROM model_metrics""")
def model_summary(spark: SparkSession, folder: str) -> DataFrame:
    means = m.averages(m.class_report(m.confusion(predictions(spark, folder))))
    summary = ranking.summarise_models(means)
    return _round(summary, 6, *[c for c in summary.columns if c not in ("total_models", "models_above_threshold")])


@query(f"""
WITH {MODEL_METRICS}, s AS (SELECT *, 0.5::DOUBLE * f1_weighted + 0.3::DOUBLE * accuracy + 0.2::DOUBLE * coalesce(roc_auc, 0) AS composite FROM model_metrics)
SELECT model, round(f1_weighted, 6) AS f1_weighted, round(accuracy, 6) AS accuracy, round(roc_auc, 6) AS roc_auc, round(composite, 6) AS composite_score,
  f1_weighted >= 0.65 AS threshold_met, {GRADE} AS performance_grade,
  CAST(row_number() OVER (ORDER BY composite DESC, model) AS INTEGER) AS rank_composite,
  CAST(row_number() OVER (ORDER BY f1_weighted DESC, model) AS INTEGER) AS rank_f1,
  CAST(row_number() OVER (ORDER BY accuracy DESC, model) AS INTEGER) AS rank_accuracy FROM s""")
def model_ranking(spark: SparkSession, folder: str) -> DataFrame:
    ranked = ranking.rank_models(m.model_metrics(predictions(spark, folder)))
    return _round(ranked, 6, "f1_weighted", "accuracy", "roc_auc", "composite_score").select(
        "model", "f1_weighted", "accuracy", "roc_auc", "composite_score", "threshold_met", "performance_grade",
        "rank_composite", "rank_f1", "rank_accuracy",
    )


@query(f"""
WITH {MODEL_METRICS}, s AS (SELECT *, f1_weighted + 0.1::DOUBLE * accuracy + 0.05::DOUBLE * coalesce(roc_auc, 0) AS score FROM model_metrics)
SELECT model, round(f1_weighted, 6) AS f1_weighted, round(accuracy, 6) AS accuracy, round(roc_auc, 6) AS roc_auc, round(score, 6) AS selection_score FROM s ORDER BY score DESC, model LIMIT 1""")
def best_model(spark: SparkSession, folder: str) -> DataFrame:
    best = ranking.best_model(m.model_metrics(predictions(spark, folder)))
    return _round(best, 6, "f1_weighted", "accuracy", "roc_auc", "selection_score").select(
        "model", "f1_weighted", "accuracy", "roc_auc", "selection_score"
    )


@query(f"""
WITH {MODEL_METRICS}, r AS (SELECT *, row_number() OVER (ORDER BY f1_weighted DESC, model) AS rn FROM model_metrics)
SELECT model, round(accuracy, 6) AS accuracy, round(f1_weighted, 6) AS f1_weighted, round(f1_macro, 6) AS f1_macro, round(roc_auc, 6) AS roc_auc,
  round(f1_weighted, 6) AS business_f1, {GRADE} AS performance_grade, f1_weighted >= 0.65 AS threshold_met, rn = 1 AS headline,
  CAST(CASE WHEN rn = 1 THEN 1 WHEN model = (SELECT min(model) FROM r WHERE rn > 1) THEN 2 ELSE 0 END AS INTEGER) AS test_place FROM r""")
def graded_models(spark: SparkSession, folder: str) -> DataFrame:
    """The comparison table: business F1 (the weighted F1), grade, headline model and the pair chosen for a test."""
    metrics = m.model_metrics(predictions(spark, folder))
    graded = metrics.withColumns(
        {"business_f1": F.col("f1_weighted"), "performance_grade": performance_grade("f1_weighted"), "threshold_met": threshold_met("f1_weighted")}
    )
    out = ranking.test_places(graded)
    return (
        _round(out.withColumn("headline", F.col("test_place") == 1), 6, "accuracy", "f1_weighted", "f1_macro", "roc_auc", "business_f1")
        .select("model", "accuracy", "f1_weighted", "f1_macro", "roc_auc", "business_f1", "performance_grade", "threshold_met", "headline", "test_place")
        .orderBy(F.desc("business_f1"), "model")
    )


@query(f"""
WITH {PREDICTIONS}, {report_sql('model, part')}, {averages_sql('model, part')},
long AS (SELECT model, part, 'accuracy' AS metric, accuracy AS value FROM averages UNION ALL SELECT model, part, 'f1_weighted', f1_weighted FROM averages
  UNION ALL SELECT model, part, 'f1_macro', f1_macro FROM averages)
SELECT a.model, a.metric, round(a.value, 6) AS v1_value, round(b.value, 6) AS v2_value, round(b.value - a.value, 6) AS difference, b.value - a.value > 0 AS improvement
FROM long a JOIN long b ON a.model = b.model AND a.metric = b.metric AND a.part = 'F' AND b.part = 'O'""")
def metric_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Two versions of each model, here the two line-status halves, metric by metric."""
    keys = ["model", "part"]
    means = m.averages(m.class_report(m.confusion(predictions(spark, folder), keys), keys), keys)
    long = m.metrics_long(means, keys, ["accuracy", "f1_weighted", "f1_macro"])
    return _round(ranking.metric_difference(long, "F", "O", "part"), 6, "v1_value", "v2_value", "difference")


@query(f"""
WITH {PREDICTIONS}, {report_sql('model', "(SELECT * FROM predictions WHERE fold <> 0)", 'train_report')}, {averages_sql('model', 'train_report', 'trained')},
{report_sql('model', "(SELECT * FROM predictions WHERE fold = 0)")}, {averages_sql('model')},
verdict AS (SELECT model, f1_weighted >= 0.65 AS threshold_met, {GRADE} AS performance_grade FROM averages WHERE accuracy > 0.5)
SELECT t.model, round(t.accuracy, 6) AS accuracy, round(t.f1_weighted, 6) AS f1_weighted, coalesce(v.threshold_met, false) AS threshold_met,
  coalesce(v.performance_grade, 'Unknown') AS performance_grade, v.model IS NOT NULL AS validation_passed FROM trained t LEFT JOIN verdict v USING (model)""")
def validation_join(spark: SparkSession, folder: str) -> DataFrame:
    """Training metrics with the validation verdict where there is one (accuracy above one half)."""
    keys = ["model", "validation"]
    tagged = predictions(spark, folder).withColumn("validation", F.col("fold") == 0)
    both = m.averages(m.class_report(m.confusion(tagged, keys), keys), keys)
    verdict = both.where(F.col("validation") & (F.col("accuracy") > 0.5)).select(
        "model", threshold_met("f1_weighted").alias("threshold_met"), performance_grade("f1_weighted").alias("performance_grade"),
        F.lit(True).alias("validation_passed"),
    )
    return both.where(~F.col("validation")).join(verdict, "model", "left").select(
        "model", F.round("accuracy", 6).alias("accuracy"), F.round("f1_weighted", 6).alias("f1_weighted"),
        F.coalesce("threshold_met", F.lit(False)).alias("threshold_met"),
        F.coalesce("performance_grade", F.lit("Unknown")).alias("performance_grade"),
        F.coalesce("validation_passed", F.lit(False)).alias("validation_passed"),
    )


@query("""
SELECT user_id, ts, event_id, event_type, round(value, 4) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The newest row per key."""
    events = table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type", F.round("value", 4).alias("value"))
    return ranking.latest(events, ["user_id"], ["ts", "event_id"])


@query("""
SELECT event_type, event_id, ts, CAST(rn AS INTEGER) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 5""")
def recent_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The five newest rows per key."""
    events = table(spark, folder, "events").select("event_type", "event_id", "ts")
    return ranking.recent(events, ["event_type"], [F.desc("ts"), F.desc("event_id")], 5)
