"""Attribution queries: given linear coefficients over the accounts, and sampled attribution of a fitted model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.operators import explain as ex
from ledgerlark.operators import models as ml
from ledgerlark.operators.features import hash_sample
from ledgerlark.plans.learning import PREDICTORS
from ledgerlark.plans.registry import query
from ledgerlark.plans.views import ACCOUNTS
from ledgerlark.sources.accounts import accounts

# Given coefficients per class, and intercepts.
COEFFICIENTS = {
    "full_payment": {"credit_score": 0.004, "days_overdue": -0.006, "payment_history_score": 1.5, "response_rate": 1.2, "contact_attempts": -0.01, "debt_to_income_ratio": -0.3},
    "no_payment": {"credit_score": -0.005, "days_overdue": 0.007, "payment_history_score": -1.1, "response_rate": -1.4, "contact_attempts": 0.02, "debt_to_income_ratio": 0.4},
    "partial_payment": {"credit_score": 0.001, "days_overdue": -0.001, "payment_history_score": -0.4, "response_rate": 0.2, "contact_attempts": -0.001, "debt_to_income_ratio": -0.1},
}
INTERCEPTS = {"full_payment": -2.0, "no_payment": 1.0, "partial_payment": 1.0}
FEATURES = list(COEFFICIENTS["full_payment"])
CLASSES = list(COEFFICIENTS)

MEANS = ", ".join(f"avg({f}) AS {f}" for f in FEATURES)
SHAP = f"""{ACCOUNTS}, ready AS (SELECT customer_id, {', '.join(f'coalesce({f}, 0) AS {f}' for f in FEATURES)} FROM accounts),
means AS (SELECT {MEANS} FROM ready),
shap AS ({' UNION ALL '.join(
    f"SELECT customer_id AS row_id, '{c}' AS class, '{f}' AS feature, {w!r}::DOUBLE * (ready.{f} - means.{f}) AS shap_value, ready.{f}::DOUBLE AS feature_value FROM ready, means"
    for c, ws in COEFFICIENTS.items() for f, w in ws.items())})"""
MARGINS = ", ".join(
    f"{INTERCEPTS[c]!r}::DOUBLE + " + " + ".join(f"{w!r}::DOUBLE * {f}" for f, w in ws.items()) + f" AS m{i}" for i, (c, ws) in enumerate(COEFFICIENTS.items())
)
PROBS = f"""
margins AS (SELECT customer_id, {MARGINS} FROM ready),
exps AS (SELECT customer_id, exp(m0 - greatest(m0, m1, m2)) AS e0, exp(m1 - greatest(m0, m1, m2)) AS e1, exp(m2 - greatest(m0, m1, m2)) AS e2 FROM margins),
probs AS (SELECT customer_id AS row_id, e0 / (e0 + e1 + e2) AS p0, e1 / (e0 + e1 + e2) AS p1, e2 / (e0 + e1 + e2) AS p2 FROM exps),
predicted AS (SELECT *, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 'full_payment' WHEN p1 >= p2 THEN 'no_payment' ELSE 'partial_payment' END AS class FROM probs)"""
PROFILE = f"""{SHAP}, chosen AS (SELECT * FROM shap WHERE class = 'no_payment'),
sds AS (SELECT feature, stddev_pop(shap_value) AS sd FROM chosen GROUP BY 1),
profile AS (
  SELECT feature, avg(abs(shap_value)) AS importance, avg(shap_value) AS mean_shap, stddev_pop(shap_value) AS std_shap,
    avg(CASE WHEN shap_value > 0 THEN 1.0 ELSE 0.0 END) AS positive_impact_ratio, 1 - stddev_pop(shap_value) / (abs(avg(shap_value)) + 1e-8::DOUBLE) AS impact_consistency,
    quantile_cont(shap_value, 0.95) AS percentile_95, quantile_cont(shap_value, 0.05) AS percentile_5, avg(CASE WHEN abs(shap_value) > 2 * sd THEN 1.0 ELSE 0.0 END) AS outlier_impact
  FROM chosen JOIN sds USING (feature) GROUP BY 1)"""


def ready(spark: SparkSession, folder: str) -> DataFrame:
    return accounts(spark, folder).select(
        "customer_id", *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in FEATURES]
    )


def shap_long(spark: SparkSession, folder: str) -> DataFrame:
    df = ready(spark, folder)
    return ex.linear_attribution(df, "customer_id", COEFFICIENTS, ex.column_means(df, FEATURES))


def documents(spark: SparkSession, folder: str, n: int = 10) -> DataFrame:
    """Explanation documents of the given linear model."""
    df = ready(spark, folder)
    return ex.linear_explanations(df, "customer_id", COEFFICIENTS, INTERCEPTS, ex.column_means(df, FEATURES), n)


@query(f"WITH {SHAP} SELECT row_id, class, feature, round(shap_value, 6) AS shap_value, round(feature_value, 6) AS feature_value FROM shap")
def linear_attribution(spark: SparkSession, folder: str) -> DataFrame:
    return shap_long(spark, folder).withColumns({c: F.round(c, 6) for c in ("shap_value", "feature_value")})


@query(f"WITH {SHAP} SELECT feature, round(avg(abs(shap_value)), 6) AS importance FROM shap GROUP BY 1")
def attribution_importance(spark: SparkSession, folder: str) -> DataFrame:
    return ex.importance(shap_long(spark, folder)).withColumn("importance", F.round("importance", 6))


@query(f"WITH {SHAP}, i AS (SELECT feature, avg(abs(shap_value)) AS v FROM shap GROUP BY 1 ORDER BY v DESC, feature LIMIT 3) SELECT feature, round(v, 6) AS importance FROM i")
def importance_top(spark: SparkSession, folder: str) -> DataFrame:
    return ex.top_importance(shap_long(spark, folder), 3).withColumn("importance", F.round("importance", 6))


PROFILE_COLUMNS = ["importance", "mean_shap", "std_shap", "positive_impact_ratio", "percentile_95", "percentile_5", "outlier_impact"]


@query(f"WITH {PROFILE} SELECT feature, {', '.join(f'round({c}, 5) + 0.0::DOUBLE AS {c}' for c in PROFILE_COLUMNS)}, impact_consistency < 0.3 AS inconsistent FROM profile")
def attribution_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Profile of one class. The mean is 0 up to rounding, so the consistency is shown as its flag."""
    profile = ex.feature_profile(shap_long(spark, folder).where("class = 'no_payment'"))
    return profile.select(
        "feature", *[(F.round(c, 5) + F.lit(0.0)).alias(c) for c in PROFILE_COLUMNS], (F.col("impact_consistency") < 0.3).alias("inconsistent")
    )


@query(f"""
WITH {PROFILE}, totals AS (SELECT row_id, sum(shap_value) AS t FROM chosen GROUP BY 1), s AS (SELECT stddev_pop(t) AS sd, avg(t) AS mu FROM totals)
SELECT round((SELECT avg(sd) FROM sds), 5) AS prediction_stability, round(avg(CASE WHEN abs(t) > sd THEN 1.0 ELSE 0.0 END), 5) AS high_confidence_predictions,
  round(avg(t), 5) + 0.0::DOUBLE AS mean, round(stddev_pop(t), 5) AS std, round(avg(power(t - mu, 3)) / power(stddev_pop(t), 3), 5) AS skewness FROM totals, s""")
def attribution_behavior(spark: SparkSession, folder: str) -> DataFrame:
    behaviour = ex.model_behaviour(shap_long(spark, folder).where("class = 'no_payment'"))
    return behaviour.select(*[(F.round(c, 5) + F.lit(0.0)).alias(c) for c in behaviour.columns])


def _pairs() -> str:
    out = []
    for i, a in enumerate(FEATURES):
        for b in FEATURES[i + 1 :]:
            sign = (1 if COEFFICIENTS["no_payment"][a] > 0 else -1) * (1 if COEFFICIENTS["no_payment"][b] > 0 else -1)
            out.append(f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, round({sign} * corr({a}, {b}), 6) AS r FROM ready")
    return " UNION ALL ".join(out)


@query(f"WITH {SHAP}, c AS ({_pairs()}) SELECT * FROM c WHERE abs(r) > 0.1")
def attribution_interactions(spark: SparkSession, folder: str) -> DataFrame:
    """Correlated attributions of one class (above 0.1 here)."""
    return ex.feature_interactions(shap_long(spark, folder).where("class = 'no_payment'"), FEATURES, 0.1)


@query(f"""
WITH {SHAP}, recent AS (SELECT feature, shap_value AS v FROM shap WHERE class = 'no_payment' AND row_id IN (SELECT customer_id FROM accounts WHERE days_overdue <= 60))
SELECT feature, round(avg(v), 6) AS average_impact, round(avg(CASE WHEN v < 0 THEN 1.0 ELSE 0.0 END), 6) AS frequency FROM recent GROUP BY 1 HAVING avg(v) < -0.1""")
def attribution_risks(spark: SparkSession, folder: str) -> DataFrame:
    """Features with a clearly negative mean among accounts at most 60 days overdue (over all accounts it is 0)."""
    recent = accounts(spark, folder).where("days_overdue <= 60").select(F.col("customer_id").alias("row_id"))
    risks = ex.risk_factors(shap_long(spark, folder).where("class = 'no_payment'").join(recent, "row_id", "left_semi"))
    return risks.withColumns({c: F.round(c, 6) for c in ("average_impact", "frequency")})


@query(f"""
WITH {PROFILE}, r AS (SELECT *, row_number() OVER (ORDER BY importance DESC, feature) AS ir FROM profile),
hits AS (
  SELECT 'inconsistent_high_impact' AS rule, 3 AS keep, 1 AS need, ir, feature FROM r WHERE ir <= 10 AND impact_consistency < 0.3
  UNION ALL SELECT 'low_importance', 1000000, 6, ir, feature FROM r WHERE importance < 0.01
  UNION ALL SELECT 'outlier_impact', 3, 1, ir, feature FROM r WHERE outlier_impact > 0.1 AND importance > 0.05
  UNION ALL SELECT 'interaction_candidates', 2, 1, ir, feature FROM r WHERE positive_impact_ratio > 0.8 AND importance > 0.05
  UNION ALL SELECT 'binning_candidates', 2, 1, ir, feature FROM r WHERE positive_impact_ratio > 0.3 AND positive_impact_ratio < 0.7 AND importance > 0.05
  UNION ALL SELECT 'scaling_candidates', 3, 1, ir, feature FROM r WHERE std_shap > 0.2 AND importance > 0.05
  UNION ALL SELECT 'top_drivers', 3, 1, ir, feature FROM r WHERE ir <= 3
  UNION ALL SELECT 'beneficial_factors', 3, 1, ir, feature FROM r WHERE positive_impact_ratio > 0.7 AND importance > 0.05
  UNION ALL SELECT 'inconsistent_features', 2, 1, ir, feature FROM r WHERE impact_consistency < 0.5 AND importance > 0.05
  UNION ALL SELECT 'risk_factors', 2, 1, ir, feature FROM r WHERE mean_shap < -0.1 AND importance > 0.05),
placed AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY ir) AS place, count(*) OVER (PARTITION BY rule) AS found FROM hits)
SELECT rule, CAST(place AS INTEGER) AS place, feature FROM placed WHERE place <= keep AND found >= need""")
def attribution_rules(spark: SparkSession, folder: str) -> DataFrame:
    return ex.insights(ex.feature_profile(shap_long(spark, folder).where("class = 'no_payment'")))


TOP = """
placed AS (SELECT *, row_number() OVER (PARTITION BY row_id, class ORDER BY abs(shap_value) DESC, feature) AS place FROM shap)"""


@query(f"""
WITH {SHAP}, {PROBS}, {TOP}
SELECT row_id, class, round(greatest(p0, p1, p2), 6) AS confidence, CAST(place AS INTEGER) AS place, feature, round(shap_value, 6) AS shap_value, round(feature_value, 6) AS feature_value,
  CASE WHEN shap_value > 0 THEN 'positive' ELSE 'negative' END AS impact FROM placed JOIN predicted USING (row_id, class) WHERE place <= 10""")
def top_features_per_row(spark: SparkSession, folder: str) -> DataFrame:
    """The explanation document of every row, flattened to its strongest features for the predicted class."""
    return documents(spark, folder).select("row_id", "class", "probabilities", F.posexplode("top_features").alias("pos", "t")).select(
        "row_id", "class", F.round(F.array_max(F.map_values("probabilities")), 6).alias("confidence"),
        (F.col("pos") + 1).alias("place"), "t.feature", F.round("t.shap_value", 6).alias("shap_value"),
        F.round("t.feature_value", 6).alias("feature_value"), "t.impact",
    )


@query(f"""
WITH {SHAP}, {PROBS}, {TOP},
c AS (SELECT class, CASE WHEN shap_value > 0 THEN 'positive' ELSE 'negative' END AS impact, feature, count(*) AS n FROM placed JOIN predicted USING (row_id, class) WHERE place <= 3 GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY class, impact ORDER BY n DESC, feature) AS place FROM c)
SELECT class, impact, feature, n, CAST(place AS INTEGER) AS place FROM r WHERE place <= 5""")
def class_drivers(spark: SparkSession, folder: str) -> DataFrame:
    return ex.drivers_of_documents(documents(spark, folder, 3))


@query(f"""
WITH {SHAP}, {PROBS}
SELECT round(avg(greatest(p0, p1, p2)), 6) AS average_confidence, round(stddev_pop(greatest(p0, p1, p2)), 6) AS confidence_std,
  CAST(sum(CASE WHEN greatest(p0, p1, p2) > 0.8 THEN 1 ELSE 0 END) AS BIGINT) AS high_confidence_predictions, count(*) AS n FROM predicted""")
def explanation_confidence(spark: SparkSession, folder: str) -> DataFrame:
    summary = ex.confidence_summary(documents(spark, folder))
    return summary.withColumns({c: F.round(c, 6) for c in ("average_confidence", "confidence_std")})


@query(f"""
WITH {SHAP}, {PROBS}, {TOP}, g AS (SELECT feature, avg(abs(shap_value)) AS v FROM shap GROUP BY 1),
picked AS (SELECT * FROM predicted ORDER BY CAST('0x' || substr(md5(row_id), 1, 7) AS BIGINT), row_id LIMIT 10)
SELECT 'global' AS section, 'all' AS key, CAST(row_number() OVER (ORDER BY v DESC, feature) AS INTEGER) AS place, feature AS item, round(v, 6) AS value FROM g
UNION ALL SELECT 'sample', row_id, CAST(place AS INTEGER), feature, round(shap_value, 6) FROM placed JOIN picked USING (row_id, class) WHERE place <= 10""")
def explanation_report(spark: SparkSession, folder: str) -> DataFrame:
    """Global importance, and the documents of ten sampled rows."""
    shap = shap_long(spark, folder)
    # one row per feature
    order = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("importance"), "feature"))
    overall = ex.importance(shap).select(
        F.lit("global").alias("section"), F.lit("all").alias("key"), order.alias("place"), F.col("feature").alias("item"), F.round("importance", 6).alias("value")
    )
    sample = hash_sample(documents(spark, folder), "row_id", 10)
    rows = sample.select("row_id", F.posexplode("top_features").alias("pos", "t")).select(
        F.lit("sample").alias("section"), F.col("row_id").alias("key"), (F.col("pos") + 1).alias("place"),
        F.col("t.feature").alias("item"), F.round("t.shap_value", 6).alias("value"),
    )
    return overall.unionByName(rows)


@query()
def sampled_shapley(spark: SparkSession, folder: str) -> DataFrame:
    """Attribution of a fitted logistic model to no_payment, for every account; mean |value| per feature."""
    frame = ml.training_frame(accounts(spark, folder), PREDICTORS, "payment_status", "customer_id")
    fitted = ml.logistic(frame.count()).fit(frame)
    model = PipelineModel([VectorAssembler(inputCols=PREDICTORS, outputCol="features"), fitted])
    rows = accounts(spark, folder).select("customer_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in PREDICTORS])
    values = ex.sampled_shapley(rows, "customer_id", PREDICTORS, model, ex.column_means(rows, PREDICTORS), class_index=1)
    return values.groupBy("feature").agg(
        F.count(F.lit(1)).alias("rows"), F.avg(F.abs("shap_value")).alias("importance"), F.avg("shap_value").alias("mean_value")
    )
