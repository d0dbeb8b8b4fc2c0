"""A/B test queries over the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.operators import experiments as ab
from ledgerlark.plans.evaluation import averages_sql, report_sql
from ledgerlark.plans.registry import query
from ledgerlark.plans.views import AB_EVENTS
from ledgerlark.session import run_dir
from ledgerlark.sources.accounts import EXPERIMENTS, ab_actuals, ab_predictions, experiments
from ledgerlark.sources.tables import table

MIN_SAMPLE = 2500
PAIRS = f"""{AB_EVENTS},
pairs AS (SELECT experiment_id, variant, unit_id, prediction, actual AS label FROM ab_predictions JOIN ab_actuals USING (unit_id))"""
MOMENTS = f"""{PAIRS},
s AS (SELECT experiment_id, variant, CASE WHEN prediction = label THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS v FROM pairs),
moments AS (SELECT experiment_id, count(v) FILTER (variant = 'control') AS n2, count(v) FILTER (variant = 'treatment') AS n1,
    avg(v) FILTER (variant = 'control') AS m2, avg(v) FILTER (variant = 'treatment') AS m1,
    var_samp(v) FILTER (variant = 'control') AS v2, var_samp(v) FILTER (variant = 'treatment') AS v1,
    var_pop(v) FILTER (variant = 'control') AS w2, var_pop(v) FILTER (variant = 'treatment') AS w1 FROM s GROUP BY 1),
t0 AS (SELECT *, m1 - m2 AS difference, n1 + n2 - 2 AS df, (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0::DOUBLE / n1 + 1.0::DOUBLE / n2)) AS t,
    (m1 - m2) / sqrt(((n1 - 1) * w1 + (n2 - 1) * w2) / (n1 + n2 - 2)) AS d, n1 >= {MIN_SAMPLE} AND n2 >= {MIN_SAMPLE} AS enough FROM moments),
tests AS (SELECT *, enough AND abs(t) > 1.959963984540054::DOUBLE + (power(1.959963984540054::DOUBLE, 3) + 1.959963984540054::DOUBLE) / (4.0::DOUBLE * df) AS significant FROM t0),
judged AS (SELECT *, CASE WHEN NOT enough THEN 'inconclusive' WHEN difference > 0 AND significant THEN 'treatment' ELSE 'control' END AS winner FROM tests)"""


def tested(spark: SparkSession, folder: str) -> DataFrame:
    pairs = ab.paired(ab_predictions(spark, folder), ab_actuals(spark, folder))
    score = F.when(F.col("prediction") == F.col("actual"), 1.0).otherwise(0.0)
    return ab.t_test(ab.variant_moments(pairs, score), min_sample=MIN_SAMPLE)


@query(f"WITH {AB_EVENTS} SELECT DISTINCT experiment_id, user_id, variant FROM assigned")
def ab_assign(spark: SparkSession, folder: str) -> DataFrame:
    """The variant of every user in every experiment."""
    listed = F.array(*[F.struct(F.lit(e).alias("id"), F.lit(s).alias("split")) for e, s, _ in EXPERIMENTS])
    users = table(spark, folder, "events").select("user_id").distinct()
    return users.select("user_id", F.explode(listed).alias("x")).select(
        F.col("x.id").alias("experiment_id"), "user_id", ab.assign_variant(F.col("x.id"), "user_id", F.col("x.split")).alias("variant")
    )


@query(f"""
WITH {PAIRS}, {report_sql('experiment_id, variant', 'pairs')}, {averages_sql('experiment_id, variant')}
SELECT experiment_id, variant, round(accuracy, 6) AS accuracy, round(f1_weighted, 6) AS f1_score, round(precision_weighted, 6) AS precision,
  round(recall_weighted, 6) AS recall, 0.5::DOUBLE AS roc_auc, n AS sample_size FROM averages""")
def ab_metrics(spark: SparkSession, folder: str) -> DataFrame:
    metrics = ab.variant_metrics(ab.paired(ab_predictions(spark, folder), ab_actuals(spark, folder)))
    return metrics.withColumns({c: F.round(c, 6) for c in ("accuracy", "f1_score", "precision", "recall", "roc_auc")})


@query(f"""
WITH {MOMENTS}
SELECT experiment_id, n2 AS control_n, n1 AS treatment_n, round(m2, 6) AS control_metric, round(m1, 6) AS treatment_metric, round(difference, 6) AS difference,
  round(t, 6) AS test_statistic, round(d, 6) AS effect_size, significant, winner,
  CASE WHEN NOT enough THEN 'Insufficient sample size (min: {MIN_SAMPLE})' ELSE '' END AS reason FROM judged""")
def ab_ttest(spark: SparkSession, folder: str) -> DataFrame:
    """Test of the per-row score 1[prediction = actual]; one experiment is too small for its gate."""
    rounded = {c: F.round(c, 6) for c in ("control_metric", "treatment_metric", "difference", "test_statistic", "effect_size")}
    return tested(spark, folder).withColumns({**rounded, "reason": F.coalesce("reason", F.lit(""))}).select(
        "experiment_id", "control_n", "treatment_n", "control_metric", "treatment_metric", "difference",
        "test_statistic", "effect_size", "significant", "winner", "reason",
    )


@query()
def ab_interval(spark: SparkSession, folder: str) -> DataFrame:
    """p-value, critical value and confidence interval of the difference (t tails are not SQL)."""
    return tested(spark, folder).select("experiment_id", "difference", "p_value", "critical", "ci_lower", "ci_upper")


@query(f"""
WITH {MOMENTS}, c AS (SELECT *, TIMESTAMP '2024-02-01 00:00:00' > created_at + INTERVAL 30 DAY AS expired FROM judged JOIN experiments USING (experiment_id))
SELECT experiment_id, significant OR expired AS concluded, expired, significant, CASE WHEN significant OR expired THEN winner ELSE '' END AS winner,
  CASE WHEN NOT (significant OR expired) THEN 'Experiment criteria not met for conclusion'
    WHEN NOT significant THEN '{ab.ADVICE['none']}'
    WHEN winner = 'treatment' THEN CASE WHEN abs(d) > 0.8 THEN '{ab.ADVICE['strong']}' WHEN abs(d) > 0.5 THEN '{ab.ADVICE['moderate']}' ELSE '{ab.ADVICE['weak']}' END
    ELSE '{ab.ADVICE['control']}' END AS recommendation FROM c""")
def ab_conclude(spark: SparkSession, folder: str) -> DataFrame:
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return ab.conclude(tested(spark, folder), experiments(spark), as_of).withColumn("winner", F.coalesce("winner", F.lit("")))


@query(f"""
WITH {AB_EVENTS}
SELECT p.experiment_id, p.variant, count(*) AS predictions, count(a.unit_id) AS actuals FROM ab_predictions p LEFT JOIN ab_actuals a USING (unit_id) GROUP BY 1, 2""")
def ab_append(spark: SparkSession, folder: str) -> DataFrame:
    """Events appended in two writes to a partitioned table, then read back and counted."""
    path = run_dir(spark, "ab-events")
    predictions = ab_predictions(spark, folder)
    for later in (False, True):
        half = predictions.where((F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")) == F.lit(later))
        ab.record_events(half, path)
    stored = spark.read.parquet(path)
    seen = ab_actuals(spark, folder).select("unit_id", F.lit(1).alias("seen"))
    return stored.join(seen, "unit_id", "left").groupBy("experiment_id", "variant").agg(
        F.count(F.lit(1)).alias("predictions"), F.count("seen").alias("actuals")
    )


@query()
def random_assign(spark: SparkSession, folder: str) -> DataFrame:
    """Seeded random assignment of events without a user."""
    events = table(spark, folder, "events").select("event_id", ab.assign_randomly(F.lit(0.5), 42).alias("variant"))
    return events.groupBy("variant").agg(F.count(F.lit(1)).alias("n"))
