"""A/B tests as queries over append-only event tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.hashing import hash_bucket
from ledgerlark.functions.special import t_critical, t_tail
from ledgerlark.operators.metrics import averages, class_report, confusion

ALPHA = 0.05
MIN_SAMPLE = 100
MAX_DAYS = 30
# Recommendation texts.
ADVICE = {
    "none": "No significant difference detected. Consider running longer or with larger sample size.",
    "strong": "Strong evidence for treatment model. Recommend full rollout.",
    "moderate": "Moderate evidence for treatment model. Consider gradual rollout.",
    "weak": "Weak evidence for treatment model. Consider additional testing.",
    "control": "Control model performs better. Do not deploy treatment model.",
}
KEYS = ["experiment_id", "variant"]


def assign_variant(experiment: Column | str, user: Column | str, split: Column) -> Column:
    """Stable assignment: the same user always gets the same variant of an experiment."""
    user = F.col(user) if isinstance(user, str) else user
    return F.when(hash_bucket(experiment, user.cast("string")) < split * 100, "treatment").otherwise("control")


def assign_randomly(split: Column, seed: int) -> Column:
    """For events without a user id."""
    return F.when(F.rand(seed) < split, "treatment").otherwise("control")


def paired(predictions: DataFrame, actuals: DataFrame) -> DataFrame:
    """Predictions with their outcome by unit id; units without outcome are left out."""
    return predictions.join(actuals, "unit_id")


def variant_metrics(pairs: DataFrame) -> DataFrame:
    """Accuracy, weighted F1, precision and recall per variant, from one confusion table.

    AUC of plain class predictions is the mean recall for two classes and 0.5 for more.
    """
    report = class_report(confusion(pairs.withColumnRenamed("actual", "label"), KEYS), KEYS)
    means = averages(report, KEYS)
    classes = report.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("classes"))
    auc = F.when(F.col("classes") == 2, F.col("recall_macro")).otherwise(0.5)
    return means.join(classes, KEYS).select(
        *KEYS, "accuracy", F.col("f1_weighted").alias("f1_score"), F.col("precision_weighted").alias("precision"),
        F.col("recall_weighted").alias("recall"), auc.alias("roc_auc"), F.col("n").alias("sample_size"),
    )


def variant_moments(pairs: DataFrame, value: Column) -> DataFrame:
    """Both variants side by side per experiment: size, mean and variances of a per-row metric."""
    control, treatment = F.col("variant") == "control", F.col("variant") == "treatment"
    columns = []
    for name, side in (("control", control), ("treatment", treatment)):
        v = F.when(side, value)
        columns += [
            F.count(v).alias(f"{name}_n"), F.avg(v).alias(f"{name}_metric"),
            F.var_samp(v).alias(f"{name}_var"), F.var_pop(v).alias(f"{name}_var_pop"),
        ]
    return pairs.groupBy("experiment_id").agg(*columns)


def t_test(moments: DataFrame, alpha: float = ALPHA, min_sample: int = MIN_SAMPLE) -> DataFrame:
    """Pooled t-test, effect size, interval, gate and winner; one row per experiment."""
    n1, n2 = F.col("treatment_n"), F.col("control_n")
    df = n1 + n2 - 2
    difference = F.col("treatment_metric") - F.col("control_metric")
    pooled = F.try_divide((n1 - 1) * F.col("treatment_var") + (n2 - 1) * F.col("control_var"), df)
    flat = F.sqrt(F.try_divide((n1 - 1) * F.col("treatment_var_pop") + (n2 - 1) * F.col("control_var_pop"), df))
    spread = F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2)
    enough = (n1 >= min_sample) & (n2 >= min_sample)
    tested = moments.withColumns(
        {
            "difference": difference,
            "df": df.cast("double"),
            "test_statistic": F.try_divide(difference, F.sqrt(pooled * spread)),
            "effect_size": F.when(flat > 0, difference / flat).otherwise(0.0),
            "standard_error": flat * F.sqrt(spread),
            "enough": F.coalesce(enough, F.lit(False)),
        }
    )
    judged = tested.withColumn("p_value", t_tail("test_statistic", "df")).withColumn(
        "critical", t_critical(F.lit(1 - alpha / 2), "df")
    )
    significant = F.col("enough") & F.coalesce(F.col("p_value") < alpha, F.lit(False))
    return judged.withColumn("significant", significant).withColumns(
        {
            "ci_lower": F.col("difference") - F.col("critical") * F.col("standard_error"),
            "ci_upper": F.col("difference") + F.col("critical") * F.col("standard_error"),
            "winner": F.when(~F.col("enough"), "inconclusive")
            .when((F.col("difference") > 0) & F.col("significant"), "treatment")
            .otherwise("control"),
            "reason": F.when(~F.col("enough"), f"Insufficient sample size (min: {min_sample})"),
        }
    )


def recommendation(significant: Column, winner: Column, effect: Column) -> Column:
    size = F.abs(effect)
    treatment = F.when(size > 0.8, ADVICE["strong"]).when(size > 0.5, ADVICE["moderate"]).otherwise(ADVICE["weak"])
    return F.when(~significant, ADVICE["none"]).when(winner == "treatment", treatment).otherwise(ADVICE["control"])


def conclude(tests: DataFrame, experiments: DataFrame, as_of: Column, force: bool = False, max_days: int = MAX_DAYS) -> DataFrame:
    """Whether each experiment can end at `as_of`, with winner and advice."""
    # one row per experiment on both sides
    listed = tests.join(experiments.select("experiment_id", "created_at"), "experiment_id")
    expired = as_of > F.col("created_at") + F.make_dt_interval(F.lit(max_days))
    ended = F.col("significant") | F.lit(force) | expired
    return listed.select(
        "experiment_id",
        ended.alias("concluded"),
        expired.alias("expired"),
        "significant",
        F.when(ended, F.col("winner")).alias("winner"),
        F.when(ended, recommendation(F.col("significant"), F.col("winner"), F.col("effect_size")))
        .otherwise("Experiment criteria not met for conclusion")
        .alias("recommendation"),
    )


def record_events(events: DataFrame, path: str, partition_by: Sequence[str] = ("experiment_id", "variant")) -> None:
    """Append events; existing files are never rewritten."""
    events.write.mode("append").partitionBy(*partition_by).parquet(path)
