"""Classification metrics over `(keys..., label, prediction, probability array)`; classes are 0..k-1."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.ordered import prefix_sum, quantiles_of_counts, quantiles_wide, value_counts

HIGH_CONFIDENCE = 0.8
CALIBRATION_BINS = 10


def _zero_if_undefined(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def confusion(df: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """`(keys..., label, prediction, n)`; the only pass over the predictions that the reports below need."""
    return df.groupBy(*keys, "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def class_report(confused: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Precision, recall, F1 and support per class, from a confusion table."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), none.alias("predicted"), hit.alias("hits")),
        F.struct(F.col("prediction").alias("class"), none.alias("support"), F.col("n").alias("predicted"), none.alias("hits")),
    )
    totals = (
        confused.select(*keys, F.explode(sides).alias("s"))
        .groupBy(*keys, F.col("s.class").cast("int").alias("class"))
        .agg(F.sum("s.support").alias("support"), F.sum("s.predicted").alias("predicted"), F.sum("s.hits").alias("hits"))
    )
    p, r = F.col("precision"), F.col("recall")
    return (
        totals.withColumns(
            {"precision": _zero_if_undefined(F.col("hits"), F.col("predicted")), "recall": _zero_if_undefined(F.col("hits"), F.col("support"))}
        )
        .withColumn("f1", _zero_if_undefined(2 * p * r, p + r))
        .select(*keys, "class", "precision", "recall", "f1", "support", "hits")
    )


def averages(report: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Accuracy and the macro and weighted means over classes, from a class report."""

    def weighted(c: str) -> Column:
        return _zero_if_undefined(F.sum(F.col(c) * F.col("support")), F.sum("support"))

    return report.groupBy(*keys).agg(
        _zero_if_undefined(F.sum("hits"), F.sum("support")).alias("accuracy"),
        weighted("f1").alias("f1_weighted"),
        F.avg("f1").alias("f1_macro"),
        weighted("precision").alias("precision_weighted"),
        F.avg("precision").alias("precision_macro"),
        weighted("recall").alias("recall_weighted"),
        F.avg("recall").alias("recall_macro"),
        F.sum("support").alias("n"),
    )


def class_scores(df: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """One row per prediction and class `(keys..., class, score, positive)`."""
    return df.select(*keys, "label", F.posexplode("probability").alias("class", "score")).select(
        *keys, "class", "score", (F.col("label") == F.col("class")).cast("int").alias("positive")
    )


def roc_auc_by_class(df: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """One-vs-rest AUC per class by the rank formula; ties share their mean rank.

    Scores are counted per distinct value first; ranks come from the block-wise prefix sum.
    """
    by = [*keys, "class"]
    counts = class_scores(df, keys).groupBy(*by, "score").agg(
        F.count(F.lit(1)).alias("n"), F.sum("positive").alias("n_positive")
    )
    ranked = prefix_sum(counts, by, ["score"], ["n"])
    rank = F.col("n_before") + (F.col("n") + 1) / 2
    sums = ranked.groupBy(*by).agg(
        F.sum(F.col("n_positive") * rank).alias("rank_sum"), F.sum("n_positive").alias("support"), F.sum("n").alias("n")
    )
    pos, neg = F.col("support").cast("double"), (F.col("n") - F.col("support")).cast("double")
    auc = F.try_divide(F.col("rank_sum") - pos * (pos + 1) / 2, pos * neg)
    return sums.select(*by, auc.alias("roc_auc"), "support")


def roc_auc_weighted(by_class: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Mean AUC weighted by prevalence; classes without both sides are left out."""
    defined = by_class.where(F.col("roc_auc").isNotNull())
    mean = F.try_divide(F.sum(F.col("roc_auc") * F.col("support")), F.sum("support"))
    return defined.groupBy(*keys).agg(mean.alias("roc_auc"))


def model_metrics(df: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Averages and AUC side by side; one row per model."""
    labelled = averages(class_report(confusion(df, keys), keys), keys)
    return labelled.join(roc_auc_weighted(roc_auc_by_class(df, keys), keys), list(keys), "left")


def brier(df: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Mean squared error of the probability per class; classes never or always seen are left out."""
    error = F.pow(F.col("score") - F.col("positive"), 2)
    seen = class_scores(df, keys).groupBy(*keys, "class").agg(
        F.avg(error).alias("brier"), F.avg("positive").alias("share")
    )
    return seen.where((F.col("share") > 0) & (F.col("share") < 1)).select(*keys, "class", "brier")


def calibration(df: DataFrame, keys: Sequence[str] = ("model",), bins: int = CALIBRATION_BINS) -> DataFrame:
    """Mean prediction and share of positives per uniform bin; bins without rows do not appear."""
    at = sum((F.col("score") > F.lit(i * (1.0 / bins))).cast("int") for i in range(1, bins))
    return class_scores(df, keys).groupBy(*keys, "class", at.alias("bin")).agg(
        F.avg("score").alias("mean_predicted"), F.avg("positive").alias("fraction_positive"), F.count(F.lit(1)).alias("n")
    )


def confidence_profile(df: DataFrame, keys: Sequence[str] = ("model",), limit: float = HIGH_CONFIDENCE) -> DataFrame:
    """Distribution of the largest probability, split by correctness, and its high slice."""
    scored = df.select(
        *keys, F.array_max("probability").alias("value"), (F.col("label") == F.col("prediction")).alias("correct")
    )
    c, right = F.col("value"), F.col("correct")
    high = c >= limit
    basic = scored.groupBy(*keys).agg(
        F.avg(c).alias("mean"), F.stddev_pop(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"),
        F.avg(F.when(right, c)).alias("correct_mean"),
        F.avg(F.when(~right, c)).alias("incorrect_mean"),
        (100 * F.avg(high.cast("int"))).alias("high_pct"),
        F.coalesce(F.avg(F.when(high, right.cast("int"))), F.lit(0.0)).alias("high_accuracy"),
        F.sum(high.cast("int")).alias("high_count"),
    )
    names = {0.25: "q25", 0.5: "median", 0.75: "q75"}
    wide = quantiles_wide(quantiles_of_counts(value_counts(scored, keys), keys, list(names)), keys, names)
    return basic.join(wide, list(keys)).select(
        *keys, "mean", "std", "min", "max", "median", "q25", "q75",
        F.coalesce("correct_mean", F.lit(0.0)).alias("correct_mean"),
        F.coalesce("incorrect_mean", F.lit(0.0)).alias("incorrect_mean"),
        F.coalesce(F.col("correct_mean") - F.col("incorrect_mean"), F.lit(0.0)).alias("separation"),
        "high_pct", "high_accuracy", "high_count",
    )


def metrics_long(metrics: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Wide metrics to `(keys..., metric, value)`."""
    return metrics.select(*keys, *[F.col(n).cast("double").alias(n) for n in names]).unpivot(list(keys), list(names), "metric", "value")
