"""Ranking, selection and comparison of models; latest and recent rows.

Model tables have one row per model, so their windows are small; windows over data keep only the
first rows per key, which Spark prunes before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.functions.rules import ACCEPTANCE_F1, performance_grade, threshold_met


def composite_score(f1="f1_weighted", accuracy="accuracy", auc="roc_auc") -> Column:
    """Score of the ranking."""
    return 0.5 * F.col(f1) + 0.3 * F.col(accuracy) + 0.2 * F.coalesce(F.col(auc), F.lit(0.0))


def selection_score(f1="f1_weighted", accuracy="accuracy", auc="roc_auc") -> Column:
    """Score of the choice of the best model, which differs from the ranking's."""
    return F.col(f1) + 0.1 * F.col(accuracy) + 0.05 * F.coalesce(F.col(auc), F.lit(0.0))


def _rank(partition: Sequence[str], *order: Column) -> Column:
    by = Window.partitionBy(*partition) if partition else Window.partitionBy(F.lit(0))
    return F.row_number().over(by.orderBy(*order))


def rank_models(metrics: DataFrame, experiment: Sequence[str] = (), threshold: float = ACCEPTANCE_F1) -> DataFrame:
    """Rank by composite score, F1 and accuracy; ties by name."""
    scored = metrics.withColumns(
        {
            "composite_score": composite_score(),
            "threshold_met": threshold_met("f1_weighted", threshold),
            "performance_grade": performance_grade("f1_weighted", threshold),
        }
    )
    return scored.withColumns(
        {
            "rank_composite": _rank(experiment, F.desc("composite_score"), F.asc("model")),
            "rank_f1": _rank(experiment, F.desc("f1_weighted"), F.asc("model")),
            "rank_accuracy": _rank(experiment, F.desc("accuracy"), F.asc("model")),
        }
    )


def best_by(df: DataFrame, partition: Sequence[str], *order: Column) -> DataFrame:
    """First row per partition in the given total order."""
    return df.withColumn("__rn", _rank(partition, *order)).where("__rn = 1").drop("__rn")


def best_model(metrics: DataFrame, experiment: Sequence[str] = ()) -> DataFrame:
    scored = metrics.withColumn("selection_score", selection_score())
    return best_by(scored, experiment, F.desc("selection_score"), F.asc("model"))


def test_places(metrics: DataFrame) -> DataFrame:
    """Add `test_place`: 1 for the best F1, 2 for the first other model by name, else 0."""
    ranked = metrics.withColumn("__f1", _rank((), F.desc("f1_weighted"), F.asc("model")))
    order = _rank((), (F.col("__f1") != 1).asc(), F.asc("model"))
    return ranked.withColumn("__place", order).withColumn(
        "test_place", F.when(F.col("__place") <= 2, F.col("__place")).otherwise(0)
    ).drop("__f1", "__place")


def summarise_models(metrics: DataFrame, experiment: Sequence[str] = (), threshold: float = ACCEPTANCE_F1) -> DataFrame:
    """Number of models, share above the threshold, and the spread of F1 and accuracy."""
    above = F.sum(threshold_met("f1_weighted", threshold).cast("int"))
    spread = []
    for column, name in (("f1_weighted", "f1"), ("accuracy", "accuracy")):
        spread += [
            F.avg(column).alias(f"{name}_mean"),
            F.stddev_pop(column).alias(f"{name}_std"),
            F.min(column).alias(f"{name}_min"),
            F.max(column).alias(f"{name}_max"),
            F.median(column).alias(f"{name}_median"),
        ]
    return metrics.groupBy(*experiment).agg(
        F.count(F.lit(1)).alias("total_models"),
        above.alias("models_above_threshold"),
        F.coalesce(F.try_divide(above, F.count(F.lit(1))), F.lit(0.0)).alias("threshold_success_rate"),
        *spread,
    )


def metric_difference(run_metrics: DataFrame, first: str, second: str, version: str = "version") -> DataFrame:
    """`(model, metric, v1_value, v2_value, difference, improvement)` for metrics both versions have."""
    left = run_metrics.where(F.col(version) == first).select("model", "metric", F.col("value").alias("v1_value"))
    right = run_metrics.where(F.col(version) == second).select("model", "metric", F.col("value").alias("v2_value"))
    change = F.col("v2_value") - F.col("v1_value")
    return left.join(right, ["model", "metric"]).withColumns({"difference": change, "improvement": change > 0})


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key as a struct maximum: combined before the shuffle, safe for a hot key."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("r"))
    return newest.select(*keys, *[F.col(f"r.{c}").alias(c) for c in df.columns if c not in keys])


def recent(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows per key with their place; the row-number limit is applied before the shuffle too."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("place", place).where(F.col("place") <= n)
