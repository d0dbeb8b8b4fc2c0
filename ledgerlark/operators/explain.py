"""Feature attribution and the reports built on it.

Attributions are kept long, `(row_id, class, feature, shap_value, feature_value)`, so every report is
a grouping by feature, by row or by class.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.functions.hashing import hash_number
from ledgerlark.operators.explore import high_correlation_pairs
from ledgerlark.operators.ordered import quantiles_of_counts, quantiles_wide, small_side, value_counts
from ledgerlark.session import materialise

TOP_FEATURES = 10
HIGH_CONFIDENCE = 0.8
INTERACTION_LIMIT = 0.3


def column_means(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    return df.agg(*[F.avg(F.col(f).cast("double")).alias(f) for f in features]).first().asDict()


def linear_attribution(
    df: DataFrame, row_id: str, coefficients: Mapping[str, Mapping[str, float]], means: Mapping[str, float]
) -> DataFrame:
    """Exact attribution of a linear model, coef * (x - mean): one row per row, class and feature.

    Coefficients and means are a few numbers, so this is one narrow projection and an explode.
    """
    cells = [
        F.struct(
            F.lit(c).alias("class"),
            F.lit(f).alias("feature"),
            (F.lit(float(w)) * (F.col(f).cast("double") - F.lit(means[f]))).alias("shap_value"),
            F.col(f).cast("double").alias("feature_value"),
        )
        for c, weights in coefficients.items()
        for f, w in weights.items()
    ]
    return df.select(F.col(row_id).alias("row_id"), F.explode(F.array(*cells)).alias("s")).select("row_id", "s.*")


def with_linear_scores(
    df: DataFrame, coefficients: Mapping[str, Mapping[str, float]], intercepts: Mapping[str, float]
) -> DataFrame:
    """Add `class_index` (1-based) and `probability` of a multinomial linear model.

    Margins and exponentials are columns of their own steps, so no later expression repeats their sums.
    """
    classes = list(coefficients)
    margins, powers = [f"__m{i}" for i in range(len(classes))], [f"__e{i}" for i in range(len(classes))]

    def margin(c: str) -> Column:
        return sum((F.lit(float(w)) * F.col(f).cast("double") for f, w in coefficients[c].items()), F.lit(float(intercepts[c])))

    scored = df.withColumns({m: margin(c) for m, c in zip(margins, classes)}).withColumn("__top", F.greatest(*margins))
    raised = scored.withColumns({e: F.exp(F.col(m) - F.col("__top")) for e, m in zip(powers, margins)})
    total = raised.withColumn("__sum", sum((F.col(e) for e in powers[1:]), F.col(powers[0])))
    index = None
    for i, m in enumerate(margins):
        hit = F.col(m) == F.col("__top")
        index = F.when(hit, i + 1) if index is None else index.when(hit, i + 1)
    return total.withColumns(
        {"class_index": index, "probability": F.array(*[F.col(e) / F.col("__sum") for e in powers])}
    ).drop(*margins, *powers, "__top", "__sum")


def importance(shap: DataFrame) -> DataFrame:
    """Mean |shap| per feature over rows and classes."""
    return shap.groupBy("feature").agg(F.avg(F.abs("shap_value")).alias("importance"))


def top_importance(shap: DataFrame, n: int = 20) -> DataFrame:
    return importance(shap).orderBy(F.desc("importance"), "feature").limit(n)


def feature_profile(shap: DataFrame) -> DataFrame:
    """Per feature: importance, mean, spread, sign share, consistency, 5th and 95th percentile, outlier share.

    Everything is read from value counts per feature, written once: one scan, hot values combined before
    the shuffle.
    """
    counts = materialise(value_counts(shap.select("feature", F.col("shap_value").alias("value")), ["feature"]))
    v, n = F.col("value"), F.col("n")
    size = F.sum(n)
    first = counts.groupBy("feature").agg(
        (F.sum(n * F.abs(v)) / size).alias("importance"),
        (F.sum(n * v) / size).alias("mean_shap"),
        (F.sum(F.when(v > 0, n).otherwise(0)) / size).alias("positive_impact_ratio"),
    )
    by = ["feature", "importance", "mean_shap", "positive_impact_ratio"]
    spread = counts.join(small_side(first), "feature").groupBy(*by).agg(
        F.sqrt(F.sum(n * F.pow(v - F.col("mean_shap"), 2)) / size).alias("std_shap")
    )
    outside = counts.join(small_side(spread), "feature").groupBy(*by, "std_shap").agg(
        (F.sum(F.when(F.abs(v) > 2 * F.col("std_shap"), n).otherwise(0)) / size).alias("outlier_impact")
    )
    names = {0.95: "percentile_95", 0.05: "percentile_5"}
    tails = quantiles_wide(quantiles_of_counts(counts, ["feature"], list(names)), ["feature"], names)
    consistency = 1 - F.col("std_shap") / (F.abs("mean_shap") + 1e-8)
    return outside.join(tails, "feature").withColumn("impact_consistency", consistency).select(
        "feature", "importance", "mean_shap", "std_shap", "positive_impact_ratio", "impact_consistency",
        "percentile_95", "percentile_5", "outlier_impact",
    )


def feature_interactions(shap: DataFrame, features: Sequence[str], limit: float = INTERACTION_LIMIT) -> DataFrame:
    """Pairs whose attributions are correlated beyond the limit, from one row per data row."""
    wide = shap.groupBy("row_id").agg(*[F.max(F.when(F.col("feature") == f, F.col("shap_value"))).alias(f) for f in features])
    return high_correlation_pairs(wide, features, limit)


def risk_factors(shap: DataFrame, limit: float = -0.1) -> DataFrame:
    """Features that lower the score on average, with the share of rows they lower."""
    per = shap.groupBy("feature").agg(
        F.avg("shap_value").alias("average_impact"), F.avg((F.col("shap_value") < 0).cast("int")).alias("frequency")
    )
    return per.where(F.col("average_impact") < limit)


def model_behaviour(shap: DataFrame) -> DataFrame:
    """One row: mean spread of features; and the distribution of row totals."""
    stability = shap.groupBy("feature").agg(F.stddev_pop("shap_value").alias("std")).agg(F.avg("std")).first()[0]
    totals = shap.groupBy("row_id").agg(F.sum("shap_value").alias("total"))
    spread = totals.agg(F.stddev_pop("total")).first()[0] or 0.0
    return totals.agg(
        F.lit(stability).alias("prediction_stability"),
        F.avg((F.abs("total") > F.lit(spread)).cast("int")).alias("high_confidence_predictions"),
        F.avg("total").alias("mean"),
        F.stddev_pop("total").alias("std"),
        F.coalesce(F.skewness("total"), F.lit(0.0)).alias("skewness"),
    )


# Rule name -> (condition on the profile, how many features are listed (None: all), needed count).
def insight_rules() -> dict[str, tuple[Column, int | None, int]]:
    importance_, consistency = F.col("importance"), F.col("impact_consistency")
    positive, spread = F.col("positive_impact_ratio"), F.col("std_shap")
    strong = importance_ > 0.05
    return {
        "inconsistent_high_impact": ((F.col("importance_rank") <= 10) & (consistency < 0.3), 3, 1),
        "low_importance": (importance_ < 0.01, None, 6),
        "outlier_impact": ((F.col("outlier_impact") > 0.1) & strong, 3, 1),
        "interaction_candidates": ((positive > 0.8) & strong, 2, 1),
        "binning_candidates": ((positive > 0.3) & (positive < 0.7) & strong, 2, 1),
        "scaling_candidates": ((spread > 0.2) & strong, 3, 1),
        "top_drivers": (F.col("importance_rank") <= 3, 3, 1),
        "beneficial_factors": ((positive > 0.7) & strong, 3, 1),
        "inconsistent_features": ((consistency < 0.5) & strong, 2, 1),
        "risk_factors": ((F.col("mean_shap") < -0.1) & strong, 2, 1),
    }


def insights(profile: DataFrame) -> DataFrame:
    """Tidy rows `(rule, place, feature)`, most important first; rules with too few features are silent.

    The profile has one row per feature, so the windows here are small.
    """
    ranked = profile.withColumn(
        "importance_rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("importance"), "feature"))
    )
    hits = F.array(
        *[
            F.when(condition, F.struct(F.lit(name).alias("rule"), F.lit(keep).cast("int").alias("keep"), F.lit(need).alias("need")))
            for name, (condition, keep, need) in insight_rules().items()
        ]
    )
    rows = ranked.select("feature", "importance_rank", F.explode(F.filter(hits, lambda h: h.isNotNull())).alias("h")).select(
        "feature", "importance_rank", "h.*"
    )
    by_rule = Window.partitionBy("rule")
    return (
        rows.withColumns({"place": F.row_number().over(by_rule.orderBy("importance_rank")), "found": F.count(F.lit(1)).over(by_rule)})
        .where((F.col("keep").isNull() | (F.col("place") <= F.col("keep"))) & (F.col("found") >= F.col("need")))
        .select("rule", "place", "feature")
    )


def top_features(shap: DataFrame, n: int = TOP_FEATURES) -> DataFrame:
    """Per row and class the n strongest features `(row_id, class, place, feature, shap_value, feature_value, impact)`."""
    order = Window.partitionBy("row_id", "class").orderBy(F.desc(F.abs("shap_value")), "feature")
    placed = shap.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)
    return placed.withColumn("impact", F.when(F.col("shap_value") > 0, "positive").otherwise("negative"))


def class_drivers(top: DataFrame, predicted: DataFrame, per_row: int = 3, n: int = 5) -> DataFrame:
    """Features that are among the strongest of rows predicted as a class, by direction and how often.

    `predicted` is `(row_id, class)`; only the predicted class's attributions count.
    """
    strongest = top.where(F.col("place") <= per_row).join(predicted, ["row_id", "class"])
    counted = strongest.groupBy("class", "impact", "feature").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("class", "impact").orderBy(F.desc("n"), "feature")
    return counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def confidence_summary(probabilities: DataFrame, column: str = "probability") -> DataFrame:
    """Mean and spread of the largest probability, and how many are above the limit (strictly)."""
    top = F.array_max(column)
    return probabilities.agg(
        F.avg(top).alias("average_confidence"),
        F.stddev_pop(top).alias("confidence_std"),
        F.sum((top > HIGH_CONFIDENCE).cast("int")).alias("high_confidence_predictions"),
        F.count(F.lit(1)).alias("n"),
    )


def explanation_documents(top: DataFrame, predicted: DataFrame) -> DataFrame:
    """One document per row: predicted class, probabilities and its strongest features in order."""
    entry = F.struct("place", "feature", "shap_value", "feature_value", "impact")
    listed = top.join(predicted.select("row_id", "class", "probabilities"), ["row_id", "class"])
    return listed.groupBy("row_id", "class", "probabilities").agg(F.array_sort(F.collect_list(entry)).alias("top_features"))


def sampled_shapley(
    df: DataFrame, row_id: str, features: Sequence[str], model: Model, baseline: Mapping[str, float], permutations: int = 4,
    seed: int = 42, class_index: int = 0,
) -> DataFrame:
    """Attribution for any model with probabilities, by feature orders drawn per row.

    Each row and order becomes a path from the baseline to the row, one feature switched on per step;
    every step is scored in one `model.transform`, and a feature's value is the mean change over orders.
    Along a path the changes add up to f(x) - f(baseline), so their sum is exact at any number of orders.
    """
    names = list(features)
    base = F.array(*[F.lit(float(baseline[f])) for f in names])
    rows = df.select(F.col(row_id).cast("string").alias("row_id"), F.array(*[F.col(f).cast("double") for f in names]).alias("x"))
    paths = rows.select("row_id", "x", F.explode(F.sequence(F.lit(1), F.lit(permutations))).alias("draw"))
    keyed = F.array_sort(
        F.array(
            *[
                F.struct(hash_number(F.lit(str(seed)), "row_id", F.col("draw").cast("string"), F.lit(f)).alias("h"), F.lit(i).alias("i"))
                for i, f in enumerate(names)
            ]
        )
    )
    ordered = paths.withColumn("order", F.transform(keyed, lambda s: s["i"]))
    steps = ordered.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(names)))).alias("step"))
    on = F.slice("order", F.lit(1), F.col("step"))
    mixed = F.transform("x", lambda v, i: F.when(F.array_contains(on, i), v).otherwise(F.element_at(base, i + 1)))
    points = steps.withColumn("mix", mixed).select("row_id", "draw", "step", "order", *[F.col("mix")[i].alias(f) for i, f in enumerate(names)])
    scored = model.transform(points)
    value = vector_to_array("probability")[class_index]
    # f(step) counts for the feature switched on last and against the one switched on next; all rows of
    # an account come out of one task, so they are summed there before the shuffle
    last, following = F.try_element_at("order", F.col("step")), F.try_element_at("order", F.col("step") + 1)
    signed = F.array(
        F.when(F.col("step") > 0, F.struct(last.alias("i"), F.col("f").alias("part"))),
        F.when(F.col("step") < len(names), F.struct(following.alias("i"), (-F.col("f")).alias("part"))),
    )
    parts = scored.select("row_id", "step", "order", value.alias("f")).select("row_id", F.explode(signed).alias("s"))
    return (
        parts.where(F.col("s").isNotNull())
        .groupBy("row_id", F.element_at(F.array(*[F.lit(f) for f in names]), F.col("s.i") + 1).alias("feature"))
        .agg((F.sum("s.part") / permutations).alias("shap_value"))
    )


def linear_explanations(
    df: DataFrame, row_id: str, coefficients: Mapping[str, Mapping[str, float]], intercepts: Mapping[str, float],
    means: Mapping[str, float], n: int = TOP_FEATURES,
) -> DataFrame:
    """The explanation document of every row of a linear model, in one narrow projection.

    `(row_id, class, probability, probabilities map, top_features array)`: the n strongest attributions
    of the predicted class, strongest first, ties by name.
    """
    classes = list(coefficients)
    names = F.array(*[F.lit(c) for c in classes])
    scored = with_linear_scores(df, coefficients, intercepts)
    cells = F.array(
        *[
            F.struct(
                F.lit(f).alias("feature"),
                (
                    F.element_at(F.array(*[F.lit(float(coefficients[c][f])) for c in classes]), F.col("class_index"))
                    * (F.col(f).cast("double") - F.lit(means[f]))
                ).alias("value"),
                F.col(f).cast("double").alias("feature_value"),
            )
            for f in coefficients[classes[0]]
        ]
    )
    by_strength = F.array_sort(
        F.transform(cells, lambda e: F.struct((-F.abs(e["value"])).alias("order"), e["feature"].alias("feature"), e.alias("e")))
    )
    top = F.transform(
        F.slice(by_strength, 1, n),
        lambda s: F.struct(
            s["feature"].alias("feature"), s["e"]["value"].alias("shap_value"), s["e"]["feature_value"].alias("feature_value"),
            F.when(s["e"]["value"] > 0, "positive").otherwise("negative").alias("impact"),
        ),
    )
    return scored.select(
        F.col(row_id).alias("row_id"), F.element_at(names, F.col("class_index")).alias("class"), "probability",
        F.map_from_arrays(names, F.col("probability")).alias("probabilities"), top.alias("top_features"),
    )


def drivers_of_documents(documents: DataFrame, per_row: int = 3, n: int = 5) -> DataFrame:
    """`class_drivers` straight from explanation documents: only counts per class and feature are shuffled."""
    strongest = documents.select("class", F.explode(F.slice("top_features", 1, per_row)).alias("t"))
    counted = strongest.groupBy("class", "t.impact", "t.feature").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("class", "impact").orderBy(F.desc("n"), "feature")  # one row per feature
    return counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)
