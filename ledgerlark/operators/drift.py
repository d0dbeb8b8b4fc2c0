"""Drift between a reference and a batch: statistics, three tests per feature, target test, verdicts, alerts.

Both sides are turned into one table of distinct values per feature with a count per side. All tests
and statistics read that table, so each side is scanned once however many features there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.rules import pick
from ledgerlark.functions.special import chi2_tail, kolmogorov_tail, normal_two_sided
from ledgerlark.operators.ordered import melt, prefix_sum, quantiles_of_ranked, quantiles_wide
from ledgerlark.operators.profile import bin_of, bin_ranges
from ledgerlark.session import materialise

P_LIMIT = 0.05
PSI_LIMIT = 0.2
PSI_BINS = 10
PSI_FLOOR = 0.0001
HIGH_SCORE = 0.5


def side_counts(reference: DataFrame, batch: DataFrame, features: Sequence[str]) -> DataFrame:
    """`(feature, value, n_ref, n_new)`: both sides stacked with a tag and combined before the shuffle."""
    tagged = melt(reference, features).withColumn("is_ref", F.lit(1)).unionByName(
        melt(batch, features).withColumn("is_ref", F.lit(0))
    )
    return tagged.groupBy("feature", "value").agg(
        F.sum("is_ref").alias("n_ref"), F.sum(1 - F.col("is_ref")).alias("n_new")
    )


def ranked_counts(counts: DataFrame) -> DataFrame:
    """Running counts of both sides in value order, per feature; checkpointed, so several tests can read it."""
    return prefix_sum(counts, ["feature"], ["value"], ["n_ref", "n_new"])


def ecdf_ranks(ranked: DataFrame) -> DataFrame:
    """Empirical distribution of both sides and the mean rank of every tie group."""
    both_before = F.col("n_ref_before") + F.col("n_new_before")
    return ranked.withColumns(
        {
            "ecdf_ref": F.try_divide(F.col("n_ref_before") + F.col("n_ref"), F.col("n_ref_total")),
            "ecdf_new": F.try_divide(F.col("n_new_before") + F.col("n_new"), F.col("n_new_total")),
            "mean_rank": both_before + (F.col("n_ref") + F.col("n_new") + 1) / 2,
        }
    )


def side_stats(ranked: DataFrame) -> DataFrame:
    """Moments and quartiles of both sides from their counts, one row per feature and side.

    Both sides are summed in the same passes. Drift reports use the sample standard deviation for the
    reference and the population one for the new side; both are returned under their own name.
    """
    sides, v = {"ref": "reference", "new": "new"}, F.col("value")
    first = ranked.groupBy("feature").agg(
        *[
            c
            for s in sides
            for c in (
                F.sum(f"n_{s}").alias(f"size_{s}"),
                F.try_divide(F.sum(F.col(f"n_{s}") * v), F.sum(f"n_{s}")).alias(f"mean_{s}"),
                F.min(F.when(F.col(f"n_{s}") > 0, v)).alias(f"min_{s}"),
                F.max(F.when(F.col(f"n_{s}") > 0, v)).alias(f"max_{s}"),
            )
        ]
    )
    # one row per feature
    centred = ranked.join(F.broadcast(first), "feature").withColumns({f"away_{s}": v - F.col(f"mean_{s}") for s in sides})
    wide = centred.groupBy(*first.columns).agg(
        *[
            F.sum(F.col(f"n_{s}") * F.pow(f"away_{s}", F.lit(k))).alias(f"m{k}_{s}")
            for s in sides
            for k in (2, 3, 4)
        ]
    )
    parts = ("size", "mean", "min", "max", "m2", "m3", "m4")
    stacked = wide.select(
        "feature",
        F.explode(
            F.array(*[F.struct(F.lit(s).alias("key"), *[F.col(f"{c}_{s}").alias(c) for c in parts]) for s in sides])
        ).alias("s"),
    ).select("feature", "s.*")
    names = {0.25: "q25", 0.5: "median", 0.75: "q75"}
    quartiles = None
    for s in sides:
        one = quantiles_of_ranked(ranked, ["feature"], list(names), f"n_{s}").withColumn("key", F.lit(s))
        quartiles = one if quartiles is None else quartiles.unionByName(one)
    size, m2 = F.col("size"), F.try_divide(F.col("m2"), F.col("size"))
    return stacked.join(quantiles_wide(quartiles, ["feature", "key"], names), ["feature", "key"]).select(
        pick("key", sides).alias("side"),
        "feature",
        size.alias("n"),
        "mean",
        F.sqrt(F.try_divide(F.col("m2"), size - 1)).alias("std_samp"),
        F.sqrt(m2).alias("std_pop"),
        "min", "max", "median", "q25", "q75",
        F.try_divide(F.col("m3") / size, F.pow(m2, 1.5)).alias("skewness"),
        (F.try_divide(F.col("m4") / size, m2 * m2) - 3).alias("kurtosis"),
    )


def rank_sums(ranked: DataFrame) -> DataFrame:
    """Everything the rank tests need, one row per feature from one pass."""
    gap = F.abs(F.col("ecdf_ref") - F.col("ecdf_new"))
    ties = F.col("n_ref").cast("double") + F.col("n_new")
    return ecdf_ranks(ranked).groupBy("feature").agg(
        F.max(gap).alias("largest_gap"),
        F.sum(F.col("n_ref") * F.col("mean_rank")).alias("rank_sum"),
        F.sum(ties * ties * ties - ties).alias("tie_sum"),
        F.max("n_ref_total").cast("double").alias("n1"),
        F.max("n_new_total").cast("double").alias("n2"),
    )


def ks_test(sums: DataFrame) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov `(feature, statistic, p_value)`, asymptotic p."""
    d, n1, n2 = F.col("largest_gap"), F.col("n1"), F.col("n2")
    return sums.select(
        "feature", d.alias("statistic"), kolmogorov_tail(F.sqrt(F.try_divide(n1 * n2, n1 + n2)) * d).alias("p_value")
    )


def mann_whitney(sums: DataFrame) -> DataFrame:
    """Two-sided Mann-Whitney `(feature, statistic, z, p_value)`; statistic is U of the reference.

    Normal approximation with tie and continuity correction at every size.
    """
    n1, n2 = F.col("n1"), F.col("n2")
    n = n1 + n2
    u = F.col("rank_sum") - n1 * (n1 + 1) / 2
    larger = F.greatest(u, n1 * n2 - u)
    sigma = F.sqrt(n1 * n2 / 12 * (n + 1 - F.try_divide(F.col("tie_sum"), n * (n - 1))))
    z = F.try_divide(larger - n1 * n2 / 2 - 0.5, sigma)
    return sums.select("feature", u.alias("statistic"), z.alias("z")).withColumn(
        "p_value", F.least(F.when(F.col("z") < 0, 1.0).otherwise(normal_two_sided("z")), F.lit(1.0))
    )


def psi(ranked: DataFrame, bins: int = PSI_BINS) -> DataFrame:
    """Population stability index over equal-width bins of the reference range `(feature, statistic)`.

    New values outside the range stay in the denominator only. A bin empty on both sides adds exactly
    0, so bins without rows need no grid.
    """
    ranges = bin_ranges(ranked.where(F.col("n_ref") > 0), ["feature"], bins)
    # one row per feature
    binned = ranked.join(F.broadcast(ranges), "feature").withColumn("bin", bin_of("value", bins))
    per_bin = binned.where(F.col("bin").isNotNull()).groupBy("feature", "bin", "n_ref_total", "n_new_total").agg(
        F.sum("n_ref").alias("r"), F.sum("n_new").alias("q")
    )

    def share(n: str, total: str) -> Column:
        return F.when(F.col(n) == 0, PSI_FLOOR).otherwise(F.try_divide(F.col(n), F.col(total)))

    p, q = share("r", "n_ref_total"), share("q", "n_new_total")
    return per_bin.groupBy("feature").agg(F.sum((q - p) * F.ln(q / p)).alias("statistic"))


def drift_tests(ranked: DataFrame) -> DataFrame:
    """Tidy rows `(feature, test, statistic, p_value, drift_detected)`."""
    # one row per feature, written once and read by both rank tests
    sums, p_flag = materialise(rank_sums(ranked)), F.col("p_value") < P_LIMIT
    ks = ks_test(sums).select("feature", F.lit("ks_test").alias("test"), "statistic", "p_value", p_flag.alias("drift_detected"))
    mw = mann_whitney(sums).select("feature", F.lit("mannwhitney_test").alias("test"), "statistic", "p_value", p_flag.alias("drift_detected"))
    index = psi(ranked).select(
        "feature", F.lit("psi").alias("test"), "statistic", F.lit(None).cast("double").alias("p_value"),
        (F.col("statistic") > PSI_LIMIT).alias("drift_detected"),
    )
    return ks.unionByName(mw).unionByName(index)


def feature_verdicts(tests: DataFrame) -> DataFrame:
    """Votes per feature; drift when at least half of the available tests say so.

    One row per feature, written once since summary, alerts and missing features all read it.
    """
    available = tests.where(F.col("drift_detected").isNotNull())
    votes = available.groupBy("feature").agg(
        F.sum(F.col("drift_detected").cast("int")).alias("votes"), F.count(F.lit(1)).alias("tests")
    )
    return materialise(
        votes.select(
            "feature", "votes", "tests",
            (F.col("votes") >= F.col("tests") / 2).alias("drift_detected"),
            (F.col("votes") / F.col("tests")).alias("drift_score"),
        )
    )


def drift_summary(verdicts: DataFrame, total_features: int) -> DataFrame:
    """One row: features with drift and the mean score."""
    return verdicts.agg(
        F.lit(total_features).cast("long").alias("total_features"),
        F.coalesce(F.sum(F.col("drift_detected").cast("int")), F.lit(0)).alias("features_with_drift"),
        F.coalesce(F.avg("drift_score"), F.lit(0.0)).alias("overall_drift_score"),
    ).withColumn("drift_detected", F.col("features_with_drift") > 0)


def missing_features(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Features of `expected` without rows in `present` (each one row per feature)."""
    return expected.select("feature").join(present.select("feature"), "feature", "left_anti")


def drift_alerts(verdicts: DataFrame, summary: DataFrame, missing: DataFrame) -> DataFrame:
    """Alert rows `(kind, message)`."""
    absent = missing.select(F.lit("missing").alias("kind"), F.concat(F.lit("Missing feature: "), "feature").alias("message"))
    overall = summary.where("drift_detected").select(
        F.lit("drift").alias("kind"), F.format_string("DRIFT ALERT: %d features showing drift", "features_with_drift").alias("message")
    )
    high = summary.where(F.col("overall_drift_score") > HIGH_SCORE).select(
        F.lit("high").alias("kind"), F.format_string("HIGH DRIFT: Overall drift score %.3f", "overall_drift_score").alias("message")
    )
    single = verdicts.where("drift_detected").select(
        F.lit("feature").alias("kind"), F.format_string("Feature '%s' showing significant drift", "feature").alias("message")
    )
    return absent.unionByName(overall).unionByName(high).unionByName(single)


def aligned_categories(reference: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """`(category, n_ref, n_new, p_ref, p_new)`; categories of either side, absent ones 0."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("category")).agg(F.count(F.lit(1)).alias(name))

    both = counted(reference, "n_ref").join(counted(batch, "n_new"), "category", "full").fillna(0, ["n_ref", "n_new"])
    stored = materialise(both)
    sizes = stored.agg(F.sum("n_ref").alias("ref"), F.sum("n_new").alias("new")).first()
    return stored.withColumns(
        {
            "p_ref": F.coalesce(F.try_divide(F.col("n_ref"), F.lit(sizes["ref"])), F.lit(0.0)),
            "p_new": F.coalesce(F.try_divide(F.col("n_new"), F.lit(sizes["new"])), F.lit(0.0)),
        }
    )


def target_chi2(aligned: DataFrame) -> DataFrame:
    """Chi-square of the new counts against the reference shares scaled to the new total.

    A category unseen in the reference makes the statistic infinite and the p-value 0.
    """
    new_total = aligned.agg(F.sum("n_new")).first()[0] or 0
    expected = F.col("p_ref") * F.lit(new_total)
    part = F.when(expected > 0, F.pow(F.col("n_new") - expected, 2) / expected).when(
        F.col("n_new") > 0, F.lit(float("inf"))
    ).otherwise(0.0)
    total = aligned.withColumn("part", part).agg(
        F.sum("part").alias("statistic"), (F.count(F.lit(1)) - 1).cast("double").alias("df")
    )
    return total.withColumn("p_value", chi2_tail("statistic", "df")).withColumn("drift_detected", F.col("p_value") < P_LIMIT)
