"""Exploration: shares, group rates, cross tabs, correlations, best groups."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.ordered import present
from ledgerlark.session import materialise


def value_counts_share(df: DataFrame, column: str, digits: int = 6) -> DataFrame:
    """`(column, n, share)`. The grouped table is written once; only its total comes to the driver."""
    counts = materialise(df.groupBy(column).agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.select(column, "n", F.round(F.try_divide(F.col("n"), F.lit(total)), digits).alias("share"))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts, absent combinations 0. The list of values is given, so no extra job finds it."""
    return df.groupBy(row).pivot(column, list(values)).agg(F.count(F.lit(1))).fillna(0)


def crosstab_pct(df: DataFrame, row: str, column: str, values: Sequence[str], digits: int = 4) -> DataFrame:
    counts = crosstab(df, row, column, values)
    total = sum((F.col(v) for v in values[1:]), F.col(values[0]))
    return counts.select(row, *[F.round(100.0 * F.col(v) / total, digits).alias(v) for v in values])


def rate(condition: Column) -> Column:
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def group_rates(df: DataFrame, group: str, condition: Column) -> DataFrame:
    return df.groupBy(group).agg(rate(condition).alias("rate"), F.count(F.lit(1)).alias("n"))


def best_group(rates: DataFrame, group: str) -> DataFrame:
    """Highest rate, ties to the alphabetically first group: a top-1 over one row per group."""
    return rates.orderBy(F.desc("rate"), F.asc(group)).limit(1)


def correlation_pairs(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson r of every unordered column pair `(feature_1, feature_2, r)` from one pass of sums.

    Rows missing either value are left out pair by pair; a constant column gives NULL instead of an
    error. One aggregate per pair suits tables up to some dozens of columns.
    """
    aggregates = []
    for a, b in combinations(columns, 2):
        both = present(F.col(a).cast("double")) & present(F.col(b).cast("double"))
        x, y = F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double"))
        spread = F.stddev_pop(x) * F.stddev_pop(y)
        aggregates.append(F.try_divide(F.covar_pop(x, y), spread).alias(f"{a}|{b}"))
    wide = df.agg(*aggregates)
    named = [f"{a}|{b}" for a, b in combinations(columns, 2)]
    return wide.unpivot([], named, "pair", "r").select(
        F.split_part("pair", F.lit("|"), F.lit(1)).alias("feature_1"),
        F.split_part("pair", F.lit("|"), F.lit(2)).alias("feature_2"),
        F.round("r", digits).alias("r"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Long symmetric matrix with its diagonal."""
    half = correlation_pairs(df, columns, digits)
    mirrored = half.select(F.col("feature_2").alias("feature_1"), F.col("feature_1").alias("feature_2"), "r")
    variances = df.agg(*[F.var_pop(F.when(present(F.col(c).cast("double")), F.col(c).cast("double"))).alias(c) for c in columns])
    diagonal = variances.unpivot([], list(columns), "feature_1", "v").select(
        "feature_1", F.col("feature_1").alias("feature_2"), F.when(F.col("v") > 0, 1.0).alias("r")
    )
    return half.unionByName(mirrored).unionByName(diagonal)


def high_correlation_pairs(df: DataFrame, columns: Sequence[str], limit: float, digits: int = 6) -> DataFrame:
    return correlation_pairs(df, columns, digits).where(F.abs("r") > limit)
