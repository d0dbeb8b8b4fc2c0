"""Data quality: missing values, duplicates, cardinality, outliers, score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, LongType, NumericType

from ledgerlark.operators.ordered import melt, quantiles, quantiles_wide, same_keys, small_side, value_counts

FLAG_LIMIT_PCT = 5.0
NUMERIC_RATIO = 0.05


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def _missing(df: DataFrame, name: str) -> Column:
    field = df.schema[name]
    null = F.col(name).isNull()
    return null | F.isnan(name) if isinstance(field.dataType, (DoubleType, FloatType)) else null


def missing_profile(df: DataFrame) -> DataFrame:
    """`(column, missing_count, missing_pct)` from one aggregate; no value is shuffled."""
    total = F.col("__rows")
    counted = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.sum(_missing(df, c).cast("long")).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(c, F.lit(0)).alias("missing_count")) for c in df.columns])
    return counted.select("__rows", F.inline(rows)).select(
        "column", "missing_count", F.round(100.0 * F.try_divide(F.col("missing_count"), total), 6).alias("missing_pct")
    )


def column_profile(df: DataFrame, rsd: float | None = None) -> DataFrame:
    """`(column, dtype, missing_count, missing_pct, unique_values, cardinality_ratio)`.

    One scan: every cell becomes `(column, text)`, counted before the shuffle, so a value that fills
    a third of a column travels as one row per task. With `rsd`, distinct values are estimated within
    that relative error by mergeable sketches instead, and no value is shuffled at all.
    """
    names = df.columns
    cells = df.select(*[F.when(~_missing(df, c), F.col(c).cast("string")).alias(c) for c in names])
    long = cells.unpivot([], names, "column", "value")
    if rsd is None:
        counted = value_counts(long, ["column"])
        distinct = F.count("value")
    else:
        counted = long.withColumn("n", F.lit(1).cast("long"))
        distinct = F.approx_count_distinct("value", rsd)
    summary = counted.groupBy("column").agg(
        F.sum("n").alias("total"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing_count"),
        distinct.alias("unique_values"),
    )
    types = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    return summary.select(
        "column",
        types[F.col("column")].alias("dtype"),
        "missing_count",
        F.round(100.0 * F.col("missing_count") / F.col("total"), 6).alias("missing_pct"),
        "unique_values",
        F.round(F.col("unique_values") / F.col("total"), 6).alias("cardinality_ratio"),
    )


def duplicate_profile(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row (missing values equal); copies are combined before the shuffle."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    totals = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("total_duplicates"),
    )
    pct = F.coalesce(F.try_divide(100.0 * F.col("total_duplicates"), F.col("total_rows")), F.lit(0.0))
    return totals.select("total_rows", "total_duplicates", F.round(pct, 6).alias("duplicate_pct"))


def iqr_bounds(df: DataFrame, columns: Sequence[str], threshold: float = 1.5, accuracy: int | None = None) -> DataFrame:
    """`(feature, q25, q75, lower, upper)`."""
    wide = quantiles_wide(quantiles(df, columns, [0.25, 0.75], accuracy=accuracy), ["feature"], {0.25: "q25", 0.75: "q75"})
    spread = F.col("q75") - F.col("q25")
    return wide.select(
        "feature", "q25", "q75",
        (F.col("q25") - threshold * spread).alias("lower"),
        (F.col("q75") + threshold * spread).alias("upper"),
    )


def iqr_outliers(df: DataFrame, columns: Sequence[str], threshold: float = 1.5) -> DataFrame:
    """`(feature, lower, upper, outlier_count, outlier_pct)`; strictly outside, share of all rows.

    Exact quartiles and then one more pass that counts; no value is shuffled.
    """
    bounds = iqr_bounds(df, columns, threshold).select("feature", "lower", "upper")
    outside = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    # the broadcast side has one row per column of the table
    found = melt(df, columns, drop_missing=False).join(F.broadcast(bounds), "feature").groupBy("feature", "lower", "upper").agg(
        F.sum(F.when(outside, 1).otherwise(0)).alias("outlier_count"), F.count(F.lit(1)).alias("rows")
    )
    return found.select(
        "feature",
        F.round("lower", 6).alias("lower"),
        F.round("upper", 6).alias("upper"),
        "outlier_count",
        F.round(100.0 * F.col("outlier_count") / F.col("rows"), 6).alias("outlier_pct"),
    )


def quality_score(columns: DataFrame, duplicates: DataFrame, outliers: DataFrame) -> DataFrame:
    """0..100 from the three reports (each one row per column, or one row)."""
    stacked = duplicates.unionByName(columns.select("missing_pct"), allowMissingColumns=True).unionByName(
        outliers.select("outlier_pct"), allowMissingColumns=True
    )
    report = stacked.agg(
        *[F.max(c).alias(c) for c in ("total_rows", "total_duplicates", "duplicate_pct")],
        F.avg("missing_pct").alias("avg_missing_pct"),
        F.avg("outlier_pct").alias("avg_outlier_pct"),
    )
    score = (
        F.lit(100.0)
        - F.least(F.coalesce("avg_missing_pct", F.lit(0.0)) * 2, F.lit(30.0))
        - F.least(F.col("duplicate_pct") * 3, F.lit(20.0))
        - F.least(F.coalesce("avg_outlier_pct", F.lit(0.0)) * 0.5, F.lit(15.0))
    )
    return report.select(
        "total_rows", "total_duplicates", "duplicate_pct",
        F.round("avg_missing_pct", 4).alias("avg_missing_pct"),
        F.round("avg_outlier_pct", 4).alias("avg_outlier_pct"),
        F.round(F.greatest(score, F.lit(0.0)), 4).alias("quality_score"),
    )


def quality_flags(columns: DataFrame, outliers: DataFrame, limit_pct: float = FLAG_LIMIT_PCT) -> DataFrame:
    """`(issue, column, pct)` above the limit, worst first."""
    missing = columns.select(F.lit("missing").alias("issue"), "column", F.col("missing_pct").alias("pct"))
    extreme = outliers.select(F.lit("outliers").alias("issue"), F.col("feature").alias("column"), F.col("outlier_pct").alias("pct"))
    return missing.unionByName(extreme).where(F.col("pct") > limit_pct).orderBy("issue", F.desc("pct"), "column")


def feature_types(df: DataFrame, exclude: Sequence[str] = (), ratio: float = NUMERIC_RATIO) -> DataFrame:
    """`(column, feature_type)`: numeric only if long or double and more than `ratio` distinct."""
    used = [c for c in df.columns if c not in exclude]
    wide = [f.name for f in df.schema.fields if f.name in used and isinstance(f.dataType, (LongType, DoubleType))]
    profile = column_profile(df.select(*used))
    numeric = F.col("column").isin(wide) & (F.col("cardinality_ratio") > ratio)
    return profile.select("column", F.when(numeric, "numeric").otherwise("categorical").alias("feature_type"))


def describe_by_group(df: DataFrame, columns: Sequence[str], by: str, digits: int = 4) -> DataFrame:
    """count, mean, std (ddof 1), min, quartiles and max of each column per group.

    A missing key is a group of its own; a group without any value has count 0.
    """
    long = melt(df, columns, [by], drop_missing=False)
    basic = long.groupBy(by, "feature").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    names = {0.25: "q25", 0.5: "median", 0.75: "q75"}
    wide = quantiles_wide(quantiles(df, columns, list(names), by=[by]), [by, "feature"], names)
    rounded = ["mean", "std", "min", "q25", "median", "q75", "max"]
    return basic.join(wide, same_keys(basic, wide, [by, "feature"]), "left").select(
        basic[by], basic["feature"], "count", *[F.round(c, digits).alias(c) for c in rounded]
    )


def boxplot_stats(df: DataFrame, column: str, by: str, digits: int = 4) -> DataFrame:
    """Quartiles and the outermost values within 1.5 IQR per group, plus the number outside.

    A missing key is a group of its own; a group without any value has no quartiles and nothing outside.
    """
    values = melt(df, [column], [by], drop_missing=False)
    names = {0.25: "q25", 0.5: "median", 0.75: "q75"}
    wide = small_side(quantiles_wide(quantiles(df, [column], list(names), by=[by]), [by], names))
    spread = F.col("q75") - F.col("q25")
    inside = (F.col("value") >= F.col("q25") - 1.5 * spread) & (F.col("value") <= F.col("q75") + 1.5 * spread)
    return (
        values.join(wide.withColumnRenamed(by, "__by"), F.col(by).eqNullSafe(F.col("__by")), "left")
        .groupBy(by, *names.values())
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(inside | F.col("value").isNull(), 0).otherwise(1)).alias("n_outside"),
        )
        .select(by, *[F.round(c, digits).alias(c) for c in [*names.values(), "whisker_low", "whisker_high"]], "n_outside")
    )


def bin_ranges(values: DataFrame, keys: Sequence[str], bins: int, value: str = "value") -> DataFrame:
    """`(keys..., start, stop, width)` of equal-width bins per key; a constant range is widened by 0.5 each way.

    Edges are worked out here, once per key, so that the per-row expression of `bin_of` stays small.
    """
    low, high = F.col("low"), F.col("high")
    ranges = values.groupBy(*keys).agg(F.min(value).alias("low"), F.max(value).alias("high"))
    return ranges.select(
        *keys,
        F.when(low == high, low - 0.5).otherwise(low).alias("start"),
        F.when(low == high, high + 0.5).otherwise(high).alias("stop"),
    ).withColumn("width", (F.col("stop") - F.col("start")) / bins)


def bin_of(value: Column | str, bins: int) -> Column:
    """0-based bin of a row that carries `start`, `stop` and `width`; last bin right-closed, NULL outside.

    Bin i begins at its own edge `start + i * width`, so a value on an edge is never moved by rounding.
    """
    value = F.col(value) if isinstance(value, str) else value
    start, width = F.col("start"), F.col("width")
    reached = sum(((value >= i * width + start).cast("int") for i in range(1, bins)), F.lit(0))
    return F.when((value >= start) & (value <= F.col("stop")), reached)


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """`(feature, bin, n)` over each column's own range, empty bins included."""
    long = melt(df, columns)
    ranges = bin_ranges(long, ["feature"], bins)
    # one row per column of the table
    counted = long.join(F.broadcast(ranges), "feature").groupBy("feature", bin_of("value", bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    grid = ranges.select("feature", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counted, ["feature", "bin"], "left").select("feature", "bin", F.coalesce("n", F.lit(0)).alias("n"))
