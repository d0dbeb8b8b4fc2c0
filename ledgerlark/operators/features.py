"""Preprocessing and feature steps as Spark ML estimators whose fitted state is one small value per column.

Fitting is one distributed aggregate; its result (as many numbers as there are columns) comes back to
the driver and is turned into plain expressions, so every transform is a narrow projection without a
join. The fitted state is a JSON-friendly Param, so the models save and load like Spark's own.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.functions.hashing import hash_number
from ledgerlark.operators.ordered import melt, present, quantiles, row_index, value_counts

OUTLIER_METHODS = ("iqr", "zscore")
SCALING_METHODS = ("standard", "robust", "minmax")
IMPUTE_STRATEGIES = ("mean", "median", "most_frequent")
# How many leading columns the domain features use.
STATISTIC_COLUMNS = 10
FLAG_COLUMNS = 3
RATIO_OFFSET = 0.001


def one_of(value: str, allowed: Sequence[str], what: str) -> str:
    if value not in allowed:
        raise ValueError(f"unknown {what} {value!r}; choose from {', '.join(allowed)}")
    return value


def fitted_rows(df: DataFrame, key: str = "feature") -> dict[str, dict]:
    """A per-column result as a dict; the caller guarantees one row per column."""
    return {r[key]: r.asDict() for r in df.collect()}


class _Fitted(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """A model whose state is one JSON-friendly dict."""

    state = Param(Params._dummy(), "state", "fitted values by column")

    def __init__(self, input_cols: Sequence[str] = (), state: dict | None = None):
        super().__init__()
        self._set(inputCols=list(input_cols), state=state or {})

    def fitted(self) -> dict:
        return self.getOrDefault(self.state)


class _ColumnEstimator(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    method = Param(Params._dummy(), "method", "method name", TypeConverters.toString)
    threshold = Param(Params._dummy(), "threshold", "width of the accepted band", TypeConverters.toFloat)
    accuracy = Param(Params._dummy(), "accuracy", "0 for exact quantiles, else sketch accuracy", TypeConverters.toInt)

    def _options(self, **kwargs):
        self._setDefault(accuracy=0, threshold=1.5)
        self._set(**{k: v for k, v in kwargs.items() if v is not None})

    def _accuracy(self) -> int | None:
        return self.getOrDefault(self.accuracy) or None

    def _quantiles(self, df: DataFrame, probs: Sequence[float]) -> dict[str, dict[float, float]]:
        rows = quantiles(df, self.getInputCols(), probs, accuracy=self._accuracy()).collect()
        out: dict[str, dict[float, float]] = {}
        for r in rows:
            out.setdefault(r["feature"], {})[r["p"]] = r["quantile"]
        return out


def moments(df: DataFrame, columns: Sequence[str]) -> dict[str, dict]:
    """Mean, both standard deviations, minimum and maximum per column in one pass."""
    stats = (
        melt(df, columns)
        .groupBy("feature")
        .agg(
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std_samp"),
            F.stddev_pop("value").alias("std_pop"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    return fitted_rows(stats)


class OutlierCapper(_ColumnEstimator):
    """Cap columns at IQR fences or at mean ± threshold standard deviations."""

    @keyword_only
    def __init__(self, *, inputCols=None, method="iqr", threshold=None, accuracy=None):
        super().__init__()
        self._options(inputCols=inputCols, method=method, threshold=threshold, accuracy=accuracy)

    def _fit(self, df: DataFrame) -> OutlierCapperModel:
        method = one_of(self.getOrDefault(self.method), OUTLIER_METHODS, "outlier method")
        width, bounds = self.getOrDefault(self.threshold), {}
        if method == "iqr":
            for name, q in self._quantiles(df, [0.25, 0.75]).items():
                spread = q[0.75] - q[0.25]
                bounds[name] = [q[0.25] - width * spread, q[0.75] + width * spread]
        else:
            for name, m in moments(df, self.getInputCols()).items():
                if m["std_samp"] is not None:
                    bounds[name] = [m["mean"] - width * m["std_samp"], m["mean"] + width * m["std_samp"]]
        return OutlierCapperModel(self.getInputCols(), bounds)


class OutlierCapperModel(_Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        capped = {
            name: F.when(present(F.col(name).cast("double")), F.least(F.greatest(F.col(name), F.lit(low)), F.lit(high)))
            for name, (low, high) in self.fitted().items()
            if name in df.columns
        }
        return df.withColumns(capped) if capped else df


class ColumnScaler(_ColumnEstimator):
    """Standard (population deviation), robust (median and IQR) or min-max scaling; constant columns become 0."""

    @keyword_only
    def __init__(self, *, inputCols=None, method="standard", accuracy=None):
        super().__init__()
        self._options(inputCols=inputCols, method=method, accuracy=accuracy)

    def _fit(self, df: DataFrame) -> ColumnScalerModel:
        method = one_of(self.getOrDefault(self.method), SCALING_METHODS, "scaling method")
        state = {}
        if method == "robust":
            for name, q in self._quantiles(df, [0.25, 0.5, 0.75]).items():
                state[name] = [q[0.5], (q[0.75] - q[0.25]) or 1.0]
        else:
            for name, m in moments(df, self.getInputCols()).items():
                if method == "standard":
                    state[name] = [m["mean"], m["std_pop"] or 1.0]
                else:
                    state[name] = [m["min"], (m["max"] - m["min"]) or 1.0]
        return ColumnScalerModel(self.getInputCols(), state)


class ColumnScalerModel(_Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        scaled = {n: (F.col(n).cast("double") - F.lit(shift)) / F.lit(scale) for n, (shift, scale) in self.fitted().items()}
        return df.withColumns(scaled) if scaled else df


class ColumnImputer(_ColumnEstimator):
    """Fill missing values by mean, exact median or most frequent value (ties to the smallest)."""

    @keyword_only
    def __init__(self, *, inputCols=None, method="median", accuracy=None):
        super().__init__()
        self._options(inputCols=inputCols, method=method, accuracy=accuracy)

    def _fit(self, df: DataFrame) -> ColumnImputerModel:
        method = one_of(self.getOrDefault(self.method), IMPUTE_STRATEGIES, "imputation strategy")
        columns = self.getInputCols()
        if method == "mean":
            fills = {n: m["mean"] for n, m in moments(df, columns).items()}
        elif method == "median":
            fills = {n: q[0.5] for n, q in self._quantiles(df, [0.5]).items()}
        else:
            fills = {n: r["best"]["value"] for n, r in fitted_rows(most_frequent(df, columns)).items()}
        return ColumnImputerModel(columns, fills)


def most_frequent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`(feature, best struct<negative count, value>)` by text value; combined before the shuffle, no window."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "feature", "value")
    counts = value_counts(text.where(F.col("value").isNotNull()), ["feature"])
    return counts.groupBy("feature").agg(F.min(F.struct((-F.col("n")).alias("order"), F.col("value"))).alias("best"))


class ColumnImputerModel(_Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        filled = {}
        for name, fill in self.fitted().items():
            dtype = df.schema[name].dataType
            value = F.col(name)
            if dtype.typeName() in ("double", "float"):
                value = F.when(~F.isnan(name), value)
            filled[name] = F.coalesce(value, F.lit(fill).cast(dtype))
        return df.withColumns(filled) if filled else df


def categories(df: DataFrame, columns: Sequence[str], most: int) -> dict[str, list[str]]:
    """Sorted categories per column, refused above `most` since each becomes an output column."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "feature", "value")
    distinct = text.where(F.col("value").isNotNull()).distinct()
    sizes = fitted_rows(distinct.groupBy("feature").agg(F.count(F.lit(1)).alias("n")))
    wide = {n: r["n"] for n, r in sizes.items() if r["n"] > most}
    if wide:
        raise ValueError(f"too many categories for one column each: {wide}; use ordinal_encode")
    out: dict[str, list[str]] = {c: [] for c in columns}
    for r in distinct.orderBy("feature", "value").collect():
        out[r["feature"]].append(r["value"])
    return out


class OneHot(_ColumnEstimator):
    """0/1 columns `<column>_<category>` without the alphabetically first category; unknown is all zero."""

    most = Param(Params._dummy(), "most", "largest accepted number of categories per column", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, most=1000):
        super().__init__()
        self._options(inputCols=inputCols, most=most)

    def _fit(self, df: DataFrame) -> OneHotModel:
        return OneHotModel(self.getInputCols(), categories(df, self.getInputCols(), self.getOrDefault(self.most)))


class OneHotModel(_Fitted):
    def output_columns(self) -> list[str]:
        return [f"{n}_{v}" for n in self.getInputCols() for v in self.fitted()[n][1:]]

    def _transform(self, df: DataFrame) -> DataFrame:
        flags = {
            f"{n}_{v}": F.coalesce((F.col(n).cast("string") == F.lit(v)).cast("double"), F.lit(0.0))
            for n in self.getInputCols()
            for v in self.fitted()[n][1:]
        }
        return df.withColumns(flags).drop(*self.getInputCols())


def ordinal_codes(df: DataFrame, column: str) -> DataFrame:
    """`(column, code)` with codes in sorted order; works for any number of categories."""
    distinct = df.select(column).where(F.col(column).isNotNull()).distinct()
    return row_index(distinct, [], [column], "code").drop("code_total")


def ordinal_encode(df: DataFrame, codes: DataFrame, column: str, output: str) -> DataFrame:
    """Codes joined on; unknown and missing categories get -1. The join strategy is left to run-time sizes."""
    return df.join(codes.withColumnRenamed("code", output), column, "left").withColumn(
        output, F.coalesce(F.col(output), F.lit(-1)).cast("double")
    )


def statistics_of(columns: Sequence[str]) -> dict[str, Column]:
    """Row-wise sum, mean, std (ddof 1, 0 for a single value), max and min; missing values skipped."""
    values = F.filter(F.array(*[F.col(c).cast("double") for c in columns]), lambda v: v.isNotNull() & ~F.isnan(v))
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    size = F.size(values)
    mean = F.try_divide(total, size)
    squares = F.aggregate(values, F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean))
    return {
        "feature_sum": total,
        "feature_mean": mean,
        "feature_std": F.coalesce(F.sqrt(F.try_divide(squares, F.when(size > 1, size - 1))), F.lit(0.0)),
        "feature_max": F.array_max(values),
        "feature_min": F.array_min(values),
    }


def leading_products(columns: Sequence[str]) -> dict[str, Column]:
    """Ratios and products of the first four columns."""
    c = [F.col(x).cast("double") for x in columns[:4]]
    return {
        "ratio_1_2": F.try_divide(c[1], c[0] + RATIO_OFFSET),
        "ratio_3_4": F.try_divide(c[3], c[2] + RATIO_OFFSET),
        "product_1_2": c[0] * c[1],
        "product_3_4": c[2] * c[3],
    }


def leading_powers(columns: Sequence[str]) -> dict[str, Column]:
    c = [F.col(x).cast("double") for x in columns[:2]]
    return {"squared_1": c[0] * c[0], "squared_2": c[1] * c[1], "cubic_1": c[0] * c[0] * c[0]}


class DomainFeatures(_ColumnEstimator):
    """Ratios, row statistics, quartile flags and powers over leading columns; thresholds are fitted once."""

    @keyword_only
    def __init__(self, *, inputCols=None, accuracy=None):
        super().__init__()
        self._options(inputCols=inputCols, accuracy=accuracy)

    def _fit(self, df: DataFrame) -> DomainFeaturesModel:
        columns = self.getInputCols()
        if len(columns) < 5:
            raise ValueError("domain features need at least five columns")
        rows = quantiles(df, columns[:FLAG_COLUMNS], [0.25, 0.75], accuracy=self._accuracy()).collect()
        limits: dict[str, list] = {c: [None, None] for c in columns[:FLAG_COLUMNS]}
        for r in rows:
            limits[r["feature"]][0 if r["p"] == 0.25 else 1] = r["quantile"]
        return DomainFeaturesModel(columns, limits)


class DomainFeaturesModel(_Fitted):
    def flags(self) -> dict[str, Column]:
        out = {}
        for i, c in enumerate(self.getInputCols()[:FLAG_COLUMNS]):
            low, high = self.fitted()[c]
            out[f"high_risk_{i}"] = F.coalesce((F.col(c) > F.lit(high)).cast("int"), F.lit(0))
            out[f"low_risk_{i}"] = F.coalesce((F.col(c) < F.lit(low)).cast("int"), F.lit(0))
        return out

    def output_columns(self) -> list[str]:
        return list(self._added())

    def _added(self) -> dict[str, Column]:
        columns = self.getInputCols()
        return {
            **leading_products(columns),
            **statistics_of(columns[:STATISTIC_COLUMNS]),
            **self.flags(),
            **leading_powers(columns),
        }

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self._added())


class Interactions(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Pairwise products of all columns, or of the first `maxColumns` if that is set; no squares."""

    maxColumns = Param(Params._dummy(), "maxColumns", "how many leading columns are multiplied", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, maxColumns=None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=list(inputCols))
        if maxColumns is not None:
            self._set(maxColumns=maxColumns)

    def _pairs(self) -> list[tuple[str, str]]:
        columns = self.getInputCols()
        return list(combinations(columns[: self.getOrDefault(self.maxColumns)] if self.isDefined(self.maxColumns) else columns, 2))

    def output_columns(self) -> list[str]:
        return [f"{a}_x_{b}" for a, b in self._pairs()]

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"{a}_x_{b}": F.col(a).cast("double") * F.col(b).cast("double") for a, b in self._pairs()})


def anova_f(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """One-way F per column `(feature, f_value, df_between, df_within)`; one shuffle of one row per column and class."""
    groups = melt(df, columns, [label]).groupBy("feature", label).agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.var_pop("value").alias("var")
    )
    every = Window.partitionBy("feature")
    grand = F.sum(F.col("n") * F.col("mean")).over(every) / F.sum("n").over(every)
    sums = groups.withColumn("grand", grand).groupBy("feature").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n") * (F.col("mean") - F.col("grand")) * (F.col("mean") - F.col("grand"))).alias("between"),
        F.sum(F.col("n") * F.col("var")).alias("within"),
    )
    ratio = F.try_divide(
        F.try_divide(F.col("between"), F.col("k") - 1), F.try_divide(F.col("within"), F.col("n") - F.col("k"))
    )
    return sums.select(
        "feature", ratio.alias("f_value"), (F.col("k") - 1).alias("df_between"), (F.col("n") - F.col("k")).alias("df_within")
    )


class BestFeatures(_ColumnEstimator, HasLabelCol):
    """Keep the k columns with the largest F value; ties go to the later column."""

    k = Param(Params._dummy(), "k", "number of columns kept", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol=None, k=50):
        super().__init__()
        self._options(inputCols=inputCols, labelCol=labelCol, k=k)

    def _fit(self, df: DataFrame) -> BestFeaturesModel:
        columns = self.getInputCols()
        scores = {r["feature"]: r["f_value"] for r in anova_f(df, columns, self.getLabelCol()).collect()}
        order = sorted(range(len(columns)), key=lambda i: (scores.get(columns[i]) or -1.0, i), reverse=True)
        chosen = [columns[i] for i in sorted(order[: self.getOrDefault(self.k)])]
        return BestFeaturesModel(columns, {"chosen": chosen})


class BestFeaturesModel(_Fitted):
    def output_columns(self) -> list[str]:
        return self.fitted()["chosen"]

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*[c for c in self.getInputCols() if c not in self.fitted()["chosen"]])


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """`(label, n, weight)` with weight = rows / (classes * rows of the class); one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy(F.lit(0))
    return counts.select(
        label, "n", (F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n"))).alias("weight")
    )


def stratified_index(df: DataFrame, label: str, id_column: str) -> DataFrame:
    """Add a reproducible 0-based position within the class; a hot class is spread over range blocks."""
    hashed = df.withColumn("__hash", hash_number(F.col(id_column).cast("string")))
    return row_index(hashed, [label], ["__hash", id_column], "position").drop("__hash")


def stratified_folds(df: DataFrame, label: str, id_column: str, folds: int = 3) -> DataFrame:
    indexed = stratified_index(df, label, id_column)
    return indexed.withColumn("fold", (F.col("position") % folds).cast("int")).drop("position", "position_total")


def stratified_split(df: DataFrame, label: str, id_column: str, test_share: float = 0.2) -> DataFrame:
    """Add `part` = train / test with the exact share in every class."""
    indexed = stratified_index(df, label, id_column)
    cut = F.floor(F.col("position_total") * test_share + 0.5)
    return indexed.withColumn("part", F.when(F.col("position") < cut, "test").otherwise("train")).drop(
        "position", "position_total"
    )


def time_folds(df: DataFrame, order: Sequence[str], folds: int = 5) -> DataFrame:
    """Add `fold`: the fold whose test part holds the row, -1 for rows that only ever train.

    Fold i trains on all rows before its test part.
    """
    indexed = row_index(df, [], order, "position")
    size = F.floor(F.col("position_total") / (folds + 1))
    start = F.col("position_total") - folds * size
    fold = F.when(F.col("position") < start, -1).otherwise(F.floor((F.col("position") - start) / size))
    return indexed.withColumn("fold", fold.cast("int")).drop("position", "position_total")


def hash_sample(df: DataFrame, id_column: str, n: int) -> DataFrame:
    """n rows without replacement, the same in every run (a distributed top-n)."""
    return df.orderBy(hash_number(F.col(id_column).cast("string")), id_column).limit(n)
