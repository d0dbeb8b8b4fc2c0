"""Imputers as steps that are fitted, saved, loaded and applied to new rows: by neighbours and by regression; and codes.

Neighbour imputation compares two rows over the columns that both have: the squared distance is the sum over these,
scaled up by (number of columns / number of shared ones). Each missing cell takes the mean of the k nearest fitted rows
that have its column, ties to the smaller id. Rows that share no column with any of them take the column mean. All
missing columns of a row are filled in the same pass.

Two rows whose gaps are known share a known set of columns, in which the distance is a plain one; so in large tables each
such set is a space with an exact search for neighbours, and all spaces are searched by the same jobs. Rows with rare
patterns of gaps are compared with all rows, in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.regression import LinearRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType
from pyspark.sql.window import Window

from ledgerlark.operators.features import _Fitted
from ledgerlark.operators.fitted import TableModel
from ledgerlark.operators.neighbours import nearest_lists
from ledgerlark.operators.ordered import row_index, small_side
from ledgerlark.session import materialise

BLOCK_ROWS = 4096
CHUNK_CELLS = 4_000_000
SMALL_PAIRS = 200_000_000  # pairs of rows up to which all are compared
MAX_PATTERNS = 64  # patterns of gaps that are listed on the driver
MAX_SPACES = 32  # sets of shared columns that are searched


def _values(columns: Sequence[str]):
    """The columns as one array; not-a-number counts as missing."""
    return F.array(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns])


def _missing(array: str):
    return F.exists(array, lambda v: v.isNull())


def _pattern(array: str):
    """Which values a row has: 1 or 0 for each column."""
    return F.array_join(F.transform(array, lambda v: F.when(v.isNull(), "0").otherwise("1")), "")


def _grid(rows: pd.Series) -> np.ndarray:
    return np.array([[np.nan if v is None else v for v in row] for row in rows], dtype=np.float64)


def shared_distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Distances over the columns that both rows have, scaled by their number; NaN where they share none."""
    have_left, have_right = ~np.isnan(left), ~np.isnan(right)
    shared = have_left.astype(np.float64) @ have_right.astype(np.float64).T
    total = np.zeros((len(left), len(right)))
    for c in range(left.shape[1]):
        gap = left[:, c, None] - right[None, :, c]
        total += np.where(np.isnan(gap), 0.0, gap * gap)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.sqrt(np.where(shared > 0, left.shape[1] / shared * total, np.nan))


def _nearest_givers(k: int):
    """For each asking row and each column it lacks the k nearest offered rows that have it."""

    def run(asking: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        parts: dict[str, list] = {"q": [], "at": [], "distance": [], "giver": [], "given": []}
        if len(asking) and len(offered):
            offered = offered.sort_values("giver", kind="stable")
            givers, points = offered["giver"].to_numpy(), _grid(offered["v"])
            step = max(1, CHUNK_CELLS // len(points))
            for start in range(0, len(asking), step):
                some = asking["q"].iloc[start : start + step]
                lacking = _grid(some)
                d = shared_distances(lacking, points)
                for c in range(points.shape[1]):
                    has = np.flatnonzero(~np.isnan(points[:, c]))
                    for row in np.flatnonzero(np.isnan(lacking[:, c])):
                        near = d[row, has]
                        limit = np.partition(near, k - 1)[k - 1] if len(near) > k else np.nan  # NaN comes last
                        few = np.flatnonzero(near <= limit) if limit == limit else np.arange(len(near))
                        order = few[np.argsort(near[few], kind="stable")[:k]]
                        order = order[~np.isnan(near[order])]
                        parts["q"] += [some.iloc[row]] * len(order)
                        parts["at"] += [c] * len(order)
                        parts["distance"] += near[order].tolist()
                        parts["giver"] += givers[has[order]].tolist()
                        parts["given"] += points[has[order], c].tolist()
        kinds = {"q": object, "at": "int32", "distance": "float64", "giver": object, "given": "float64"}
        return pd.DataFrame({c: pd.Series(v, dtype=kinds[c]) for c, v in parts.items()})  # also of no rows

    return run


class NeighbourImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fill each gap from the k nearest rows by missing-aware distance."""

    k = Param(Params._dummy(), "k", "neighbours of a gap", TypeConverters.toInt)
    idCol = Param(Params._dummy(), "idCol", "column that breaks ties", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, idCol="id", k=5):
        super().__init__()
        self._setDefault(k=5, idCol="id")
        self._set(inputCols=list(inputCols or []), idCol=idCol, k=k)

    def _fit(self, df: DataFrame) -> NeighbourImputerModel:
        columns, k = self.getInputCols(), self.getOrDefault(self.k)
        means = df.agg(*[F.avg(F.when(~F.isnan(F.col(c).cast("double")), F.col(c))).alias(c) for c in columns]).first().asDict()
        rows = df.select(F.col(self.getOrDefault(self.idCol)).alias("giver"), _values(columns).alias("v"))
        rows = rows.where(F.exists("v", lambda v: v.isNotNull()))
        # of equal rows no more than k can be among the k nearest
        place = F.row_number().over(Window.partitionBy(F.xxhash64("v"), "v").orderBy("giver"))
        table = materialise(rows.withColumn("place", place).where(F.col("place") <= k).drop("place"))
        return NeighbourImputerModel({"columns": columns, "k": k, "means": means}, table)


class NeighbourImputerModel(TableModel):
    """`table` has the fitted rows `(giver, v)`."""

    def fills(self, df: DataFrame) -> DataFrame:
        """`(q, fill)`: the filled array of each different incomplete row; written once, as later steps read it often."""
        k, means = self.fitted()["k"], self.fitted()["means"]
        asked = materialise(df.select(_values(self.fitted()["columns"]).alias("q")).where(_missing("q")).distinct())
        asked_rows, given_rows = asked.count(), self.table.count()
        spaces = self._spaces(asked) if asked_rows * given_rows > SMALL_PAIRS else {}
        rest = asked.where(~_pattern("q").isin([*spaces])) if spaces else asked
        found = self._compared(rest, k)
        if spaces:
            found = found.unionByName(self._searched(asked, spaces, k))
        # every block or space brings k rows at most for a cell, of which the k nearest count; hashes sort faster than arrays
        order = F.row_number().over(Window.partitionBy(F.xxhash64("q", "at"), "q", "at").orderBy("distance", "giver"))
        cells = found.withColumn("rank", order).where(F.col("rank") <= k).groupBy("q", "at").agg(F.avg("given").alias("fill"))
        listed = cells.groupBy("q").agg(F.map_from_entries(F.collect_list(F.struct("at", "fill"))).alias("fills"))
        mean = F.array(*[F.lit(means[c]).cast("double") for c in self.fitted()["columns"]])
        filled = F.transform("q", lambda v, i: F.coalesce(v, F.col("fills")[i], F.get(mean, i)))
        return materialise(asked.join(listed, "q", "left").select("q", filled.alias("fill")))

    def _compared(self, asked: DataFrame, k: int) -> DataFrame:
        """`(q, at, distance, giver, given)` from every pair of rows, in blocks."""
        kind = self.table.schema["giver"].dataType.simpleString()
        shape = f"q array<double>, at int, distance double, giver {kind}, given double"
        asked = asked.where(F.exists("q", lambda v: v.isNotNull()))  # others share no column with any row
        if asked.isEmpty():
            return asked.sparkSession.createDataFrame([], shape)
        blocks, groups = (max(1, math.ceil(t.count() / BLOCK_ROWS)) for t in (self.table, asked))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        asks = asked.select("q", F.pmod(F.xxhash64("q"), F.lit(groups)).cast("int").alias("grp"), every(blocks).alias("block"))
        offers = self.table.select("giver", "v", F.pmod(F.xxhash64("giver", "v"), F.lit(blocks)).cast("int").alias("block"), every(groups).alias("grp"))
        return asks.groupBy("grp", "block").cogroup(offers.groupBy("grp", "block")).applyInPandas(_nearest_givers(k), shape)

    def _spaces(self, asked: DataFrame) -> dict[str, dict[tuple[int, tuple[int, ...]], list[str]]]:
        """For each pattern of gaps of asking rows, for each column it lacks and each set of columns it shares with fitted
        rows that have it, the patterns of these. Patterns that would need more than MAX_SPACES sets in all are left out,
        rare ones first; so are all if a value is infinite or patterns are too many to list."""

        def patterns(rows: DataFrame, array: str) -> list[str] | None:
            endless = F.exists(array, lambda v: F.abs(v) == float("inf"))
            counted = rows.groupBy(_pattern(array).alias("p")).agg(F.count(F.lit(1)).alias("n"), F.max(endless).alias("endless"))
            listed = counted.orderBy(F.desc("endless"), F.desc("n"), "p").limit(MAX_PATTERNS + 1).collect()
            return None if len(listed) > MAX_PATTERNS or any(r["endless"] for r in listed) else [r["p"] for r in listed]

        asking, offered = patterns(asked, "q"), patterns(self.table, "v")
        found, used = {}, 0
        for p in asking or [] if offered is not None else []:
            own: dict[tuple[int, tuple[int, ...]], list[str]] = {}
            for at in (i for i, present in enumerate(p) if present == "0"):
                for o in offered:
                    shared = tuple(i for i in range(len(p)) if p[i] == o[i] == "1")
                    if shared and o[at] == "1":
                        own.setdefault((at, shared), []).append(o)
            if own and used + len(own) <= MAX_SPACES:
                found[p], used = own, used + len(own)
        return found

    def _searched(self, asked: DataFrame, spaces: dict, k: int) -> DataFrame:
        """`(q, at, distance, giver, given)`: in the columns shared by two patterns distances are plain ones, so each set is
        an exact search for neighbours; the k nearest of all are among the k nearest of each."""
        width = len(self.fitted()["columns"])
        rows = materialise(row_index(self.table.withColumn("h", F.xxhash64("v")), [], ["giver", "h"], "n").select("n", "giver", "v"))

        tasks = [(p, space, patterns) for p, own in spaces.items() for space, patterns in own.items()]
        own = lambda array, shared: F.array(*[F.col(array)[i] for i in shared]).alias("x")
        inline = lambda structs: F.inline(F.filter(F.array(*structs), lambda s: s.isNotNull()))
        asks = asked.withColumn("p", _pattern("q")).select("q", inline(
            [F.when(F.col("p") == p, F.struct(F.lit(n).alias("space"), F.lit(at).alias("at"), own("q", shared))) for n, (p, (at, shared), _) in enumerate(tasks)]
        ))
        offers = rows.withColumn("p", _pattern("v")).select("n", inline(
            [F.when(F.col("p").isin(patterns), F.struct(F.lit(n).alias("space"), own("v", shared))) for n, (_, (_, shared), patterns) in enumerate(tasks)]
        ))
        lists = nearest_lists(asks, offers, k, "n", "x", "space").withColumnRenamed("query_v", "x")
        # lists of several spaces for a cell are cut by their scaled distances, with room for rounding, before rows are joined
        scaled = F.transform("near", lambda s: F.struct((s["distance"] * F.sqrt(F.lit(float(width)) / F.size("x"))).alias("d"), s["neighbour_id"].alias("n")))
        listed = asks.join(lists, ["space", "x"]).select(F.xxhash64("q", "at").alias("h"), "q", "at", scaled.alias("near"))
        whole = listed.groupBy("h", "q", "at").agg(F.array_sort(F.flatten(F.collect_list("near"))).alias("near"))
        limit = F.coalesce(F.get("near", F.lit(k - 1))["d"] * (1 + 1e-9), F.lit(float("inf")))
        pairs = whole.select("q", "at", F.explode(F.filter("near", lambda s: s["d"] <= limit)["n"]).alias("n")).join(rows, "n")
        gaps = F.zip_with("q", "v", lambda a, b: F.coalesce((a - b) * (a - b), F.lit(0.0)))
        shared = F.size(F.filter(F.zip_with("q", "v", lambda a, b: a.isNotNull() & b.isNotNull()), lambda both: both))
        distance = F.sqrt(F.lit(float(width)) / shared * F.aggregate(gaps, F.lit(0.0), lambda total, v: total + v))
        return pairs.select("q", "at", distance.alias("distance"), "giver", F.get("v", F.col("at")).alias("given"))

    def _transform(self, df: DataFrame) -> DataFrame:
        columns = self.fitted()["columns"]
        # arrays with gaps equal each other place by place; complete rows find no partner
        fills = self.fills(df).select(F.col("q").alias("__q"), F.col("fill").alias("__fill"))
        joined = df.withColumn("__q", _values(columns)).join(fills, "__q", "left")
        return joined.withColumns({c: F.coalesce(F.col("__fill")[i], F.col(c).cast("double")) for i, c in enumerate(columns)}).drop("__q", "__fill")


class RegressionImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Round-robin regression: every incomplete column from all others, in rounds, until the values settle.

    Starts from column means; columns with fewest gaps go first. The fitted state is the list of all regressions in the
    order in which they ran; new rows pass through the same list.
    """

    rounds = Param(Params._dummy(), "rounds", "most rounds", TypeConverters.toInt)
    ridge = Param(Params._dummy(), "ridge", "strength of the penalty", TypeConverters.toFloat)
    tolerance = Param(Params._dummy(), "tolerance", "change, relative to the column, that counts as settled", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, rounds=10, ridge=1e-3, tolerance=1e-3):
        super().__init__()
        self._set(inputCols=list(inputCols or []), rounds=rounds, ridge=ridge, tolerance=tolerance)

    def _fit(self, df: DataFrame) -> RegressionImputerModel:
        columns = self.getInputCols()
        value = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
        stats = df.agg(
            *[F.sum(value[c].isNull().cast("int")).alias(f"gaps_{c}") for c in columns],
            *[F.avg(value[c]).alias(f"mean_{c}") for c in columns],
            *[F.max(F.abs(value[c])).alias(f"span_{c}") for c in columns],
        ).first()
        order = sorted((c for c in columns if stats[f"gaps_{c}"]), key=lambda c: (stats[f"gaps_{c}"], c))
        state = materialise(df.select(
            *[F.coalesce(value[c], F.lit(stats[f"mean_{c}"])).alias(c) for c in columns], *[value[c].isNull().alias(f"__gap_{c}") for c in order]
        ))
        steps = []
        for _ in range(self.getOrDefault(self.rounds)):
            current = state.select("*", *[F.col(c).alias(f"__old_{c}") for c in order])
            for c in order:
                others = [o for o in columns if o != c]
                train = VectorAssembler(inputCols=others, outputCol="__x").transform(current.where(~F.col(f"__gap_{c}")))
                fit = LinearRegression(featuresCol="__x", labelCol=c, regParam=self.getOrDefault(self.ridge), solver="normal").fit(train.select("__x", c))
                weights = [float(w) for w in fit.coefficients]
                steps.append([columns.index(c), float(fit.intercept), [0.0 if o == c else weights[others.index(o)] for o in columns]])
                guess = sum((F.lit(w) * F.col(o) for o, w in zip(others, weights)), F.lit(float(fit.intercept)))
                current = current.withColumn(c, F.when(F.col(f"__gap_{c}"), guess).otherwise(F.col(c)))
            current = materialise(current)
            moved = current.agg(*[F.max(F.abs(F.col(c) - F.col(f"__old_{c}"))).alias(c) for c in order]).first() if order else {}
            state = current.drop(*[f"__old_{c}" for c in order])
            if all((moved[c] or 0.0) <= self.getOrDefault(self.tolerance) * (stats[f"span_{c}"] or 1.0) for c in order):
                break
        return RegressionImputerModel(columns, {"means": [stats[f"mean_{c}"] for c in columns], "steps": steps})


class RegressionImputerModel(_Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        columns, state = self.getInputCols(), self.fitted()
        means = np.array([np.nan if m is None else m for m in state["means"]])
        steps = [(c, intercept, np.array(weights)) for c, intercept, weights in state["steps"]]

        @F.pandas_udf(ArrayType(DoubleType()))
        def filled(rows: pd.Series) -> pd.Series:
            x = _grid(rows)
            gaps = np.isnan(x)
            x = np.where(gaps, means, x)
            for c, intercept, weights in steps:
                x[gaps[:, c], c] = intercept + x[gaps[:, c]] @ weights
            return pd.Series(list(x), dtype=object)

        rows = df.withColumn("__filled", filled(_values(columns)))
        return rows.withColumns({c: F.when(~F.isnan(F.col("__filled")[i]), F.col("__filled")[i]) for i, c in enumerate(columns)}).drop("__filled")


class OrdinalCoder(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Categories to codes in sorted order, for any number of categories; unknown and missing ones become -1."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(inputCols=list(inputCols or []))

    def _fit(self, df: DataFrame) -> OrdinalCoderModel:
        columns = self.getInputCols()
        text = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "feature", "value")
        known = text.where(F.col("value").isNotNull()).distinct()
        return OrdinalCoderModel({"columns": columns}, materialise(row_index(known, ["feature"], ["value"], "code").select("feature", "value", "code")))


class OrdinalCoderModel(TableModel):
    """`table` has `(feature, value, code)`."""

    def _transform(self, df: DataFrame) -> DataFrame:
        for c in self.fitted()["columns"]:
            codes = small_side(self.table.where(F.col("feature") == c).select(F.col("value").alias("__value"), F.col("code").alias("__code")))
            df = df.join(codes, F.col(c).cast("string") == F.col("__value"), "left").withColumn(c, F.coalesce("__code", F.lit(-1)).cast("double")).drop("__value", "__code")
        return df
