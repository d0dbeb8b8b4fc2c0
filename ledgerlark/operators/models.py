"""Training, tuning, cross-validation and scoring with Spark ML."""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.operators import boosting
from ledgerlark.operators import metrics as m
from ledgerlark.operators.features import class_weights, ordinal_codes, ordinal_encode, stratified_folds
from ledgerlark.operators.fitted import TableModel
from ledgerlark.operators.ordered import small_side
from ledgerlark.session import materialise

DEFAULT_CONFIDENCE = 0.5
# Preset parameters and search grids.
PRESETS = {
    "random_forest": {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 2, "featureSubsetStrategy": "sqrt"},
    "boosted_trees": {"maxIter": 100, "maxDepth": 6, "stepSize": 0.1, "subsamplingRate": 0.8, "featureShare": 0.8, "alpha": 0.1, "ridge": 1.0},
    "logistic": {"C": 1.0, "maxIter": 1000},
}
GRIDS = {
    "random_forest": {"numTrees": [50, 100], "maxDepth": [5, 10], "minInstancesPerNode": [1, 2]},
    "boosted_trees": {"maxIter": [50, 100], "maxDepth": [3, 6], "stepSize": [0.1, 0.2], "subsamplingRate": [0.8, 1.0]},
    "logistic": {"C": [0.1, 1.0, 10.0], "elasticNetParam": [0.0, 1.0]},
}
SEED = 42
PARALLEL_FITS = 4
TASK_ROWS = 250_000  # of a task of an iterative fit
LEAST_TASKS = 8
PASS_ROWS = 65_536  # of a task of a regression's pass: fewer take less time than starting the task
FEW_ROWS = 500_000  # up to which twice as many fits run at a time: each of them mostly waits for its next job
TEST = -1  # the fold of test rows in a prediction table


def training_frame(df: DataFrame, features: Sequence[str], target: str, id_column: str) -> DataFrame:
    """`(id, label, weight, features vector, <target>)`; labels in alphabetical order, balanced class weights.

    Materialised once: every fit, fold and score of a run reads this table instead of its sources. It is
    dealt out over the tasks of iterative fits, which pass over it many times.
    """
    narrow = materialise(df.select(
        F.col(id_column).alias("id"), target, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]
    ).where(F.col(target).isNotNull()))
    coded = ordinal_encode(narrow, ordinal_codes(narrow, target), target, "label")
    weights = class_weights(narrow, target).select(target, "weight")
    joined = coded.join(small_side(weights), target)
    assembled = VectorAssembler(inputCols=list(features), outputCol="features").transform(joined)
    return materialise(few(dealt(assembled.select("id", "label", "weight", "features", target)), narrow.count()))


def dealt(df: DataFrame, key: str = "id") -> DataFrame:
    """Rows dealt out by key over all shuffle partitions, for iterative fits after a step that left few."""
    session = df.sparkSession
    parts = max(int(session.conf.get("spark.sql.shuffle.partitions")), session.sparkContext.defaultParallelism)
    return df.repartition(parts, key)


def few(df: DataFrame, rows: int) -> DataFrame:
    """As few tasks as fill the cluster, of TASK_ROWS rows at most: an iterative fit starts all of them in every pass."""
    return df.coalesce(max(math.ceil(rows / TASK_ROWS), df.sparkSession.sparkContext.defaultParallelism, LEAST_TASKS))


def scaled(train: DataFrame, *others: DataFrame) -> list[DataFrame]:
    """Standardised features, fitted on the training part only."""
    model = StandardScaler(inputCol="features", outputCol="z", withMean=True, withStd=True).fit(train)

    def apply(df: DataFrame) -> DataFrame:
        return model.transform(df).drop("features").withColumnRenamed("z", "features")

    return [apply(df) for df in (train, *others)]


class Forest(RandomForestClassifier):
    """Spark's forest from as few tasks as fill the cluster: every task sums, and shuffles, all nodes of all trees that are
    split, whatever rows it has."""

    def _fit(self, df: DataFrame) -> Model:
        return super()._fit(few(df, df.count()))


class Logistic(LogisticRegression):
    """Spark's regression from as few tasks as fill the cluster, or fewer for few rows: every one of its hundreds of passes
    starts them all, and sums of more than four in two stages."""

    def _fit(self, df: DataFrame) -> Model:
        rows = df.count()
        dealt_out = few(df, rows)
        least = max(1, math.ceil(rows / PASS_ROWS))
        return super()._fit(dealt_out.coalesce(least) if least <= LEAST_TASKS // 2 else dealt_out)


def random_forest(**params) -> Estimator:
    return Forest(weightCol="weight", seed=SEED, **{**PRESETS["random_forest"], **params})


def logistic(rows: int, C: float = 1.0, maxIter: int = 1000, **params) -> Estimator:
    """Multinomial with L2; the inverse strength C is spread over the rows as Spark averages the loss."""
    return Logistic(family="multinomial", weightCol="weight", regParam=1.0 / (C * rows), maxIter=maxIter, **params)


class BoostedPerClass(Estimator):
    """Gradient-boosted trees for any number of classes: one tree per class and round, see `boosting`."""

    def __init__(self, classes: int, **params):
        super().__init__()
        self.classes, self.options = classes, {**PRESETS["boosted_trees"], **params}

    def candidate(self, name: str = "", fold: int | None = None, expanding: bool = False) -> boosting.Candidate:
        o = self.options
        return boosting.Candidate(
            name, o["maxIter"], o["maxDepth"], o["stepSize"], o["subsamplingRate"], o["featureShare"], o["alpha"], o["ridge"], fold=fold, expanding=expanding
        )

    def _fit(self, df: DataFrame) -> BoostedPerClassModel:
        (trees,) = boosting.train(df, [self.candidate()], self.classes, SEED)
        return BoostedPerClassModel.of(trees, df.sparkSession)


class BoostedPerClassModel(TableModel):
    """`table` has a row `(round, class, node, feature, threshold, value)` for each node of each tree."""

    SCHEMA = "round int, class int, node int, feature int, threshold double, value double"

    @classmethod
    def of(cls, trees: boosting.Trees, session: SparkSession) -> BoostedPerClassModel:
        rounds, classes = trees.feature.shape[:2]
        model = cls({"rounds": rounds, "classes": classes}, session.createDataFrame(trees.rows(), cls.SCHEMA))
        model._trees = trees
        return model

    def trees(self) -> boosting.Trees:
        """Bounded by rounds, classes and depth, whatever the data."""
        if getattr(self, "_trees", None) is None:
            rows = [tuple(r) for r in self.table.select("round", "class", "node", "feature", "threshold", "value").collect()]
            self._trees = boosting.Trees.of_rows(rows, self.fitted()["rounds"], self.fitted()["classes"])
        return self._trees

    def stage(self, rounds: int) -> BoostedPerClassModel:
        """The model of the first rounds alone."""
        first = self.table.where(F.col("round") < rounds)
        return BoostedPerClassModel({**self.fitted(), "rounds": min(rounds, self.fitted()["rounds"])}, first)

    def _transform(self, df: DataFrame) -> DataFrame:
        trees = self.trees()

        @F.pandas_udf("array<double>")
        def shares(vectors: pd.Series) -> pd.Series:
            x = np.array(vectors.to_list(), dtype=np.float64).reshape(len(vectors), -1)
            return pd.Series(list(boosting.probabilities(trees.margins(x))), dtype=object)

        best = F.array_position(F.col("__shares"), F.array_max("__shares")) - 1
        out = df.withColumn("__shares", shares(vector_to_array("features")))
        return out.withColumns({"probability": array_to_vector("__shares"), "prediction": best.cast("double")}).drop("__shares")


def score(model: Model, df: DataFrame, keep: Sequence[str] = ("id", "label")) -> DataFrame:
    """`(keep..., prediction int, probability array, confidence)`; 0.5 for a model without probabilities."""
    out = model.transform(df)
    if "probability" in out.columns:
        p = vector_to_array("probability")
        return out.select(
            *keep, F.col("prediction").cast("int").alias("prediction"), p.alias("probability"), F.array_max(p).alias("confidence")
        )
    return out.select(
        *keep, F.col("prediction").cast("int").alias("prediction"), F.lit(None).cast("array<double>").alias("probability"),
        F.lit(DEFAULT_CONFIDENCE).alias("confidence"),
    )


def class_names(df: DataFrame, target: str) -> DataFrame:
    """The fitted label table `(label, class_name)`, one row per class."""
    return ordinal_codes(df, target).select(F.col("code").cast("int").alias("label"), F.col(target).alias("class_name"))


def evaluate(scored: DataFrame) -> DataFrame:
    """All test metrics of one or more scored models; needs `(model, label, prediction, probability)`."""
    return m.model_metrics(scored.withColumn("label", F.col("label").cast("int")))


def validate(
    builds: Mapping[str, Estimator], train: DataFrame, test: DataFrame, parallelism: int = PARALLEL_FITS
) -> DataFrame:
    """Test metrics of several models, one row each; all are scored into one table and measured together."""
    fitted = _parallel(lambda name: builds[name].fit(train), list(builds), parallelism, train)
    out = None
    for name, model in zip(builds, fitted):
        part = score(model, test).withColumn("model", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return evaluate(materialise(out))


def fit_folds(
    df: DataFrame,
    builds: Mapping[str, Callable[[DataFrame], Estimator]],
    folds: Sequence[int],
    expanding: bool = False,
    parallelism: int = PARALLEL_FITS,
    whole: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Out-of-fold predictions `(model, fold, id, label, prediction, probability, confidence)` of several candidates, in
    one table that is written once.

    `df` carries a `fold` column. Scalers are fitted inside the training part, once per fold, and both parts are
    written. Fits are independent Spark jobs, so a few run at a time to fill the cluster; boosted models of all
    candidates and folds are grown together, and one is scored at every number of rounds that is asked for.
    Expanding folds train on earlier folds (and fold -1) only. `whole` is all rows without their folds and test rows: these
    are scored, as fold `TEST`, by models of all rows that are fitted beside those of the folds.
    """
    df = materialise(df)  # fold columns come from joins, and every fold reads them
    rows = df.count()

    def prepare(fold: int) -> tuple[DataFrame, DataFrame]:
        if fold == TEST:
            train, held = whole
            held = held.withColumn("fold", F.lit(TEST))
        else:
            train = dealt(df.where(F.col("fold") < fold) if expanding else df.where(F.col("fold") != fold))
            held = df.where(F.col("fold") == fold)
        # written once: every candidate's fit and score reads these tables
        return tuple(materialise(few(part, rows)) for part in scaled(train, held))

    folds = [*folds, *([TEST] if whole else [])]
    parts = dict(zip(folds, _parallel(prepare, folds, parallelism, df)))
    tasks = [(name, fold) for name in builds for fold in folds]
    built = {task: builds[task[0]](parts[task[1]][0]) for task in tasks}
    boosted = [t for t in tasks if isinstance(built[t], BoostedPerClass)]
    others = [t for t in tasks if t not in boosted]
    # trees do not depend on the scale, and all candidates grow together
    candidates = [built[t].candidate(t[0], None if t[1] == TEST else t[1], expanding) for t in boosted]
    fits, stages = boosting.with_stages(candidates)

    def fit(task: tuple[str, int] | None):
        return boosting.train(df, fits, built[boosted[0]].classes, SEED) if task is None else built[task].fit(parts[task[1]][0])

    # the boosted models are one task; regressions come next, as their passes are short and follow each other
    order = sorted(others, key=lambda t: not isinstance(built[t], Logistic))
    at_once = parallelism if rows > FEW_ROWS else 2 * parallelism
    fitted = _parallel(fit, [*([None] if boosted else []), *order], at_once, df)
    trees = fitted.pop(0) if boosted else []
    of_task = dict(zip(order, fitted))
    kept = ["fold", "id", "label"]
    out = []
    for name, fold in others:
        out.append(score(of_task[name, fold], parts[fold][1], kept).select(F.lit(name).alias("model"), *_as_scored(df)))
    if boosted:
        given = few(df, rows)
        if whole:
            given = given.select("id", "label", "fold", "features").unionByName(few(whole[1], rows).select("id", "label", F.lit(TEST).alias("fold"), "features"))
        scored = boosting.held_out(given, [replace(c, fold=t[1]) for c, t in zip(candidates, boosted)], trees, stages).withColumn("confidence", F.array_max("probability"))
        best = (F.array_position("probability", F.array_max("probability")) - 1).cast("int")
        out.append(scored.withColumn("prediction", best).select("model", *_as_scored(df)))
    return materialise(reduce(DataFrame.unionByName, out))


def _as_scored(df: DataFrame) -> list[Column]:
    """The columns of a prediction table besides the model."""
    kinds = {"fold": "int", "id": df.schema["id"].dataType.simpleString(), "label": "int", "prediction": "int"}
    return [*[F.col(c).cast(t).alias(c) for c, t in kinds.items()], F.col("probability"), F.col("confidence")]


def _parallel(work: Callable, items: Sequence, parallelism: int, df: DataFrame) -> list:
    pool = ThreadPool(min(parallelism, len(items)))
    try:
        return pool.map(inheritable_thread_target(df.sparkSession)(work), items, chunksize=1)
    finally:
        pool.close()


def fold_metrics(predictions: DataFrame) -> DataFrame:
    """Metrics per candidate and fold, from one confusion table of all of them."""
    keys = ["model", "fold"]
    return m.averages(m.class_report(m.confusion(predictions, keys), keys), keys)


def predictions_of(
    builds: Mapping[str, Callable[[DataFrame], Estimator]], train: DataFrame, test: DataFrame, folds: int, parallelism: int = PARALLEL_FITS
) -> DataFrame:
    """Every prediction that a validation needs, written once: out of fold for the training rows (fold 0 and up, dealt
    by label), and of models fitted on all training rows for the test rows (fold `TEST`)."""
    dealt_out = stratified_folds(train, "label", "id", folds)
    return fit_folds(dealt_out, builds, range(folds), parallelism=parallelism, whole=(train, test))


def validation_report(predictions: DataFrame) -> DataFrame:
    """One row per model: all test metrics, mean and spread of the folds, Brier score and calibration error (means over
    classes), and the confidence of right and wrong predictions. Every number is a grouping of the prediction table."""
    test = predictions.where(F.col("fold") == TEST)
    inside = fold_metrics(predictions.where(F.col("fold") != TEST))
    names = ("f1_weighted", "accuracy")
    spread = [f.alias(f"cv_{c}_{kind}") for c in names for f, kind in ((F.avg(c), "mean"), (F.stddev_pop(c), "std"))]
    bins = m.calibration(test)
    gap = F.abs(F.col("mean_predicted") - F.col("fraction_positive"))
    # each class weighs by its rows in the bin; every class has all rows
    error = bins.groupBy("model").agg((F.sum(gap * F.col("n")) / F.sum("n")).alias("calibration_error"))
    parts = [
        inside.groupBy("model").agg(*spread, F.count(F.lit(1)).alias("folds")),
        m.brier(test).groupBy("model").agg(F.avg("brier").alias("brier")),
        error,
        m.confidence_profile(test).select("model", F.col("mean").alias("confidence_mean"), "correct_mean", "incorrect_mean", "separation", "high_pct", "high_accuracy"),
    ]
    return reduce(lambda left, right: left.join(right, "model"), parts, evaluate(test))


def cross_validate(
    df: DataFrame, build: Callable[[DataFrame], Estimator], folds: Sequence[int], name: str, expanding: bool = False
) -> DataFrame:
    """`(model, fold, accuracy, f1_weighted, ...)` of one candidate."""
    return fold_metrics(fit_folds(df, {name: build}, folds, expanding))


def grid_points(grid: Mapping[str, Sequence]) -> list[dict]:
    names = list(grid)
    return [dict(zip(names, values)) for values in itertools.product(*grid.values())]


def draw_points(grid: Mapping[str, Sequence], n: int, seed: int = SEED) -> list[dict]:
    """n different grid points in a seeded order; all of them if there are fewer."""
    points = grid_points(grid)
    return random.Random(seed).sample(points, min(n, len(points)))


def search(
    df: DataFrame, build: Callable[..., Estimator], points: Sequence[dict], folds: Sequence[int], metric: str = "f1_weighted"
) -> DataFrame:
    """`(params, mean, std, rank)` of each parameter set over the folds; ties to the earlier set."""
    named = {f"{i:03d} " + ", ".join(f"{k}={v}" for k, v in p.items()): p for i, p in enumerate(points)}
    builds = {name: (lambda train, p=point: build(train, **p)) for name, point in named.items()}
    scores = fold_metrics(fit_folds(df, builds, folds))
    means = scores.groupBy(F.col("model").alias("params")).agg(F.avg(metric).alias("mean"), F.stddev_pop(metric).alias("std"))
    # one row per parameter set
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("mean"), "params")
    return means.withColumn("rank", F.row_number().over(order))


def iterative_impute(
    df: DataFrame, columns: Sequence[str], rounds: int = 10, ridge: float = 1e-3, tolerance: float = 1e-3
) -> DataFrame:
    """Round-robin regression: each incomplete column is predicted from the others until values settle.

    Starts from column means; columns with fewest gaps go first. Each round keeps only coefficients and
    cuts the lineage, so the plan does not grow with the rounds.
    """
    gaps = df.agg(*[F.sum((F.col(c).isNull() | F.isnan(c)).cast("int")).alias(c) for c in columns]).first()
    means = df.agg(*[F.avg(F.when(~F.isnan(c), F.col(c))).alias(c) for c in columns]).first()
    spans = df.agg(*[(F.max(F.abs(F.when(~F.isnan(c), F.col(c))))).alias(c) for c in columns]).first()
    order = sorted((c for c in columns if gaps[c]), key=lambda c: (gaps[c], c))
    state = df.withColumns({f"__gap_{c}": F.col(c).isNull() | F.isnan(c) for c in order})
    state = materialise(state.withColumns({c: F.when(F.col(f"__gap_{c}"), F.lit(means[c])).otherwise(F.col(c)) for c in order}))
    for _ in range(rounds):
        before = {c: F.col(c).alias(f"__old_{c}") for c in order}
        current = state.select("*", *before.values())
        for c in order:
            others = [o for o in columns if o != c]
            train = VectorAssembler(inputCols=others, outputCol="__x").transform(current.where(~F.col(f"__gap_{c}")))
            fit = LinearRegression(featuresCol="__x", labelCol=c, regParam=ridge, solver="normal").fit(train.select("__x", c))
            guess = F.lit(float(fit.intercept))
            for o, weight in zip(others, fit.coefficients):
                guess = guess + F.lit(float(weight)) * F.col(o)
            current = current.withColumn(c, F.when(F.col(f"__gap_{c}"), guess).otherwise(F.col(c)))
        current = materialise(current)
        moved = current.agg(*[F.max(F.abs(F.col(c) - F.col(f"__old_{c}"))).alias(c) for c in order]).first()
        state = current.drop(*[f"__old_{c}" for c in order])
        if all((moved[c] or 0.0) <= tolerance * (spans[c] or 1.0) for c in order):
            break
    return state.drop(*[f"__gap_{c}" for c in order])


def pca(df: DataFrame, components: int, vector: str = "features"):
    """`(fitted centring, fitted PCA)`; features are centred first, as Spark's PCA does not centre on transform."""
    centring = StandardScaler(inputCol=vector, outputCol="__centred", withMean=True, withStd=False).fit(df)
    return centring, PCA(k=components, inputCol="__centred", outputCol="components").fit(centring.transform(df))
