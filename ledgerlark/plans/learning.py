"""Imputation by neighbours and regression, rebalancing, training, tuning and scoring queries."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.operators import features as ft
from ledgerlark.operators import models as ml
from ledgerlark.operators import neighbours as nn
from ledgerlark.operators import ranking
from ledgerlark.plans.registry import query
from ledgerlark.plans.views import ACCOUNTS
from ledgerlark.session import materialise, run_dir
from ledgerlark.sources.accounts import NUMERIC_FEATURES, accounts
from ledgerlark.sources.tables import table

PREDICTORS = ["credit_score", "days_overdue", "contact_attempts", "payment_history_score", "response_rate", "debt_to_income_ratio"]
NEAR = ["credit_score", "days_overdue", "debt_amount"]


@query(f"""
WITH {ACCOUNTS}, g AS (SELECT customer_id, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE annual_income END AS income, credit_score, days_overdue, coalesce(debt_amount, 0) AS debt_amount FROM accounts),
d AS (SELECT q.customer_id, o.income, row_number() OVER (PARTITION BY q.customer_id ORDER BY
    sqrt(power(q.credit_score - o.credit_score, 2) + power(q.days_overdue - o.days_overdue, 2) + power(q.debt_amount - o.debt_amount, 2)), o.customer_id) AS rn
  FROM g q JOIN g o ON q.income IS NULL AND o.income IS NOT NULL),
f AS (SELECT customer_id, avg(income) AS fill FROM d WHERE rn <= 5 GROUP BY 1)
SELECT customer_id, round(coalesce(income, fill), 4) AS annual_income, income IS NULL AS imputed FROM g LEFT JOIN f USING (customer_id)""")
def knn_impute(spark: SparkSession, folder: str) -> DataFrame:
    """Incomes removed by rule, filled from the five nearest accounts."""
    df = accounts(spark, folder).select(
        "customer_id", F.when(F.col("c_custkey") % 9 != 0, F.col("annual_income")).alias("annual_income"),
        "credit_score", "days_overdue", F.coalesce("debt_amount", F.lit(0.0)).alias("debt_amount"),
        (F.col("c_custkey") % 9 == 0).alias("imputed"),
    )
    filled = nn.knn_impute(df, "customer_id", NEAR, "annual_income")
    return filled.select("customer_id", F.round("annual_income", 4).alias("annual_income"), "imputed")


@query("""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
d AS (SELECT a.vec_id AS id, b.vec_id AS neighbour_id, list_distance(a.e, b.e) AS dist FROM v a JOIN v b ON a.vec_id <> b.vec_id)
SELECT id, neighbour_id, round(dist, 5) AS distance, CAST(rn AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, neighbour_id) AS rn FROM d) WHERE rn <= 5""")
def neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest other vectors of every vector."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    found = nn.neighbours_of(vectors, vectors, 5, "vec_id", "embedding", same_table=True)
    return found.withColumn("distance", F.round("distance", 5))


@query(f"""
WITH {ACCOUNTS}, c AS (SELECT payment_status, count(*) AS original FROM accounts GROUP BY 1)
SELECT payment_status, original, (SELECT max(original) FROM c) - original AS synthetic, (SELECT max(original) FROM c) AS total FROM c""")
def smote_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Class sizes before and after rebalancing."""
    df = accounts(spark, folder).select("customer_id", "payment_status", *PREDICTORS).na.fill(0.0)
    balanced = nn.smote(df, "payment_status", "customer_id", PREDICTORS)
    return balanced.groupBy("payment_status").agg(
        F.sum((~F.col("synthetic")).cast("int")).alias("original"),
        F.sum(F.col("synthetic").cast("int")).alias("synthetic"),
        F.count(F.lit(1)).alias("total"),
    )


@query()
def iterative_impute(spark: SparkSession, folder: str) -> DataFrame:
    """Quantity and price with gaps, filled from each other and the tax until they settle."""
    key = F.col("l_orderkey")
    df = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(key % 10 != 0, F.col("l_quantity")).alias("l_quantity"),
        F.when(key % 7 != 0, F.col("l_extendedprice")).alias("l_extendedprice"),
        "l_tax",
    )
    filled = ml.iterative_impute(df, ["l_quantity", "l_extendedprice", "l_tax"])
    return filled.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("l_quantity").isNull().cast("int")).alias("missing_quantity"),
        F.sum(F.col("l_extendedprice").isNull().cast("int")).alias("missing_price"),
        F.avg("l_quantity").alias("mean_quantity"),
        F.avg("l_extendedprice").alias("mean_price"),
    )


@query()
def pca_variance(spark: SparkSession, folder: str) -> DataFrame:
    """Explained variance of five components and the spread of the centred projections."""
    df = table(spark, folder, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    centring, model = ml.pca(df, 5)
    projected = model.transform(centring.transform(df)).select(F.posexplode(vector_to_array("components")).alias("component", "value"))
    spread = projected.groupBy("component").agg(F.avg("value").alias("mean"), F.var_samp("value").alias("variance"))
    ratio = F.array(*[F.lit(float(v)) for v in model.explainedVariance])
    return spread.select("component", "mean", "variance", ratio[F.col("component")].alias("explained"))


# all models with their presets; search points override them
BUILDS = {
    "random_forest": lambda train, **p: ml.random_forest(**p),
    "boosted_trees": lambda train, **p: ml.BoostedPerClass(3, **p),
    "logistic": lambda train, **p: ml.logistic(train.count(), **p),
}


def _frame(spark: SparkSession, folder: str) -> DataFrame:
    return ml.training_frame(accounts(spark, folder), PREDICTORS, "payment_status", "customer_id")


def _split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    parts = ft.stratified_split(df, "label", "id")
    # written once: every statistic, fit and score reads these tables
    return materialise(ml.dealt(parts.where("part = 'train'").drop("part"))), materialise(parts.where("part = 'test'").drop("part"))


def _scores(spark: SparkSession, folder: str, build, name: str) -> DataFrame:
    """Fit on the training part, score the test part, report all metrics."""
    train, test = ml.scaled(*_split(_frame(spark, folder)))
    model = build(train).fit(train)
    return ml.evaluate(materialise(ml.score(model, test).withColumn("model", F.lit(name))))


@query()
def rf_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(spark, folder, lambda train: ml.random_forest(), "random_forest")


@query()
def logit_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(spark, folder, lambda train: ml.logistic(train.count()), "logistic")


@query()
def gbt_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(spark, folder, lambda train: ml.BoostedPerClass(3), "boosted_trees")


@query()
def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Three models trained on rebalanced rows, validated on one test part, ranked, and the choice marked."""
    train, test = _split(_frame(spark, folder))
    flat = train.select("id", "payment_status", vector_to_array("features").alias("x")).select(
        "id", "payment_status", *[F.col("x")[i].alias(c) for i, c in enumerate(PREDICTORS)]
    )
    balanced = ml.training_frame(nn.smote(flat, "payment_status", "id", PREDICTORS), PREDICTORS, "payment_status", "id")
    train, test = ml.scaled(balanced, test)
    builds = {name: build(train) for name, build in BUILDS.items()}
    scored = ml.validate(builds, train, test)
    ranked = ranking.rank_models(scored)
    return ranked.withColumn("selection_score", ranking.selection_score())


@query()
def param_search(spark: SparkSession, folder: str) -> DataFrame:
    """All points of every model's grid, three stratified folds each."""
    df = ft.stratified_folds(_frame(spark, folder), "label", "id", 3)
    points = [{"model": name, **p} for name, grid in ml.GRIDS.items() for p in ml.grid_points(grid)]
    return ml.search(df, lambda train, model, **p: BUILDS[model](train, **p), points, range(3))


@query()
def cv_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Every model over five time-ordered folds by latest order date (here days overdue, oldest first)."""
    df = _frame(spark, folder)
    dated = df.withColumn("age", -vector_to_array("features")[PREDICTORS.index("days_overdue")])
    folds = ft.time_folds(dated, ["age", "id"], 5).drop("age")
    return ml.fold_metrics(ml.fit_folds(folds, BUILDS, range(5), expanding=True))


@query()
def fitted_transforms(spark: SparkSession, folder: str) -> DataFrame:
    """All preprocessing and feature steps fitted as one, saved, loaded and applied."""
    numeric = [c for c in NUMERIC_FEATURES if c != "customer_age"]
    # every step reads its input anew to fit, so the view is written once first
    df = materialise(accounts(spark, folder).select("customer_id", "payment_status", "employment_status", "debt_type", *numeric))
    before = Pipeline(stages=[
        ft.ColumnImputer(inputCols=numeric, method="median"),
        ft.ColumnImputer(inputCols=["employment_status", "debt_type"], method="most_frequent"),
        ft.OutlierCapper(inputCols=numeric, method="iqr"),
        ft.ColumnScaler(inputCols=numeric, method="standard"),
        ft.OneHot(inputCols=["employment_status", "debt_type"]),
        ft.DomainFeatures(inputCols=numeric),
        ft.Interactions(inputCols=numeric),
    ])
    first = before.fit(df)
    wide = [c for c in first.transform(df).columns if c not in ("customer_id", "payment_status")]
    after = Pipeline(stages=[first, ft.BestFeatures(inputCols=wide, labelCol="payment_status", k=20)]).fit(df)
    path = run_dir(spark, "fitted")
    after.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    chosen = loaded.stages[-1].output_columns()
    vectors = VectorAssembler(inputCols=chosen, outputCol="features").transform(loaded.transform(df))
    values = vectors.select(F.posexplode(vector_to_array("features")).alias("at", "value"))
    names = F.array(*[F.lit(c) for c in chosen])
    return values.groupBy("at").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")).select(
        names[F.col("at")].alias("feature"), "n", "mean", "std"
    )
