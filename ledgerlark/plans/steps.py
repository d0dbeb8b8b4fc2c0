"""Searches by buckets, imputers and codes as saved steps, boosted trees and whole validation."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.operators import features as ft
from ledgerlark.operators import impute as im
from ledgerlark.operators import models as ml
from ledgerlark.operators import neighbours as nn
from ledgerlark.plans.learning import BUILDS, PREDICTORS, _frame, _split
from ledgerlark.plans.registry import query
from ledgerlark.plans.views import ACCOUNTS
from ledgerlark.session import materialise, run_dir
from ledgerlark.sources.accounts import NUMERIC_FEATURES, accounts

GAPS = {"annual_income": 9, "credit_score": 7, "days_overdue": 11}  # a value goes where the key is a multiple


def _standardised(spark: SparkSession, folder: str) -> DataFrame:
    df = accounts(spark, folder).select("customer_id", *PREDICTORS).na.fill(0.0)
    scaled = ft.ColumnScaler(inputCols=PREDICTORS, method="standard").fit(df).transform(df)
    return materialise(scaled.select("customer_id", F.array(*PREDICTORS).alias("v")))


@query()
def neighbours_hashed(spark: SparkSession, folder: str) -> DataFrame:
    """Five near accounts of every account, from random-projection buckets."""
    rows = _standardised(spark, folder)
    found = nn.neighbours_of(rows, rows, 5, "customer_id", "v", same_table=True, how=nn.Hashing())
    return found.withColumn("distance", F.round("distance", 5))


@query("SELECT count(*) AS n, true AS recall_reached, true AS fewer_pairs, true AS distances_exact FROM customer")
def neighbours_hashed_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Against the exact search: at least nine tenths of the neighbours, less than half of the pairs (a share that
    falls with the rows), and no distance smaller than the exact one of its rank."""
    rows = _standardised(spark, folder)
    exact = nn.neighbours_of(rows, rows, 5, "customer_id", "v", same_table=True)
    near = nn.neighbours_of(rows, rows, 5, "customer_id", "v", same_table=True, how=nn.Hashing())
    # of neighbours at one distance any may be named, so a rank is met if its distance is
    both = exact.select("id", "rank", F.col("distance").alias("best")).join(near.select("id", "rank", "distance"), ["id", "rank"], "left")
    met = (F.col("distance") <= F.col("best") + 1e-9).cast("int")
    share = nn.pairs_met(rows, rows, 6, "customer_id", "v").select((F.col("pairs") / F.col("all_pairs")).alias("share")).first()[0]
    return both.agg(
        F.countDistinct("id").alias("n"), (F.avg(F.coalesce(met, F.lit(0))) >= 0.9).alias("recall_reached"), F.lit(share < 1 / 2).alias("fewer_pairs"),
        (F.min(F.coalesce(F.col("distance") - F.col("best"), F.lit(0.0))) >= -1e-9).alias("distances_exact"),
    )


def _with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    rows = accounts(spark, folder)
    return rows.select("customer_id", "c_custkey", *[F.when(F.col("c_custkey") % n != 0, F.col(c).cast("double")).alias(c) for c, n in GAPS.items()])


def _fill_sql(column: str) -> str:
    return f"""(SELECT customer_id, avg(given) AS fill FROM (SELECT customer_id, o_{column} AS given,
        row_number() OVER (PARTITION BY customer_id ORDER BY sqrt(3.0::DOUBLE / shared * total), giver) AS rn
        FROM pairs WHERE {column} IS NULL AND o_{column} IS NOT NULL) WHERE rn <= 5 GROUP BY 1)"""


@query(f"""
WITH {ACCOUNTS}, g AS (SELECT customer_id, {', '.join(f'CASE WHEN c_custkey % {n} <> 0 THEN CAST({c} AS DOUBLE) END AS {c}' for c, n in GAPS.items())} FROM accounts),
pairs AS (SELECT * FROM (SELECT q.*, o.customer_id AS giver, {', '.join(f'o.{c} AS o_{c}' for c in GAPS)},
    {' + '.join(f'(q.{c} IS NOT NULL AND o.{c} IS NOT NULL)::INT' for c in GAPS)} AS shared,
    {' + '.join(f'coalesce((q.{c} - o.{c}) * (q.{c} - o.{c}), 0)' for c in GAPS)} AS total
  FROM g q JOIN g o ON q.annual_income IS NULL OR q.credit_score IS NULL OR q.days_overdue IS NULL) WHERE shared > 0)
SELECT g.customer_id, {', '.join(f'round(coalesce(g.{c}, f_{c}.fill, (SELECT avg({c}) FROM g)), 4) AS {c}' for c in GAPS)}
FROM g {' '.join(f'LEFT JOIN {_fill_sql(c)} f_{c} ON f_{c}.customer_id = g.customer_id' for c in GAPS)}""")
def knn_impute_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Three columns with gaps in each, filled in one pass from the nearest accounts by missing-aware distance."""
    df = _with_gaps(spark, folder)
    model = im.NeighbourImputer(inputCols=[*GAPS], idCol="customer_id").fit(df)
    return model.transform(df).select("customer_id", *[F.round(c, 4).alias(c) for c in GAPS])


@query("""
SELECT branch, count(*) AS n, CAST(0 AS BIGINT) AS different, CAST(0 AS BIGINT) AS missing
FROM customer, (VALUES ('iterative, ordinal'), ('knn, onehot'), ('knn, ordinal')) AS b(branch) GROUP BY branch""")
def preprocessing_branches_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Preprocessing by each imputer and encoder, fitted on half of the accounts, saved, loaded and applied to all: the
    loaded steps give what the fitted ones give, and leave no gap."""
    words = ["employment_status", "debt_type"]
    keys = accounts(spark, folder).select("customer_id", *words)
    df = materialise(_with_gaps(spark, folder).join(keys, "customer_id"))
    imputers = {"knn": im.NeighbourImputer(inputCols=[*GAPS], idCol="customer_id"), "iterative": im.RegressionImputer(inputCols=[*GAPS])}
    encoders = {"onehot": ft.OneHot(inputCols=words), "ordinal": im.OrdinalCoder(inputCols=words)}
    out = None
    for imputer, encoder in (("knn", "onehot"), ("knn", "ordinal"), ("iterative", "ordinal")):
        fitted = Pipeline(stages=[
            imputers[imputer], ft.OutlierCapper(inputCols=[*GAPS], method="iqr"), ft.ColumnScaler(inputCols=[*GAPS], method="standard"),
            ft.ColumnImputer(inputCols=words, method="most_frequent"), encoders[encoder],
        ]).fit(df.where("c_custkey % 2 = 0"))
        path = run_dir(spark, "branch")
        fitted.write().overwrite().save(path)
        first, second = (_hashed(m.transform(df), name) for m, name in ((fitted, "first"), (PipelineModel.load(path), "second")))
        both = first.join(second.drop("missing"), "customer_id").select(F.lit(f"{imputer}, {encoder}").alias("branch"), "first", "second", "missing")
        out = both if out is None else out.unionByName(both)
    return out.groupBy("branch").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("first") != F.col("second")).cast("long")).alias("different"), F.sum("missing").cast("long").alias("missing")
    )


def _hashed(df: DataFrame, name: str) -> DataFrame:
    columns = sorted(c for c in df.columns if c not in ("customer_id", "c_custkey"))
    values = [F.round(F.col(c).cast("double"), 9) for c in columns]
    gaps = F.greatest(*[v.isNull().cast("int") for v in values])
    return df.select("customer_id", F.xxhash64(*values).alias(name), gaps.alias("missing"))


def walked(model: ml.BoostedPerClassModel, df: DataFrame) -> DataFrame:
    """`(id, probability)` by joins of rows and nodes, level by level: what the written trees say, without the model."""
    nodes = model.table
    depth = nodes.agg(F.floor(F.log2(F.max("node") + 1))).first()[0]
    rows = df.select("id", vector_to_array("features").alias("x"))
    classes = model.fitted()["classes"]
    trees = F.sequence(F.lit(0), F.lit(model.fitted()["rounds"] * classes - 1))
    at = rows.withColumn("t", F.explode(trees)).select(
        "id", "x", F.floor(F.col("t") / classes).cast("int").alias("round"), (F.col("t") % classes).alias("class"), F.lit(0).alias("node")
    )
    for _ in range(int(depth)):
        here = at.join(nodes.drop("value"), ["round", "class", "node"])
        right = (~F.coalesce(F.get("x", F.col("feature")) <= F.col("threshold"), F.lit(False))).cast("int")
        at = here.select("id", "x", "round", "class", F.when(F.col("feature") >= 0, 2 * F.col("node") + 1 + right).otherwise(F.col("node")).alias("node"))
    sums = at.join(nodes.select("round", "class", "node", "value"), ["round", "class", "node"]).groupBy("id", "class").agg(F.exp(F.sum("value")).alias("e"))
    share = F.col("e") / F.sum("e").over(Window.partitionBy("id"))
    shares = F.array_sort(F.collect_list(F.struct("class", "share")))
    return sums.withColumn("share", share).groupBy("id").agg(F.transform(shares, lambda s: s["share"]).alias("probability"))


@query("SELECT count(*) AS n, CAST(0 AS BIGINT) AS different, true AS above_floor FROM customer")
def boosted_facts(spark: SparkSession, folder: str) -> DataFrame:
    """A boosted model at its preset, fitted on the training part, saved and loaded: its probabilities equal those that
    joins over the written trees give, for every account, and its accuracy on the test part is above 0.8."""
    frame = _frame(spark, folder)
    train, test = _split(frame)
    path = run_dir(spark, "boosted")
    ml.BoostedPerClass(3).fit(train).write().overwrite().save(path)
    model = ml.BoostedPerClassModel.load(path)
    scored = ml.score(model, frame)
    expected = walked(model, frame).withColumnRenamed("probability", "expected")
    gap = F.aggregate(F.zip_with("probability", "expected", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda a, v: F.greatest(a, v))
    held = test.select("id", F.lit(True).alias("held"))
    right = F.when(F.col("held"), (F.col("label") == F.col("prediction")).cast("int"))
    return scored.join(expected, "id").join(held, "id", "left").agg(
        F.count(F.lit(1)).alias("n"), F.sum((gap > 1e-9).cast("long")).alias("different"), (F.avg(right) >= 0.8).alias("above_floor")
    )


@query()
def full_validation(spark: SparkSession, folder: str) -> DataFrame:
    """Every model at its preset: test metrics, five stratified folds, Brier score, calibration and confidence."""
    predictions = ml.predictions_of(BUILDS, *_split(_frame(spark, folder)), folds=5)
    return ml.validation_report(predictions)


VALIDATION_SQL = """
WITH test AS (SELECT *, array_max(probability) AS top FROM predictions WHERE fold = -1),
cells AS (SELECT model, pos AS class, p, CAST(label = pos AS INT) AS hit FROM test LATERAL VIEW posexplode(probability) AS pos, p),
per_class AS (SELECT model, c AS class, sum(CAST(label = c AND prediction = c AS INT)) AS tp, sum(CAST(label = c AS INT)) AS support, sum(CAST(prediction = c AS INT)) AS named
  FROM test LATERAL VIEW explode(sequence(0, 2)) AS c GROUP BY model, c),
f1 AS (SELECT model, sum(support * CASE WHEN support + named > 0 THEN 2.0D * tp / (support + named) ELSE 0 END) / sum(support) AS f1_weighted FROM per_class WHERE support + named > 0 GROUP BY model),
folds AS (SELECT model, avg(a) AS cv_accuracy_mean, stddev_pop(a) AS cv_accuracy_std FROM (SELECT model, fold, avg(CAST(label = prediction AS INT)) AS a FROM predictions WHERE fold >= 0 GROUP BY model, fold) GROUP BY model),
brier AS (SELECT model, avg(b) AS brier FROM (SELECT model, class, avg((p - hit) * (p - hit)) AS b FROM cells GROUP BY model, class) GROUP BY model)
SELECT test.model, avg(CAST(label = prediction AS INT)) AS accuracy, any_value(f1_weighted) AS f1_weighted, any_value(cv_accuracy_mean) AS cv_accuracy_mean,
  any_value(cv_accuracy_std) AS cv_accuracy_std, any_value(brier.brier) AS brier, avg(top) AS confidence_mean
FROM test JOIN f1 USING (model) JOIN folds USING (model) JOIN brier USING (model) GROUP BY test.model"""


@query("SELECT unnest(['logistic', 'random_forest']) AS model, true AS agrees, true AS above_floor")
def validation_facts(spark: SparkSession, folder: str) -> DataFrame:
    """The report of two models against plain SQL over their written predictions."""
    builds = {name: BUILDS[name] for name in ("logistic", "random_forest")}
    predictions = ml.predictions_of(builds, *_split(_frame(spark, folder)), folds=3)
    plain = spark.sql(VALIDATION_SQL.replace("predictions", "{predictions}"), predictions=predictions)
    names = [c for c in plain.columns if c != "model"]
    both = ml.validation_report(predictions).join(plain.select("model", *[F.col(c).alias(f"__{c}") for c in names]), "model")
    agree = F.greatest(*[F.abs(F.col(c) - F.col(f"__{c}")) for c in names]) < 1e-9
    return both.select("model", agree.alias("agrees"), (F.col("accuracy") >= 0.8).alias("above_floor"))
