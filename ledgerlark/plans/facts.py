"""What must hold of results that SQL cannot recompute: kept values, sums, shares, floors, and saved steps."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.operators import explain as ex
from ledgerlark.operators import features as ft
from ledgerlark.operators import models as ml
from ledgerlark.plans.learning import PREDICTORS, _frame, _split
from ledgerlark.plans.operations import stream_scores
from ledgerlark.plans.registry import query
from ledgerlark.plans.testing import ab_interval, random_assign
from ledgerlark.session import materialise, run_dir
from ledgerlark.sources.accounts import NUMERIC_FEATURES, accounts
from ledgerlark.sources.tables import table

ACCURACY_FLOOR = 0.8


@query("""
SELECT count(*) AS n, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS changed, true AS settled FROM lineitem""")
def iterative_impute_facts(spark: SparkSession, folder: str) -> DataFrame:
    """All gaps filled within ten rounds, given values kept, and filled ones inside twice the range of given ones."""
    key = F.col("l_orderkey")
    given = table(spark, folder, "lineitem").select(
        F.monotonically_increasing_id().alias("row"), F.when(key % 10 != 0, F.col("l_quantity")).alias("l_quantity"),
        F.when(key % 7 != 0, F.col("l_extendedprice")).alias("l_extendedprice"), "l_tax",
    )
    given = materialise(given)
    filled = ml.iterative_impute(given, ["l_quantity", "l_extendedprice", "l_tax"], rounds=10)
    both = filled.join(given.select("row", F.col("l_quantity").alias("q"), F.col("l_extendedprice").alias("p")), "row")
    wrong = [F.col(g).isNotNull() & (F.col(g) != F.col(c)) for c, g in (("l_quantity", "q"), ("l_extendedprice", "p"))]
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("l_quantity").isNull() | F.col("l_extendedprice").isNull()).cast("long")).alias("missing"),
        F.sum((wrong[0] | wrong[1]).cast("long")).alias("changed"),
        ((F.max("l_quantity") <= 2 * F.max("q")) & (F.max("l_extendedprice") <= 2 * F.max("p"))).alias("settled"),
    )


@query("""
SELECT CAST(c AS INTEGER) AS component, true AS centred, true AS explained, true AS ordered FROM (SELECT unnest(range(5)) AS c)""")
def pca_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Projections have mean 0 and their explained share of the whole variance, the largest first."""
    df = table(spark, folder, "embeddings").select(F.col("embedding").cast("array<double>").alias("x"))
    width = len(df.first()["x"])
    total = df.agg(sum((F.var_samp(F.col("x")[i]) for i in range(1, width)), F.var_samp(F.col("x")[0]))).first()[0]
    vectors = df.select(array_to_vector("x").alias("features"))
    centring, model = ml.pca(vectors, 5)
    shares = [float(v) for v in model.explainedVariance]
    projected = model.transform(centring.transform(vectors)).select(F.posexplode(vector_to_array("components")).alias("component", "value"))
    spread = projected.groupBy("component").agg(F.avg("value").alias("mean"), F.var_samp("value").alias("variance"))
    share = F.array(*[F.lit(v) for v in shares])[F.col("component")]
    earlier = F.array(*[F.lit(v) for v in [1.0, *shares]])[F.col("component")]
    return spread.select(
        "component", (F.abs("mean") < 1e-6).alias("centred"), (F.abs(F.col("variance") / total - share) < 1e-6).alias("explained"),
        (share <= earlier).alias("ordered"),
    )


@query("SELECT count(*) AS n, true AS two_variants, true AS even FROM events")
def random_assign_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Every event has a variant, and the halves differ by chance only (five standard errors)."""
    sizes = random_assign(spark, folder)
    total = F.sum("n")
    return sizes.agg(
        total.alias("n"), (F.count(F.lit(1)) == 2).alias("two_variants"), (F.max("n") - F.min("n") <= 5 * F.sqrt(total)).alias("even")
    )


@query("SELECT unnest([true, true, true]) AS symmetric_and_consistent")
def ab_interval_facts(spark: SparkSession, folder: str) -> DataFrame:
    """The difference is the middle of its interval, and the interval leaves out 0 just where p is below 0.05."""
    low, high, p = F.col("ci_lower"), F.col("ci_upper"), F.col("p_value")
    middle = F.abs((low + high) / 2 - F.col("difference")) < 1e-9
    agreed = ((low > 0) | (high < 0)) == (p < 0.05)
    return ab_interval(spark, folder).select((middle & agreed & p.between(0, 1)).alias("symmetric_and_consistent"))


@query("""
SELECT unnest(['logistic', 'random_forest']) AS model, true AS above_floor, true AS sums_to_one""")
def model_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy on the test part above the stated floor, and probabilities that add up."""
    train, test = ml.scaled(*_split(_frame(spark, folder)))
    train, test = materialise(train), materialise(test)
    out = None
    for name, estimator in (("logistic", ml.logistic(train.count())), ("random_forest", ml.random_forest())):
        scored = ml.score(estimator.fit(train), test).withColumn("model", F.lit(name))
        out = scored if out is None else out.unionByName(scored)
    whole = F.aggregate("probability", F.lit(0.0), lambda a, v: a + v)
    return out.groupBy("model").agg(
        (F.avg((F.col("label") == F.col("prediction")).cast("int")) >= ACCURACY_FLOOR).alias("above_floor"),
        (F.max(F.abs(whole - 1)) < 1e-9).alias("sums_to_one"),
    )


@query("SELECT count(*) AS n, CAST(0 AS BIGINT) AS not_additive FROM customer")
def shapley_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Attributions of every account add up to the change of its probability from the baseline; four orders."""
    frame = ml.training_frame(accounts(spark, folder), PREDICTORS, "payment_status", "customer_id")
    fitted = ml.logistic(frame.count(), maxIter=50).fit(frame)
    model = PipelineModel([VectorAssembler(inputCols=PREDICTORS, outputCol="features"), fitted])
    rows = accounts(spark, folder).select("customer_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in PREDICTORS])
    means = ex.column_means(rows, PREDICTORS)
    totals = ex.sampled_shapley(rows, "customer_id", PREDICTORS, model, means, class_index=1).groupBy("row_id").agg(F.sum("shap_value").alias("total"))
    base = spark.createDataFrame([tuple(float(means[c]) for c in PREDICTORS)], PREDICTORS)
    chance = vector_to_array("probability")[1]
    start = model.transform(base).select(chance).first()[0]
    own = model.transform(rows).select(F.col("customer_id").alias("row_id"), (chance - F.lit(start)).alias("change"))
    return own.join(totals, "row_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.abs(F.col("total") - F.col("change")) > 1e-9).cast("long")).alias("not_additive")
    )


@query("SELECT count(*) AS n, true AS confident FROM lineitem")
def stream_score_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Every line item is scored once, with a confidence no lower than an even guess."""
    return stream_scores(spark, folder).agg(F.sum("n").alias("n"), (F.min("mean_confidence") >= 1 / 3).alias("confident"))


@query("SELECT count(*) AS n, CAST(0 AS BIGINT) AS different FROM customer")
def saved_steps_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Steps that were saved and loaded transform every row as the fitted ones do."""
    numeric = [c for c in NUMERIC_FEATURES if c != "customer_age"]
    df = materialise(accounts(spark, folder).select("customer_id", "employment_status", *numeric))
    fitted = Pipeline(stages=[
        ft.ColumnImputer(inputCols=numeric, method="median"),
        ft.OutlierCapper(inputCols=numeric, method="iqr"),
        ft.ColumnScaler(inputCols=numeric, method="robust"),
        ft.OneHot(inputCols=["employment_status"]),
        ft.Interactions(inputCols=numeric),
    ]).fit(df)
    path = run_dir(spark, "saved-steps")
    fitted.write().overwrite().save(path)
    hashed = lambda model, name: model.transform(df).select("customer_id", F.xxhash64(*[c for c in model.transform(df).columns if c != "customer_id"]).alias(name))
    both = hashed(fitted, "first").join(hashed(PipelineModel.load(path), "second"), "customer_id")
    return both.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("first") != F.col("second")).cast("long")).alias("different"))
