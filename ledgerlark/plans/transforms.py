"""Preprocessing, feature and fold queries."""

from __future__ import annotations

from itertools import combinations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.rules import clip
from ledgerlark.operators import features as ft
from ledgerlark.operators.ordered import melt
from ledgerlark.operators.profile import iqr_bounds
from ledgerlark.plans.registry import query
from ledgerlark.plans.views import ACCOUNTS
from ledgerlark.session import run_dir
from ledgerlark.sources import tables
from ledgerlark.sources.accounts import NUMERIC_FEATURES, accounts
from ledgerlark.sources.tables import table

SCALED = ["annual_income", "debt_amount", "credit_score", "days_overdue"]
LEADING = ["credit_score", "debt_amount", "annual_income", "days_overdue", "contact_attempts", "response_rate"]


def digits_of(name: str) -> int:
    """Enough digits that no rounding tie can occur."""
    return {"ratio_1_2": 6, "ratio_3_4": 6, "feature_mean": 7}.get(name, 4)


def rounded(columns, digits: int = 6):
    return [F.round(c, digits).alias(c) for c in columns]


GAPS = """
gaps AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
    CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_extendedprice END AS l_extendedprice,
    CASE WHEN l_partkey % 20 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag FROM lineitem)"""


def with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("l_orderkey")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(key % 10 != 0, F.col("l_quantity")).alias("l_quantity"),
        F.when(key % 7 != 0, F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(F.col("l_partkey") % 20 != 0, F.col("l_returnflag")).alias("l_returnflag"),
    )


@query(f"""
WITH {GAPS}
SELECT l_orderkey, l_linenumber, round(coalesce(l_quantity, (SELECT avg(l_quantity) FROM gaps)), 6) AS l_quantity,
  round(coalesce(l_extendedprice, (SELECT quantile_cont(l_extendedprice, 0.5) FROM gaps)), 6) AS l_extendedprice,
  coalesce(l_returnflag, (SELECT l_returnflag FROM gaps WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS l_returnflag
FROM gaps""")
def impute_simple(spark: SparkSession, folder: str) -> DataFrame:
    """Mean, median and most frequent value for three columns with gaps."""
    steps = Pipeline(stages=[
        ft.ColumnImputer(inputCols=["l_quantity"], method="mean"),
        ft.ColumnImputer(inputCols=["l_extendedprice"], method="median"),
        ft.ColumnImputer(inputCols=["l_returnflag"], method="most_frequent"),
    ])
    df = with_gaps(spark, folder)
    return steps.fit(df).transform(df).select(
        "l_orderkey", "l_linenumber", *rounded(["l_quantity", "l_extendedprice"]), "l_returnflag"
    )


def _each(template: str, columns) -> str:
    return ", ".join(template.format(c=c) for c in columns)


CAPPED = ["debt_amount", "contact_attempts", "debt_to_income_ratio"]


@query(f"""
WITH {ACCOUNTS}, b AS (SELECT {_each('quantile_cont({c}, 0.25) AS {c}_1, quantile_cont({c}, 0.75) AS {c}_3', CAPPED)} FROM accounts)
SELECT customer_id, {_each('round(CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, {c}_1 - 1.5::DOUBLE * ({c}_3 - {c}_1)), {c}_3 + 1.5::DOUBLE * ({c}_3 - {c}_1)) END, 6) AS {c}', CAPPED)}
FROM accounts, b""")
def cap_iqr(spark: SparkSession, folder: str) -> DataFrame:
    df = accounts(spark, folder)
    return ft.OutlierCapper(inputCols=CAPPED, method="iqr").fit(df).transform(df).select("customer_id", *rounded(CAPPED))


@query(f"""
WITH {ACCOUNTS}, b AS (SELECT {_each('avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s', CAPPED)} FROM accounts)
SELECT customer_id, {_each('round(CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, {c}_m - 1.5::DOUBLE * {c}_s), {c}_m + 1.5::DOUBLE * {c}_s) END, 6) AS {c}', CAPPED)}
FROM accounts, b""")
def cap_zscore(spark: SparkSession, folder: str) -> DataFrame:
    df = accounts(spark, folder)
    return ft.OutlierCapper(inputCols=CAPPED, method="zscore").fit(df).transform(df).select("customer_id", *rounded(CAPPED))


def _scaled(spark: SparkSession, folder: str, method: str) -> DataFrame:
    df = accounts(spark, folder)
    return ft.ColumnScaler(inputCols=SCALED, method=method).fit(df).transform(df).select("customer_id", *rounded(SCALED))


@query(f"""
WITH {ACCOUNTS}, b AS (SELECT {_each('avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s', SCALED)} FROM accounts)
SELECT customer_id, {_each('round(({c} - {c}_m) / {c}_s, 6) AS {c}', SCALED)} FROM accounts, b""")
def scale_standard(spark: SparkSession, folder: str) -> DataFrame:
    return _scaled(spark, folder, "standard")


@query(f"""
WITH {ACCOUNTS}, b AS (SELECT {_each('quantile_cont({c}, 0.5) AS {c}_m, nullif(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 0) AS {c}_s', SCALED)} FROM accounts)
SELECT customer_id, {_each('round(({c} - {c}_m) / coalesce({c}_s, 1), 6) AS {c}', SCALED)} FROM accounts, b""")
def scale_robust(spark: SparkSession, folder: str) -> DataFrame:
    return _scaled(spark, folder, "robust")


@query(f"""
WITH {ACCOUNTS}, b AS (SELECT {_each('min({c}) AS {c}_m, nullif(max({c}) - min({c}), 0) AS {c}_s', SCALED)} FROM accounts)
SELECT customer_id, {_each('round(({c} - {c}_m) / coalesce({c}_s, 1), 6) AS {c}', SCALED)} FROM accounts, b""")
def scale_minmax(spark: SparkSession, folder: str) -> DataFrame:
    return _scaled(spark, folder, "minmax")


@query(f"""
WITH {ACCOUNTS}
SELECT customer_id, {_each("coalesce(CAST(employment_status = '{c}' AS DOUBLE), 0) AS employment_status_{c}", ['retired', 'self_employed', 'student', 'unemployed'])},
  {_each("coalesce(CAST(debt_type = '{c}' AS DOUBLE), 0) AS debt_type_{c}", ['credit_card', 'medical', 'mortgage', 'personal_loan'])} FROM accounts""")
def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    df = accounts(spark, folder).select("customer_id", "employment_status", "debt_type")
    return ft.OneHot(inputCols=["employment_status", "debt_type"]).fit(df).transform(df)


@query(f"""
WITH {ACCOUNTS}, known AS (SELECT debt_type, CAST(row_number() OVER (ORDER BY debt_type) - 1 AS DOUBLE) AS code
  FROM (SELECT DISTINCT debt_type FROM accounts WHERE employment_status = 'student' AND debt_type <> 'medical'))
SELECT customer_id, debt_type, coalesce(code, -1::DOUBLE) AS debt_code FROM accounts LEFT JOIN known USING (debt_type)""")
def ordinal(spark: SparkSession, folder: str) -> DataFrame:
    """Codes learnt on a part that never saw one category, which therefore gets -1."""
    df = accounts(spark, folder).select("customer_id", "employment_status", "debt_type")
    codes = ft.ordinal_codes(df.where((F.col("employment_status") == "student") & (F.col("debt_type") != "medical")), "debt_type")
    return ft.ordinal_encode(df, codes, "debt_type", "debt_code").select("customer_id", "debt_type", "debt_code")


@query(f"""
WITH {ACCOUNTS}
SELECT customer_id, payment_status, CAST(dense_rank() OVER (ORDER BY payment_status) - 1 AS DOUBLE) AS label FROM accounts""")
def label_encode(spark: SparkSession, folder: str) -> DataFrame:
    df = accounts(spark, folder).select("customer_id", "payment_status")
    return ft.ordinal_encode(df, ft.ordinal_codes(df, "payment_status"), "payment_status", "label").select(
        "customer_id", "payment_status", "label"
    )


LEADING_LIST = f"list_filter([{', '.join(LEADING)}], lambda x: x IS NOT NULL)"
STATISTICS_SQL = f"""
  round(list_sum({LEADING_LIST}), 4) AS feature_sum, round(list_sum({LEADING_LIST}) / len({LEADING_LIST}), 7) AS feature_mean,
  round(list_aggregate({LEADING_LIST}, 'stddev_samp'), 4) AS feature_std,
  round(list_max({LEADING_LIST}), 4) AS feature_max, round(list_min({LEADING_LIST}), 4) AS feature_min"""
PRODUCTS_SQL = """
  round(debt_amount / (credit_score + 0.001::DOUBLE), 6) AS ratio_1_2, round(days_overdue / (annual_income + 0.001::DOUBLE), 6) AS ratio_3_4,
  round(credit_score * debt_amount, 4) AS product_1_2, round(annual_income * days_overdue, 4) AS product_3_4"""
POWERS_SQL = """
  round(credit_score * credit_score, 4) AS squared_1, round(debt_amount * debt_amount, 4) AS squared_2,
  round(credit_score * credit_score * credit_score, 4) AS cubic_1"""
FLAGS_SQL = ", ".join(
    f"CASE WHEN {c} > {c}_3 THEN 1 ELSE 0 END AS high_risk_{i}, CASE WHEN {c} < {c}_1 THEN 1 ELSE 0 END AS low_risk_{i}"
    for i, c in enumerate(LEADING[:3])
)
FLAG_LIMITS = f"limits AS (SELECT {_each('quantile_cont({c}, 0.25) AS {c}_1, quantile_cont({c}, 0.75) AS {c}_3', LEADING[:3])} FROM accounts)"


@query(f"WITH {ACCOUNTS} SELECT customer_id, {PRODUCTS_SQL}, {STATISTICS_SQL}, {POWERS_SQL} FROM accounts")
def row_stats(spark: SparkSession, folder: str) -> DataFrame:
    added = {**ft.leading_products(LEADING), **ft.statistics_of(LEADING), **ft.leading_powers(LEADING)}
    return accounts(spark, folder).select(
        "customer_id", *[F.round(c, digits_of(name)).alias(name) for name, c in added.items()]
    )


@query(f"WITH {ACCOUNTS}, {FLAG_LIMITS} SELECT customer_id, {FLAGS_SQL} FROM accounts, limits")
def quartile_flags(spark: SparkSession, folder: str) -> DataFrame:
    df = accounts(spark, folder).select("customer_id", *LEADING)
    model = ft.DomainFeatures(inputCols=LEADING).fit(df)
    return df.select("customer_id", *[c.alias(name) for name, c in model.flags().items()])


PAIRS = list(combinations(LEADING[:4], 2))


@query(f"WITH {ACCOUNTS} SELECT customer_id, {', '.join(f'round({a} * {b}, 4) AS {a}_x_{b}' for a, b in PAIRS)} FROM accounts")
def interactions(spark: SparkSession, folder: str) -> DataFrame:
    step = ft.Interactions(inputCols=LEADING[:4])
    return step.transform(accounts(spark, folder)).select("customer_id", *rounded(step.output_columns(), 4))


@query(f"""
WITH {ACCOUNTS}, {FLAG_LIMITS}
SELECT {_each('round({c}, 4) AS {c}', LEADING)}, {PRODUCTS_SQL}, {STATISTICS_SQL}, {FLAGS_SQL}, {POWERS_SQL} FROM accounts, limits""")
def domain_features(spark: SparkSession, folder: str) -> DataFrame:
    """The whole block as one fitted step, after id and target are dropped."""
    df = accounts(spark, folder).select("customer_id", "payment_status", *LEADING).drop("customer_id", "payment_status", "absent")
    model = ft.DomainFeatures(inputCols=LEADING).fit(df)
    flags = list(model.flags())
    out = model.transform(df)
    return out.select(
        *[c if c in flags else F.round(c, digits_of(c)).alias(c) for c in out.columns]
    )


def _anova(column: str) -> str:
    return f"""
  SELECT '{column}' AS feature, (sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) AS f FROM (
    SELECT payment_status, count({column}) AS n, avg({column}) AS m, var_pop({column}) AS v,
      (SELECT avg({column}) FROM accounts) AS g FROM accounts GROUP BY 1)"""


@query(f"""
WITH {ACCOUNTS}, f AS ({' UNION ALL '.join(_anova(c) for c in NUMERIC_FEATURES)})
SELECT feature, round(f, 4) AS f_value FROM f ORDER BY f DESC LIMIT 5""")
def anova_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The five columns that separate the outcome best."""
    df = accounts(spark, folder).select("payment_status", *NUMERIC_FEATURES)
    scores = ft.anova_f(df, NUMERIC_FEATURES, "payment_status")
    return scores.orderBy(F.desc("f_value"), F.desc("feature")).limit(5).select("feature", F.round("f_value", 4).alias("f_value"))


@query(f"""
WITH {ACCOUNTS}, c AS (SELECT payment_status, count(*) AS n FROM accounts GROUP BY 1)
SELECT payment_status, n, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n), 6) AS weight FROM c""")
def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    return ft.class_weights(accounts(spark, folder), "payment_status").withColumn("weight", F.round("weight", 6))


@query(f"""
WITH {ACCOUNTS}
SELECT a.customer_id, round(a.debt_amount, 4) AS debt_amount, round(a.credit_score, 4) AS credit_score,
  round(a.debt_to_income_ratio, 6) AS debt_to_income_ratio, a.employment_status FROM accounts a""")
def column_concat(spark: SparkSession, folder: str) -> DataFrame:
    """Two blocks of columns put side by side."""
    df = accounts(spark, folder)
    left = [F.round("debt_amount", 4).alias("debt_amount"), F.round("credit_score", 4).alias("credit_score")]
    right = [F.round("debt_to_income_ratio", 6).alias("debt_to_income_ratio"), F.col("employment_status")]
    return df.select("customer_id", *left, *right)  # both blocks come from one table, so no join is needed


@query(" UNION ALL ".join(f"""
SELECT '{c}' AS feature, round(min(lo), 6) AS lower, round(min(hi), 6) AS upper, round(avg(least(greatest({c}, lo), hi)), 6) AS mean_capped,
  CAST(sum(CASE WHEN {c} < lo OR {c} > hi THEN 1 ELSE 0 END) AS BIGINT) AS n_capped
FROM lineitem, (SELECT quantile_cont({c}, 0.25) - 0.5::DOUBLE * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo,
  quantile_cont({c}, 0.75) + 0.5::DOUBLE * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi FROM lineitem)""" for c in ["l_quantity", "l_extendedprice", "l_discount"]))
def bounds_broadcast(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted bounds (one row per column) broadcast onto the long values."""
    df, columns = table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]
    bounds = iqr_bounds(df, columns, 0.5).select("feature", "lower", "upper")
    long = melt(df, columns).join(F.broadcast(bounds), "feature")
    capped = F.least(F.greatest("value", "lower"), F.col("upper"))
    return long.groupBy("feature", "lower", "upper").agg(
        F.round(F.avg(capped), 6).alias("mean_capped"),
        F.sum(F.when(capped != F.col("value"), 1).otherwise(0)).alias("n_capped"),
    ).withColumns({"lower": F.round("lower", 6), "upper": F.round("upper", 6)})


@query(f"WITH {ACCOUNTS} SELECT c_custkey, payment_status AS label, {_each('round({c}, 6) AS {c}', SCALED)} FROM accounts")
def matrix_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Feature matrix written with its names, read back by name."""
    path = run_dir(spark, "matrix")
    tables.write_matrix(accounts(spark, folder), path, "c_custkey", SCALED, "payment_status")
    return tables.read_matrix(spark, path, SCALED).select("c_custkey", "label", *rounded(SCALED))


HASH_SQL = "CAST('0x' || substr(md5({c}), 1, 7) AS BIGINT)"
POSITIONS = f"""
positions AS (SELECT customer_id, payment_status, row_number() OVER (PARTITION BY payment_status ORDER BY {HASH_SQL.format(c='customer_id')}, customer_id) - 1 AS pos,
  count(*) OVER (PARTITION BY payment_status) AS total FROM accounts)"""


@query(f"""
WITH {ACCOUNTS}, {POSITIONS}
SELECT customer_id, payment_status, CASE WHEN pos < floor(total * 0.2::DOUBLE + 0.5::DOUBLE) THEN 'test' ELSE 'train' END AS part FROM positions""")
def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    return ft.stratified_split(accounts(spark, folder).select("customer_id", "payment_status"), "payment_status", "customer_id")


@query(f"WITH {ACCOUNTS}, {POSITIONS} SELECT customer_id, payment_status, CAST(pos % 3 AS INTEGER) AS fold FROM positions")
def stratified_folds(spark: SparkSession, folder: str) -> DataFrame:
    return ft.stratified_folds(accounts(spark, folder).select("customer_id", "payment_status"), "payment_status", "customer_id")


@query("""
WITH p AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos, count(*) OVER () AS n FROM events),
s AS (SELECT *, n // 6 AS size, n - 5 * (n // 6) AS start FROM p)
SELECT event_id, CAST(CASE WHEN pos < start THEN -1 ELSE (pos - start) // size END AS INTEGER) AS fold FROM s""")
def time_folds(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "ts")
    return ft.time_folds(events, ["ts", "event_id"]).select("event_id", "fold")


@query(f"""
SELECT o_orderkey, o_orderstatus FROM orders ORDER BY {HASH_SQL.format(c='CAST(o_orderkey AS VARCHAR)')}, o_orderkey LIMIT 100""")
def hash_sample(spark: SparkSession, folder: str) -> DataFrame:
    """A reproducible sample of 100 orders out of the whole table."""
    return ft.hash_sample(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 100)
