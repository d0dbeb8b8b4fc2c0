"""Profiling and exploration queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.operators import explore, profile
from ledgerlark.operators.ordered import melt
from ledgerlark.plans.portfolio import with_segment
from ledgerlark.plans.registry import query
from ledgerlark.plans.views import ACCOUNTS, RISK_SEGMENT, bin_sql
from ledgerlark.sources.accounts import accounts
from ledgerlark.sources.tables import table

HOLES = """
holes AS (
  SELECT * REPLACE (CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE l_discount END AS l_discount,
         CASE WHEN l_partkey % 20 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag)
  FROM lineitem)"""
HOLE_COLUMNS = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"), ("l_quantity", "double"),
    ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"),
    ("l_shipdate", "timestamp_ntz"),
]
NUMBERS = ("bigint", "int", "double")
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SKEWED = ["debt_amount", "debt_to_income_ratio", "contact_attempts", "annual_income"]
CORRELATED = ["credit_score", "annual_income", "debt_amount", "days_overdue", "payment_history_score", "response_rate", "propensity"]


def with_holes(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with missing values made by rule, since the given table has none."""
    return table(spark, folder, "lineitem").withColumns({
        "l_discount": F.when(F.col("l_orderkey") % 10 != 0, F.col("l_discount")),
        "l_returnflag": F.when(F.col("l_partkey") % 20 != 0, F.col("l_returnflag")),
    })


def _union(template: str, columns) -> str:
    return " UNION ALL ".join(template.format(c=c, t=t) for c, t in columns)


COLUMN_PROFILE = f"""{HOLES},
column_profile AS ({_union('''
  SELECT '{c}' AS "column", '{t}' AS dtype, count(*) - count({c}) AS missing_count,
    round(100.0::DOUBLE * (count(*) - count({c})) / count(*), 6) AS missing_pct, count(DISTINCT {c}) AS unique_values,
    round(count(DISTINCT {c})::DOUBLE / count(*), 6) AS cardinality_ratio FROM holes''', HOLE_COLUMNS)})"""
OUTLIER_TEMPLATE = """
  SELECT '{c}' AS feature, round(min(lo), 6) AS lower, round(min(hi), 6) AS upper,
    CAST(sum(CASE WHEN {c} < lo OR {c} > hi THEN 1 ELSE 0 END) AS BIGINT) AS outlier_count,
    round(100.0::DOUBLE * sum(CASE WHEN {c} < lo OR {c} > hi THEN 1 ELSE 0 END) / count(*), 6) AS outlier_pct
  FROM {t}, (SELECT quantile_cont({c}, 0.25) - 1.5::DOUBLE * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo,
    quantile_cont({c}, 0.75) + 1.5::DOUBLE * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi FROM {t})"""
HOLE_OUTLIERS = f"outliers AS ({_union(OUTLIER_TEMPLATE, [(c, 'holes') for c, t in HOLE_COLUMNS if t in NUMBERS])})"
DUPLICATES = """
duplicates AS (
  SELECT (SELECT count(*) FROM holes2) AS total_rows,
    (SELECT count(*) FROM holes2) - (SELECT count(*) FROM (SELECT DISTINCT * FROM holes2)) AS total_duplicates)"""


@query(f"WITH {COLUMN_PROFILE} SELECT * FROM column_profile")
def column_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.column_profile(with_holes(spark, folder))


@query(f"""
WITH {HOLES}, holes2 AS (SELECT l_quantity, l_discount, l_returnflag, l_linestatus FROM holes), {DUPLICATES}
SELECT total_rows, total_duplicates, round(100.0::DOUBLE * total_duplicates / total_rows, 6) AS duplicate_pct FROM duplicates""")
def duplicate_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated rows over a projection narrow enough to have some; missing values count as equal."""
    return profile.duplicate_profile(with_holes(spark, folder).select("l_quantity", "l_discount", "l_returnflag", "l_linestatus"))


@query(f"WITH {ACCOUNTS} {_union(OUTLIER_TEMPLATE, [(c, 'accounts') for c in SKEWED])}")
def iqr_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return profile.iqr_outliers(accounts(spark, folder), SKEWED)


@query(f"""
WITH {COLUMN_PROFILE}, {HOLE_OUTLIERS}, holes2 AS (SELECT * FROM holes), {DUPLICATES},
parts AS (
  SELECT total_rows, total_duplicates, round(100.0::DOUBLE * total_duplicates / total_rows, 6) AS duplicate_pct,
    (SELECT avg(missing_pct) FROM column_profile) AS m, (SELECT avg(outlier_pct) FROM outliers) AS o FROM duplicates)
SELECT total_rows, total_duplicates, duplicate_pct, round(m, 4) AS avg_missing_pct, round(o, 4) AS avg_outlier_pct,
  round(greatest(100.0::DOUBLE - least(m * 2, 30.0::DOUBLE) - least(duplicate_pct * 3, 20.0::DOUBLE) - least(o * 0.5::DOUBLE, 15.0::DOUBLE), 0.0::DOUBLE), 4) AS quality_score
FROM parts""")
def quality_score(spark: SparkSession, folder: str) -> DataFrame:
    df = with_holes(spark, folder)
    return profile.quality_score(
        profile.missing_profile(df), profile.duplicate_profile(df), profile.iqr_outliers(df, profile.numeric_columns(df))
    )


@query(f"""
WITH {COLUMN_PROFILE}, {HOLE_OUTLIERS}
SELECT * FROM (SELECT 'missing' AS issue, "column", missing_pct AS pct FROM column_profile
  UNION ALL SELECT 'outliers', feature, outlier_pct FROM outliers) WHERE pct > 4.9""")
def quality_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Columns above the limit (4.9 % here, so that the rule's 5 % hole is seen)."""
    df = with_holes(spark, folder)
    return profile.quality_flags(profile.missing_profile(df), profile.iqr_outliers(df, profile.numeric_columns(df)), 4.9)


@query("""
SELECT 'l_partkey' AS "column", CASE WHEN count(DISTINCT l_partkey)::DOUBLE / count(*) > 0.05 THEN 'numeric' ELSE 'categorical' END AS feature_type FROM lineitem
UNION ALL SELECT 'l_linenumber', 'categorical'
UNION ALL SELECT 'l_quantity', CASE WHEN count(DISTINCT l_quantity)::DOUBLE / count(*) > 0.05 THEN 'numeric' ELSE 'categorical' END FROM lineitem
UNION ALL SELECT 'l_extendedprice', CASE WHEN count(DISTINCT l_extendedprice)::DOUBLE / count(*) > 0.05 THEN 'numeric' ELSE 'categorical' END FROM lineitem
UNION ALL SELECT 'l_discount', CASE WHEN count(DISTINCT l_discount)::DOUBLE / count(*) > 0.05 THEN 'numeric' ELSE 'categorical' END FROM lineitem
UNION ALL SELECT 'l_suppkey', CASE WHEN count(DISTINCT l_suppkey)::DOUBLE / count(*) > 0.05 THEN 'numeric' ELSE 'categorical' END FROM lineitem
UNION ALL SELECT 'l_tax', CASE WHEN count(DISTINCT l_tax)::DOUBLE / count(*) > 0.05 THEN 'numeric' ELSE 'categorical' END FROM lineitem
UNION ALL SELECT 'l_linestatus', 'categorical' UNION ALL SELECT 'l_shipdate', 'categorical'""")
def feature_types(spark: SparkSession, folder: str) -> DataFrame:
    """Numeric or categorical by type and distinct share; id and target are left out."""
    return profile.feature_types(table(spark, folder, "lineitem"), exclude=["l_orderkey", "l_returnflag"])


def _describe(column: str) -> str:
    return f"""
  SELECT l_returnflag, '{column}' AS feature, count({column}) AS count, round(avg({column}), 4) AS mean, round(stddev_samp({column}), 4) AS std,
    round(min({column}), 4) AS min, round(quantile_cont({column}, 0.25), 4) AS q25, round(quantile_cont({column}, 0.5), 4) AS median,
    round(quantile_cont({column}, 0.75), 4) AS q75, round(max({column}), 4) AS max FROM lineitem GROUP BY 1"""


@query(" UNION ALL ".join(_describe(c) for c in MEASURES))
def describe_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return profile.describe_by_group(table(spark, folder, "lineitem"), MEASURES, "l_returnflag")


@query(f"""
WITH {ACCOUNTS}
SELECT payment_status, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM accounts GROUP BY 1""")
def value_shares(spark: SparkSession, folder: str) -> DataFrame:
    return explore.value_counts_share(accounts(spark, folder), "payment_status")


@query(f"""
WITH {ACCOUNTS}
SELECT employment_status,
  round(100.0::DOUBLE * sum(CASE WHEN debt_type = 'auto_loan' THEN 1 ELSE 0 END) / sum(CASE WHEN debt_type IS NULL THEN 0 ELSE 1 END), 4) AS auto_loan,
  round(100.0::DOUBLE * sum(CASE WHEN debt_type = 'credit_card' THEN 1 ELSE 0 END) / sum(CASE WHEN debt_type IS NULL THEN 0 ELSE 1 END), 4) AS credit_card,
  round(100.0::DOUBLE * sum(CASE WHEN debt_type = 'medical' THEN 1 ELSE 0 END) / sum(CASE WHEN debt_type IS NULL THEN 0 ELSE 1 END), 4) AS medical,
  round(100.0::DOUBLE * sum(CASE WHEN debt_type = 'mortgage' THEN 1 ELSE 0 END) / sum(CASE WHEN debt_type IS NULL THEN 0 ELSE 1 END), 4) AS mortgage,
  round(100.0::DOUBLE * sum(CASE WHEN debt_type = 'personal_loan' THEN 1 ELSE 0 END) / sum(CASE WHEN debt_type IS NULL THEN 0 ELSE 1 END), 4) AS personal_loan
FROM accounts GROUP BY 1""")
def crosstab_pct(spark: SparkSession, folder: str) -> DataFrame:
    kinds = ["auto_loan", "credit_card", "medical", "mortgage", "personal_loan"]
    return explore.crosstab_pct(accounts(spark, folder), "employment_status", "debt_type", kinds)


@query(f"""
WITH {ACCOUNTS}, r AS (
  SELECT employment_status, avg(CASE WHEN payment_status = 'partial_payment' THEN 1.0 ELSE 0.0 END) AS rate, count(*) AS n FROM accounts GROUP BY 1)
SELECT employment_status, round(rate, 6) AS rate, n FROM r ORDER BY rate DESC, employment_status LIMIT 1""")
def group_rate_best(spark: SparkSession, folder: str) -> DataFrame:
    rates = explore.group_rates(accounts(spark, folder), "employment_status", F.col("payment_status") == "partial_payment")
    return explore.best_group(rates, "employment_status").withColumn("rate", F.round("rate", 6))


@query(f"""
WITH {ACCOUNTS}, q AS (
  SELECT payment_status, quantile_cont(debt_amount, 0.25) AS q25, quantile_cont(debt_amount, 0.5) AS median, quantile_cont(debt_amount, 0.75) AS q75
  FROM accounts GROUP BY 1),
f AS (SELECT a.payment_status, debt_amount, q25, median, q75,
  debt_amount >= q25 - 1.5::DOUBLE * (q75 - q25) AND debt_amount <= q75 + 1.5::DOUBLE * (q75 - q25) AS inside FROM accounts a JOIN q USING (payment_status) WHERE debt_amount IS NOT NULL)
SELECT payment_status, round(q25, 7) AS q25, round(median, 7) AS median, round(q75, 7) AS q75,
  round(min(CASE WHEN inside THEN debt_amount END), 7) AS whisker_low, round(max(CASE WHEN inside THEN debt_amount END), 7) AS whisker_high,
  CAST(sum(CASE WHEN inside THEN 0 ELSE 1 END) AS BIGINT) AS n_outside
FROM f GROUP BY payment_status, q25, median, q75""")
def boxplot_stats(spark: SparkSession, folder: str) -> DataFrame:
    return profile.boxplot_stats(accounts(spark, folder), "debt_amount", "payment_status", digits=7)


def _histogram(column: str) -> str:
    return f"""
  SELECT '{column}' AS feature, CAST(b AS INTEGER) AS bin, count(v) AS n FROM range(10) AS g(b) LEFT JOIN (
    SELECT {column} AS v, {bin_sql(column, 'lo', 'hi')} AS vb
    FROM lineitem, (SELECT min({column}) AS lo, max({column}) AS hi FROM lineitem)) ON vb = b GROUP BY b"""


@query(" UNION ALL ".join(_histogram(c) for c in MEASURES))
def histogram(spark: SparkSession, folder: str) -> DataFrame:
    return profile.histogram(table(spark, folder, "lineitem"), MEASURES)


def _pairs(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, round(corr({a}, {b}), 6) AS r FROM accounts"
        for i, a in enumerate(columns)
        for b in columns[i + 1 :]
    )


@query(f"""
WITH {ACCOUNTS}, half AS ({_pairs(CORRELATED)})
SELECT * FROM half UNION ALL SELECT feature_2, feature_1, r FROM half
UNION ALL SELECT f, f, 1.0::DOUBLE FROM (SELECT unnest({CORRELATED}) AS f)""")
def corr_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return explore.correlation_matrix(accounts(spark, folder), CORRELATED)


@query(f"WITH {ACCOUNTS}, half AS ({_pairs(CORRELATED)}) SELECT * FROM half WHERE abs(r) > 0.2")
def high_corr_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return explore.high_correlation_pairs(accounts(spark, folder), CORRELATED, 0.2)


@query(f"""
WITH {ACCOUNTS}, full_view AS (
  SELECT a.*, r_name AS region, {RISK_SEGMENT} AS risk_segment, CASE WHEN payment_status <> 'no_payment' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS paid
  FROM accounts a JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
occ AS (SELECT employment_status AS k, avg(paid) AS v FROM full_view GROUP BY 1 ORDER BY v DESC, k LIMIT 1),
reg AS (SELECT region AS k, avg(paid) AS v FROM full_view GROUP BY 1 ORDER BY v DESC, k LIMIT 1),
chan AS (SELECT debt_type AS k, avg(paid) AS v FROM full_view GROUP BY 1 ORDER BY v DESC, k LIMIT 1)
SELECT 'payment_rate' AS insight, 'all' AS key, round(avg(paid), 6) AS value FROM full_view
UNION ALL SELECT 'best_employment', k, round(v, 6) FROM occ
UNION ALL SELECT 'best_region', k, round(v, 6) FROM reg
UNION ALL SELECT 'best_debt_type', k, round(v, 6) FROM chan
UNION ALL SELECT 'segment_rate', risk_segment, round(avg(paid), 6) FROM full_view WHERE risk_segment IN ('Low Risk', 'High Risk') GROUP BY 2
UNION ALL SELECT 'mean_debt_ratio', CASE WHEN paid = 1 THEN 'paid' ELSE 'not_paid' END, round(avg(debt_to_income_ratio), 6) FROM full_view GROUP BY 2""")
def key_insights(spark: SparkSession, folder: str) -> DataFrame:
    """Tidy rows `(insight, key, value)`: overall rate, best groups, risk gap, debt ratio by outcome.

    Everything is derived from one small grouped table, so the accounts are scanned once.
    """
    places = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("region"))
    view = with_segment(accounts(spark, folder)).join(places, "c_nationkey")
    paid = F.col("payment_status") != "no_payment"
    dims = {"best_employment": "employment_status", "best_region": "region", "best_debt_type": "debt_type", "segment_rate": "risk_segment"}
    tagged = [F.struct(F.lit(i).alias("insight"), F.col(c).alias("key")) for i, c in dims.items()]
    tagged.append(F.struct(F.lit("payment_rate").alias("insight"), F.lit("all").alias("key")))
    tagged.append(F.struct(F.lit("mean_debt_ratio").alias("insight"), F.when(paid, "paid").otherwise("not_paid").alias("key")))
    grouped = (
        view.select(F.explode(F.array(*tagged)).alias("t"), paid.alias("paid"), "debt_to_income_ratio")
        .groupBy("t.insight", "t.key")
        .agg(explore.rate(F.col("paid")).alias("rate"), F.avg("debt_to_income_ratio").alias("mean_ratio"))
    )
    best = F.col("insight").startswith("best_")
    # the grouped table has one row per category
    order = Window.partitionBy("insight").orderBy(F.desc("rate"), "key")
    return (
        grouped.withColumn("rn", F.row_number().over(order))
        .where(~best | (F.col("rn") == 1))
        .where((F.col("insight") != "segment_rate") | F.col("key").isin("Low Risk", "High Risk"))
        .select(
            "insight", "key",
            F.round(F.when(F.col("insight") == "mean_debt_ratio", F.col("mean_ratio")).otherwise(F.col("rate")), 6).alias("value"),
        )
    )


@query(f"""
WITH {ACCOUNTS}
SELECT 'annual_income' AS metric_name, count(annual_income) AS n, round(avg(annual_income), 4) AS mean, round(stddev_pop(annual_income), 4) AS std FROM accounts
UNION ALL SELECT 'contact_attempts', count(contact_attempts), round(avg(contact_attempts), 4), round(stddev_pop(contact_attempts), 4) FROM accounts
UNION ALL SELECT 'credit_score', count(credit_score), round(avg(credit_score), 4), round(stddev_pop(credit_score), 4) FROM accounts
UNION ALL SELECT 'debt_amount', count(debt_amount), round(avg(debt_amount), 4), round(stddev_pop(debt_amount), 4) FROM accounts""")
def metric_log_rollup(spark: SparkSession, folder: str) -> DataFrame:
    long = melt(accounts(spark, folder), ["annual_income", "contact_attempts", "credit_score", "debt_amount"], name="metric_name")
    return long.groupBy("metric_name").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 4).alias("mean"), F.round(F.stddev_pop("value"), 4).alias("std")
    )
