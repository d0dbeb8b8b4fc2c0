"""Queries whose keys, labels or whole groups are missing, and steps over all columns."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.operators import features as ft
from ledgerlark.operators import profile
from ledgerlark.plans.registry import query
from ledgerlark.plans.transforms import HASH_SQL
from ledgerlark.plans.views import ACCOUNTS
from ledgerlark.session import run_dir
from ledgerlark.sources import tables
from ledgerlark.sources.accounts import NUMERIC_FEATURES, accounts
from ledgerlark.sources.tables import table

GAPS = """
gaps AS (SELECT CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_returnflag END AS flag, l_quantity,
  CASE WHEN l_returnflag <> 'R' OR l_partkey % 7 = 0 THEN l_discount END AS l_discount FROM lineitem)"""
WIDE = [c for c in NUMERIC_FEATURES if c != "customer_age"]
WIDE = [*WIDE, *[f"{c}_2" for c in WIDE]][:12]


def with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """A seventh of the keys is missing, and one group has no discount at all."""
    gap, flag = F.col("l_partkey") % 7 == 0, F.col("l_returnflag")
    return table(spark, folder, "lineitem").select(
        F.when(~gap, flag).alias("flag"), "l_quantity", F.when((flag != "R") | gap, F.col("l_discount")).alias("l_discount")
    )


def _describe(c: str) -> str:
    return f"""
  SELECT flag, '{c}' AS feature, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min,
    round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS median, round(quantile_cont({c}, 0.75), 4) AS q75,
    round(max({c}), 4) AS max FROM gaps GROUP BY 1"""


@query(f"WITH {GAPS} {_describe('l_quantity')} UNION ALL {_describe('l_discount')}")
def describe_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return profile.describe_by_group(with_gaps(spark, folder), ["l_quantity", "l_discount"], "flag")


@query(f"""
WITH {GAPS}, q AS (SELECT flag, quantile_cont(l_discount, 0.25) AS a, quantile_cont(l_discount, 0.5) AS b, quantile_cont(l_discount, 0.75) AS c FROM gaps GROUP BY 1),
j AS (SELECT gaps.flag, l_discount AS v, a, b, c, a - 1.5::DOUBLE * (c - a) AS lo, c + 1.5::DOUBLE * (c - a) AS hi FROM gaps JOIN q ON gaps.flag IS NOT DISTINCT FROM q.flag)
SELECT flag, round(min(a), 4) AS q25, round(min(b), 4) AS median, round(min(c), 4) AS q75, round(min(CASE WHEN v BETWEEN lo AND hi THEN v END), 4) AS whisker_low,
  round(max(CASE WHEN v BETWEEN lo AND hi THEN v END), 4) AS whisker_high, CAST(sum(CASE WHEN v < lo OR v > hi THEN 1 ELSE 0 END) AS BIGINT) AS n_outside FROM j GROUP BY 1""")
def boxplot_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return profile.boxplot_stats(with_gaps(spark, folder), "l_discount", "flag")


LABEL_GAPS = f"""
labelled AS (SELECT customer_id, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE payment_status END AS label FROM accounts),
positions AS (SELECT customer_id, label, row_number() OVER (PARTITION BY label ORDER BY {HASH_SQL.format(c='customer_id')}, customer_id) - 1 AS pos,
  count(*) OVER (PARTITION BY label) AS total FROM labelled)"""


def with_label_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return accounts(spark, folder).select("customer_id", F.when(F.col("c_custkey") % 4 != 0, F.col("payment_status")).alias("label"))


@query(f"""
WITH {ACCOUNTS}, {LABEL_GAPS}
SELECT customer_id, label, CASE WHEN pos < floor(total * 0.2::DOUBLE + 0.5::DOUBLE) THEN 'test' ELSE 'train' END AS part FROM positions""")
def split_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Rows without a label are a class of their own."""
    return ft.stratified_split(with_label_gaps(spark, folder), "label", "customer_id")


@query(f"WITH {ACCOUNTS}, {LABEL_GAPS} SELECT customer_id, label, CAST(pos % 3 AS INTEGER) AS fold FROM positions")
def folds_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return ft.stratified_folds(with_label_gaps(spark, folder), "label", "customer_id")


def _source(c: str) -> str:
    return f"{c[:-2]} * 2" if c.endswith("_2") else c


@query(f"""
WITH {ACCOUNTS}, wide AS (SELECT customer_id, {', '.join(f'{_source(c)} AS {c}' for c in WIDE)} FROM accounts)
SELECT customer_id, {', '.join(f'round(ln(1 + {a} * {b}), 7) AS {a}_x_{b}' for a, b in combinations(WIDE, 2))} FROM wide""")
def interactions_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Products of all pairs of twelve columns, as logarithms, so that no value lies on a rounding edge."""
    df = accounts(spark, folder)
    df = df.select("customer_id", *[(F.col(c[:-2]) * 2).alias(c) if c.endswith("_2") else F.col(c) for c in WIDE])
    step = ft.Interactions(inputCols=WIDE)
    return step.transform(df).select("customer_id", *[F.round(F.log(1 + F.col(c)), 7).alias(c) for c in step.output_columns()])


@query("SELECT unnest(['l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber', 'l_quantity', 'l_extendedprice', 'l_discount', 'l_tax', 'l_returnflag', 'l_linestatus', 'l_shipdate']) AS \"column\", true AS within")
def profile_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """Sketched numbers of distinct values against exact ones: within four standard errors."""
    df = table(spark, folder, "lineitem")
    exact = profile.column_profile(df).select("column", F.col("unique_values").alias("exact"))
    rough = profile.column_profile(df, rsd=0.02).select("column", "unique_values")
    return exact.join(rough, "column").select("column", (F.abs(F.col("unique_values") - F.col("exact")) <= 0.08 * F.col("exact")).alias("within"))


@query(f"""
WITH {ACCOUNTS}
SELECT 'audit' AS log, payment_status AS item, count(*) AS n, round(avg(propensity), 6) AS value FROM accounts GROUP BY 2
UNION ALL SELECT 'metric', event_type, count(*), round(avg(value), 6) FROM events GROUP BY 2""")
def log_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Audit and metric logs written as JSON lines, read by their schemas and rolled up."""
    audit, metric = run_dir(spark, "audit-log"), run_dir(spark, "metric-log")
    scored = accounts(spark, folder).select(
        F.lit("model_prediction").alias("audit_type"), F.lit("baseline").alias("model_name"),
        F.col("payment_status").alias("prediction"), F.col("propensity").alias("confidence"),
    )
    tables.write_json(scored, audit)
    measured = table(spark, folder, "events").select(
        F.lit("events").alias("component"), F.col("event_type").alias("metric_name"), F.col("value").cast("double").alias("metric_value")
    )
    tables.write_json(measured, metric)
    decisions = tables.read_json_lines(spark, audit, tables.AUDIT_LOG).groupBy(F.col("prediction").alias("item"))
    metrics = tables.read_json_lines(spark, metric, tables.METRIC_LOG).groupBy(F.col("metric_name").alias("item"))
    both = [
        decisions.agg(F.lit("audit").alias("log"), F.count(F.lit(1)).alias("n"), F.avg("confidence").alias("value")),
        metrics.agg(F.lit("metric").alias("log"), F.count(F.lit(1)).alias("n"), F.avg("metric_value").alias("value")),
    ]
    return both[0].unionByName(both[1]).select("log", "item", "n", F.round("value", 6).alias("value"))
