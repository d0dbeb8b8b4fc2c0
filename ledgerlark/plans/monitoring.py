"""Drift queries: line items shipped before and after a date, plus one feature shifted by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.operators import drift
from ledgerlark.operators.ordered import melt
from ledgerlark.plans.registry import query
from ledgerlark.plans.views import bin_sql
from ledgerlark.sources.tables import table

CUT = "1999-01-01"
FEATURES = ["quantity", "price", "discount", "tax", "shifted_price"]
SIDES = f"""
sides AS (
  SELECT l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax, l_returnflag AS flag,
    CASE WHEN l_shipdate < TIMESTAMP '{CUT}' THEN l_extendedprice ELSE l_extendedprice * 1.5::DOUBLE END AS shifted_price,
    l_shipdate < TIMESTAMP '{CUT}' AS is_ref FROM lineitem)"""
LONG = f"""{SIDES},
long AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature, {f} AS value, is_ref FROM sides" for f in FEATURES)}),
counts AS (SELECT feature, value, CAST(sum(CASE WHEN is_ref THEN 1 ELSE 0 END) AS BIGINT) AS n_ref, CAST(sum(CASE WHEN is_ref THEN 0 ELSE 1 END) AS BIGINT) AS n_new
  FROM long GROUP BY 1, 2),
ranked AS (
  SELECT *, CAST(sum(n_ref) OVER w AS BIGINT) AS ref_upto, CAST(sum(n_new) OVER w AS BIGINT) AS new_upto,
    CAST(sum(n_ref) OVER (PARTITION BY feature) AS DOUBLE) AS n1, CAST(sum(n_new) OVER (PARTITION BY feature) AS DOUBLE) AS n2
  FROM counts WINDOW w AS (PARTITION BY feature ORDER BY value))"""
KS = """
ks0 AS (SELECT feature, max(abs(ref_upto / n1 - new_upto / n2)) AS d, min(n1) AS n1, min(n2) AS n2 FROM ranked GROUP BY 1),
ks AS (SELECT feature, d, (SELECT least(greatest(2 * sum(CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END * exp(-2.0::DOUBLE * k * k * d * d * n1 * n2 / (n1 + n2))), 0), 1)
  FROM range(1, 101) AS r(k)) AS p FROM ks0)"""
MW = """
mw0 AS (SELECT feature, sum(n_ref * (ref_upto + new_upto - n_ref - n_new + (n_ref + n_new + 1) / 2)) AS rs,
    sum(power((n_ref + n_new)::DOUBLE, 3) - (n_ref + n_new)) AS ties, min(n1) AS n1, min(n2) AS n2 FROM ranked GROUP BY 1),
mw AS (SELECT feature, rs - n1 * (n1 + 1) / 2 AS u,
    (greatest(rs - n1 * (n1 + 1) / 2, n1 * n2 - (rs - n1 * (n1 + 1) / 2)) - n1 * n2 / 2 - 0.5)
    / sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))) AS z FROM mw0)"""
PSI = f"""
ranges AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM counts WHERE n_ref > 0 GROUP BY 1),
bins AS (SELECT feature, bin, sum(n_ref) AS r, sum(n_new) AS q, min(n1) AS n1, min(n2) AS n2 FROM (
    SELECT feature, n_ref, n_new, n1, n2, {bin_sql('value', 'lo', 'hi')} AS bin
    FROM ranked JOIN ranges USING (feature)) WHERE bin IS NOT NULL GROUP BY 1, 2),
shares AS (SELECT feature, CASE WHEN r = 0 THEN 0.0001::DOUBLE ELSE r / n1 END AS p, CASE WHEN q = 0 THEN 0.0001::DOUBLE ELSE q / n2 END AS q FROM bins),
psi AS (SELECT feature, sum((q - p) * ln(q / p)) AS psi FROM shares GROUP BY 1)"""
VERDICTS = f"""{LONG}, {KS}, {MW}, {PSI},
votes AS (SELECT feature, CASE WHEN p < 0.05 THEN 1 ELSE 0 END AS k, CASE WHEN z > 1.959963984540054 THEN 1 ELSE 0 END AS m, CASE WHEN psi > 0.2 THEN 1 ELSE 0 END AS s
  FROM ks JOIN mw USING (feature) JOIN psi USING (feature)),
verdicts AS (SELECT feature, CAST(k + m + s AS BIGINT) AS votes, 3::BIGINT AS tests, k + m + s >= 1.5 AS drift_detected, (k + m + s) / 3.0::DOUBLE AS drift_score FROM votes)"""


def sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    items = table(spark, folder, "lineitem")
    before = F.col("l_shipdate") < F.lit(CUT).cast("timestamp_ntz")
    price = F.col("l_extendedprice")

    def named(df: DataFrame, shifted) -> DataFrame:
        return df.select(
            F.col("l_quantity").alias("quantity"), price.alias("price"), F.col("l_discount").alias("discount"),
            F.col("l_tax").alias("tax"), F.col("l_returnflag").alias("flag"), shifted.alias("shifted_price"),
        )

    return named(items.where(before), price), named(items.where(~before), price * 1.5)


def ranked(spark: SparkSession, folder: str) -> DataFrame:
    return drift.ranked_counts(drift.side_counts(*sides(spark, folder), FEATURES))


STAT_COLUMNS = ["mean", "std_samp", "std_pop", "min", "max", "median", "q25", "q75", "skewness", "kurtosis"]


@query(f"""
WITH {LONG}, m AS (SELECT feature, is_ref, avg(value) AS mu FROM long GROUP BY 1, 2)
SELECT CASE WHEN is_ref THEN 'reference' ELSE 'new' END AS side, feature, count(*) AS n, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std_samp, round(stddev_pop(value), 4) AS std_pop,
  round(min(value), 4) AS min, round(max(value), 4) AS max, round(median(value), 4) AS median, round(quantile_cont(value, 0.25), 4) AS q25, round(quantile_cont(value, 0.75), 4) AS q75,
  round(avg(power(value - mu, 3)) / power(var_pop(value), 1.5), 4) AS skewness, round(kurtosis_pop(value), 4) AS kurtosis
FROM long JOIN m USING (feature, is_ref) GROUP BY 1, 2""")
def feature_stats(spark: SparkSession, folder: str) -> DataFrame:
    both = drift.side_stats(ranked(spark, folder))
    return both.select("side", "feature", "n", *[F.round(c, 4).alias(c) for c in STAT_COLUMNS])


@query(f"""
WITH {LONG}
SELECT feature, round(avg(CASE WHEN is_ref THEN value END), 4) AS ref_mean, round(avg(CASE WHEN NOT is_ref THEN value END), 4) AS new_mean,
  round(avg(CASE WHEN NOT is_ref THEN value END) - avg(CASE WHEN is_ref THEN value END), 4) AS mean_shift,
  round(stddev_samp(CASE WHEN is_ref THEN value END), 4) AS ref_std, round(stddev_pop(CASE WHEN NOT is_ref THEN value END), 4) AS new_std
FROM long GROUP BY 1""")
def stats_side_by_side(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics of both sides joined by feature (one row per feature on each side)."""
    reference, batch = sides(spark, folder)
    ref = melt(reference, FEATURES).groupBy("feature").agg(F.avg("value").alias("ref_mean"), F.stddev_samp("value").alias("ref_std"))
    new = melt(batch, FEATURES).groupBy("feature").agg(F.avg("value").alias("new_mean"), F.stddev_pop("value").alias("new_std"))
    joined = ref.join(new, "feature").withColumn("mean_shift", F.col("new_mean") - F.col("ref_mean"))
    return joined.select("feature", *[F.round(c, 4).alias(c) for c in ("ref_mean", "new_mean", "mean_shift", "ref_std", "new_std")])


@query(f"""
WITH {LONG}
SELECT feature, value, n_ref, n_new, round(ref_upto / n1, 6) AS ecdf_ref, round(new_upto / n2, 6) AS ecdf_new,
  ref_upto + new_upto - n_ref - n_new + (n_ref + n_new + 1) / 2 AS mean_rank FROM ranked WHERE feature IN ('quantity', 'discount', 'tax')""")
def ecdf_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """Both distribution functions and the tie-averaged ranks of three features."""
    counts = drift.side_counts(*sides(spark, folder), ["quantity", "discount", "tax"])
    return drift.ecdf_ranks(drift.ranked_counts(counts)).select(
        "feature", "value", "n_ref", "n_new", F.round("ecdf_ref", 6).alias("ecdf_ref"), F.round("ecdf_new", 6).alias("ecdf_new"), "mean_rank"
    )


@query(f"WITH {LONG}, {KS} SELECT feature, round(d, 6) AS statistic, round(p, 6) AS p_value, p < 0.05 AS drift_detected FROM ks")
def ks_stat(spark: SparkSession, folder: str) -> DataFrame:
    test = drift.ks_test(drift.rank_sums(ranked(spark, folder)))
    return test.select("feature", F.round("statistic", 6).alias("statistic"), F.round("p_value", 6).alias("p_value"), (F.col("p_value") < 0.05).alias("drift_detected"))


@query(f"WITH {LONG}, {MW} SELECT feature, u AS statistic, round(z, 6) AS z, z > 1.959963984540054 AS drift_detected FROM mw")
def mann_whitney(spark: SparkSession, folder: str) -> DataFrame:
    test = drift.mann_whitney(drift.rank_sums(ranked(spark, folder)))
    return test.select("feature", "statistic", F.round("z", 6).alias("z"), (F.col("p_value") < 0.05).alias("drift_detected"))


@query(f"WITH {LONG}, {PSI} SELECT feature, round(psi, 6) AS psi, psi > 0.2 AS drift_detected FROM psi")
def psi(spark: SparkSession, folder: str) -> DataFrame:
    index = drift.psi(ranked(spark, folder))
    return index.select("feature", F.round("statistic", 6).alias("psi"), (F.col("statistic") > 0.2).alias("drift_detected"))


@query(f"WITH {VERDICTS} SELECT feature, votes, tests, drift_detected, round(drift_score, 6) AS drift_score FROM verdicts")
def drift_verdict(spark: SparkSession, folder: str) -> DataFrame:
    verdicts = drift.feature_verdicts(drift.drift_tests(ranked(spark, folder)))
    return verdicts.withColumn("drift_score", F.round("drift_score", 6))


@query(f"""
WITH {VERDICTS}
SELECT 5::BIGINT AS total_features, CAST(sum(CASE WHEN drift_detected THEN 1 ELSE 0 END) AS BIGINT) AS features_with_drift,
  round(avg(drift_score), 6) AS overall_drift_score, sum(CASE WHEN drift_detected THEN 1 ELSE 0 END) > 0 AS drift_detected FROM verdicts""")
def drift_summary(spark: SparkSession, folder: str) -> DataFrame:
    verdicts = drift.feature_verdicts(drift.drift_tests(ranked(spark, folder)))
    return drift.drift_summary(verdicts, len(FEATURES)).withColumn("overall_drift_score", F.round("overall_drift_score", 6))


@query(f"""
WITH {VERDICTS}
SELECT 'missing' AS kind, 'Missing feature: cost' AS message
UNION ALL SELECT 'drift', 'DRIFT ALERT: ' || sum(CASE WHEN drift_detected THEN 1 ELSE 0 END) || ' features showing drift' FROM verdicts HAVING sum(CASE WHEN drift_detected THEN 1 ELSE 0 END) > 0
UNION ALL SELECT 'high', printf('HIGH DRIFT: Overall drift score %.3f', avg(drift_score)) FROM verdicts HAVING avg(drift_score) > 0.5
UNION ALL SELECT 'feature', 'Feature ''' || feature || ''' showing significant drift' FROM verdicts WHERE drift_detected""")
def drift_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts, with one expected feature that the batch does not bring."""
    reference, batch = sides(spark, folder)
    expected = melt(reference.withColumn("cost", F.col("price") * 0.8), [*FEATURES, "cost"]).select("feature").distinct()
    verdicts = drift.feature_verdicts(drift.drift_tests(drift.ranked_counts(drift.side_counts(reference, batch, FEATURES))))
    missing = drift.missing_features(expected, verdicts)
    return drift.drift_alerts(verdicts, drift.drift_summary(verdicts, len(FEATURES) + 1), missing)


def _expected_and_seen(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    reference, batch = sides(spark, folder)
    expected = melt(reference, FEATURES).select("feature").distinct()
    seen = melt(batch.withColumn("tax", F.lit(None).cast("double")).drop("discount"), ["quantity", "price", "tax", "shifted_price"])
    return expected, seen.select("feature").distinct()


PRESENT_SQL = f"""
WITH {LONG}, expected AS (SELECT DISTINCT feature FROM long WHERE is_ref), seen AS (SELECT DISTINCT feature FROM long WHERE NOT is_ref AND feature NOT IN ('tax', 'discount'))
SELECT feature FROM expected EXCEPT SELECT feature FROM seen"""


@query(PRESENT_SQL)
def missing_features(spark: SparkSession, folder: str) -> DataFrame:
    """Expected features of which the batch has no value (one all missing, one absent), by anti join."""
    return drift.missing_features(*_expected_and_seen(spark, folder))


@query(PRESENT_SQL)
def feature_diff(spark: SparkSession, folder: str) -> DataFrame:
    """The same difference as a set operation."""
    expected, seen = _expected_and_seen(spark, folder)
    return expected.exceptAll(seen)


CATEGORY_SQL = f"""{SIDES},
tagged AS (SELECT is_ref, CASE WHEN is_ref AND flag = 'R' THEN 'A' WHEN NOT is_ref AND quantity = 50 THEN 'X' ELSE flag END AS category FROM sides)"""


def _categories(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Sides whose categories differ: R never in the reference, X only in the batch."""
    reference, batch = sides(spark, folder)
    flag = F.col("flag")
    return (
        reference.select(F.when(flag == "R", "A").otherwise(flag).alias("flag")),
        batch.select(F.when(F.col("quantity") == 50, "X").otherwise(flag).alias("flag")),
    )


@query(f"""
WITH {CATEGORY_SQL}, a AS (SELECT category, count(*) AS n FROM tagged WHERE is_ref GROUP BY 1), b AS (SELECT category, count(*) AS n FROM tagged WHERE NOT is_ref GROUP BY 1)
SELECT coalesce(a.category, b.category) AS category, coalesce(a.n, 0) AS n_ref, coalesce(b.n, 0) AS n_new,
  round(coalesce(a.n, 0) / (SELECT sum(n) FROM a), 6) AS p_ref, round(coalesce(b.n, 0) / (SELECT sum(n) FROM b), 6) AS p_new
FROM a FULL JOIN b ON a.category = b.category""")
def category_alignment(spark: SparkSession, folder: str) -> DataFrame:
    aligned = drift.aligned_categories(*_categories(spark, folder), "flag")
    return aligned.withColumns({"p_ref": F.round("p_ref", 6), "p_new": F.round("p_new", 6)})


@query(f"""
WITH {SIDES}, c AS (SELECT flag, sum(CASE WHEN is_ref THEN 1 ELSE 0 END)::DOUBLE AS r, sum(CASE WHEN is_ref THEN 0 ELSE 1 END)::DOUBLE AS o FROM sides GROUP BY 1),
e AS (SELECT o, r / (SELECT sum(r) FROM c) * (SELECT sum(o) FROM c) AS e FROM c), x AS (SELECT sum((o - e) * (o - e) / e) AS x, count(*) - 1 AS df FROM e)
SELECT round(x, 6) AS statistic, df::DOUBLE AS df, round(exp(-x / 2), 6) AS p_value, exp(-x / 2) < 0.05 AS drift_detected FROM x""")
def target_chi2(spark: SparkSession, folder: str) -> DataFrame:
    """Class shares of the two periods (three classes, so the tail has a closed form to check with)."""
    test = drift.target_chi2(drift.aligned_categories(*sides(spark, folder), "flag"))
    return test.withColumns({"statistic": F.round("statistic", 6), "p_value": F.round("p_value", 6)})
