"""Published results recomputed from their literal inputs."""

import pytest
from pyspark.sql import functions as F

from ledgerlark.functions import contact, rules
from ledgerlark.operators import drift, metrics, oplog, ranking
from ledgerlark.operators.features import time_folds

MATRICES = {
    "forest": ([[255, 1, 93], [1, 228, 97], [270, 277, 778]], 0.6406089999904152),
    "boosted": ([[244, 0, 105], [3, 207, 116], [260, 256, 809]], 0.6401796769015237),
    "light": ([[244, 1, 104], [3, 213, 110], [255, 252, 818]], 0.6475830681487513),
    "logistic": ([[272, 0, 77], [3, 234, 89], [291, 340, 694]], 0.6093531300096285),
}


@pytest.fixture(scope="module")
def means(spark):
    rows = [
        (name, label, guess, n)
        for name, (matrix, _) in MATRICES.items()
        for label, line in enumerate(matrix)
        for guess, n in enumerate(line)
    ]
    confused = spark.createDataFrame(rows, "model string, label int, prediction int, n long")
    return metrics.averages(metrics.class_report(confused))


def test_averages_from_confusion(means):
    got = {r["model"]: r for r in means.collect()}
    for name, (_, f1) in MATRICES.items():
        assert got[name]["f1_weighted"] == pytest.approx(f1, abs=1e-12)
    forest = got["forest"]
    assert forest["accuracy"] == pytest.approx(0.6305, abs=1e-12)
    assert forest["f1_macro"] == pytest.approx(0.6031736899530183, abs=1e-12)
    assert forest["precision_weighted"] == pytest.approx(0.6905064908959748, abs=1e-12)


def test_ranking_and_selection_scores(spark):
    one = spark.createDataFrame([("light", 0.6475830681487513, 0.6375, 0.757191526)], "model string, f1_weighted double, accuracy double, roc_auc double")
    row = ranking.rank_models(one).withColumn("selection_score", ranking.selection_score()).first()
    assert row["composite_score"] == pytest.approx(0.66648, abs=1e-5)
    assert row["selection_score"] == pytest.approx(0.749193, abs=1e-5)
    assert row["performance_grade"] == "D" and not row["threshold_met"]


def test_summary_over_models(means):
    row = ranking.summarise_models(means).first()
    assert row["f1_mean"] == pytest.approx(0.6344312187625797, abs=1e-10)
    assert row["f1_std"] == pytest.approx(0.01477406028865818, abs=1e-10)
    assert row["f1_median"] == pytest.approx(0.6403943384459694, abs=1e-10)
    assert row["models_above_threshold"] == 0 and row["threshold_success_rate"] == 0


def test_time_folds_sizes(spark):
    sizes = {r["fold"]: r["count"] for r in time_folds(spark.range(8000).withColumnRenamed("id", "t"), ["t"], 5).groupBy("fold").count().collect()}
    assert sizes == {-1: 1335, 0: 1333, 1: 1333, 2: 1333, 3: 1333, 4: 1333}


@pytest.mark.parametrize("votes, score", [([1] * 17 + [2], 19 / 150), ([3, 3, 3] + [1] * 45, 54 / 150)])
def test_drift_score_is_mean_of_votes(spark, votes, score):
    votes = votes + [0] * (50 - len(votes))
    tests = spark.createDataFrame(
        [(f"f{i}", t, t < v) for i, v in enumerate(votes) for t in range(3)], "feature string, test int, drift_detected boolean"
    )
    row = drift.drift_summary(drift.feature_verdicts(tests), 50).first()
    assert row["overall_drift_score"] == pytest.approx(score)
    assert row["features_with_drift"] == sum(v >= 2 for v in votes)


def test_worked_recommendation(spark):
    profile = spark.createDataFrame(
        [("CUST_001234", 35, "employed", "partial_payment", 45.0, 8500.0, 0.7)],
        "customer_id string, customer_age int, employment_status string, payment_status string, days_overdue double, debt_amount double, contact_success_rate double",
    )
    as_of = F.lit("2025-10-15 08:00:00").cast("timestamp_ntz")
    doc = contact.recommendation(profile, as_of).first()
    channel = doc["channel_recommendations"]
    assert [(r["channel"], r["priority"]) for r in channel["recommendations"]] == [("phone", 1), ("email", 3)]
    assert channel["recommendations"][0]["expected_effectiveness"] == pytest.approx(0.9)
    assert (channel["primary_channel"], channel["urgency_level"]) == ("phone", "high")
    strategy = doc["contact_strategy"]
    assert (strategy["approach"], strategy["frequency"], strategy["escalation_timeline"]) == ("persuasive", "twice_weekly", "21_days")
    assert strategy["special_instructions"] == [
        "Focus on relationship", "Offer incentives", "Acknowledge partial payments", "Encourage completion",
    ]
    slots = doc["timing_recommendations"]["next_best_times"]
    assert [s["score"] for s in slots] == [2.0] * 5
    assert [s["hour"] for s in slots] == [9, 10, 17, 18, 19]


def test_missing_profile_attributes_take_defaults(spark):
    doc = contact.recommendation(spark.createDataFrame([("C",)], "customer_id string"), F.lit("2025-10-15 08:00:00").cast("timestamp_ntz")).first()
    assert doc["channel_recommendations"]["primary_channel"] == "phone"
    assert doc["channel_recommendations"]["urgency_level"] == "low"
    assert doc["contact_strategy"]["approach"] == "standard"


def test_deployment_rollup(spark):
    records = spark.createDataFrame([("staging", "failed")] * 16, "environment string, status string")
    rows = {(r["section"], r["key"]): (r["total"], r["healthy"], r["unhealthy"]) for r in oplog.deployment_rollup(records).collect()}
    assert rows == {("environment", "staging"): (16, 0, 16), ("status", "failed"): (16, 0, 16)}


def test_separation_score(spark):
    rows = [(0, 0, [0.6655780567, 0.3344219433]), (1, 0, [0.6418123662, 0.3581876338])]
    df = spark.createDataFrame([("m", *r) for r in rows], "model string, label int, prediction int, probability array<double>")
    assert metrics.confidence_profile(df).first()["separation"] == pytest.approx(0.023765690485964552, abs=1e-9)


def test_mean_brier(spark):
    rows = spark.createDataFrame([("m", 0.115093), ("m", 0.123955), ("m", 0.243821)], "model string, brier double")
    assert rows.groupBy("model").agg(F.avg("brier")).first()[1] == pytest.approx(0.1609563, abs=1e-6)


@pytest.mark.parametrize("days, bucket", [(0, None), (30, "0-30"), (31, "31-60"), (60, "31-60"), (180, "91-180"), (365, "181-365"), (366, "365+")])
def test_days_past_due_buckets(spark, days, bucket):
    row = spark.range(1).select(rules.days_past_due_bucket(F.lit(float(days))).alias("b")).first()
    assert row["b"] == bucket
