"""Views that carry the account domain on the given order, customer, line item and event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.hashing import hash_bucket
from ledgerlark.functions.rules import formatted_id, outcome_of_propensity, payment_propensity, pick, ratio
from ledgerlark.sources.tables import table

AS_OF = "2001-08-01"
EMPLOYMENT = {
    "AUTOMOBILE": "employed",
    "BUILDING": "self_employed",
    "FURNITURE": "unemployed",
    "HOUSEHOLD": "retired",
    "MACHINERY": "student",
}
DEBT_TYPES = {1: "credit_card", 2: "personal_loan", 3: "auto_loan", 4: "mortgage", 5: "medical"}
NUMERIC_FEATURES = [
    "customer_age",
    "annual_income",
    "credit_score",
    "debt_amount",
    "days_overdue",
    "payment_history_score",
    "contact_attempts",
    "response_rate",
    "contact_success_rate",
    "debt_to_income_ratio",
]


def accounts(spark: SparkSession, folder: str, as_of: str = AS_OF) -> DataFrame:
    """One row per customer: its latest order plus order shares.

    The latest order is found by one number, day and order key (a key beyond 2^47 is an error), so all aggregate
    buffers are plain numbers: rows are combined in a hash map before the shuffle, without a sort, and
    a customer with very many orders costs one row per task.
    """
    key = F.col("o_orderkey")
    checked = F.when(key.between(0, (1 << 47) - 1), key).otherwise(F.raise_error(F.lit("order keys must lie between 0 and 2^47 - 1")).cast("long"))
    orders = table(spark, folder, "orders").withColumn("recency", F.unix_date(F.col("o_orderdate").cast("date")).cast("long") * (1 << 47) + checked)

    def share(status: str):
        return F.avg(F.when(F.col("o_orderstatus") == status, 1.0).otherwise(0.0))

    history = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_orderdate").alias("latest_date"),
        F.max_by("o_totalprice", "recency").alias("latest_price"),
        F.max_by(F.substring("o_orderpriority", 1, 1).cast("int"), "recency").alias("latest_priority"),
        F.count(F.lit(1)).cast("double").alias("attempts"),
        share("F").alias("history"),
        share("O").alias("response"),
        share("P").alias("success"),
    )
    days = F.datediff(F.lit(as_of).cast("date"), F.col("latest_date").cast("date")).cast("double")
    view = (
        table(spark, folder, "customer")
        .join(history, "c_custkey", "left")
        .select(
            formatted_id("c_custkey").alias("customer_id"),
            "c_custkey",
            "c_nationkey",
            (F.lit(18) + (F.col("c_custkey") * 37) % 68).alias("customer_age"),
            (F.lit(15000.0) + (F.col("c_acctbal") + 1000.0) * 12.0).alias("annual_income"),
            pick("c_mktsegment", EMPLOYMENT).alias("employment_status"),
            (F.lit(300) + (F.col("c_custkey") * 53) % 551).cast("double").alias("credit_score"),
            (F.col("latest_price") / 10.0).alias("debt_amount"),
            pick("latest_priority", DEBT_TYPES).alias("debt_type"),
            F.greatest(F.least(days, F.lit(365.0)), F.lit(1.0)).alias("days_overdue"),
            F.coalesce("history", F.lit(0.0)).alias("payment_history_score"),
            F.coalesce("attempts", F.lit(0.0)).alias("contact_attempts"),
            F.coalesce("response", F.lit(0.0)).alias("response_rate"),
            F.coalesce("success", F.lit(0.0)).alias("contact_success_rate"),
        )
    )
    propensity = payment_propensity(
        "credit_score", "annual_income", "debt_amount", "days_overdue", "payment_history_score", "response_rate"
    )
    return view.withColumns(
        {"debt_to_income_ratio": ratio("debt_amount", "annual_income"), "propensity": propensity}
    ).withColumn("payment_status", outcome_of_propensity("propensity"))


# Score rules of four stand-in models over line items: multipliers of order, part and supplier key
# per class, and the bonus of the true class.
SCORE_CLASSES = ["A", "N", "R"]
SCORE_MODELS = {
    "cedar": ([(3, 5, 7), (11, 2, 5), (7, 13, 3)], 40),
    "linden": ([(5, 3, 2), (2, 7, 11), (13, 5, 3)], 90),
    "maple": ([(7, 2, 3), (3, 11, 5), (5, 3, 13)], 150),
    "willow": ([(2, 11, 5), (7, 5, 3), (3, 2, 7)], 15),
}
SCORE_MODULUS = 97


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """`(model, fold, part, label, prediction, probability array<double>)` per line item and model; classes 0..2.

    `fold` (order key mod 5) and `part` (line status) stand in for validation folds and model versions.
    """
    scan = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"
    )
    items = scan.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        (F.col("l_orderkey") % 5).cast("int").alias("fold"),
        F.col("l_linestatus").alias("part"),
        (F.array_position(F.array(*[F.lit(c) for c in SCORE_CLASSES]), F.col("l_returnflag")) - 1).cast("int").alias("label"),
    )

    def scores(model: str):
        rules, bonus = SCORE_MODELS[model]
        return F.struct(
            F.lit(model).alias("model"),
            F.array(
                *[
                    (
                        (F.col("l_orderkey") * a + F.col("l_partkey") * b + F.col("l_suppkey") * c + F.col("l_linenumber"))
                        % SCORE_MODULUS
                        + 1
                        + F.when(F.col("label") == k, bonus).otherwise(0)
                    ).cast("double")
                    for k, (a, b, c) in enumerate(rules)
                ]
            ).alias("raw"),
        )

    long = items.select("fold", "part", "label", F.explode(F.array(*[scores(m) for m in SCORE_MODELS])).alias("s"))
    raw = F.col("s.raw")
    total = raw[0] + raw[1] + raw[2]
    return long.select(
        F.col("s.model").alias("model"),
        "fold",
        "part",
        "label",
        (F.array_position(raw, F.array_max(raw)) - 1).cast("int").alias("prediction"),
        F.array(raw[0] / total, raw[1] / total, raw[2] / total).alias("probability"),
    )


# Experiments over the event table: id, share of treatment, first day.
EXPERIMENTS = [("e1", 0.5, "2023-12-20"), ("e2", 0.3, "2024-01-10"), ("e3", 0.2, "2024-01-28")]


def experiments(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        EXPERIMENTS, "experiment_id string, treatment_split double, created_at string"
    ).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


def ab_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of both variants, one per event and experiment: `(experiment_id, variant, unit_id, user_id, ts, prediction)`."""
    listed = F.array(*[F.struct(F.lit(e).alias("experiment_id"), F.lit(s).alias("split")) for e, s, _ in EXPERIMENTS])
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", F.explode(listed).alias("x"))
    variant = F.when(
        hash_bucket(F.col("x.experiment_id"), F.col("user_id").cast("string")) < F.col("x.split") * 100, "treatment"
    ).otherwise("control")
    return events.select(
        F.col("x.experiment_id").alias("experiment_id"),
        variant.alias("variant"),
        F.col("event_id").alias("unit_id"),
        "user_id",
        "ts",
        F.when(
            F.col("event_id") % F.when(variant == "treatment", 4).otherwise(3) == 0,
            ((F.col("event_id") + F.col("user_id")) % 3).cast("int"),
        )
        .otherwise((F.col("event_id") % 3).cast("int"))
        .alias("prediction"),
    )


def ab_actuals(spark: SparkSession, folder: str) -> DataFrame:
    """Outcomes seen later: `(unit_id, actual_ts, actual)`; one unit in ten has none yet."""
    return (
        table(spark, folder, "events")
        .where(F.col("event_id") % 10 != 9)
        .select(
            F.col("event_id").alias("unit_id"),
            F.col("ts").alias("actual_ts"),
            (F.col("event_id") % 3).cast("int").alias("actual"),
        )
    )
