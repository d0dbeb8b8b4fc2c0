"""Operational roll-ups, sources and sinks, and streaming queries."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.clock import as_utc, utc_naive
from ledgerlark.functions.rules import pick
from ledgerlark.operators import models as ml
from ledgerlark.operators import oplog
from ledgerlark.operators.experiments import assign_variant
from ledgerlark.plans.registry import query
from ledgerlark.plans.views import AB_EVENTS, ACCOUNTS, bin_sql
from ledgerlark.session import materialise, run_dir
from ledgerlark.sources import tables
from ledgerlark.sources.accounts import EXPERIMENTS, accounts
from ledgerlark.sources.tables import table
from ledgerlark.streaming import jobs

STATUS = {"view": "healthy", "click": "unhealthy", "error": "failed", "signup": "pending", "purchase": "rolled_back"}
ENVIRONMENTS = {0: "staging", 1: "production", 2: "development"}


@query("""
WITH d AS (SELECT CASE user_id % 3 WHEN 0 THEN 'staging' WHEN 1 THEN 'production' ELSE 'development' END AS environment,
    CASE event_type WHEN 'view' THEN 'healthy' WHEN 'click' THEN 'unhealthy' WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'pending' WHEN 'purchase' THEN 'rolled_back' END AS status FROM events),
k AS (SELECT 'environment' AS section, environment AS key, status FROM d UNION ALL SELECT 'status', status, status FROM d)
SELECT section, key, count(*) AS total, CAST(sum(CASE WHEN status = 'healthy' THEN 1 ELSE 0 END) AS BIGINT) AS healthy,
  CAST(sum(CASE WHEN status IN ('unhealthy', 'failed') THEN 1 ELSE 0 END) AS BIGINT) AS unhealthy FROM k GROUP BY 1, 2""")
def deployment_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Events read as deployment records."""
    records = table(spark, folder, "events").select(
        pick(F.col("user_id") % 3, ENVIRONMENTS).alias("environment"), pick("event_type", STATUS).alias("status")
    )
    return oplog.deployment_rollup(records)


TIMINGS = "count({d}) AS count, round(sum({d}), 4) AS total_time, round(avg({d}), 6) AS avg_time, round(min({d}), 6) AS min_time, round(max({d}), 6) AS max_time"


def _rounded_timings(df: DataFrame) -> DataFrame:
    return df.withColumns({"total_time": F.round("total_time", 4), **{c: F.round(c, 6) for c in ("avg_time", "min_time", "max_time")}})


def performance_log(events: DataFrame) -> DataFrame:
    """Events read as timing records."""
    return events.select(
        F.col("ts").alias("timestamp"), F.lit("engine").alias("component"), F.col("event_type").alias("operation"),
        F.col("value").alias("duration_seconds"), F.lit("timing").alias("performance_type"),
    )


@query(f"SELECT event_type AS operation, {TIMINGS.format(d='value')} FROM events GROUP BY 1")
def timing_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded_timings(oplog.timing_rollup(performance_log(table(spark, folder, "events"))))


@query(f"""
WITH {ACCOUNTS}
SELECT customer_id, TIMESTAMP '2001-08-01 10:30:00' AS timestamp, 'model_decision' AS audit_type, 'propensity' AS model_name,
  sha256('{{"credit_score":' || CAST(credit_score AS BIGINT) || ',"customer_age":' || customer_age || ',"employment_status":"' || employment_status || '"}}') AS input_hash,
  payment_status AS prediction, round(propensity, 6) AS confidence FROM accounts""")
def audit_rows(spark: SparkSession, folder: str) -> DataFrame:
    scored = accounts(spark, folder).select(
        "customer_id", F.col("credit_score").cast("bigint").alias("credit_score"), "customer_age", "employment_status",
        F.col("payment_status").alias("prediction"), F.round("propensity", 6).alias("confidence"),
    )
    at = F.lit("2001-08-01 10:30:00").cast("timestamp_ntz")
    return oplog.audit_rows(scored, ["customer_age", "credit_score", "employment_status"], "propensity", at, ["customer_id"])


@query(f"""
SELECT 'lines' AS source, event_type AS operation, {TIMINGS.format(d='value')} FROM events GROUP BY 2
UNION ALL SELECT 'documents', event_type, {TIMINGS.format(d='value')} FROM events GROUP BY 2""")
def json_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The timing log written and read as JSON lines, and its roll-up as one JSON document per file."""
    log = performance_log(table(spark, folder, "events"))
    lines = run_dir(spark, "perf-log")
    tables.write_json(log.drop("timestamp"), lines)
    schema = "component string, operation string, duration_seconds double, performance_type string"
    from_lines = oplog.timing_rollup(tables.read_json_lines(spark, lines, schema))

    documents = run_dir(spark, "documents")
    report = oplog.timing_rollup(log)
    # one row per operation, hence one document per folder
    report.select("operation", F.to_json(F.struct(*report.columns)).alias("value")).write.partitionBy("operation").text(documents)
    fields = "operation string, count long, total_time double, avg_time double, min_time double, max_time double"
    from_documents = tables.read_json_documents(spark, f"{documents}/*/*.txt", fields).drop("modified_at")
    both = from_lines.withColumn("source", F.lit("lines")).unionByName(from_documents.withColumn("source", F.lit("documents")))
    return _rounded_timings(both)


@query(f"""
WITH {ACCOUNTS}, t AS (SELECT count(*) AS n, round(sum(debt_amount), 2) AS total_debt, count(DISTINCT payment_status) AS statuses FROM accounts)
SELECT format, n, total_debt, statuses FROM t, (SELECT unnest(['csv', 'json', 'snapshot']) AS format)""")
def sinks(spark: SparkSession, folder: str) -> DataFrame:
    """The same table through the CSV, JSON and snapshot sinks, read back and summed."""
    df = accounts(spark, folder).select("customer_id", "debt_amount", "payment_status")
    schema = "customer_id string, debt_amount double, payment_status string"
    csv, json, snapshots = run_dir(spark, "csv"), run_dir(spark, "json"), run_dir(spark, "snapshots")
    tables.write_csv(df, csv)
    tables.write_json(df, json)
    for stamp in ("20010731_103000", "20010801_103000"):
        tables.append_snapshot(df, snapshots, stamp)
    newest = spark.read.parquet(snapshots).where("run_ts = '20010801_103000'").select(*df.columns)
    read = {"csv": tables.read_csv(spark, csv, schema), "json": tables.read_json_lines(spark, json, schema), "snapshot": newest}
    stacked = None
    for name, part in read.items():
        part = part.withColumn("format", F.lit(name))
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy("format").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("debt_amount"), 2).alias("total_debt"), F.countDistinct("payment_status").alias("statuses")
    )


DRIFT_CUT = "2024-01-08"


@query(f"""
WITH e AS (SELECT ts, event_type, value * CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN 1.4::DOUBLE ELSE 1.0::DOUBLE END AS value FROM events),
ranges AS (SELECT event_type, min(value) AS lo, max(value) AS hi, count(*)::DOUBLE AS size FROM e WHERE ts < TIMESTAMP '{DRIFT_CUT}' GROUP BY 1),
b AS (SELECT ts, event_type, coalesce({bin_sql('value', 'lo', 'hi')}, -1) AS bin FROM e JOIN ranges USING (event_type)),
grid AS (SELECT event_type, size, unnest(range(10)) AS bin FROM ranges),
ref AS (SELECT g.event_type, g.bin, count(b.ts) / min(g.size) AS p FROM grid g LEFT JOIN b ON g.event_type = b.event_type AND g.bin = b.bin AND b.ts < TIMESTAMP '{DRIFT_CUT}' GROUP BY 1, 2),
days AS (SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS size FROM b WHERE ts >= TIMESTAMP '{DRIFT_CUT}' GROUP BY 1, 2),
n AS (SELECT date_trunc('day', ts) AS window_start, event_type, bin, count(*) AS n FROM b WHERE ts >= TIMESTAMP '{DRIFT_CUT}' GROUP BY 1, 2, 3),
s AS (SELECT days.window_start, days.event_type, days.size, CASE WHEN p = 0 THEN 0.0001::DOUBLE ELSE p END AS p, CASE WHEN coalesce(n, 0) = 0 THEN 0.0001::DOUBLE ELSE n::DOUBLE / days.size END AS q
  FROM days JOIN ref USING (event_type) LEFT JOIN n ON n.window_start = days.window_start AND n.event_type = days.event_type AND n.bin = ref.bin)
SELECT window_start, event_type, size, round(sum((q - p) * ln(q / p)), 6) AS psi, sum((q - p) * ln(q / p)) > 0.2 AS drift_detected FROM s GROUP BY 1, 2, 3""")
def stream_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Daily drift of the event stream against its first week; values rise by rule from the 20th on."""
    ts = F.col("ts")

    def day(text: str):
        return as_utc(F.lit(text).cast("timestamp_ntz"))

    def shifted(df: DataFrame) -> DataFrame:
        factor = F.when(ts >= day("2024-01-20"), 1.4).otherwise(1.0)
        return df.select("ts", "event_type", (F.col("value") * factor).alias("value"))

    cut = day(DRIFT_CUT)
    past = table(spark, folder, "events").withColumn("ts", as_utc("ts"))
    reference = jobs.reference_bins(shifted(past).where(ts < cut), ["event_type"], "value")
    reference = materialise(reference)  # ten rows per event type, read by the stream and by the verdicts
    ranges = reference.where("bin = 0").select("event_type", "start", "stop", "width")
    stream = shifted(jobs.table_stream(spark, folder, "events", "ts")).where(ts >= cut)
    counts = jobs.run_updates(
        jobs.drift_bin_counts(stream, ranges, ["event_type"], "value"), run_dir(spark, "stream-drift"), ["window_start", "event_type", "bin"]
    )
    verdicts = jobs.drift_verdicts(counts, reference, ["event_type"])
    return verdicts.select(utc_naive("window_start").alias("window_start"), "event_type", "size", F.round("psi", 6).alias("psi"), "drift_detected")


@query(f"""
WITH {AB_EVENTS}
SELECT date_trunc('day', p.ts) AS window_start, experiment_id, variant, count(*) AS n, CAST(sum(CASE WHEN prediction = actual THEN 1 ELSE 0 END) AS BIGINT) AS correct
FROM ab_predictions p JOIN ab_actuals USING (unit_id) GROUP BY 1, 2, 3""")
def stream_ab(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions arriving partly twice, matched once with their outcomes, counted per day and variant."""
    listed = F.array(*[F.struct(F.lit(e).alias("id"), F.lit(s).alias("split")) for e, s, _ in EXPERIMENTS])

    def predictions(events: DataFrame) -> DataFrame:
        spread = events.select("event_id", "user_id", "ts", F.explode(listed).alias("x"))
        variant = assign_variant(F.col("x.id"), "user_id", F.col("x.split"))
        key = F.col("event_id")
        wrong = key % F.when(variant == "treatment", 4).otherwise(3) == 0
        guess = F.when(wrong, (key + F.col("user_id")) % 3).otherwise(key % 3).cast("int")
        return spread.select(
            F.col("x.id").alias("experiment_id"), variant.alias("variant"), key.alias("unit_id"), "ts", guess.alias("prediction")
        )

    events = jobs.table_stream(spark, folder, "events", "ts")
    repeated = jobs.table_stream(spark, folder, "events", "ts").where(F.col("event_id") % 5 == 0)
    actuals = jobs.table_stream(spark, folder, "events", "ts").where(F.col("event_id") % 10 != 9).select(
        F.col("event_id").alias("unit_id"), F.col("ts").alias("actual_ts"), (F.col("event_id") % 3).cast("int").alias("actual")
    )
    pairs = jobs.matched_events(predictions(events.unionByName(repeated)), actuals)
    path = run_dir(spark, "stream-pairs")
    matched = jobs.run_append(pairs, path)
    again = spark.readStream.schema(matched.schema).parquet(f"{path}/table")
    windows = jobs.run_updates(jobs.variant_windows(again), run_dir(spark, "stream-ab"), ["window_start", "experiment_id", "variant"])
    return windows.withColumn("window_start", utc_naive("window_start"))


@query(f"""
WITH s AS (SELECT event_type AS operation, value, unnest([time_bucket(INTERVAL 12 HOUR, ts), time_bucket(INTERVAL 12 HOUR, ts) - INTERVAL 12 HOUR]) AS window_start FROM events)
SELECT window_start, operation, {TIMINGS.format(d='value')} FROM s GROUP BY 1, 2""")
def stream_timings(spark: SparkSession, folder: str) -> DataFrame:
    """Timings over sliding days, read from JSON lines as a stream."""
    log = run_dir(spark, "timing-log")
    tables.write_json(performance_log(table(spark, folder, "events")), log)
    schema = "timestamp timestamp_ntz, component string, operation string, duration_seconds double, performance_type string"
    stream = spark.readStream.schema(schema).json(log).withColumn("timestamp", as_utc("timestamp"))
    windows = jobs.run_updates(jobs.timing_windows(stream), run_dir(spark, "stream-timings"), ["window_start", "operation"])
    return _rounded_timings(windows.withColumn("window_start", utc_naive("window_start")))


@query()
def stream_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Line items scored as a stream by a model fitted on the same table, with audit fields."""
    inputs = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    items = table(spark, folder, "lineitem")
    model = Pipeline(stages=[
        StringIndexer(inputCol="l_returnflag", outputCol="label", stringOrderType="alphabetAsc"),
        VectorAssembler(inputCols=inputs, outputCol="features"),
        LogisticRegression(family="multinomial", maxIter=ml.PRESETS["logistic"]["maxIter"]),
    ]).fit(items)
    stream = jobs.table_stream(spark, folder, "lineitem")
    at = F.lit("2001-08-01 10:30:00").cast("timestamp_ntz")
    scored = jobs.run_append(jobs.scored_stream(stream, model, inputs, "logistic", at, ["l_orderkey"]), run_dir(spark, "stream-scores"))
    return scored.groupBy("model_name", "prediction").agg(
        F.count(F.lit(1)).alias("n"), F.avg("confidence").alias("mean_confidence"), F.countDistinct("input_hash").alias("distinct_inputs")
    )
