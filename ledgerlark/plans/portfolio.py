"""Per-account rules, segments and contact recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions import contact, rules
from ledgerlark.operators.explore import crosstab_pct, value_counts_share
from ledgerlark.plans.registry import query
from ledgerlark.plans.views import ACCOUNTS, RISK_SEGMENT
from ledgerlark.sources.accounts import accounts
from ledgerlark.sources.tables import table

AS_OF_TS = "2001-08-01 10:30:00"
HOURS = {name: str(hours) for name, hours in contact.BEST_HOURS.items()}
AVOID = {name: str(hours) for name, hours in contact.AVOID_HOURS.items()}


def _case(column: str, options: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in options.items())
    return f"CASE {column} {whens} ELSE {default} END"


BEST_SQL = _case("employment_status", HOURS, HOURS["employed"])
AVOID_SQL = _case("employment_status", AVOID, AVOID["employed"])
URGENCY_SQL = """
  CASE WHEN dp + ap >= 4 THEN 'critical' WHEN dp + ap >= 2 THEN 'high' WHEN dp + ap >= 1 THEN 'medium' ELSE 'low' END"""
URGENCY_POINTS = """
  CASE WHEN days_overdue > 90 THEN 3 WHEN days_overdue > 60 THEN 2 WHEN days_overdue > 30 THEN 1 ELSE 0 END AS dp,
  CASE WHEN debt_amount > 25000 THEN 3 WHEN debt_amount > 10000 THEN 2 WHEN debt_amount > 5000 THEN 1 ELSE 0 END AS ap"""
PROFILES = f"""{ACCOUNTS},
profiles AS (
  SELECT customer_id, customer_age, employment_status, payment_status, days_overdue, contact_success_rate,
         coalesce(debt_amount, 0.0::DOUBLE) AS debt_amount FROM accounts)"""
OPTIONS = f"""{PROFILES},
flags AS (
  SELECT *, (days_overdue > 90 OR debt_amount > 10000) AS urgent,
         NOT (days_overdue > 90 OR debt_amount > 10000) AND days_overdue > 30 AS medium,
         NOT (days_overdue > 90 OR debt_amount > 10000) AND days_overdue <= 30 AS low FROM profiles),
options AS (
  SELECT customer_id, 1 AS priority, 'legal_notice' AS channel, 'High debt amount requires legal intervention' AS reason, 1.0::DOUBLE AS uplift
    FROM flags WHERE urgent AND debt_amount > 25000
  UNION ALL SELECT customer_id, 2, 'phone', 'Urgent case requires immediate contact', 1.0 FROM flags WHERE urgent
  UNION ALL SELECT customer_id, 1, 'phone', 'Good response history suggests phone contact', 1.2 FROM flags WHERE medium AND contact_success_rate > 0.6
  UNION ALL SELECT customer_id, 1, 'sms', 'SMS for better response with poor phone history', 1.0 FROM flags WHERE medium AND contact_success_rate <= 0.6
  UNION ALL SELECT customer_id, 1, 'sms', 'Younger customers prefer SMS communication', 1.1 FROM flags WHERE low AND customer_age < 40
  UNION ALL SELECT customer_id, 2, 'email', 'Digital-native demographic', 1.1 FROM flags WHERE low AND customer_age < 40
  UNION ALL SELECT customer_id, 1, 'phone', 'Traditional contact method for older customers', 1.0 FROM flags WHERE low AND customer_age >= 40
  UNION ALL SELECT customer_id, 3, 'email', 'Cost-effective backup option', 1.0 FROM flags WHERE NOT (low AND customer_age < 40)),
channels AS (
  SELECT * FROM (VALUES ('phone', 0.75::DOUBLE, 5.0::DOUBLE, 'immediate'), ('email', 0.45, 1.0, '24-48h'), ('sms', 0.65, 2.0, '1-4h'),
    ('letter', 0.35, 8.0, '5-7 days'), ('legal_notice', 0.85, 50.0, '7-14 days')) AS t(channel, effectiveness, cost, response_time)),
ranked AS (
  SELECT customer_id, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY priority) AS INTEGER) AS rank, channel, priority, reason,
         round(effectiveness * uplift, 6) AS expected_effectiveness, cost, response_time,
         first_value(channel) OVER (PARTITION BY customer_id ORDER BY priority) AS primary_channel
  FROM options JOIN channels USING (channel))"""
SLOTS = f"""{PROFILES},
hours AS (
  SELECT customer_id, employment_status, CASE WHEN days_overdue > 60 THEN [9,10,11,12,13,14,15,16,17,18,19] ELSE {BEST_SQL} END AS best,
         {BEST_SQL} AS liked, {AVOID_SQL} AS disliked FROM profiles),
grid AS (
  SELECT customer_id, employment_status, liked, disliked, d.i AS day_offset, unnest(best) AS hour
  FROM hours CROSS JOIN range(7) AS d(i)),
stamped AS (
  SELECT *, TIMESTAMP '2001-08-01 00:00:00' + day_offset * INTERVAL 1 DAY + hour * INTERVAL 1 HOUR AS slot_ts,
         strftime(DATE '2001-08-01' + CAST(day_offset AS INTEGER), '%A') AS day FROM grid),
slots AS (
  SELECT customer_id, slot_ts, day, hour,
         greatest(0.1::DOUBLE, 1.0::DOUBLE
           + CASE WHEN employment_status = 'employed'
                  THEN CASE WHEN day IN ('Saturday', 'Sunday') THEN -0.3::DOUBLE ELSE 0.5::DOUBLE END
                  ELSE CASE WHEN day IN ('Tuesday', 'Wednesday', 'Thursday') THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END END
           + CASE WHEN list_contains(liked, hour) THEN 0.5::DOUBLE WHEN list_contains(disliked, hour) THEN -0.5::DOUBLE ELSE 0.0::DOUBLE END) AS score
  FROM stamped
  WHERE slot_ts > TIMESTAMP '{AS_OF_TS}'
    AND NOT (CASE WHEN employment_status = 'employed' THEN day IN ('Saturday', 'Sunday') ELSE day IN ('Monday', 'Sunday') END)),
top_slots AS (
  SELECT customer_id, CAST(rn AS INTEGER) AS slot_rank, slot_ts, day, CAST(hour AS INTEGER) AS hour, round(score, 4) AS score
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, slot_ts) AS rn FROM slots) WHERE rn <= 5)"""
STRATEGY = f"""{PROFILES},
strategies AS (
  SELECT customer_id,
    CASE WHEN days_overdue > 90 THEN 'aggressive' WHEN days_overdue > 60 THEN 'firm' WHEN days_overdue > 30 THEN 'persuasive' ELSE 'standard' END AS approach,
    CASE WHEN days_overdue > 90 THEN 'daily' WHEN days_overdue > 60 THEN 'every_3_days' WHEN days_overdue > 30 THEN 'twice_weekly' ELSE 'weekly' END AS frequency,
    CASE WHEN days_overdue > 90 THEN '7_days' WHEN days_overdue > 60 THEN '14_days' WHEN days_overdue > 30 THEN '21_days' ELSE '30_days' END AS escalation_timeline,
    concat_ws(' | ',
      CASE WHEN days_overdue > 90 THEN 'Consider legal action | Offer payment plan immediately'
           WHEN days_overdue > 60 THEN 'Emphasize consequences | Negotiate payment terms'
           WHEN days_overdue > 30 THEN 'Focus on relationship | Offer incentives' END,
      CASE WHEN debt_amount > 15000 THEN 'Assign senior collector | Consider settlement options' END,
      CASE WHEN payment_status = 'partial_payment' THEN 'Acknowledge partial payments | Encourage completion'
           WHEN payment_status = 'no_payment' THEN 'Investigate payment ability | Consider hardship programs' END) AS special_instructions
  FROM profiles)"""


def with_segment(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "risk_segment",
        rules.risk_segment("days_overdue", "credit_score", F.col("response_rate") * 100, "debt_amount", "annual_income"),
    )


def as_of() -> Column:
    return F.lit(AS_OF_TS).cast("timestamp_ntz")


@query(f"""
WITH {ACCOUNTS}, seg AS (SELECT {RISK_SEGMENT} AS risk_segment, payment_status FROM accounts)
SELECT risk_segment,
  round(100.0::DOUBLE * sum(CASE WHEN payment_status = 'full_payment' THEN 1 ELSE 0 END) / count(*), 4) AS full_payment,
  round(100.0::DOUBLE * sum(CASE WHEN payment_status = 'no_payment' THEN 1 ELSE 0 END) / count(*), 4) AS no_payment,
  round(100.0::DOUBLE * sum(CASE WHEN payment_status = 'partial_payment' THEN 1 ELSE 0 END) / count(*), 4) AS partial_payment
FROM seg GROUP BY risk_segment""")
def risk_segment_outcome(spark: SparkSession, folder: str) -> DataFrame:
    """How the outcome varies by risk segment (row percentages)."""
    return crosstab_pct(with_segment(accounts(spark, folder)), "risk_segment", "payment_status", rules.OUTCOMES, digits=4)


@query(f"WITH {ACCOUNTS} SELECT customer_id, round(propensity, 6) AS propensity, payment_status FROM accounts")
def propensity_status(spark: SparkSession, folder: str) -> DataFrame:
    return accounts(spark, folder).select(
        "customer_id", F.round("propensity", 6).alias("propensity"), "payment_status"
    )


@query(f"""
WITH {ACCOUNTS}, b AS (
  SELECT *, CASE WHEN days_overdue - 1 <= 0 THEN NULL WHEN days_overdue - 1 <= 30 THEN '0-30' WHEN days_overdue - 1 <= 60 THEN '31-60'
    WHEN days_overdue - 1 <= 90 THEN '61-90' WHEN days_overdue - 1 <= 180 THEN '91-180' WHEN days_overdue - 1 <= 365 THEN '181-365' ELSE '365+' END AS dpd_category
  FROM accounts)
SELECT dpd_category,
  CASE dpd_category WHEN '0-30' THEN 1 WHEN '31-60' THEN 2 WHEN '61-90' THEN 3 WHEN '91-180' THEN 4 WHEN '181-365' THEN 5 WHEN '365+' THEN 6 ELSE 0 END AS dpd_rank,
  count(*) AS n, round(avg(credit_score), 4) AS mean_credit_score, round(avg(response_rate), 6) AS mean_response_rate,
  round(avg(CASE WHEN payment_status = 'full_payment' THEN 1.0 ELSE 0.0 END), 6) AS full_payment_rate
FROM b GROUP BY 1, 2""")
def dpd_bucket_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Group means per days-past-due bucket; accounts not yet overdue have no bucket."""
    bucket = rules.days_past_due_bucket(F.col("days_overdue") - 1)
    grouped = accounts(spark, folder).withColumn("dpd_category", bucket).groupBy("dpd_category")
    return grouped.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("credit_score"), 4).alias("mean_credit_score"),
        F.round(F.avg("response_rate"), 6).alias("mean_response_rate"),
        F.round(F.avg(F.when(F.col("payment_status") == "full_payment", 1.0).otherwise(0.0)), 6).alias("full_payment_rate"),
    ).select(
        "dpd_category",
        F.coalesce(rules.days_past_due_rank("dpd_category"), F.lit(0)).alias("dpd_rank"),
        "n", "mean_credit_score", "mean_response_rate", "full_payment_rate",
    )


@query(f"""
WITH {PROFILES}, u AS (SELECT {URGENCY_POINTS} FROM profiles), l AS (SELECT {URGENCY_SQL} AS urgency_level FROM u)
SELECT urgency_level, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM l GROUP BY 1""")
def urgency_counts(spark: SparkSession, folder: str) -> DataFrame:
    profiles = contact.with_profile_defaults(accounts(spark, folder))
    level = rules.urgency_level(F.col("days_overdue"), F.col("debt_amount"))
    return value_counts_share(profiles.withColumn("urgency_level", level), "urgency_level")


@query(f"WITH {OPTIONS} SELECT * FROM ranked")
def channel_recommendation(spark: SparkSession, folder: str) -> DataFrame:
    """One row per account and channel option, with the channel's response time."""
    p = contact.with_profile_defaults(accounts(spark, folder))
    options = contact.channel_options(
        F.col("days_overdue"), F.col("debt_amount"), F.col("contact_success_rate"), F.col("customer_age")
    )
    listed = p.select("customer_id", options.alias("options")).select(
        "customer_id", F.col("options")[0]["channel"].alias("primary_channel"), F.posexplode("options").alias("pos", "o")
    )
    # five fixed rows, so the hint is safe at any scale
    dimension = F.broadcast(contact.contact_channels(spark).select("channel", "response_time"))
    return (
        listed.select(
            "customer_id",
            (F.col("pos") + 1).alias("rank"),
            "o.channel", "o.priority", "o.reason",
            F.round("o.expected_effectiveness", 6).alias("expected_effectiveness"),
            "o.cost",
            "primary_channel",
        )
        .join(dimension, "channel")
        .select("customer_id", "rank", "channel", "priority", "reason", "expected_effectiveness", "cost", "response_time", "primary_channel")
    )


@query(f"WITH {SLOTS} SELECT * FROM top_slots")
def contact_slots_top5(spark: SparkSession, folder: str) -> DataFrame:
    """The five best coming slots per account, ranked without a shuffle."""
    p = contact.with_timing(contact.with_profile_defaults(accounts(spark, folder)), as_of())
    return p.select("customer_id", F.posexplode("next_best_times").alias("pos", "s")).select(
        "customer_id", (F.col("pos") + 1).alias("slot_rank"), "s.slot_ts", "s.day", "s.hour", F.round("s.score", 4).alias("score")
    )


@query(f"WITH {STRATEGY} SELECT * FROM strategies")
def contact_strategy(spark: SparkSession, folder: str) -> DataFrame:
    p = contact.with_profile_defaults(accounts(spark, folder))
    s = contact.strategy(F.col("days_overdue"), F.col("debt_amount"), F.col("payment_status"))
    return p.select("customer_id", s.alias("s")).select(
        "customer_id", "s.approach", "s.frequency", "s.escalation_timeline",
        F.concat_ws(" | ", "s.special_instructions").alias("special_instructions"),
    )


@query(f"""
WITH {OPTIONS}, hours AS (
  SELECT customer_id, employment_status, CASE WHEN days_overdue > 60 THEN [9,10,11,12,13,14,15,16,17,18,19] ELSE {BEST_SQL} END AS best,
         CASE WHEN days_overdue > 60 THEN [21,22,23,0,1,2,3,4,5,6,7,8] ELSE {AVOID_SQL} END AS avoid FROM profiles),
u AS (SELECT customer_id, {URGENCY_POINTS} FROM profiles)
SELECT p.customer_id, r.primary_channel, {URGENCY_SQL} AS urgency_level,
  o.channels, array_to_string(h.best, ',') AS best_hours, array_to_string(h.avoid, ',') AS avoid_hours,
  CASE WHEN p.employment_status = 'employed' THEN 'Monday,Tuesday,Wednesday,Thursday,Friday' ELSE 'Tuesday,Wednesday,Thursday,Friday,Saturday' END AS best_days,
  CASE WHEN p.employment_status = 'employed' THEN 'Saturday,Sunday' ELSE 'Monday,Sunday' END AS avoid_days,
  CASE WHEN p.days_overdue > 90 THEN 'aggressive' WHEN p.days_overdue > 60 THEN 'firm' WHEN p.days_overdue > 30 THEN 'persuasive' ELSE 'standard' END AS approach
FROM profiles p JOIN hours h USING (customer_id) JOIN u USING (customer_id)
  JOIN (SELECT customer_id, string_agg(channel, ',' ORDER BY priority) AS channels FROM options GROUP BY 1) o USING (customer_id)
  JOIN (SELECT customer_id, primary_channel FROM ranked WHERE rank = 1) r USING (customer_id)""")
def recommendation_document(spark: SparkSession, folder: str) -> DataFrame:
    """The whole document per account, flattened to one row."""
    doc = contact.recommendation(accounts(spark, folder), as_of())
    channel, timing = F.col("channel_recommendations"), F.col("timing_recommendations")

    def listed(array):
        return F.array_join(array.cast("array<string>"), ",")

    return doc.select(
        "customer_id",
        channel["primary_channel"].alias("primary_channel"),
        channel["urgency_level"].alias("urgency_level"),
        listed(F.transform(channel["recommendations"], lambda r: r["channel"])).alias("channels"),
        listed(timing["best_hours"]).alias("best_hours"),
        listed(timing["avoid_hours"]).alias("avoid_hours"),
        listed(timing["best_days"]).alias("best_days"),
        listed(timing["avoid_days"]).alias("avoid_days"),
        F.col("contact_strategy.approach").alias("approach"),
    )


@query(f"""
WITH {ACCOUNTS}, texts AS (
  SELECT customer_id, CASE WHEN c_custkey % 11 = 0 THEN 'unknown' WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(CAST(days_overdue AS BIGINT) AS VARCHAR) END AS days_text,
         debt_amount FROM accounts),
parsed AS (SELECT *, CASE WHEN days_text IS NULL THEN 0.0::DOUBLE ELSE TRY_CAST(days_text AS DOUBLE) END AS days_overdue FROM texts),
pts AS (SELECT customer_id, days_text, days_overdue AS days, {URGENCY_POINTS} FROM (SELECT customer_id, days_text, days_overdue, coalesce(debt_amount, 0.0::DOUBLE) AS debt_amount FROM parsed))
SELECT customer_id, CASE WHEN days IS NOT NULL THEN {URGENCY_SQL} END AS urgency_level,
  CASE WHEN days IS NULL THEN 'unreadable days_overdue: ' || days_text END AS error
FROM pts""")
def recommendation_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Text profiles: an unreadable attribute gives an error row, a missing one its default; no row is lost."""
    key = F.col("c_custkey")
    text = (
        F.when(key % 11 == 0, "unknown")
        .when(key % 13 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("days_overdue").cast("bigint").cast("string"))
    )
    raw = accounts(spark, folder).select("customer_id", text.alias("days_text"), "debt_amount")
    days = F.when(F.col("days_text").isNull(), 0.0).otherwise(F.col("days_text").try_cast("double"))
    parsed = raw.withColumn("days_overdue", days)
    readable = F.col("days_overdue").isNotNull()
    level = rules.urgency_level(F.col("days_overdue"), rules.with_default("debt_amount", 0.0))
    return parsed.select(
        "customer_id",
        F.when(readable, level).alias("urgency_level"),
        F.when(~readable, F.concat(F.lit("unreadable days_overdue: "), "days_text")).alias("error"),
    )


@query(f"""
WITH {ACCOUNTS}
SELECT customer_id, round(debt_amount / nullif(annual_income, 0), 6) AS debt_ratio,
  round(debt_amount / nullif(contact_attempts, 0), 9) AS debt_per_attempt,
  round(CASE WHEN debt_amount IS NOT NULL THEN least(greatest(debt_amount, 5000.0::DOUBLE), 40000.0::DOUBLE) END, 4) AS clipped_debt,
  round(CASE WHEN annual_income > 0 THEN log10(annual_income) END, 6) AS log_income,
  CASE WHEN c_custkey % 2 = 0 THEN 'even' ELSE 'odd' END AS parity
FROM accounts""")
def derived_ratios(spark: SparkSession, folder: str) -> DataFrame:
    return accounts(spark, folder).select(
        "customer_id",
        F.round(rules.ratio("debt_amount", "annual_income"), 6).alias("debt_ratio"),
        F.round(rules.ratio("debt_amount", "contact_attempts"), 9).alias("debt_per_attempt"),
        F.round(rules.clip("debt_amount", 5000.0, 40000.0), 4).alias("clipped_debt"),
        F.round(rules.log10_positive("annual_income"), 6).alias("log_income"),
        F.when(F.col("c_custkey") % 2 == 0, "even").otherwise("odd").alias("parity"),
    )


@query("""
WITH t AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN 'missing' WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_totalprice AS VARCHAR) END AS price_text FROM orders)
SELECT o_orderstatus, count(*) AS n, count(TRY_CAST(price_text AS DOUBLE)) AS readable,
  round(avg(coalesce(TRY_CAST(price_text AS DOUBLE), 0.0::DOUBLE)), 4) AS mean_coerced, round(avg(TRY_CAST(price_text AS DOUBLE)), 4) AS mean_readable
FROM t GROUP BY 1""")
def numeric_coerce(spark: SparkSession, folder: str) -> DataFrame:
    """Text amounts coerced to numbers, unreadable ones to 0; and the mean over readable ones only."""
    key = F.col("o_orderkey")
    text = (
        F.when(key % 7 == 0, "missing")
        .when(key % 5 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("o_totalprice").cast("string"))
    )
    read = table(spark, folder, "orders").select("o_orderstatus", text.alias("price_text"))
    number = F.col("price_text").try_cast("double")
    return read.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(number).alias("readable"),
        F.round(F.avg(rules.to_number("price_text")), 4).alias("mean_coerced"),
        F.round(F.avg(number), 4).alias("mean_readable"),
    )


@query(f"""
WITH {ACCOUNTS}
SELECT customer_id, payment_status AS predicted_class,
  CASE payment_status WHEN 'no_payment' THEN 'High' WHEN 'full_payment' THEN 'Low' ELSE 'Medium' END AS risk_level,
  CASE payment_status WHEN 'no_payment' THEN 'Immediate intervention required | Consider legal action | Offer payment plan options | Increase contact frequency'
    WHEN 'full_payment' THEN 'Standard collection process | Send payment reminders | Maintain regular contact | Monitor payment behavior'
    ELSE 'Negotiate payment terms | Offer partial payment plans | Increase engagement | Monitor closely' END AS actions
FROM accounts""")
def prediction_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Class index to class name, risk level and actions."""
    index = F.array_position(F.array(*[F.lit(o) for o in rules.OUTCOMES]), F.col("payment_status")).cast("int") - 1
    coded = accounts(spark, folder).select("customer_id", index.alias("prediction"))
    name = F.array(*[F.lit(o) for o in rules.OUTCOMES])[F.col("prediction")]
    return coded.withColumn("predicted_class", name).select(
        "customer_id",
        "predicted_class",
        rules.risk_level_of_outcome("predicted_class").alias("risk_level"),
        F.array_join(rules.actions_of_outcome("predicted_class"), " | ").alias("actions"),
    )


@query(f"""
WITH {ACCOUNTS}
SELECT employment_status, string_agg(DISTINCT debt_type, ',' ORDER BY debt_type) AS debt_types, count(DISTINCT debt_type) AS n_types,
  count(*) AS n FROM accounts WHERE payment_status <> 'full_payment' AND days_overdue > 30 GROUP BY 1""")
def category_subset(spark: SparkSession, folder: str) -> DataFrame:
    """Subset by predicates, then the distinct categories per group."""
    overdue = accounts(spark, folder).where((F.col("payment_status") != "full_payment") & (F.col("days_overdue") > 30))
    return overdue.groupBy("employment_status").agg(
        F.array_join(F.array_sort(F.collect_set("debt_type")), ",").alias("debt_types"),
        F.size(F.collect_set("debt_type")).cast("long").alias("n_types"),
        F.count(F.lit(1)).alias("n"),
    )
