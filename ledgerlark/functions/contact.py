"""Contact channel, timing and strategy of one account, as expressions and one ten-row table (no shuffle, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.rules import pick, urgency_level, with_default

# Channel table, hour preferences, day policies, defaults, reasons and instructions.
CONTACT_CHANNELS = {
    "phone": (0.75, 5.0, "immediate"),
    "email": (0.45, 1.0, "24-48h"),
    "sms": (0.65, 2.0, "1-4h"),
    "letter": (0.35, 8.0, "5-7 days"),
    "legal_notice": (0.85, 50.0, "7-14 days"),
}
BEST_HOURS = {
    "employed": [9, 10, 17, 18, 19],
    "unemployed": [10, 11, 14, 15, 16],
    "retired": [9, 10, 11, 14, 15],
    "self_employed": [9, 10, 17, 18, 19, 20],
}
AVOID_HOURS = {
    "employed": [11, 12, 13, 14, 15, 16],
    "unemployed": [8, 9, 17, 18, 19],
    "retired": [12, 13, 17, 18, 19, 20],
    "self_employed": [11, 12, 13, 14, 15, 16],
}
URGENT_BEST_HOURS = [9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19]
URGENT_AVOID_HOURS = [21, 22, 23, 0, 1, 2, 3, 4, 5, 6, 7, 8]
EMPLOYED_DAYS = (["Monday", "Tuesday", "Wednesday", "Thursday", "Friday"], ["Saturday", "Sunday"])
OTHER_DAYS = (["Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"], ["Monday", "Sunday"])
OTHER_POLICY = "other"  # any other status: hours of the employed, days of the others
URGENT_DAYS = 60
MIDWEEK = ["Tuesday", "Wednesday", "Thursday"]
PROFILE_DEFAULTS = {
    "payment_status": "unknown",
    "days_overdue": 0.0,
    "contact_success_rate": 0.5,
    "debt_amount": 0.0,
    "customer_age": 45,
    "employment_status": "employed",
}
REASONS = {
    "legal": "High debt amount requires legal intervention",
    "urgent": "Urgent case requires immediate contact",
    "good_history": "Good response history suggests phone contact",
    "poor_history": "SMS for better response with poor phone history",
    "young_sms": "Younger customers prefer SMS communication",
    "young_email": "Digital-native demographic",
    "older_phone": "Traditional contact method for older customers",
    "backup": "Cost-effective backup option",
}
# (approach, frequency, escalation, instructions) above 90, 60 and 30 days, and otherwise
STRATEGY_TIERS = [
    (90, "aggressive", "daily", "7_days", ["Consider legal action", "Offer payment plan immediately"]),
    (60, "firm", "every_3_days", "14_days", ["Emphasize consequences", "Negotiate payment terms"]),
    (30, "persuasive", "twice_weekly", "21_days", ["Focus on relationship", "Offer incentives"]),
]
STANDARD_STRATEGY = ("standard", "weekly", "30_days")
HIGH_VALUE_INSTRUCTIONS = ["Assign senior collector", "Consider settlement options"]
STATUS_INSTRUCTIONS = {
    "partial_payment": ["Acknowledge partial payments", "Encourage completion"],
    "no_payment": ["Investigate payment ability", "Consider hardship programs"],
}


def contact_channels(spark: SparkSession) -> DataFrame:
    """The channel dimension: five fixed rows."""
    rows = [(name, *attributes) for name, attributes in CONTACT_CHANNELS.items()]
    return spark.createDataFrame(rows, "channel string, effectiveness double, cost double, response_time string")


def time_preferences(spark: SparkSession) -> DataFrame:
    """The hour-preference dimension: four fixed rows."""
    rows = [(name, BEST_HOURS[name], AVOID_HOURS[name]) for name in BEST_HOURS]
    return spark.createDataFrame(rows, "employment_status string, best_hours array<int>, avoid_hours array<int>")


def with_profile_defaults(df: DataFrame) -> DataFrame:
    """Fill missing attributes of a profile; attributes absent from the schema are added."""
    filled = {
        name: with_default(F.col(name), default) if name in df.columns else F.lit(default)
        for name, default in PROFILE_DEFAULTS.items()
    }
    return df.withColumns(filled)


def _option(when: Column, priority: int, channel: str, reason: str, uplift: float = 1.0) -> Column:
    effectiveness, cost, _ = CONTACT_CHANNELS[channel]
    return F.when(
        when,
        F.struct(
            F.lit(priority).alias("priority"),
            F.lit(channel).alias("channel"),
            F.lit(REASONS[reason]).alias("reason"),
            F.lit(effectiveness * uplift).alias("expected_effectiveness"),
            F.lit(cost).alias("cost"),
        ),
    )


def channel_options(days: Column, debt: Column, success: Column, age: Column) -> Column:
    """Array of channel options sorted by priority; priorities never repeat within a row."""
    urgent = (days > 90) | (debt > 10000)
    medium = ~urgent & (days > 30)
    low = ~urgent & ~medium
    young = low & (age < 40)
    options = F.array(
        _option(urgent & (debt > 25000), 1, "legal_notice", "legal"),
        _option(urgent, 2, "phone", "urgent"),
        _option(medium & (success > 0.6), 1, "phone", "good_history", 1.2),
        _option(medium & ~(success > 0.6), 1, "sms", "poor_history"),
        _option(young, 1, "sms", "young_sms", 1.1),
        _option(young, 2, "email", "young_email", 1.1),
        _option(low & ~young, 1, "phone", "older_phone"),
        _option(~young, 3, "email", "backup"),
    )
    return F.array_sort(F.filter(options, lambda o: o.isNotNull()))


def best_hours(employment: Column, days: Column) -> Column:
    usual = pick(employment, BEST_HOURS, BEST_HOURS["employed"])
    return F.when(days > URGENT_DAYS, F.array(*[F.lit(h) for h in URGENT_BEST_HOURS])).otherwise(usual)


def avoid_hours(employment: Column, days: Column) -> Column:
    usual = pick(employment, AVOID_HOURS, AVOID_HOURS["employed"])
    return F.when(days > URGENT_DAYS, F.array(*[F.lit(h) for h in URGENT_AVOID_HOURS])).otherwise(usual)


def best_days(employment: Column) -> Column:
    return pick(employment, {"employed": EMPLOYED_DAYS[0]}, OTHER_DAYS[0])


def avoid_days(employment: Column) -> Column:
    return pick(employment, {"employed": EMPLOYED_DAYS[1]}, OTHER_DAYS[1])


def slot_score(day: Column, hour: Column, employment: Column) -> Column:
    """Preference of one day and hour; hours are judged by the usual preference, not the urgent one."""
    employed = F.when(day.isin(EMPLOYED_DAYS[0]), 0.5).otherwise(-0.3)
    other = F.when(day.isin(MIDWEEK), 0.3).otherwise(0.0)
    by_day = F.when(employment == "employed", employed).otherwise(other)
    liked = F.array_contains(pick(employment, BEST_HOURS, BEST_HOURS["employed"]), hour)
    disliked = F.array_contains(pick(employment, AVOID_HOURS, AVOID_HOURS["employed"]), hour)
    by_hour = F.when(liked, 0.5).when(disliked, -0.5).otherwise(0.0)
    return F.greatest(F.lit(0.1), F.lit(1.0) + by_day + by_hour)


def next_slots(employment: Column, days: Column, as_of: Column, horizon_days: int = 7, keep: int = 5) -> Column:
    """The best coming slots as array of (rank_key, slot_ts, day, hour, score); ties chronological."""
    start = F.date_trunc("day", as_of)
    hours = best_hours(employment, days)

    def of_day(offset: Column) -> Column:
        day_start = start + F.make_dt_interval(offset)
        day = F.date_format(day_start, "EEEE")
        slots = F.transform(
            hours,
            lambda h: F.struct(
                (-slot_score(day, h, employment)).alias("rank_key"),
                (day_start + F.make_dt_interval(F.lit(0), h)).alias("slot_ts"),
                day.alias("day"),
                h.alias("hour"),
                slot_score(day, h, employment).alias("score"),
            ),
        )
        return F.filter(slots, lambda s: (s["slot_ts"] > as_of) & ~F.array_contains(avoid_days(employment), day))

    every = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(horizon_days - 1)), of_day))
    return F.slice(F.array_sort(every), 1, keep)


def slot_policy(spark: SparkSession, as_of: Column, horizon_days: int = 7, keep: int = 5) -> DataFrame:
    """`(policy, urgent, best_hours, avoid_hours, best_days, avoid_days, next_best_times)`.

    Timing depends on the employment class and on urgency only, so the slots are worked out for these
    ten combinations instead of for every account.
    """
    classes = [(name, urgent) for name in [*BEST_HOURS, OTHER_POLICY] for urgent in (False, True)]
    rows = spark.createDataFrame(classes, "policy string, urgent boolean")
    employment, days = F.col("policy"), F.when(F.col("urgent"), F.lit(URGENT_DAYS + 1)).otherwise(F.lit(0))
    return rows.select(
        "policy", "urgent",
        best_hours(employment, days).alias("best_hours"),
        avoid_hours(employment, days).alias("avoid_hours"),
        best_days(employment).alias("best_days"),
        avoid_days(employment).alias("avoid_days"),
        next_slots(employment, days, as_of, horizon_days, keep).alias("next_best_times"),
    )


def with_timing(df: DataFrame, as_of: Column) -> DataFrame:
    """Add the timing columns; the policy side has ten fixed rows, so its broadcast is safe at any scale."""
    policy = F.when(F.col("employment_status").isin(list(BEST_HOURS)), F.col("employment_status")).otherwise(OTHER_POLICY)
    keyed = df.withColumns({"policy": policy, "urgent": F.col("days_overdue") > URGENT_DAYS})
    return keyed.join(F.broadcast(slot_policy(df.sparkSession, as_of)), ["policy", "urgent"], "left").drop("policy", "urgent")


def strategy(days: Column, debt: Column, status: Column) -> Column:
    """Struct (approach, frequency, escalation_timeline, special_instructions)."""

    def tiered(index: int, standard: Column) -> Column:
        out = None
        for tier in STRATEGY_TIERS:
            value = tier[index]
            value = F.array(*[F.lit(v) for v in value]) if isinstance(value, list) else F.lit(value)
            out = F.when(days > tier[0], value) if out is None else out.when(days > tier[0], value)
        return out.otherwise(standard)

    none = F.array().cast("array<string>")
    instructions = F.concat(
        tiered(4, none),
        F.when(debt > 15000, F.array(*[F.lit(i) for i in HIGH_VALUE_INSTRUCTIONS])).otherwise(none),
        F.coalesce(pick(status, STATUS_INSTRUCTIONS), none),
    )
    return F.struct(
        tiered(1, F.lit(STANDARD_STRATEGY[0])).alias("approach"),
        tiered(2, F.lit(STANDARD_STRATEGY[1])).alias("frequency"),
        tiered(3, F.lit(STANDARD_STRATEGY[2])).alias("escalation_timeline"),
        instructions.alias("special_instructions"),
    )


def recommendation(df: DataFrame, as_of: Column) -> DataFrame:
    """The whole recommendation document of each account, without a shuffle."""
    p = with_timing(with_profile_defaults(df), as_of)
    days, debt = F.col("days_overdue"), F.col("debt_amount")
    options = channel_options(days, debt, F.col("contact_success_rate"), F.col("customer_age"))
    return p.select(
        "customer_id",
        F.struct(
            options.alias("recommendations"),
            options[0]["channel"].alias("primary_channel"),
            urgency_level(days, debt).alias("urgency_level"),
        ).alias("channel_recommendations"),
        F.struct(
            "best_hours", "avoid_hours", "best_days", "avoid_days", "next_best_times"
        ).alias("timing_recommendations"),
        strategy(days, debt, F.col("payment_status")).alias("contact_strategy"),
        as_of.alias("generated_at"),
    )
