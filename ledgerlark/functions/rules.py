"""Per-account rules as Column expressions: ratios, buckets, segments, grades."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Points, limits and labels of the business rules.
DPD_EDGES = [0, 30, 60, 90, 180, 365]
DPD_LABELS = ["0-30", "31-60", "61-90", "91-180", "181-365", "365+"]
OUTCOMES = ["full_payment", "no_payment", "partial_payment"]
OUTCOME_LIMITS = {"full_payment": 0.7, "partial_payment": 0.4}
RISK_LABELS = ["Low Risk", "Medium Risk", "High Risk"]
PROPENSITY_WEIGHTS = {"credit": 0.3, "income": 0.2, "overdue": 0.2, "history": 0.15, "response": 0.15}
GRADE_LIMITS = {"A": 0.85, "B": 0.75, "D": 0.50}
ACCEPTANCE_F1 = 0.65
OUTCOME_ACTIONS = {
    "no_payment": (
        "High",
        ["Immediate intervention required", "Consider legal action", "Offer payment plan options", "Increase contact frequency"],
    ),
    "full_payment": (
        "Low",
        ["Standard collection process", "Send payment reminders", "Maintain regular contact", "Monitor payment behavior"],
    ),
    "partial_payment": (
        "Medium",
        ["Negotiate payment terms", "Offer partial payment plans", "Increase engagement", "Monitor closely"],
    ),
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def points(value: Column | str, tiers: Sequence[tuple[float, int]], above: bool = True, otherwise: int = 0) -> Column:
    """Points of the first tier whose limit the value passes (strictly)."""
    value = _col(value)
    out = None
    for limit, score in tiers:
        passed = value > F.lit(limit) if above else value < F.lit(limit)
        out = F.when(passed, score) if out is None else out.when(passed, score)
    return out.otherwise(otherwise)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """NULL where the denominator is 0."""
    return F.try_divide(_col(numerator), _col(denominator))


def clip(value: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Bounded value; NULL stays NULL."""
    value = _col(value)
    bounded = value
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(value.isNotNull(), bounded)


def log10_positive(value: Column | str) -> Column:
    value = _col(value)
    return F.when(value > 0, F.log10(value))


def with_default(value: Column | str, default) -> Column:
    return F.coalesce(_col(value), F.lit(default))


def to_number(text: Column | str, default: float = 0.0) -> Column:
    """Text to double; unreadable, missing and NaN become the default."""
    number = _col(text).try_cast("double")
    return F.coalesce(F.when(~F.isnan(number), number), F.lit(default))


def formatted_id(number: Column | str, prefix: str = "CUST") -> Column:
    return F.format_string(f"{prefix}_%06d", _col(number))


def days_past_due_bucket(days: Column | str) -> Column:
    """Right-closed buckets; 0 and negative days have none."""
    days = _col(days)
    out = F.when(days <= DPD_EDGES[0], F.lit(None).cast("string"))
    for upper, label in zip(DPD_EDGES[1:], DPD_LABELS):
        out = out.when(days <= upper, label)
    return F.when(days.isNotNull(), out.otherwise(DPD_LABELS[-1]))


def days_past_due_rank(bucket: Column | str) -> Column:
    return F.array_position(F.array(*[F.lit(b) for b in DPD_LABELS]), _col(bucket)).cast("int")


def payment_propensity(credit_score, income, debt, days, history, response) -> Column:
    w = PROPENSITY_WEIGHTS
    credit = (_col(credit_score) - 300) / 550
    income_part = F.greatest(F.lit(0.0), F.lit(1.0) - ratio(debt, income))
    overdue = F.greatest(F.lit(0.0), F.lit(1.0) - _col(days) / 365)
    total = (
        w["credit"] * credit
        + w["income"] * income_part
        + w["overdue"] * overdue
        + w["history"] * _col(history)
        + w["response"] * _col(response)
    )
    return clip(total, 0.0, 1.0)


def outcome_of_propensity(p: Column | str) -> Column:
    p = _col(p)
    return (
        F.when(p > OUTCOME_LIMITS["full_payment"], "full_payment")
        .when(p > OUTCOME_LIMITS["partial_payment"], "partial_payment")
        .otherwise("no_payment")
    )


def risk_points(days, credit_score, response_pct, debt, income) -> Column:
    """Response rate on the 0..100 scale."""
    return (
        points(days, [(180, 4), (90, 3), (30, 2)], otherwise=1)
        + points(credit_score, [(550, 3), (650, 2), (750, 1)], above=False)
        + points(response_pct, [(20, 2), (50, 1)], above=False)
        + points(ratio(debt, income), [(0.5, 1)])
    )


def risk_segment(days, credit_score, response_pct, debt, income) -> Column:
    score = risk_points(days, credit_score, response_pct, debt, income)
    return F.when(score <= 3, RISK_LABELS[0]).when(score <= 6, RISK_LABELS[1]).otherwise(RISK_LABELS[2])


def urgency_level(days, debt) -> Column:
    score = points(days, [(90, 3), (60, 2), (30, 1)]) + points(debt, [(25000, 3), (10000, 2), (5000, 1)])
    return F.when(score >= 4, "critical").when(score >= 2, "high").when(score >= 1, "medium").otherwise("low")


def performance_grade(f1: Column | str, threshold: float = ACCEPTANCE_F1) -> Column:
    f1 = _col(f1)
    return (
        F.when(f1.isNull(), "Unknown")
        .when(f1 >= GRADE_LIMITS["A"], "A")
        .when(f1 >= GRADE_LIMITS["B"], "B")
        .when(f1 >= threshold, "C")
        .when(f1 >= GRADE_LIMITS["D"], "D")
        .otherwise("F")
    )


def threshold_met(f1: Column | str, threshold: float = ACCEPTANCE_F1) -> Column:
    return _col(f1) >= F.lit(threshold)


def pick(value: Column | str, options: Mapping, default=None) -> Column:
    """Value looked up in a small fixed mapping."""
    value, out = _col(value), None
    for key, result in options.items():
        result = F.array(*[F.lit(r) for r in result]) if isinstance(result, (list, tuple)) else F.lit(result)
        out = F.when(value == key, result) if out is None else out.when(value == key, result)
    if default is None:
        return out
    return out.otherwise(F.array(*[F.lit(d) for d in default]) if isinstance(default, (list, tuple)) else F.lit(default))


def risk_level_of_outcome(outcome: Column | str) -> Column:
    return pick(outcome, {name: level for name, (level, _) in OUTCOME_ACTIONS.items()})


def actions_of_outcome(outcome: Column | str) -> Column:
    return pick(outcome, {name: actions for name, (_, actions) in OUTCOME_ACTIONS.items()})
