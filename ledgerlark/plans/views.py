"""SQL forms of the domain views, for the oracle queries."""

from ledgerlark.sources.accounts import EXPERIMENTS, SCORE_MODELS

ACCOUNTS = """
latest AS (
  SELECT o_custkey, o_orderdate, o_totalprice, o_orderpriority FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
  WHERE rn = 1),
shares AS (
  SELECT o_custkey, CAST(count(*) AS DOUBLE) AS attempts,
         avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS history,
         avg(CASE WHEN o_orderstatus = 'O' THEN 1.0 ELSE 0.0 END) AS response,
         avg(CASE WHEN o_orderstatus = 'P' THEN 1.0 ELSE 0.0 END) AS success
  FROM orders GROUP BY o_custkey),
base AS (
  SELECT 'CUST_' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS customer_id, c_custkey, c_nationkey,
         18 + (c_custkey * 37) % 68 AS customer_age,
         15000.0::DOUBLE + (c_acctbal + 1000.0::DOUBLE) * 12.0::DOUBLE AS annual_income,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'employed' WHEN 'BUILDING' THEN 'self_employed'
              WHEN 'FURNITURE' THEN 'unemployed' WHEN 'HOUSEHOLD' THEN 'retired' WHEN 'MACHINERY' THEN 'student' END
              AS employment_status,
         CAST(300 + (c_custkey * 53) % 551 AS DOUBLE) AS credit_score,
         o_totalprice / 10.0::DOUBLE AS debt_amount,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'credit_card' WHEN '2' THEN 'personal_loan'
              WHEN '3' THEN 'auto_loan' WHEN '4' THEN 'mortgage' WHEN '5' THEN 'medical' END AS debt_type,
         greatest(least(CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') AS DOUBLE), 365.0::DOUBLE),
                  1.0::DOUBLE) AS days_overdue,
         coalesce(history, 0.0::DOUBLE) AS payment_history_score,
         coalesce(attempts, 0.0::DOUBLE) AS contact_attempts,
         coalesce(response, 0.0::DOUBLE) AS response_rate,
         coalesce(success, 0.0::DOUBLE) AS contact_success_rate
  FROM customer LEFT JOIN latest ON c_custkey = latest.o_custkey LEFT JOIN shares ON c_custkey = shares.o_custkey),
scored AS (
  SELECT *, debt_amount / nullif(annual_income, 0) AS debt_to_income_ratio,
         least(greatest(
           0.3::DOUBLE * ((credit_score - 300) / 550)
           + 0.2::DOUBLE * greatest(0.0::DOUBLE, 1.0::DOUBLE - debt_amount / nullif(annual_income, 0))
           + 0.2::DOUBLE * greatest(0.0::DOUBLE, 1.0::DOUBLE - days_overdue / 365)
           + 0.15::DOUBLE * payment_history_score + 0.15::DOUBLE * response_rate, 0.0::DOUBLE), 1.0::DOUBLE) AS propensity
  FROM base),
accounts AS (
  SELECT *, CASE WHEN propensity > 0.7 THEN 'full_payment' WHEN propensity > 0.4 THEN 'partial_payment'
                 ELSE 'no_payment' END AS payment_status
  FROM scored)
"""

RISK_POINTS = """
  (CASE WHEN days_overdue > 180 THEN 4 WHEN days_overdue > 90 THEN 3 WHEN days_overdue > 30 THEN 2 ELSE 1 END
   + CASE WHEN credit_score < 550 THEN 3 WHEN credit_score < 650 THEN 2 WHEN credit_score < 750 THEN 1 ELSE 0 END
   + CASE WHEN response_rate * 100 < 20 THEN 2 WHEN response_rate * 100 < 50 THEN 1 ELSE 0 END
   + CASE WHEN debt_to_income_ratio > 0.5 THEN 1 ELSE 0 END)"""
RISK_SEGMENT = f"""
  CASE WHEN {RISK_POINTS} <= 3 THEN 'Low Risk' WHEN {RISK_POINTS} <= 6 THEN 'Medium Risk' ELSE 'High Risk' END"""


def _model_rows() -> str:
    parts = []
    for model, (rules, bonus) in SCORE_MODELS.items():
        raw = [
            f"CAST((l_orderkey * {a} + l_partkey * {b} + l_suppkey * {c} + l_linenumber) % 97 + 1 "
            f"+ CASE WHEN label = {k} THEN {bonus} ELSE 0 END AS DOUBLE) AS r{k}"
            for k, (a, b, c) in enumerate(rules)
        ]
        parts.append(f"SELECT '{model}' AS model, fold, part, label, {', '.join(raw)} FROM items")
    return " UNION ALL ".join(parts)


PREDICTIONS = f"""
items AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_orderkey % 5 AS INTEGER) AS fold, l_linestatus AS part,
         CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS label FROM lineitem),
raw AS ({_model_rows()}),
predictions AS (
  SELECT model, fold, part, label,
         CASE WHEN r0 >= r1 AND r0 >= r2 THEN 0 WHEN r1 >= r2 THEN 1 ELSE 2 END AS prediction,
         r0 / (r0 + r1 + r2) AS p0, r1 / (r0 + r1 + r2) AS p1, r2 / (r0 + r1 + r2) AS p2
  FROM raw)
"""

EXPERIMENT_ROWS = ", ".join(f"('{e}', {s}::DOUBLE, TIMESTAMP '{d} 00:00:00')" for e, s, d in EXPERIMENTS)
AB_EVENTS = f"""
experiments AS (SELECT * FROM (VALUES {EXPERIMENT_ROWS}) AS t(experiment_id, treatment_split, created_at)),
assigned AS (
  SELECT experiment_id, event_id, user_id, ts,
         CASE WHEN CAST('0x' || substr(md5(experiment_id || ':' || CAST(user_id AS VARCHAR)), 1, 7) AS BIGINT) % 100
                   < treatment_split * 100 THEN 'treatment' ELSE 'control' END AS variant
  FROM events CROSS JOIN experiments),
ab_predictions AS (
  SELECT experiment_id, variant, event_id AS unit_id, user_id, ts,
         CAST(CASE WHEN event_id % (CASE WHEN variant = 'treatment' THEN 4 ELSE 3 END) = 0
                   THEN (event_id + user_id) % 3 ELSE event_id % 3 END AS INTEGER) AS prediction
  FROM assigned),
ab_actuals AS (
  SELECT event_id AS unit_id, ts AS actual_ts, CAST(event_id % 3 AS INTEGER) AS actual
  FROM events WHERE event_id % 10 <> 9)
"""


def bin_sql(value: str, low: str, high: str, bins: int = 10) -> str:
    """Number of inner edges the value has reached; NULL outside the range."""
    edges = " + ".join(f"CASE WHEN {value} >= {i} * (({high} - {low}) / {bins}) + {low} THEN 1 ELSE 0 END" for i in range(1, bins))
    return f"CASE WHEN {value} BETWEEN {low} AND {high} THEN {edges} END"
