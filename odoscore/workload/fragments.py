"""SQL fragments shared by the checks: adapter views and reference formulas."""

from __future__ import annotations

from ..views import CUSTOMER_BASE_EXPRS, RAW_CUSTOMER_EXPRS, REQUEST_LOG_EXPRS, TELEMETRY_EXPRS

TELEMETRY = f"telemetry AS (SELECT {', '.join(TELEMETRY_EXPRS)} FROM events)"
REQUEST_LOG = f"request_log AS (SELECT {', '.join(REQUEST_LOG_EXPRS)} FROM events)"

RAW = f"""
base AS (SELECT {', '.join(CUSTOMER_BASE_EXPRS)} FROM customer),
raw_customer AS (SELECT {', '.join(RAW_CUSTOMER_EXPRS)}, k, nation FROM base)"""

# Names of the raw columns and codes of the cleaned ones.
_FLAGS = [
    ("OnlineSecurity", "online_security"), ("OnlineBackup", "online_backup"),
    ("DeviceProtection", "device_protection"), ("TechSupport", "tech_support"),
    ("StreamingTV", "streaming_tv"), ("StreamingMovies", "streaming_movies"),
    ("MultipleLines", "multiple_lines"), ("SeniorCitizen", "senior_citizen"),
    ("Partner", "has_partner"), ("Dependents", "has_dependents"), ("PaperlessBilling", "paperless_billing"),
]
FLAG_NAMES = [clean for _, clean in _FLAGS]
_FLAG_SQL = ", ".join(
    f"{raw} AS {clean}" if raw == "SeniorCitizen"
    else f"cast(CASE WHEN {raw} = 'Yes' THEN 1 ELSE 0 END AS int) AS {clean}"
    for raw, clean in _FLAGS
)

# k and nation ride along for the derived inputs.
CLEAN = RAW + f""",
clean AS (
 SELECT customerID AS customer_id, tenure AS tenure_months,
  CASE Contract WHEN 'Month-to-month' THEN 'month_to_month' WHEN 'One year' THEN 'one_year'
   WHEN 'Two year' THEN 'two_year' END AS contract_type,
  CASE PaymentMethod WHEN 'Electronic check' THEN 'electronic_check' WHEN 'Mailed check' THEN 'mailed_check'
   WHEN 'Bank transfer (automatic)' THEN 'bank_transfer' WHEN 'Credit card (automatic)' THEN 'credit_card' END AS payment_method,
  CASE InternetService WHEN 'DSL' THEN 'dsl' WHEN 'Fiber optic' THEN 'fiber_optic' WHEN 'No' THEN 'none' END AS internet_service,
  MonthlyCharges AS monthly_charges, coalesce(try_cast(TotalCharges AS double), 0.0::double) AS total_charges,
  {_FLAG_SQL},
  cast(CASE Churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS int) AS churn, k, nation
 FROM raw_customer)"""

CLEAN_COLUMNS = (
    "customer_id, tenure_months, contract_type, payment_method, internet_service, monthly_charges, "
    "total_charges, " + ", ".join(FLAG_NAMES) + ", churn"
)

FEATURE_SQL = """
  tenure_months, monthly_charges, total_charges, senior_citizen, has_partner, has_dependents,
  paperless_billing, multiple_lines,
  round_even(total_charges / greatest(tenure_months, 1), 3) AS charges_per_tenure_month,
  cast(online_security + online_backup + device_protection + tech_support + streaming_tv + streaming_movies AS int)
   AS num_addon_services,
  cast(CASE WHEN monthly_charges > 70 THEN 1 ELSE 0 END AS int) AS is_high_value,
  cast(CASE WHEN tenure_months <= 6 THEN 0 WHEN tenure_months <= 12 THEN 1 WHEN tenure_months <= 24 THEN 2
   WHEN tenure_months <= 48 THEN 3 ELSE 4 END AS int) AS tenure_bucket,
  cast(CASE WHEN contract_type = 'month_to_month' AND tenure_months <= 12 THEN 1 ELSE 0 END AS int) AS is_new_high_risk,
  cast(CASE contract_type WHEN 'month_to_month' THEN 0 WHEN 'one_year' THEN 1 WHEN 'two_year' THEN 2 ELSE -1 END AS int)
   AS contract_type_encoded,
  cast(CASE payment_method WHEN 'electronic_check' THEN 0 WHEN 'mailed_check' THEN 1 WHEN 'bank_transfer' THEN 2
   WHEN 'credit_card' THEN 3 ELSE -1 END AS int) AS payment_method_encoded,
  cast(CASE internet_service WHEN 'none' THEN 0 WHEN 'dsl' THEN 1 WHEN 'fiber_optic' THEN 2 ELSE -1 END AS int)
   AS internet_service_encoded"""

FEATURE_ROWS = CLEAN + f""",
feature_rows AS (SELECT customer_id, churn, k, nation, {FEATURE_SQL} FROM clean)"""

# 70/15/15 by class: sizes by largest remainder, members by md5 rank.
SPLIT = FEATURE_ROWS + """,
classes AS (SELECT churn, count(*)::hugeint AS n FROM feature_rows GROUP BY churn),
drawn AS (SELECT churn, n, (sum(n) OVER ())::hugeint AS total,
  ceil(round((sum(n) OVER ())::double * 0.3::double, 9))::hugeint AS held FROM classes),
train_size AS (
 SELECT churn, n, held, n * (total - held) // total
  + CASE WHEN row_number() OVER (ORDER BY (n * (total - held)) % total DESC, churn)
     <= total - held - sum(n * (total - held) // total) OVER () THEN 1 ELSE 0 END AS n_train,
  held - ceil(round(held::double * 0.5::double, 9))::hugeint AS want_val
 FROM drawn),
sizes AS (
 SELECT churn, n_train, (n - n_train) * want_val // held
  + CASE WHEN row_number() OVER (ORDER BY ((n - n_train) * want_val) % held DESC, churn)
     <= want_val - sum((n - n_train) * want_val // held) OVER () THEN 1 ELSE 0 END AS n_val
 FROM train_size),
ranked AS (SELECT *, row_number() OVER (PARTITION BY churn ORDER BY md5('42:' || customer_id), customer_id) AS rk FROM feature_rows),
split_rows AS (
 SELECT r.*, CASE WHEN rk <= n_train THEN 'train' WHEN rk <= n_train + n_val THEN 'validation' ELSE 'test' END AS split
 FROM ranked r JOIN sizes s USING (churn))"""

STAGED = CLEAN + """,
staged AS (
 SELECT *, date '2024-01-01' + (ntile(10) OVER (ORDER BY md5('42:' || customer_id), customer_id) - 1)::int AS snapshot_date
 FROM clean)"""


def auc_sql(table: str, by: list[str], label: str = "label", score: str = "score") -> str:
    """accuracy, roc_auc, n_samples, positive_rate by the rank-sum formula."""
    keys = "".join(f"{b}, " for b in by)
    part = f"PARTITION BY {', '.join(by)} " if by else ""
    group = f"GROUP BY {', '.join(by)}" if by else ""
    return f"""
 SELECT {keys}
  round_even(avg(CASE WHEN (score >= 0.5)::int = label THEN 1.0::double ELSE 0.0::double END), 4) AS accuracy,
  round_even(CASE WHEN sum(label) = 0 OR sum(label) = count(*) THEN NULL ELSE
   (sum(CASE WHEN label = 1 THEN rnk ELSE 0 END) - sum(label)::double * (sum(label) + 1) / 2)
   / (sum(label)::double * (count(*) - sum(label))) END, 4) AS roc_auc,
  count(*)::bigint AS n_samples,
  round_even(avg(label::double), 4) AS positive_rate
 FROM (SELECT {keys}{label} AS label, {score} AS score,
   rank() OVER ({part}ORDER BY {score}) + (count(*) OVER (PARTITION BY {keys}{score}) - 1) / 2.0::double AS rnk
  FROM {table} WHERE {label} IS NOT NULL) {group}"""
