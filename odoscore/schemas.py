"""Schemas, vocabularies and thresholds used across the library."""

from __future__ import annotations

# --- fixed values: table layouts -------------------------------------------
TELEMETRY = (
    "vehicle_id string, vehicle_model string, engine_temp double, speed double, "
    "latitude double, longitude double, battery_efficiency double, miles double"
)

RAW_CUSTOMER_COLUMNS = [
    "customerID", "tenure", "Contract", "PaymentMethod", "InternetService",
    "MonthlyCharges", "TotalCharges", "SeniorCitizen", "OnlineSecurity",
    "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies", "MultipleLines", "Partner", "Dependents",
    "PaperlessBilling", "Churn",
]

SNAPSHOT = (
    "customer_id string, snapshot_date date, tenure_months int, contract_type string, "
    "payment_method string, internet_service string, monthly_charges double, "
    "total_charges double, online_security int, online_backup int, device_protection int, "
    "tech_support int, streaming_tv int, streaming_movies int, multiple_lines int, "
    "senior_citizen int, has_partner int, has_dependents int, paperless_billing int, churn int"
)
SNAPSHOT_TYPES = dict(item.strip().split(" ") for item in SNAPSHOT.split(","))
SNAPSHOT_COLUMNS = list(SNAPSHOT_TYPES)
SNAPSHOT_KEY = ["customer_id", "snapshot_date"]

# --- fixed values: label vocabularies --------------------------------------
CONTRACT_LABELS = {
    "Month-to-month": "month_to_month",
    "One year": "one_year",
    "Two year": "two_year",
}
PAYMENT_LABELS = {
    "Electronic check": "electronic_check",
    "Mailed check": "mailed_check",
    "Bank transfer (automatic)": "bank_transfer",
    "Credit card (automatic)": "credit_card",
}
INTERNET_LABELS = {"DSL": "dsl", "Fiber optic": "fiber_optic", "No": "none"}

YES_NO_FLAGS = {
    "online_security": "OnlineSecurity",
    "online_backup": "OnlineBackup",
    "device_protection": "DeviceProtection",
    "tech_support": "TechSupport",
    "streaming_tv": "StreamingTV",
    "streaming_movies": "StreamingMovies",
    "multiple_lines": "MultipleLines",
    "has_partner": "Partner",
    "has_dependents": "Dependents",
    "paperless_billing": "PaperlessBilling",
}

# --- fixed values: encodings are positions in these lists -------------------
CONTRACT_CODES = ["month_to_month", "one_year", "two_year"]
PAYMENT_CODES = ["electronic_check", "mailed_check", "bank_transfer", "credit_card"]
INTERNET_CODES = ["none", "dsl", "fiber_optic"]

ADDON_FLAGS = [
    "online_security", "online_backup", "device_protection",
    "tech_support", "streaming_tv", "streaming_movies",
]
BINARY_FLAGS = ADDON_FLAGS + [
    "multiple_lines", "senior_citizen", "has_partner", "has_dependents", "paperless_billing",
]

# --- fixed values: model inputs, in order -----------------------------------
FEATURES = [
    "tenure_months", "monthly_charges", "total_charges", "senior_citizen",
    "has_partner", "has_dependents", "paperless_billing", "multiple_lines",
    "charges_per_tenure_month", "num_addon_services", "is_high_value",
    "tenure_bucket", "is_new_high_risk", "contract_type_encoded",
    "payment_method_encoded", "internet_service_encoded",
]

# Columns a scoring or monitoring batch must carry.
PAYLOAD_COLUMNS = [c for c in SNAPSHOT_COLUMNS if c not in ("customer_id", "snapshot_date", "churn")]

# --- fixed values: thresholds -----------------------------------------------
HIGH_VALUE_CHARGE = 70
NEW_CUSTOMER_MONTHS = 12
TENURE_EDGES = [-1, 6, 12, 24, 48, 1000]      # right-closed bins
PAYLOAD_MAX_TENURE = 200
FILE_MAX_NULL_FRACTION = 0.5
DQ_MAX_NULL_RATE = 0.05
DQ_RANGES = {"monthly_charges": (0, 1000), "tenure_months": (0, 600)}
DRIFT_MAX_MEAN_SHIFT = 0.20
RETRAIN_MAX_DAYS = 14
RETRAIN_MAX_AUC_DROP = 0.03
FEEDBACK_MIN_AUC = 0.80
DECISION_THRESHOLD = 0.5
ALERT_P95_MS = 300.0
ALERT_ERROR_RATE = 0.02
ALERT_WINDOW = "5 minutes"
ALERT_RATE_FACTOR = 2.0
SALT_COUNT = 8
RECONCILE_TOLERANCE = 1e-6
