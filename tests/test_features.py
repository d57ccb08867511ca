import math

from odoscore.functions.cleaning import clean_customers, split_unusable
from odoscore.functions.contract import validate_rows, with_violations
from odoscore.functions.features import features
from odoscore.operators.lineage import count_exchanges, executed_plan
from odoscore.schemas import FEATURES, RAW_CUSTOMER_COLUMNS


def one(df):
    return df.first().asDict()


def test_columns_in_order_and_one_row(customers):
    out = features(customers())
    assert out.columns == FEATURES and out.count() == 1


def test_single_row_equals_batch(customers):
    batch = features(customers({}, {"customer_id": "C2", "tenure_months": 40}), ["customer_id"])
    single = features(customers(), ["customer_id"])
    assert single.first() == batch.filter("customer_id = 'C1'").first()


def test_new_customer_has_no_division_by_zero(customers):
    row = one(features(customers({"tenure_months": 0, "total_charges": 0.0})))
    assert row["charges_per_tenure_month"] == 0.0 and None not in row.values()


def test_high_value_threshold_is_strict_and_nan_safe(customers):
    values = [22.5, 133.0, 70.0, 70.01, float("nan"), None]
    rows = features(customers(*[{"customer_id": str(i), "monthly_charges": v} for i, v in enumerate(values)]), ["customer_id"])
    got = {r["customer_id"]: r["is_high_value"] for r in rows.collect()}
    assert [got[str(i)] for i in range(6)] == [0, 1, 0, 1, 0, 0]


def test_addons_and_interaction(customers):
    assert one(features(customers({"online_security": 1, "tech_support": 1})))["num_addon_services"] == 4
    assert one(features(customers({"online_security": None})))["num_addon_services"] == 2
    cases = [("month_to_month", 5, 1), ("one_year", 5, 0), ("month_to_month", 13, 0), ("month_to_month", 12, 1), (None, 1, 0)]
    for contract, tenure, want in cases:
        assert one(features(customers({"contract_type": contract, "tenure_months": tenure})))["is_new_high_risk"] == want


def test_tenure_bins_are_right_closed(customers):
    want = {-1: None, 0: 0, 1: 0, 6: 0, 7: 1, 12: 1, 13: 2, 24: 2, 25: 3, 48: 3, 49: 4, 200: 4, 1000: 4, 1001: None, None: None}
    rows = features(customers(*[{"customer_id": str(t), "tenure_months": t} for t in want]), ["customer_id"]).collect()
    assert {r["customer_id"]: r["tenure_bucket"] for r in rows} == {str(t): b for t, b in want.items()}


def test_encodings(customers):
    row = one(features(customers({"contract_type": "two_year", "payment_method": "credit_card", "internet_service": "none"})))
    assert (row["contract_type_encoded"], row["payment_method_encoded"], row["internet_service_encoded"]) == (2, 3, 0)
    row = one(features(customers({"contract_type": "lifetime", "payment_method": None})))
    assert (row["contract_type_encoded"], row["payment_method_encoded"]) == (-1, -1)


def test_ratio_rounds_half_even(customers):
    assert one(features(customers({"tenure_months": 16, "total_charges": 1.0})))["charges_per_tenure_month"] == 0.062


def test_projection_is_narrow_and_without_python(customers):
    out = features(customers())
    assert count_exchanges(out) == 0
    assert "Python" not in executed_plan(out)


def raw_row(spark, **over):
    base = dict.fromkeys(RAW_CUSTOMER_COLUMNS, "No") | {
        "customerID": "X", "tenure": "5", "Contract": "One year", "PaymentMethod": "Mailed check",
        "InternetService": "DSL", "MonthlyCharges": "20.5", "TotalCharges": " ", "SeniorCitizen": "1", "Churn": "Yes",
    }
    rows = [base | over]
    return spark.createDataFrame(
        [tuple(r[c] for c in RAW_CUSTOMER_COLUMNS) for r in rows], ", ".join(f"{c} string" for c in RAW_CUSTOMER_COLUMNS)
    )


def test_cleaning(spark):
    row = one(clean_customers(raw_row(spark, OnlineBackup="Yes", Partner=None, StreamingTV="No internet service")))
    assert row["contract_type"] == "one_year" and row["internet_service"] == "dsl"
    assert row["total_charges"] == 0.0 and row["monthly_charges"] == 20.5 and row["tenure_months"] == 5
    assert (row["online_backup"], row["has_partner"], row["streaming_tv"], row["churn"]) == (1, 0, 0, 1)
    assert row["snapshot_date"] is None
    odd = one(clean_customers(raw_row(spark, Contract="Weekly", TotalCharges="abc", MonthlyCharges="NaN")))
    assert odd["contract_type"] is None and odd["total_charges"] == 0.0 and odd["monthly_charges"] is None


def test_integers_may_carry_a_decimal_point(spark):
    values = {"5": 5, "5.0": 5, " 7 ": 7, "": None, "x": None, "NaN": None, "1e30": None, None: None}
    for text, want in values.items():
        assert one(clean_customers(raw_row(spark, tenure=text)))["tenure_months"] == want


def test_bad_labels_are_quarantined(spark):
    rows = clean_customers(raw_row(spark, Churn="Maybe").unionByName(raw_row(spark)).unionByName(raw_row(spark, tenure="x")))
    good, bad = split_unusable(rows)
    assert (good.count(), bad.count()) == (1, 2)


def test_contract_rejects(customers):
    rows = customers(
        {}, {"customer_id": "C2", "contract_type": "lifetime"}, {"customer_id": "C3", "monthly_charges": -10.0},
        {"customer_id": "C4", "tenure_months": 201}, {"customer_id": "C5", "tenure_months": 200},
        {"customer_id": "C6", "has_partner": 2, "total_charges": None}, {"customer_id": "C7", "monthly_charges": math.nan},
    )
    got = {r["customer_id"]: r["violations"] for r in with_violations(rows).collect()}
    assert got == {
        "C1": [], "C2": ["contract_type"], "C3": ["monthly_charges"], "C4": ["tenure_months"], "C5": [],
        "C6": ["total_charges", "has_partner"], "C7": ["monthly_charges"],
    }
    valid, rejected = validate_rows(rows)
    assert (valid.count(), rejected.count()) == (2, 5)
