"""The one feature projection, used by training, batch scoring and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import (
    ADDON_FLAGS,
    CONTRACT_CODES,
    FEATURES,
    HIGH_VALUE_CHARGE,
    INTERNET_CODES,
    NEW_CUSTOMER_MONTHS,
    PAYMENT_CODES,
    TENURE_EDGES,
)


def position_code(column: str, vocabulary: list[str]) -> str:
    """Zero-based position in a fixed list, -1 when absent or NULL."""
    values = ", ".join(f"'{v}'" for v in vocabulary)
    return f"cast(coalesce(array_position(array({values}), {column}), 0) - 1 AS int)"


def tenure_bucket(tenure: str = "tenure_months") -> str:
    """Right-closed bins numbered from 0; NULL outside the outer edges."""
    spans = zip(TENURE_EDGES, TENURE_EDGES[1:])
    rules = [f"WHEN {tenure} > {low} AND {tenure} <= {high} THEN {code}" for code, (low, high) in enumerate(spans)]
    return f"CASE {' '.join(rules)} END"


def _flag(condition: str) -> str:
    return f"cast(coalesce({condition}, false) AS int)"


FEATURE_SQL: dict[str, str] = {name: name for name in FEATURES} | {
    "charges_per_tenure_month": "bround(total_charges / CASE WHEN tenure_months < 1 THEN 1 ELSE tenure_months END, 3)",
    "num_addon_services": f"cast({' + '.join(f'coalesce({c}, 0)' for c in ADDON_FLAGS)} AS int)",
    # NaN sorts above every number in Spark, so it needs its own guard.
    "is_high_value": _flag(f"monthly_charges > {HIGH_VALUE_CHARGE} AND NOT isnan(monthly_charges)"),
    "tenure_bucket": tenure_bucket(),
    "is_new_high_risk": _flag(f"contract_type = 'month_to_month' AND tenure_months <= {NEW_CUSTOMER_MONTHS}"),
    "contract_type_encoded": position_code("contract_type", CONTRACT_CODES),
    "payment_method_encoded": position_code("payment_method", PAYMENT_CODES),
    "internet_service_encoded": position_code("internet_service", INTERNET_CODES),
}


def features(df: DataFrame, passthrough: list[str] | None = None) -> DataFrame:
    """Exactly the 16 features in order, after any ``passthrough`` columns."""
    return df.selectExpr(*(passthrough or []), *[f"{sql} AS {name}" for name, sql in FEATURE_SQL.items()])


def featureless() -> Column:
    """True for rows whose tenure has no bin: they cannot be scored or trained on."""
    return F.expr(f"({tenure_bucket()}) IS NULL")
