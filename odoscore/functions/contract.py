"""Row contract for scoring payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import BINARY_FLAGS, CONTRACT_CODES, INTERNET_CODES, PAYLOAD_MAX_TENURE, PAYMENT_CODES


def _one_of(column: str, values: list) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


# Column -> condition that must hold; NULL and NaN never satisfy it.
RULES: dict[str, str] = {
    "tenure_months": f"tenure_months BETWEEN 0 AND {PAYLOAD_MAX_TENURE}",
    "contract_type": _one_of("contract_type", CONTRACT_CODES),
    "payment_method": _one_of("payment_method", PAYMENT_CODES),
    "internet_service": _one_of("internet_service", INTERNET_CODES),
    "monthly_charges": "monthly_charges >= 0 AND NOT isnan(monthly_charges)",
    "total_charges": "total_charges >= 0 AND NOT isnan(total_charges)",
} | {flag: _one_of(flag, [0, 1]) for flag in BINARY_FLAGS}


def with_violations(df: DataFrame) -> DataFrame:
    """Add ``violations``: the names of the columns that break the contract."""
    broken = ", ".join(f"CASE WHEN NOT coalesce({rule}, false) THEN '{name}' END" for name, rule in RULES.items())
    return df.withColumn("violations", F.expr(f"array_compact(array({broken}))"))


def validate_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their ``violations``)."""
    checked = with_violations(df)
    bad = F.size("violations") > 0
    return checked.filter(~bad).drop("violations"), checked.filter(bad)
