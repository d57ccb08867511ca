"""Raw customer export -> typed customer snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import (
    CONTRACT_LABELS,
    INTERNET_LABELS,
    PAYMENT_LABELS,
    SNAPSHOT_COLUMNS,
    SNAPSHOT_TYPES,
    YES_NO_FLAGS,
)


def relabel(column: str, labels: dict[str, str]) -> str:
    """Dictionary lookup; a value outside the dictionary becomes NULL."""
    cases = " ".join(f"WHEN '{raw}' THEN '{clean}'" for raw, clean in labels.items())
    return f"CASE {column} {cases} END"


def yes_flag(column: str) -> str:
    """1 for ``Yes``; anything else, NULL included, is 0."""
    return f"coalesce(cast({column} = 'Yes' AS int), 0)"


def number(column: str, kind: str) -> str:
    """Typed parse; failures and NaN become NULL.  Integers may be written as 5 or 5.0."""
    if kind not in ("int", "double"):
        return f"try_cast(cast({column} AS string) AS {kind})"
    parsed = f"nanvl(try_cast(cast({column} AS string) AS double), cast(NULL AS double))"
    return parsed if kind == "double" else f"try_cast({parsed} AS int)"


def number_or_zero(column: str) -> str:
    """Tolerant parse: blanks, text and NaN become 0.0."""
    return f"coalesce({number(column, 'double')}, 0.0D)"


CLEAN_SQL: dict[str, str] = {
    "customer_id": "customerID",
    "snapshot_date": "cast(NULL AS date)",
    "tenure_months": number("tenure", "int"),
    "contract_type": relabel("Contract", CONTRACT_LABELS),
    "payment_method": relabel("PaymentMethod", PAYMENT_LABELS),
    "internet_service": relabel("InternetService", INTERNET_LABELS),
    "monthly_charges": number("MonthlyCharges", "double"),
    "total_charges": number_or_zero("TotalCharges"),
    "senior_citizen": number("SeniorCitizen", "int"),
    "churn": "CASE Churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END",
} | {name: yes_flag(source) for name, source in YES_NO_FLAGS.items()}


def clean_customers(raw: DataFrame, snapshot_date: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """One projection from vendor names and labels to the 20 snapshot columns.

    ``churn`` is NULL for a label other than Yes/No and ``tenure_months`` is
    NULL for a tenure that is no integer; :func:`unusable` finds those rows.
    ``snapshot_date`` is an expression over the raw columns, NULL until a
    batch date is known.  ``keep`` passes further columns through.
    """
    exprs = CLEAN_SQL if snapshot_date is None else CLEAN_SQL | {"snapshot_date": snapshot_date}
    return raw.selectExpr(
        *[f"cast({exprs[c]} AS {SNAPSHOT_TYPES[c]}) AS {c}" for c in SNAPSHOT_COLUMNS], *(keep or [])
    )


def unusable(label: str = "churn") -> Column:
    """True for cleaned rows the pipeline must quarantine instead of using."""
    return F.expr(f"{label} IS NULL OR tenure_months IS NULL OR senior_citizen IS NULL")


def split_unusable(clean: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, quarantined) rows."""
    return clean.filter(~unusable()), clean.filter(unusable())


def typed_snapshot(text: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """All-string snapshot rows (a landing file) -> snapshot types; bad values become NULL."""
    have = set(text.columns)

    def column(name: str) -> str:
        kind = SNAPSHOT_TYPES[name]
        if name not in have:
            return f"cast(NULL AS {kind}) AS {name}"
        return f"{name if kind == 'string' else number(name, kind)} AS {name}"

    return text.selectExpr(*[column(c) for c in SNAPSHOT_COLUMNS], *(keep or []))
