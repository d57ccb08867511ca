"""Batch statistics for data quality and drift, one scan per call.

Wide aggregates are written as SQL text: every expression built through the
Python column API is several calls to the JVM, and there are dozens here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import FEATURE_SQL
from ..schemas import (
    DQ_MAX_NULL_RATE,
    DQ_RANGES,
    DRIFT_MAX_MEAN_SHIFT,
    FEATURES,
    PAYLOAD_COLUMNS,
)


def _aggregate(df: DataFrame, by: list[str], exprs: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(*[F.expr(e) for e in exprs])


def feature_stats(features: DataFrame, version: str, by: list[str] | None = None) -> DataFrame:
    """Reference statistics (version, feature, mean, std, n_rows): mean and sample deviation."""
    by = by or []
    one = _aggregate(
        features, by,
        ["count(*) AS n_rows"] + [f"struct(avg({f}) AS mean, stddev_samp({f}) AS std) AS {f}" for f in FEATURES],
    )
    rows = ", ".join(f"struct('{f}' AS feature, {f}.mean AS mean, {f}.std AS std)" for f in FEATURES)
    return one.select(*by, "n_rows", F.expr(f"inline(array({rows}))")).select(
        *by, F.lit(version).alias("version"), "feature", "mean", "std", "n_rows"
    )


def missing_sql(column: str, kind: str) -> str:
    """True for NULL, and for NaN in float columns."""
    return f"({column} IS NULL OR isnan({column}))" if kind in ("double", "float") else f"{column} IS NULL"


def batch_checks(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Everything the checks look at, one row per check: (by..., n_rows, pos, check, name, value).

    ``value`` is the null rate or out-of-range rate of a column, or the mean
    of a feature; all come from one aggregate over the batch.  ``pos`` is the
    report order.  Features are left out when a payload column is missing.
    """
    by = by or []
    kinds = dict(df.dtypes)
    checks: list[tuple[str, str, str]] = []
    aggregates = ["count(*) AS n_rows"]

    def add(check: str, name: str, sql: str | None) -> None:
        if sql is not None:
            aggregates.append(f"{sql} AS _c{len(checks)}")
        checks.append((check, name, "cast(NULL AS double)" if sql is None else f"cast(_c{len(checks)} AS double)"))

    for name in PAYLOAD_COLUMNS:
        if name in kinds:
            add("null_rate", name, f"avg(cast({missing_sql(name, kinds[name])} AS int))")
        else:
            add("missing_column", name, None)
    for name, (low, high) in DQ_RANGES.items():
        if name in kinds:
            # A missing value counts as in range.
            outside = f"NOT {missing_sql(name, kinds[name])} AND ({name} < {low} OR {name} > {high})"
            add("out_of_range", name, f"avg(cast({outside} AS int))")
    if all(c in kinds for c in PAYLOAD_COLUMNS):
        for name in FEATURES:
            add("drift", name, f"avg(nanvl(cast({FEATURE_SQL[name]} AS double), NULL))")
    rows = ", ".join(
        f"struct({i} AS pos, '{check}' AS check, '{name}' AS name, {value} AS value)"
        for i, (check, name, value) in enumerate(checks)
    )
    return _aggregate(df, by, aggregates).select(*by, "n_rows", F.expr(f"inline(array({rows}))"))


def _percent(sql: str) -> str:
    return f"concat(cast(try_cast(bround(({sql}) * 100, 1) AS decimal(38,1)) AS string), '%')"


def _fixed(sql: str) -> str:
    return f"cast(try_cast(bround({sql}, 3) AS decimal(38,3)) AS string)"


# The texts of the messages.
QUALITY_MESSAGE = f"""CASE
 WHEN check = 'missing_column' AND n_rows > 0 THEN concat('MISSING COLUMN: ', name)
 WHEN check = 'null_rate' AND round(value, 10) > {DQ_MAX_NULL_RATE}D
  THEN concat('HIGH NULL RATE: ', name, ' = ', {_percent('value')})
 WHEN check = 'out_of_range' AND value > 0 THEN concat('OUT-OF-RANGE ', name, ': ', {_percent('value')}, ' of rows')
END"""

_SHIFT = "try_divide(abs(value - ref_mean), abs(ref_mean))"
DRIFT_MESSAGE = f"""CASE
 WHEN check = 'drift' AND round(rel_shift, 10) > {DRIFT_MAX_MEAN_SHIFT}D
  THEN concat('DRIFT in \\'', name, '\\': train_mean=', {_fixed('ref_mean')}, ' recent_mean=', {_fixed('value')},
   ' (relative shift=', {_percent('rel_shift')}, ', threshold={DRIFT_MAX_MEAN_SHIFT:.0%})')
END"""


def quality_issues(checks: DataFrame) -> DataFrame:
    """Add ``issue``: the message of a broken quality rule, else NULL."""
    return checks.withColumn("issue", F.expr(QUALITY_MESSAGE))


def drift_issues(checks: DataFrame, stats: DataFrame) -> DataFrame:
    """Add ``ref_mean``, ``rel_shift`` and ``warning`` by looking up the reference of each feature.

    A feature without a reference, with reference mean 0, or without a recent
    mean has no shift and raises no warning.
    """
    if "version" in stats.columns:
        # A statistics table keeps all versions; the newest is the reference.
        stats = stats.filter(F.col("version") == stats.agg(F.max("version")).scalar())
    ref = stats.select(F.col("feature").alias("_feature"), F.col("mean").alias("ref_mean"))
    # One row per feature.
    found = checks.join(F.broadcast(ref), (F.col("check") == "drift") & (F.col("name") == F.col("_feature")), "left")
    return found.drop("_feature").withColumn("rel_shift", F.expr(_SHIFT)).withColumn("warning", F.expr(DRIFT_MESSAGE))
