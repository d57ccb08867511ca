"""Classification metrics, precision at k, and the request latency summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import DECISION_THRESHOLD
from .quantiles import exact_percentiles


def classification_counts(
    scored: DataFrame, label: str = "label", score: str = "score", by: list[str] | None = None
) -> DataFrame:
    """Exact counts behind accuracy, positive rate and ROC AUC, per ``by`` group.

    Rows collapse to one per distinct score.  The scores are range-partitioned,
    so each slice is an interval: pairs inside a slice come from a running sum,
    pairs across slices from the slice totals (one row per slice).  Ties count
    half.  All sums are integers: ``double_wins`` is twice the number of
    (positive, negative) pairs ranked the right way round.  Rows without a
    label or a score take no part; ``n_unscored`` counts them.
    """
    by = by or []
    whole = "decimal(38,0)"
    usable = F.col(label).isNotNull() & F.col(score).isNotNull()
    positive = F.col(label) == 1
    per_score = (
        scored.groupBy(*by, F.when(usable, F.col(score).cast("double")).alias("_s"))
        .agg(
            F.count_if(usable & positive).alias("_p"), F.count_if(usable & ~positive).alias("_q"), F.count_if(~usable).alias("_u"),
        )
    )
    ranged = per_score.repartitionByRange(*by, "_s").withColumn("_slice", F.spark_partition_id())
    inside = Window.partitionBy(*by, "_slice").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("_q").over(inside), F.lit(0))
    local = ranged.withColumn("_below", below).groupBy(*by, "_slice").agg(
        F.sum(F.col("_p").cast(whole) * (2 * F.col("_below") + F.col("_q"))).cast(whole).alias("_wins"),
        F.sum("_p").alias("_p"),
        F.sum("_q").alias("_q"),
        F.sum("_u").alias("_u"),
        F.sum(F.when(F.col("_s") >= DECISION_THRESHOLD, F.col("_p")).otherwise(F.col("_q"))).alias("_hits"),
    )
    across = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    lower = F.coalesce(F.sum("_q").over(across), F.lit(0))
    return local.withColumn("_lower", lower).groupBy(*by).agg(
        F.sum(F.col("_p") + F.col("_q")).alias("n_samples"),
        F.sum("_p").alias("n_positive"),
        F.sum("_hits").alias("n_correct"),
        F.sum("_u").alias("n_unscored"),
        F.sum(F.col("_wins") + F.col("_p").cast(whole) * 2 * F.col("_lower")).cast(whole).alias("double_wins"),
    )


def classification_metrics(
    scored: DataFrame, label: str = "label", score: str = "score", by: list[str] | None = None, digits: int = 4
) -> DataFrame:
    """accuracy, roc_auc, n_samples, positive_rate per group, rounded half-even.

    AUC is NULL when a group holds one class only.
    """
    by = by or []
    c = classification_counts(scored, label, score, by)
    if by:
        c = c.filter("n_samples > 0")
    n, p = F.col("n_samples"), F.col("n_positive")
    pairs = p.cast("double") * (n - p).cast("double")
    return c.select(
        *by,
        F.bround(n_div("n_correct", "n_samples"), digits).alias("accuracy"),
        F.bround(F.try_divide(F.col("double_wins").cast("double"), 2 * pairs), digits).alias("roc_auc"),
        n.alias("n_samples"),
        F.bround(n_div("n_positive", "n_samples"), digits).alias("positive_rate"),
    )


def n_div(top: str, bottom: str):
    return F.try_divide(F.col(top).cast("double"), F.col(bottom).cast("double"))


def long_metrics(metrics: DataFrame, by: list[str]) -> DataFrame:
    """One row per metric: (by..., metric, value)."""
    names = ["accuracy", "roc_auc", "n_samples", "positive_rate"]
    wide = metrics.select(*by, *[F.col(m).cast("double").alias(m) for m in names])
    return wide.unpivot(by, names, "metric", "value")


def precision_at_k(scored: DataFrame, k: int, key: str, label: str = "label", score: str = "score") -> DataFrame:
    """Share of positives among the ``k`` highest scores; ties are ordered by key."""
    best = scored.select(key, label, score).orderBy(F.desc(score), F.asc(key)).limit(k)
    return best.agg(
        F.count("*").alias("n_selected"),
        F.sum(F.col(label).cast("long")).alias("n_hits"),
        F.bround(F.avg(F.col(label).cast("double")), 4).alias("precision_at_k"),
    )


def request_latency_summary(log: DataFrame) -> DataFrame:
    """One report row over a request log (started_at, latency_ms, is_error).

    Throughput counts every request; latency figures cover successes only.
    The wall clock runs from the first start to the last completion.
    """
    ok = log.filter(~F.col("is_error"))
    q = exact_percentiles(ok, "latency_ms", [0.50, 0.95, 0.99]).select("q").scalar()
    start = F.unix_micros(F.col("started_at").cast("timestamp"))
    finish = start + F.round(F.coalesce("latency_ms", F.lit(0.0)) * 1000).cast("long")
    seconds = (F.max(finish) - F.min(start)) / F.lit(1e6)
    one = log.agg(
        F.count("*").alias("n_requests"),
        F.count_if("is_error").alias("errors"),
        seconds.alias("_wall"),
        F.avg(F.when(~F.col("is_error"), F.col("latency_ms"))).alias("_avg"),
    ).withColumn("_q", q)
    return one.select(
        "n_requests",
        "errors",
        F.bround("_wall", 3).alias("total_wall_seconds"),
        F.when(F.col("_wall") > 0, F.bround(F.col("n_requests") / F.col("_wall"), 2)).alias("throughput_req_per_sec"),
        F.bround("_avg", 2).alias("avg_latency_ms"),
        *[F.bround(F.get("_q", F.lit(i)), 2).alias(f"p{p}_latency_ms") for i, p in enumerate((50, 95, 99))],
    )
