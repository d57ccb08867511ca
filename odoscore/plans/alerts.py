"""Windowed alerts, shared by batch and streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lineage import cut_lineage
from ..operators.quantiles import exact_percentiles
from ..schemas import ALERT_ERROR_RATE, ALERT_P95_MS, ALERT_RATE_FACTOR, ALERT_WINDOW


def latency_cells(log: DataFrame, time: str = "started_at", width: str = ALERT_WINDOW) -> DataFrame:
    """Requests counted by (window, latency, outcome): the one state a stream has to keep."""
    return (
        log.groupBy(F.window(time, width).alias("w"), "latency_ms", "is_error")
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("window_start"), "latency_ms", "is_error", "n")
    )


def alerts_from_cells(cells: DataFrame) -> DataFrame:
    """One row per window: requests, errors, error rate, p95 over successes, alert flags."""
    ok = cells.filter(~F.col("is_error"))
    p95 = exact_percentiles(ok, "latency_ms", [0.95], ["window_start"], weight="n", fine=False).select(
        F.col("window_start").alias("_w"), F.get("q", F.lit(0)).alias("p95_latency_ms")
    )
    return _alert_rows(cells, p95)


def _alert_rows(cells: DataFrame, p95: DataFrame) -> DataFrame:
    totals = cells.groupBy("window_start").agg(
        F.sum("n").alias("n_requests"), F.coalesce(F.sum(F.when(F.col("is_error"), F.col("n"))), F.lit(0)).alias("errors")
    )
    rate = F.col("errors") / F.col("n_requests")
    return (
        # Null-safe equality adds no filter to one side only, so both sides share the counting shuffle.
        totals.join(p95, F.col("window_start").eqNullSafe(F.col("_w")), "left").drop("_w")
        .withColumn("error_rate", rate)
        .withColumn("latency_alert", F.coalesce(F.col("p95_latency_ms") > ALERT_P95_MS, F.lit(False)))
        .withColumn("error_alert", rate > ALERT_ERROR_RATE)
    )


#: Logarithmic cells per factor e, about one per cent of a latency each, and the cell that holds all larger ones.
SUMMARY_CELLS_PER_E, SUMMARY_LAST = 100, 2_100
#: Most state rows of a window: the cells and one for values that are none, for either outcome.
SUMMARY_ROWS = 2 * (SUMMARY_LAST + 2)


def summary_cell(latency: Column | str) -> Column:
    """Cell of a latency; null, NaN and negative ones share cell -1."""
    value = F.col(latency) if isinstance(latency, str) else latency
    cell = F.least(F.floor(F.log1p(value) * SUMMARY_CELLS_PER_E), F.lit(SUMMARY_LAST)).cast("int")
    return F.when(value.isNull() | F.isnan(value) | (value < 0), -1).otherwise(cell)


def latency_summary(log: DataFrame, time: str = "started_at", width: str = ALERT_WINDOW) -> DataFrame:
    """A summary of the latencies of every window: count, least and greatest per cell and outcome.

    It merges by adding, and a window holds at most ``SUMMARY_ROWS`` rows of it, however many latencies differ: the bounded
    state of a stream.
    """
    return (
        log.groupBy(F.window(time, width).alias("w"), summary_cell("latency_ms").alias("cell"), "is_error")
        .agg(F.count("*").alias("n"), F.min("latency_ms").alias("low"), F.max("latency_ms").alias("high"))
        .select(F.col("w.start").alias("window_start"), "cell", "is_error", "n", "low", "high")
    )


def alerts_from_summary(summary: DataFrame, lake: DataFrame, time: str = "started_at", width: str = ALERT_WINDOW) -> DataFrame:
    """The rows of :func:`alerts_from_cells`, from summaries of whole windows and a second look at the lake.

    The summary tells which cells hold the two values next to the percentile.  A cell of one value gives it; of the others the
    rows are looked up in ``lake``, which has the log, for their windows and cells only.  A rank that the lake lacks
    (a row that has not landed yet) takes the greatest value of its cell.
    """
    ok = summary.filter(~F.col("is_error") & (F.col("cell") >= 0))
    group = Window.partitionBy("window_start")
    upto = group.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    placed = ok.withColumn("_end", F.sum("n").over(upto)).withColumn("_total", F.sum("n").over(group)).withColumn("_base", F.col("_end") - F.col("n"))
    ranks = F.array(*[F.struct(
        F.lit(side).alias("side"), F.least(F.floor((F.col("_total") - 1) * 0.95) + side, F.col("_total") - 1).alias("rank"),
        ((F.col("_total") - 1) * 0.95 % 1).alias("part"),
    ) for side in (0, 1)])
    hit = placed.withColumn("r", F.explode(ranks)).select("window_start", "cell", "low", "high", "_base", "_end", "r.*")
    hit = cut_lineage(hit.filter("rank >= _base AND rank < _end").drop("_end"), "table")
    wide = hit.filter("low < high")
    # Few windows close at a time, so the lake is read for their days, windows and cells only.
    first, last = wide.agg(F.min("window_start"), F.max("window_start") + F.expr(f"INTERVAL {width}")).first()
    if first is None:
        looked = wide.select("window_start", "side", F.lit(None).cast("double").alias("seen"))
    else:
        rows = lake.filter((F.col(time) >= F.lit(first)) & (F.col(time) < F.lit(last)) & ~F.col("is_error"))
        rows = rows.select(F.window(time, width).start.alias("window_start"), summary_cell("latency_ms").alias("cell"), "latency_ms")
        values = rows.join(wide.select("window_start", "cell").distinct(), ["window_start", "cell"], "left_semi")
        values = values.groupBy("window_start", "cell", "latency_ms").agg(F.count("*").alias("m"))
        within = Window.partitionBy("window_start", "cell").orderBy("latency_ms").rowsBetween(Window.unboundedPreceding, 0)
        values = values.withColumn("_to", F.sum("m").over(within))
        met = wide.select("window_start", "cell", "side", (F.col("rank") - F.col("_base")).alias("place")).join(values, ["window_start", "cell"])
        looked = met.filter("place < _to AND place >= _to - m").select("window_start", "side", F.col("latency_ms").cast("double").alias("seen"))
    value = F.coalesce("seen", F.col("high").cast("double"))
    sides = hit.join(looked, ["window_start", "side"], "left").groupBy(F.col("window_start").alias("_w")).agg(
        F.max(F.when(F.col("side") == 0, value)).alias("_a"), F.max(F.when(F.col("side") == 1, value)).alias("_b"), F.max("part").alias("_part")
    )
    p95 = sides.select("_w", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_part")).alias("p95_latency_ms"))
    return _alert_rows(summary, p95)


def latency_alerts(log: DataFrame, time: str = "started_at", width: str = ALERT_WINDOW) -> DataFrame:
    return alerts_from_cells(latency_cells(log, time, width))


def positive_rate_alerts(
    predictions: DataFrame, reference_rate, time: str, width: str = "1 day", prediction: str = "churn_prediction"
) -> DataFrame:
    """Windows whose predicted positive rate moved more than a factor of two.

    ``reference_rate`` is a number or a one-row, one-column DataFrame.
    """
    ref = reference_rate.scalar() if isinstance(reference_rate, DataFrame) else F.lit(float(reference_rate))
    rate = F.col("positive_rate")
    return (
        predictions.groupBy(F.window(time, width).alias("w"))
        .agg(F.count("*").alias("n_scored"), F.avg(F.col(prediction).cast("double")).alias("positive_rate"))
        .select(F.col("w.start").alias("window_start"), "n_scored", "positive_rate")
        .withColumn("reference_rate", ref)
        .withColumn(
            "rate_alert",
            (rate > F.col("reference_rate") * ALERT_RATE_FACTOR) | (rate * ALERT_RATE_FACTOR < F.col("reference_rate")),
        )
    )
