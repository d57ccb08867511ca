"""Structured Streaming forms of the batch operators.

The builders return streaming frames; the ``start_*`` functions attach sinks.
Triggers default to ``availableNow``: process what is there, then stop.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.contract import validate_rows
from ..functions.telemetry import with_temperature
from ..operators.lineage import Scratch, cut_lineage
from ..plans.alerts import alerts_from_summary, latency_summary
from ..plans.ingest import IngestPaths, ingest, upsert
from ..plans.score import score, write_scores
from ..schemas import ALERT_WINDOW
from ..session import scratch_path
from ..sources.landing import accepted_rows, checked_files, rejected_rows

LATENESS = "10 minutes"
ONCE = {"availableNow": True}


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need a zoned timestamp; the given tables carry local ones."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def telemetry_csv_stream(spark: SparkSession, folder: str, schema: str, archive: str | None = None) -> DataFrame:
    """Landing folder as a stream; consumed files move to ``archive`` when given."""
    reader = spark.readStream.schema(schema).option("header", True)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.csv(folder)


def average_temperature(
    readings: DataFrame, time: str = "event_ts", lateness: str = LATENESS, width: str = ALERT_WINDOW
) -> DataFrame:
    """Average temperature and readings per model and window; a window comes out once, when it closes.

    Readings behind the watermark are dropped here; :func:`corrected_averages` mends their windows from the lake.
    """
    return (
        with_temperature(event_time(readings, time))
        .withWatermark(time, lateness)
        .groupBy(F.window(time, width).alias("w"), "vehicle_model")
        .agg(F.avg("engine_temp").alias("avg_engine_temp"), F.count("*").alias("n_records"))
        .select(F.col("w.start").alias("window_start"), "vehicle_model", "avg_engine_temp", "n_records")
    )


def deduplicated(events: DataFrame, key: list[str], time: str, lateness: str = LATENESS) -> DataFrame:
    """First delivery of every id; state is dropped once the watermark has passed."""
    return event_time(events, time).withWatermark(time, lateness).dropDuplicatesWithinWatermark(key)


def scored_and_rejected(
    payloads: DataFrame, model: PipelineModel, version: str, promoted: str, keep: list[str], received_at: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Stateless scores of the payloads that satisfy the contract, and the other payloads with their ``violations``.

    Two streams that need a sink each; :func:`start_scores` writes both in one query.
    """
    valid, bad = validate_rows(payloads)
    return score(valid, model, version, promoted, keep, received_at), bad


def start_table(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append to a Parquet table, exactly once (the file sink logs its batches)."""
    return (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(**(trigger or ONCE)).start()
    )


def start_ingest(
    snapshots: DataFrame, table: str, checkpoint: str, quarantine: str, required: list[str],
    trigger: dict | None = None,
) -> StreamingQuery:
    """Validate, deduplicate and merge every micro-batch into the snapshot table.

    ``snapshots`` carries the stored columns, order columns included.  A batch
    that is replayed after a failure merges to the same table.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        batch.persist()     # read several times below
        if not batch.isEmpty():
            columns = F.array(*[F.lit(c) for c in batch.columns])
            files = batch.select("file_name").distinct().withColumn("columns", columns)
            with Scratch(batch.sparkSession) as scratch:
                status = checked_files(batch, files, required, scratch.store)
                rejected_rows(batch, status).write.mode("overwrite").parquet(f"{quarantine}/stream_batch={batch_id}")
                upsert(batch.sparkSession, table, accepted_rows(batch, status))
        batch.unpersist()

    return (
        snapshots.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ONCE)).start()
    )


def start_alerts(
    log: DataFrame, table: str, checkpoint: str, lake: DataFrame, time: str = "started_at", lateness: str = LATENESS,
    width: str = ALERT_WINDOW, trigger: dict | None = None,
) -> StreamingQuery:
    """Alert rows of every window once it closes.

    The stream keeps a summary of bounded size per window.  A closed window comes out whole in one micro-batch, where
    the batch rule is applied to it; the values next to the percentile are looked up in ``lake``, the log as a table.
    Each micro-batch owns one partition, so a replay overwrites its own rows.
    """
    summaries = latency_summary(event_time(log, time).withWatermark(time, lateness), time, width)
    landed = event_time(lake, time)

    def evaluate(batch: DataFrame, batch_id: int) -> None:
        with Scratch(batch.sparkSession) as scratch:    # the rule looks at it twice; the state must not be updated twice
            closed = scratch.store(batch)
            alerts_from_summary(closed, landed, time, width).write.mode("overwrite").parquet(f"{table}/stream_batch={batch_id}")

    return (
        summaries.writeStream.foreachBatch(evaluate).outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ONCE)).start()
    )


def start_scores(
    payloads: DataFrame, table: str, rejects: str, checkpoint: str, model: PipelineModel, version: str, promoted: str, keep: list[str],
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score every micro-batch and keep its rejected payloads with their violations; a replay overwrites its own rows."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_scores(batch, table, rejects, model, version, promoted, keep, batch_id)

    return (
        payloads.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or ONCE)).start()
    )


def start_landing(
    spark: SparkSession, paths: IngestPaths, run_date: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Ingest customer files as they land: headers checked, log rows written, rejected files kept.

    The stream only tells that files have come; each micro-batch runs the ingest job, whose log says what is new.
    """
    landed = spark.readStream.format("text").option("pathGlobFilter", "*.csv").option("wholetext", True).load(paths.incoming)

    def run(batch: DataFrame, batch_id: int) -> None:
        ingest(batch.sparkSession, paths, batch_id + 1, run_date)

    # No column of the files is read here.
    return (
        landed.select(F.lit(1).alias("landed")).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ONCE)).start()
    )


class Flush:
    """A second source for a windowed stream, which closes the windows still open when the first one ends.

    Its only row lies a day after the latest one, so the watermark passes all real windows and its own stays open.
    """

    def __init__(self, stream: DataFrame):
        self.spark, self.schema = stream.sparkSession, stream.schema
        self.folder = scratch_path(self.spark, "flush")
        self.spark.createDataFrame([], self.schema).write.parquet(self.folder)
        self.stream = stream.unionByName(self.spark.readStream.schema(self.schema).parquet(self.folder))

    def push(self, time: str, latest, **values) -> None:
        row = self.spark.range(1).select(*[
            (F.lit(latest) + F.expr("INTERVAL 1 DAY") if f.name == time else F.lit(values.get(f.name))).cast(f.dataType).alias(f.name)
            for f in self.schema
        ])
        row.write.mode("append").parquet(self.folder)


def late_windows(late: DataFrame, time: str = "event_ts", width: str = ALERT_WINDOW) -> DataFrame:
    """The windows that late rows belong to: (window_start)."""
    return event_time(late, time).select(F.window(time, width).start.alias("window_start")).distinct()


def corrected_averages(
    emitted: DataFrame, lake: DataFrame, late: DataFrame, time: str = "event_ts", width: str = ALERT_WINDOW
) -> DataFrame:
    """The stream's windows with those that late rows touch aggregated again from the lake, which has all rows.

    Other windows are left as they are; of the lake, only the touched days are read and only touched windows grouped.
    """
    touched = cut_lineage(late_windows(late, time, width), "table")
    low, high = touched.agg(F.min("window_start"), F.max("window_start") + F.expr(f"INTERVAL {width}")).first()
    rows = with_temperature(event_time(lake, time)).filter((F.col(time) >= F.lit(low)) & (F.col(time) < F.lit(high)))
    rows = rows.withColumn("window_start", F.window(time, width).start).join(touched, "window_start", "left_semi")
    again = rows.groupBy("window_start", "vehicle_model").agg(F.avg("engine_temp").alias("avg_engine_temp"), F.count("*").alias("n_records"))
    return emitted.join(touched, "window_start", "left_anti").unionByName(again.select(*emitted.columns))


def run_to_table(stream: DataFrame, purpose: str) -> DataFrame:
    """Drain a stream into a new table under the shared folder and read it back."""
    spark = stream.sparkSession
    root = scratch_path(spark, purpose)
    start_table(stream, f"{root}/out", f"{root}/state").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")
