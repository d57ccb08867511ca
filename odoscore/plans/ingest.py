"""Ingestion of landing files into the processed snapshot table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lineage import Scratch
from ..schemas import SNAPSHOT_COLUMNS
from ..session import move_file
from ..sources.versions import Conflict, VersionedTables
from ..sources.landing import (
    accepted_rows,
    checked_files,
    discover,
    merge_snapshots,
    read_landing,
    rejected_rows,
    touched_dates,
)
from ..sources.tables import append_rows, read_or_none, replace_partitions

# Kept in the table so that a late or repeated batch cannot undo a newer one.
ORDER = ["batch_seq", "file_name", "split_start", "row_pos"]
STORED = SNAPSHOT_COLUMNS + ORDER


@dataclass(frozen=True)
class IngestPaths:
    incoming: str
    processed: str
    log: str
    quarantine: str
    # Consumed files are moved here, so that the listing stays one delivery; None leaves them.
    archive: str | None = None


def upsert(spark: SparkSession, table: str, new: DataFrame) -> None:
    """Merge rows (STORED columns) into the table, rewriting only the dates they touch.

    The merged dates are written aside first, swapped in, and deleted.  Running the same batch again gives the
    same table, so a job that died half way is simply repeated.
    """
    new = new.select(*STORED)
    existing = read_or_none(spark, table)
    with Scratch(spark) as scratch:
        touched = None if existing is None else touched_dates(existing.select(*STORED), new, scratch.store)
        replace_partitions(scratch.store(merge_snapshots(touched, new, ORDER)), table, "snapshot_date")


def table_rows(spark: SparkSession, table: str) -> int:
    """Rows of a table as it stands (from the file footers)."""
    existing = read_or_none(spark, table)
    return 0 if existing is None else existing.count()


def log_rows(status: DataFrame, files: DataFrame, counts: list[int], batch_seq: int, run_date: str) -> DataFrame:
    """One row per file of a run; ``counts`` are the rows of the table before and after it."""
    return status.join(files.drop("columns", "unclosed"), "file_name").select(
        "file_name", "n_rows", "status", "reason",
        *[F.lit(n).cast("long").alias(f"table_rows_{when}") for when, n in zip(("before", "after"), counts)],
        F.lit(batch_seq).cast("long").alias("batch_seq"), F.lit(run_date).cast("date").alias("run_date"),
        "path", "length", "modified_at",
    )


def ingest(spark: SparkSession, paths: IngestPaths, batch_seq: int, run_date: str) -> DataFrame | None:
    """Ingest every file the log does not know; returns the log rows of this run, or None.

    A file named in the log with its length and time is never read again, whether accepted or rejected; one that
    comes again changed is.  Rejected files keep their rows in the quarantine table, in the partition of their
    batch.  The log is written last: a run that dies before that is repeated with the same ``batch_seq`` and
    leaves the same table and quarantine.
    """
    log = read_or_none(spark, paths.log)
    with Scratch(spark) as scratch:
        found = scratch.store(discover(spark, paths.incoming, log))
        if found.isEmpty():
            return None
        rows, files = read_landing(spark, found, scratch)
        rows = rows.withColumn("batch_seq", F.lit(batch_seq).cast("long"))
        files = scratch.store(files)
        status = checked_files(rows, files.select("file_name", "columns", "unclosed"), store=scratch.store)
        before = table_rows(spark, paths.processed)
        kinds = {r["status"] for r in status.select("status").distinct().collect()}
        if "accepted" in kinds:
            upsert(spark, paths.processed, accepted_rows(rows, status))
        if "rejected" in kinds:
            replace_partitions(rejected_rows(rows, status).select(*STORED), paths.quarantine, "batch_seq")
        entry = log_rows(status, files, [before, table_rows(spark, paths.processed)], batch_seq, run_date)
        append_rows(entry, paths.log)
        if paths.archive is not None:
            for row in found.select("path", "file_name").collect():
                move_file(spark, row["path"], f"{paths.archive}/{batch_seq}/{row['file_name']}")
    written = spark.read.parquet(paths.log)
    return written.filter(F.col("batch_seq") == batch_seq)


def ingest_versioned(
    spark: SparkSession, tables: VersionedTables, incoming: str, run_date: str, archive: str | None = None, attempts: int = 10
) -> DataFrame | None:
    """Ingest every file the log does not know, as one version; returns the log rows of this run, or None.

    The merged dates, the rejected rows and the log rows appear together or not at all.  A run that dies leaves the version
    before it, and its repeat counts from that one.  A run that another one has overtaken starts again from the newer version,
    whose log may know its files.  Files are archived after the commit; those that a dead run has left are archived by the
    next.  Batches are numbered by versions.
    """
    for _ in range(attempts):
        base = tables.current()
        log = tables.read("log", base)
        if archive is not None and log is not None:
            _archive_known(spark, incoming, log, archive)
        with Scratch(spark) as scratch:
            found = scratch.store(discover(spark, incoming, log))
            if found.isEmpty():
                return None
            batch = base.number + 1
            rows, files = read_landing(spark, found, scratch)
            rows = rows.withColumn("batch_seq", F.lit(batch).cast("long"))
            files = scratch.store(files)
            status = checked_files(rows, files.select("file_name", "columns", "unclosed"), store=scratch.store)
            work = tables.begin(base)
            existing = tables.read("processed", base)
            good = accepted_rows(rows, status).select(*STORED)
            if not status.where("status = 'accepted'").isEmpty():
                touched = None if existing is None else touched_dates(existing.select(*STORED), good, scratch.store)
                work.replace_partitions("processed", scratch.store(merge_snapshots(touched, good, ORDER)), "snapshot_date")
            work.replace_partitions("quarantine", rejected_rows(rows, status).select(*STORED), "batch_seq")
            counts = [0 if t is None else t.count() for t in (existing, tables.read("processed", work.staged()))]
            work.replace_partitions("log", log_rows(status, files, counts, batch, run_date), "batch_seq")
            try:
                done = work.commit(batch_seq=batch, run_date=run_date)
            except Conflict:
                continue
        log = tables.read("log", done)
        if archive is not None:
            _archive_known(spark, incoming, log, archive)
        return log.filter(F.col("batch_seq") == batch)
    raise Conflict(f"{attempts} attempts were overtaken")


def _archive_known(spark: SparkSession, incoming: str, log: DataFrame, archive: str) -> None:
    """Move the files of the folder that the log knows: one delivery, and what a dead run has left."""
    known = log.select("path", "length", "modified_at", "batch_seq")
    for row in discover(spark, incoming).join(known, ["path", "length", "modified_at"]).collect():
        move_file(spark, row["path"], f"{archive}/{row['batch_seq']}/{row['file_name']}")


def ingest_summary(log: DataFrame) -> DataFrame:
    """Files and rows per run and status."""
    return log.groupBy("batch_seq", "run_date", "status").agg(
        F.count("*").alias("n_files"),
        F.sum("n_rows").alias("n_rows"),
        F.max("table_rows_before").alias("table_rows_before"),
        F.max("table_rows_after").alias("table_rows_after"),
    )
