"""Landing files: discovery, headers, reading, validation, keep-last merge."""

from __future__ import annotations

import csv
import io
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.cleaning import typed_snapshot
from ..operators.lineage import Scratch, cut_lineage
from ..operators.stats import missing_sql
from ..schemas import FILE_MAX_NULL_FRACTION, SNAPSHOT_COLUMNS, SNAPSHOT_KEY, SNAPSHOT_TYPES
from .records import CSV_OPTIONS, QUOTE, open_after, records, split_lines

# Position of a row in its file: split offset, then order inside the split.
POSITION = ["file_name", "split_start", "row_pos"]


def _plain(path: str | Column) -> Column:
    """A path in one form: file metadata come URL-encoded, file listings do not, and local ones differ in slashes."""
    path = F.col(path) if isinstance(path, str) else path
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def _name(path: str | Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def literal_path(path: str) -> str:
    """A path whose name may hold glob signs, for the readers."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def discover(spark: SparkSession, folder: str, log: DataFrame | None = None, pattern: str = "*.csv") -> DataFrame:
    """Files in ``folder`` (path, file_name, length, modified_at) that the ingest log does not know.

    A file is known by path, length and modification time, so one that comes again under its name with other
    content is new.  Only file status is read: the content column is pruned.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select(
        "path", _name("path").alias("file_name"), "length", F.col("modificationTime").alias("modified_at")
    )
    known = ["path", "length", "modified_at"]
    return files if log is None else files.join(log.select(*known).distinct(), known, "left_anti")


def landing_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The lines of all files with their POSITION and what their quotes do: the only scan of the text."""
    raw = spark.read.option("lineSep", "\n").text([literal_path(p) for p in paths]).select(
        _name(_plain("_metadata.file_path")).alias("file_name"), F.col("_metadata.file_block_start").alias("split_start"), "value"
    )
    # A mark of byte order is no part of the first name.
    text = F.ltrim("value", F.lit("\ufeff"))
    return split_lines(raw).select(
        "file_name", "split_start", F.monotonically_increasing_id().alias("row_pos"), "value", "ending",
        F.contains("value", F.lit(QUOTE)).alias("quoted"), open_after(text, False).alias("opens"),
    )


def file_headers(rows: DataFrame) -> DataFrame:
    """First record of every file that has one: (file_name, header, header_pos)."""
    first = rows.filter("split_start = 0").groupBy("file_name").agg(F.min_by(F.struct("value", "row_pos"), "row_pos").alias("h"))
    return first.select("file_name", F.ltrim(F.col("h.value"), F.lit("\ufeff")).alias("header"), F.col("h.row_pos").alias("header_pos"))


def header_names(header: str) -> list[str]:
    """Column names as a header writes them; a quoted one may hold commas and line breaks."""
    return [c.strip() for c in next(csv.reader(io.StringIO(header, newline="")), [])]


def _columns(header: str) -> list[str]:
    """Column names of a header; an empty or repeated name gets one that nothing asks for."""
    names = header_names(header)
    return [c if c and c not in names[:i] else f"_unnamed_{i}" for i, c in enumerate(names)]


def _field(name: str) -> str:
    return "`" + name.replace("`", "``") + "` string"


def read_landing(spark: SparkSession, found: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Discovered files -> (typed rows with POSITION columns, file table (file_name, columns, unclosed)), both stored.

    The text is scanned once, into stored lines; lines become records, whatever splits the files are read in.  Files are
    matched by column name; those that share a header are typed together, so the plan grows with the number of distinct
    headers only, and they alone reach the driver.  The paths of one delivery do too.  A blank file has no named column; one
    of no bytes is not listed.  ``unclosed`` tells that a quote of the file is never closed.
    """
    found = scratch.store(found)
    lines = scratch.store(landing_lines(spark, [r["path"] for r in found.select("path").orderBy("path").collect()]))
    texts = records(lines, scratch.store)
    headers = scratch.store(file_headers(texts))
    body = texts.join(headers, "file_name").filter(
        "NOT (split_start = 0 AND row_pos = header_pos) AND trim(value) <> ''"
    )
    frames, kinds = [], [(r["header"], _columns(r["header"])) for r in headers.select("header").distinct().collect()]
    for header, names in kinds:
        if not names:
            continue
        parsed = body.filter(F.col("header") == header).select(
            F.from_csv("value", ", ".join(map(_field, names)), CSV_OPTIONS).alias("r"), *POSITION
        )
        frames.append(typed_snapshot(parsed.select("r.*", *POSITION), keep=POSITION))
    if frames:
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    else:
        rows = spark.createDataFrame([], snapshot_schema({"file_name": "string", "split_start": "bigint", "row_pos": "bigint"}))
    named = spark.createDataFrame([(h, header_names(h)) for h, _ in kinds], "header string, columns array<string>")
    unclosed = texts.filter("unclosed").select("file_name").distinct().withColumn("unclosed", F.lit(True))
    files = found.join(headers.join(named, "header"), "file_name", "left").join(unclosed, "file_name", "left").select(
        "file_name", "path", "length", "modified_at", F.coalesce("columns", F.array().cast("array<string>")).alias("columns"),
        F.coalesce("unclosed", F.lit(False)).alias("unclosed"),
    )
    return scratch.store(rows), files


def validate_files(
    rows: DataFrame, files: DataFrame, required: list[str] | None = None, file: str = "file_name"
) -> DataFrame:
    """One status row per file: rows, largest null fraction, status, reason.

    A file is rejected when its header lacks a required column, when more
    than half of the values of one required column are NULL, or when ``files``
    say that it is ``unclosed``.  A file without rows passes.
    """
    required = required or SNAPSHOT_COLUMNS
    kinds = dict(rows.dtypes)
    worst = F.expr("greatest(" + ", ".join(f"avg(cast({missing_sql(c, kinds[c])} AS int))" for c in required) + ")")
    filled = rows.groupBy(file).agg(F.count("*").alias("n_rows"), worst.alias("max_null_fraction"))
    unclosed = F.col("unclosed") if "unclosed" in files.columns else F.lit(False)
    absent = F.array_except(F.array(*[F.lit(c) for c in required]), F.col("columns"))
    return (
        files.join(filled, file, "left")
        .withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
        .withColumn("missing_columns", absent)
        .withColumn(
            "reason",
            F.when(F.size("missing_columns") > 0, F.concat(F.lit("missing: "), F.array_join("missing_columns", ",")))
            .when(unclosed, "unclosed quote")
            .when(F.round("max_null_fraction", 10) > FILE_MAX_NULL_FRACTION, "null fraction above 0.5"),
        )
        .withColumn("status", F.when(F.col("reason").isNull(), "accepted").otherwise("rejected"))
        .select(file, "n_rows", "max_null_fraction", "status", "reason")
    )


def stored_table(df: DataFrame) -> DataFrame:
    return cut_lineage(df, "table")


def checked_files(rows: DataFrame, files: DataFrame, required: list[str] | None = None, store=stored_table) -> DataFrame:
    """The status table, stored: it is joined several times, and its size is known then."""
    return store(validate_files(rows, files, required))


def accepted_rows(rows: DataFrame, status: DataFrame, file: str = "file_name") -> DataFrame:
    return rows.join(status.filter(F.col("status") == "accepted").select(file), file, "left_semi")


def rejected_rows(rows: DataFrame, status: DataFrame, file: str = "file_name") -> DataFrame:
    return rows.join(status.filter(F.col("status") != "accepted").select(file), file, "left_semi")


def keep_last(df: DataFrame, order: list[str], key: list[str] | None = None) -> DataFrame:
    """The last row per key in the given order.

    ``row_number() = 1`` is pushed below the shuffle as a group limit, so a
    key with very many repeats still moves one row per task.
    """
    key = key or SNAPSHOT_KEY
    newest = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


def touched_dates(existing: DataFrame, new: DataFrame, store=None) -> DataFrame:
    """Existing rows of the dates that ``new`` brings; other partitions are not read.

    The new dates are stored, so the planner knows how few they are and prunes
    partitions with them at run time; their first and last day prune at
    planning time.  Rows without a date form one partition and always count as
    touched.
    """
    dates = (store or stored_table)(new.select("snapshot_date").filter("snapshot_date IS NOT NULL").distinct())
    low, high = dates.agg(F.min("snapshot_date"), F.max("snapshot_date")).first()
    span = F.col("snapshot_date").between(F.lit(low), F.lit(high))
    dated = existing.filter(span).join(dates.filter(span), "snapshot_date", "left_semi")
    return dated.unionByName(existing.filter("snapshot_date IS NULL")).select(*existing.columns)


def merge_snapshots(touched: DataFrame | None, new: DataFrame, order: list[str]) -> DataFrame:
    """New rows merged over existing rows of the same dates, last row per key.

    ``order`` names columns of both sides, batch number first.
    """
    every = new if touched is None else touched.unionByName(new, allowMissingColumns=True)
    return keep_last(every, order).select(*new.columns)


def snapshot_schema(extra: dict[str, str] | None = None) -> str:
    return ", ".join(f"{c} {t}" for c, t in {**SNAPSHOT_TYPES, **(extra or {})}.items())
