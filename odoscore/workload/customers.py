"""Customer queries: cleaning, features, ingest, split, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import views
from ..functions.cleaning import clean_customers
from ..functions.contract import validate_rows
from ..functions.features import features
from ..operators.lineage import cut_lineage
from ..operators.ranking import stage_batches, stratified_split
from ..operators.stats import feature_stats
from ..plans.ingest import STORED, IngestPaths, ingest, ingest_summary, ingest_versioned
from ..plans.train import fit_scaler, standardize
from ..schemas import FEATURES, SNAPSHOT_COLUMNS
from ..session import delete_path, move_file, scratch_path
from ..sources.customers import synthesize_customers
from ..sources.landing import accepted_rows, checked_files, keep_last, validate_files
from ..sources.versions import VersionedTables, version_history
from .catalog import query
from .fragments import CLEAN, CLEAN_COLUMNS, FEATURE_ROWS, SPLIT, STAGED
from .telemetry import rounded


def clean(spark: SparkSession, sf_dir: str, keep: list[str] | None = None, dealt: bool = False) -> DataFrame:
    """Cleaned customers; ``keep`` may name ``k`` and ``nation``.  ``dealt`` spreads the two columns read over all cores."""
    table = views.read_table(spark, sf_dir, "customer")
    if dealt:
        table = views.dealt_out(table.select("c_custkey", "c_nationkey"))
    return clean_customers(views.raw_customers_from_table(table, keep), keep=keep)


def staged(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    return stage_batches(clean(spark, sf_dir, keep))


def split(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    return stratified_split(features(clean(spark, sf_dir, dealt=dealt), ["customer_id", "churn"]))


@query(f"WITH {CLEAN} SELECT {CLEAN_COLUMNS} FROM clean", name="clean_customers")
def cleaned(spark, sf_dir):
    return clean(spark, sf_dir).drop("snapshot_date")


@query(f"WITH {FEATURE_ROWS} SELECT customer_id, {', '.join(FEATURES)} FROM feature_rows")
def customer_features(spark, sf_dir):
    return features(clean(spark, sf_dir), ["customer_id"])


# The contract is checked on rows with some fields spoilt on purpose.
SPOILT = {
    "tenure_months": ("CASE WHEN k % 53 = 1 THEN 201 WHEN k % 53 = 2 THEN -1 WHEN k % 53 = 3 THEN NULL ELSE tenure_months END", "int"),
    "monthly_charges": ("CASE WHEN k % 59 = 1 THEN -0.01 WHEN k % 59 = 2 THEN 0 ELSE monthly_charges END", "double"),
    "has_partner": ("CASE WHEN k % 61 = 5 THEN 2 ELSE has_partner END", "int"),
}
_SPOILT_SQL = ", ".join(f"cast({sql} AS {kind}) AS {name}" for name, (sql, kind) in SPOILT.items())


@query(f"WITH {CLEAN}, spoilt AS (SELECT * REPLACE ({_SPOILT_SQL}) FROM clean)" + """,
checked AS (SELECT customer_id, concat_ws(',',
 CASE WHEN coalesce(tenure_months BETWEEN 0 AND 200, false) THEN NULL ELSE 'tenure_months' END,
 CASE WHEN contract_type IS NULL THEN 'contract_type' END,
 CASE WHEN payment_method IS NULL THEN 'payment_method' END,
 CASE WHEN internet_service IS NULL THEN 'internet_service' END,
 CASE WHEN monthly_charges >= 0 THEN NULL ELSE 'monthly_charges' END,
 CASE WHEN has_partner IN (0, 1) THEN NULL ELSE 'has_partner' END) AS violations FROM spoilt)
SELECT * FROM checked WHERE violations <> ''""")
def rejected_rows(spark, sf_dir):
    rows = clean(spark, sf_dir, ["k"])
    spoilt = rows.withColumns({n: F.expr(sql).cast(kind) for n, (sql, kind) in SPOILT.items()})
    _, rejected = validate_rows(spoilt)
    return rejected.select("customer_id", F.array_join("violations", ",").alias("violations"))


@query(f"WITH {STAGED} SELECT customer_id, cast(snapshot_date AS string) AS snapshot_date FROM staged", name="stage_batches")
def batch_members(spark, sf_dir):
    return staged(spark, sf_dir).select("customer_id", F.col("snapshot_date").cast("string").alias("snapshot_date"))


@query(f"WITH {STAGED} SELECT cast(snapshot_date AS string) AS snapshot_date, count(*)::bigint AS n_rows FROM staged GROUP BY 1")
def stage_batches_sizes(spark, sf_dir):
    return staged(spark, sf_dir).groupBy(F.col("snapshot_date").cast("string").alias("snapshot_date")).agg(
        F.count("*").alias("n_rows")
    )


def delivered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two deliveries of dated files and their header table.

    File names come from the snapshot date.  Day 3 lacks ``contract_type``,
    60 % of day 5 and half of day 7 have no ``payment_method``.  The second
    delivery repeats every 20th customer with a charge one higher.
    """
    rows = staged(spark, sf_dir, ["k"]).withColumn("day", F.dayofmonth("snapshot_date"))
    spoilt = (
        ((F.col("day") == 5) & (F.col("k") % 10 < 6)) | ((F.col("day") == 7) & (F.col("k") % 10 < 5))
    )
    times = F.when(F.col("k") % 20 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    every = rows.withColumn("batch_seq", F.explode(times)).withColumns({
        "batch_seq": F.col("batch_seq").cast("long"),
        "contract_type": F.when(F.col("day") != 3, F.col("contract_type")),
        "payment_method": F.when(~spoilt, F.col("payment_method")),
        "monthly_charges": F.col("monthly_charges") + (F.col("batch_seq") - 1),
        "file_name": F.format_string("customers_%s_%s.csv", F.col("snapshot_date").cast("string"), F.col("batch_seq").cast("string")),
        "split_start": F.lit(0).cast("long"),
        "row_pos": F.col("k"),
    })
    every = cut_lineage(every, "table")
    headers = F.array(*[F.lit(c) for c in SNAPSHOT_COLUMNS])
    files = every.select("file_name", "day").distinct().select(
        "file_name",
        F.when(F.col("day") == 3, F.array_remove(headers, "contract_type")).otherwise(headers).alias("columns"),
    )
    return every, files


_DELIVERED = STAGED + """,
first_batch AS (
 SELECT * REPLACE (CASE WHEN day(snapshot_date) <> 3 THEN contract_type END AS contract_type,
   CASE WHEN NOT ((day(snapshot_date) = 5 AND k % 10 < 6) OR (day(snapshot_date) = 7 AND k % 10 < 5))
    THEN payment_method END AS payment_method), 1::bigint AS batch_seq
 FROM staged),
delivered AS (
 SELECT *, concat('customers_', snapshot_date::string, '_', batch_seq::string, '.csv') AS file_name FROM (
  SELECT * FROM first_batch UNION ALL BY NAME
  SELECT * REPLACE (monthly_charges + 1.0::double AS monthly_charges, 2::bigint AS batch_seq) FROM first_batch WHERE k % 20 = 0)),
file_status AS (
 SELECT file_name, count(*)::bigint AS n_rows,
  greatest(avg((contract_type IS NULL)::int), avg((payment_method IS NULL)::int)) AS max_null_fraction,
  CASE WHEN any_value(day(snapshot_date)) = 3 THEN 'missing: contract_type'
   WHEN round(greatest(avg((contract_type IS NULL)::int), avg((payment_method IS NULL)::int)), 10) > 0.5
   THEN 'null fraction above 0.5' END AS reason
 FROM delivered GROUP BY file_name)"""


@query(f"WITH {_DELIVERED}" + """
SELECT file_name, n_rows, round(max_null_fraction, 6) AS max_null_fraction,
 CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS status, reason FROM file_status""")
def file_validation(spark, sf_dir):
    return rounded(validate_files(*delivered(spark, sf_dir)), "max_null_fraction")


@query(f"WITH {_DELIVERED}" + f""",
ok AS (SELECT d.* FROM delivered d JOIN file_status s USING (file_name) WHERE s.reason IS NULL)
SELECT {CLEAN_COLUMNS}, cast(snapshot_date AS string) AS snapshot_date, batch_seq FROM ok
QUALIFY row_number() OVER (PARTITION BY customer_id, snapshot_date ORDER BY batch_seq DESC) = 1""")
def ingest_dedup_keep_last(spark, sf_dir):
    rows, files = delivered(spark, sf_dir)
    good = accepted_rows(rows, checked_files(rows, files))
    last = keep_last(good.select(*STORED), ["batch_seq", "file_name", "split_start", "row_pos"])
    return last.select(*SNAPSHOT_COLUMNS, "batch_seq").withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


@query(f"WITH {STAGED}, " + """
days AS (SELECT *, day(snapshot_date) AS d FROM staged),
sizes AS (SELECT count(*)::bigint AS all_rows, count(*) FILTER (d <= 6)::bigint AS early, count(*) FILTER (d > 6 OR k % 20 = 0)::bigint AS late,
  count(*) FILTER (d = 1)::bigint AS first_day, count(*) FILTER (d = 2)::bigint AS second_day,
  count(*) FILTER (d = 8)::bigint AS quoted,
  round(sum(monthly_charges + CASE WHEN d = 1 THEN 1.0::double WHEN d = 8 THEN monthly_charges + 2.0::double ELSE 0.0::double END), 2) AS table_charges FROM days)
SELECT batch_seq, status, n_rows, table_rows_before, table_rows_after, table_charges, second_day AS quarantine_rows, quoted AS ids_of_two_lines FROM (
 SELECT 1::bigint AS batch_seq, 'accepted' AS status, early AS n_rows, 0::bigint AS table_rows_before, early AS table_rows_after, * FROM sizes
 UNION ALL SELECT 2, 'accepted', late, early, all_rows, * FROM sizes
 UNION ALL SELECT 3, 'accepted', first_day, all_rows, all_rows, * FROM sizes
 UNION ALL SELECT 3, 'rejected', second_day, all_rows, all_rows, * FROM sizes
 UNION ALL SELECT 4, 'accepted', quoted, all_rows, all_rows + quoted, * FROM sizes)""")
def ingest_log(spark, sf_dir):
    """Four ingest runs over real CSV files.

    The second folder content includes the first.  In the third, the file of day 1 comes again under its name with other
    charges, and a file of day 2 without payment methods is rejected.  In the fourth, customers of day 8 come under names
    of two lines, with notes that hold quotes, commas and line breaks, under a header that holds a comma.
    """
    root = scratch_path(spark, "ingest")
    paths = IngestPaths(*[f"{root}/{name}" for name in ("incoming", "processed", "log", "quarantine")])
    rows = cut_lineage(staged(spark, sf_dir, ["k"]), "table")
    day = F.dayofmonth("snapshot_date")

    def deliver(part: DataFrame, name: str | None = None, more: tuple[str, ...] = ()) -> None:
        target = paths.incoming if name is None else f"{root}/outbox/{name}"
        out = part.select(*[F.col(f"`{c}`") for c in (*more, *SNAPSHOT_COLUMNS)])
        (out if name is None else out.coalesce(1)).write.mode("append").option("header", True).option("escape", '"').csv(target)
        if name is not None:
            made = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(target).select("path").first()[0]
            move_file(spark, made, f"{paths.incoming}/{name}")

    first = rows.filter(day == 1)
    deliver(rows.filter((day > 1) & (day <= 6)))
    deliver(first, "day 1 + %.csv")
    ingest(spark, paths, 1, "2024-02-01")
    deliver(rows.filter((day > 6) | (F.col("k") % 20 == 0)))
    ingest(spark, paths, 2, "2024-02-02")
    delete_path(spark, f"{root}/outbox")
    deliver(first.withColumn("monthly_charges", F.col("monthly_charges") + 1), "day 1 + %.csv")
    deliver(rows.filter(day == 2).withColumn("payment_method", F.lit(None).cast("string")), "day 2.csv")
    ingest(spark, paths, 3, "2024-02-03")
    note = F.concat(F.lit('said "yes",\n\nthen '), F.col("customer_id"), F.lit('"'))
    quoted = rows.filter(day == 8).withColumn("note, free", note).withColumn("monthly_charges", F.col("monthly_charges") + 2)
    deliver(quoted.withColumn("customer_id", F.concat(F.lit("two\nlines,"), "customer_id")), "day 8.csv", ("note, free",))
    ingest(spark, paths, 4, "2024-02-04")
    summary = ingest_summary(spark.read.parquet(paths.log))
    table = spark.read.parquet(paths.processed)
    charges = table.agg(F.round(F.sum("monthly_charges"), 2)).scalar()
    two = table.agg(F.count_if(F.contains("customer_id", F.lit("\n")))).scalar()
    held = spark.read.parquet(paths.quarantine).agg(F.count("*")).scalar()
    return summary.select(
        "batch_seq", "status", "n_rows", "table_rows_before", "table_rows_after", charges.alias("table_charges"), held.alias("quarantine_rows"),
        two.alias("ids_of_two_lines"),
    )


@query(f"WITH {STAGED}, " + """
days AS (SELECT *, day(snapshot_date) AS d, day(snapshot_date) > 6 OR k % 20 = 0 AS again FROM staged),
sizes AS (SELECT count(*) FILTER (d <= 6)::bigint AS early, count(*) FILTER (again)::bigint AS late, count(*)::bigint AS every,
  count(DISTINCT snapshot_date) FILTER (d <= 6)::bigint AS early_days, count(DISTINCT snapshot_date) FILTER (again)::bigint AS late_days,
  count(DISTINCT snapshot_date) FILTER (again AND d <= 6)::bigint AS common_days,
  round(sum(monthly_charges) FILTER (d <= 6), 2) AS early_charges,
  round(sum(monthly_charges + CASE WHEN again THEN 1.0::double ELSE 0.0::double END), 2) AS all_charges FROM days)
SELECT 1::bigint AS version, early AS n_rows, 0::bigint AS rows_before, early AS rows_after, early_charges AS table_charges,
 early_days AS n_written, 0::bigint AS n_replaced FROM sizes
UNION ALL SELECT 2, late, early, every, all_charges, late_days, common_days FROM sizes""")
def ingest_versions(spark, sf_dir):
    """Two ingest runs as two versions, both read after the second: what the first one showed is still there."""
    root = scratch_path(spark, "ingest-versions")
    rows = cut_lineage(staged(spark, sf_dir, ["k"]), "table")
    day, tables = F.dayofmonth("snapshot_date"), VersionedTables(spark, f"{root}/tables")
    late = rows.filter((day > 6) | (F.col("k") % 20 == 0)).withColumn("monthly_charges", F.col("monthly_charges") + 1)
    for number, part in enumerate([rows.filter(day <= 6), late], 1):
        part.select(*SNAPSHOT_COLUMNS).write.mode("append").option("header", True).csv(f"{root}/incoming")
        ingest_versioned(spark, tables, f"{root}/incoming", f"2024-02-0{number}")

    def seen(number: int) -> DataFrame:
        version = tables.at(number)
        charges = tables.read("processed", version).agg(F.round(F.sum("monthly_charges"), 2)).scalar()
        log = tables.read("log", version).filter(F.col("batch_seq") == number)
        return log.groupBy(F.col("batch_seq").alias("version")).agg(
            F.sum("n_rows").alias("n_rows"), F.max("table_rows_before").alias("rows_before"), F.max("table_rows_after").alias("rows_after"),
        ).withColumn("table_charges", charges)

    parts = version_history(tables).filter("table = 'processed'").select(
        "version", F.col("n_written").cast("long").alias("n_written"), F.col("n_replaced").cast("long").alias("n_replaced")
    )
    return seen(1).unionByName(seen(2)).join(parts, "version")


def _draw(number: int) -> str:
    block, lane = divmod(number, 4)
    return f"(('0x' || substr(md5('42:{block}:' || c_custkey), {8 * lane + 1}, 8))::bigint / 4294967296.0::double)"


def _gauss(number: int) -> str:
    return f"sqrt(-2 * ln(1 - {_draw(number)})) * cos(2 * pi() * {_draw(number + 1)})"


@query(f"""
WITH drawn AS (
 SELECT floor({_draw(0)} * 72)::int AS tenure,
  CASE WHEN {_draw(1)} < 0.55 THEN 'month_to_month' WHEN {_draw(1)} < 0.8 THEN 'one_year' ELSE 'two_year' END AS contract_type,
  CASE WHEN {_draw(3)} < 0.35 THEN 'dsl' WHEN {_draw(3)} < 0.8 THEN 'fiber_optic' ELSE 'none' END AS internet_service,
  {_gauss(4)} AS z1, {_gauss(6)} AS z2, {_gauss(8)} AS z3, {_draw(10)} AS u,
  ({_draw(11)} < 0.3)::int AS security, ({_draw(14)} < 0.3)::int AS support,
  ({_draw(18)} < 0.16)::int AS senior, ({_draw(19)} < 0.48)::int AS partner
 FROM customer),
charged AS (
 SELECT *, greatest(CASE internet_service WHEN 'dsl' THEN 55 WHEN 'fiber_optic' THEN 85 ELSE 25 END + 10 * z1, 15.0::double) AS monthly
 FROM drawn),
labelled AS (
 SELECT *, greatest(monthly * tenure + 20 * z2, 0.0::double) AS total,
  u < 1 / (1 + exp(-(-1.0::double + 1.4::double * (contract_type = 'month_to_month')::int - 0.9::double * (contract_type = 'two_year')::int
   + 0.01::double * (monthly - 60) - 0.015::double * tenure - 0.35::double * (security + support) + 0.3::double * senior
   - 0.3::double * partner + 0.6::double * z3))) AS churned
 FROM charged)
SELECT contract_type, internet_service, count(*)::bigint AS n_customers, sum(churned::int)::bigint AS n_churned,
 sum(tenure)::bigint AS tenure_sum, round(avg(round_even(monthly, 2)), 4) AS avg_monthly, round(avg(round_even(total, 2)), 4) AS avg_total
FROM labelled GROUP BY 1, 2""")
def synthetic_customers_profile(spark, sf_dir):
    ids = views.read_table(spark, sf_dir, "customer").select("c_custkey")
    made = synthesize_customers(ids, "c_custkey")
    out = made.groupBy("contract_type", "internet_service").agg(
        F.count("*").alias("n_customers"),
        F.sum("churn").alias("n_churned"),
        F.sum("tenure_months").alias("tenure_sum"),
        F.avg("monthly_charges").alias("avg_monthly"),
        F.avg("total_charges").alias("avg_total"),
    )
    return rounded(out, "avg_monthly", "avg_total", digits=4)


@query(f"WITH {SPLIT} SELECT split, churn, count(*)::bigint AS n_rows FROM split_rows GROUP BY ALL")
def stratified_split_counts(spark, sf_dir):
    return split(spark, sf_dir).groupBy("split", "churn").agg(F.count("*").alias("n_rows"))


@query(f"WITH {SPLIT} SELECT customer_id, churn, split FROM split_rows")
def stratified_split_members(spark, sf_dir):
    return split(spark, sf_dir).select("customer_id", "churn", "split")


_STATS_SQL = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, round(avg({f}), 6) AS mean, round(stddev_samp({f}), 6) AS std, count(*)::bigint AS n_rows FROM train"
    for f in FEATURES
)


@query(f"WITH {SPLIT}, train AS (SELECT * FROM split_rows WHERE split = 'train') {_STATS_SQL}")
def feature_reference_stats(spark, sf_dir):
    stats = feature_stats(cut_lineage(split(spark, sf_dir), "table").filter("split = 'train'"), "v1")
    return rounded(stats.drop("version"), "mean", "std")


_Z = ", ".join(f"round(({f} - m_{f}) / s_{f}, 6) + 0.0 AS {f}" for f in FEATURES)
_Z_STATS = ", ".join(
    f"avg({f}) AS m_{f}, CASE WHEN stddev_pop({f}) > 0 THEN stddev_pop({f}) ELSE 1 END AS s_{f}" for f in FEATURES
)


@query(f"WITH {SPLIT}, z AS (SELECT {_Z_STATS} FROM split_rows WHERE split = 'train') "
       f"SELECT customer_id, split, {_Z} FROM split_rows, z")
def standardized_features(spark, sf_dir):
    rows = cut_lineage(split(spark, sf_dir), "table")
    scaled = standardize(rows, fit_scaler(rows.filter("split = 'train'")), ["customer_id", "split"])
    # + 0.0 turns a rounded -0.0 into 0.0.
    return scaled.withColumns({f: F.round(f, 6) + F.lit(0.0) for f in FEATURES})
