import datetime
import json

import pytest
from pyspark.sql import functions as F

from odoscore.functions.telemetry import cycle_step, with_temperature
from odoscore.operators import lineage
from odoscore.plans.ingest import IngestPaths, ingest, ingest_summary
from odoscore.schemas import SNAPSHOT_COLUMNS
from odoscore.session import get_spark, scratch_path, shared_root, shuffle_partitions
from odoscore.sources import customers as cust
from odoscore.sources import landing, tables, telemetry


class FakeContext:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class FakeSession:
    def __init__(self, master, setting=None, folder=None):
        self.sparkContext, self.conf = FakeContext(master, folder), self
        self.setting = setting

    def get(self, name, default):
        return self.setting or default


def test_shared_root_follows_the_cluster_setting():
    assert shared_root(FakeSession("spark://x", "hdfs:///chk/")) == "hdfs:///chk"
    assert shared_root(FakeSession("spark://x", None, "hdfs:///set")) == "hdfs:///set"
    with pytest.raises(RuntimeError):
        shared_root(FakeSession("spark://x"))
    local = FakeSession("local[2]")
    assert shared_root(local) == shared_root(local) == local.sparkContext.folder


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_session_is_reused_and_sized(spark):
    assert get_spark("other") is spark
    assert shuffle_partitions(10) == 8 and shuffle_partitions(100 * 2**40) == 819200
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_telemetry_csv(spark, tmp_path):
    head = "vehicle_id,vehicle_model,engine_temp,speed,latitude,longitude,battery_efficiency,miles\n"
    path = write(tmp_path / "t.csv", head + "EV-1,Model_Y,34.6,11.2,13.0,80.3,3.8,2537.2\nEV-2,Model_Y,,1,1,1,1,1\nEV-3,Model_Y,oops,1,1,1,1,1\n")
    df = telemetry.read_csv(spark, path).cache()
    assert df.count() == 3 and df.filter("engine_temp IS NULL").count() == 2
    assert df.filter("_corrupt_record IS NOT NULL").count() == 1
    assert telemetry.read_csv_with_temperature(spark, path).count() == 1


def test_lake_is_partitioned_and_pruned(spark, tmp_path):
    df = spark.createDataFrame([(f"2024-01-0{i % 3 + 1} 10:00:00", float(i)) for i in range(30)], "t string, engine_temp double")
    tables.write_lake(df.withColumn("event_ts", F.col("t").cast("timestamp")), str(tmp_path / "lake"))
    day = telemetry.read_lake(spark, str(tmp_path / "lake"), "2024-01-02", "2024-01-02")
    assert day.count() == 10
    plan = lineage.explain(with_temperature(day))
    assert "PartitionFilters: [isnotnull(event_date" in plan and "PushedFilters: [IsNotNull(engine_temp)]" in plan


def test_part_files_one_per_task(spark, tmp_path):
    tables.write_parts(spark.range(100).repartition(3), str(tmp_path / "p"))
    assert len(list((tmp_path / "p").glob("part-*"))) == 3


def test_raw_export_by_header_name(spark, tmp_path):
    from odoscore.schemas import RAW_CUSTOMER_COLUMNS
    names = list(reversed(RAW_CUSTOMER_COLUMNS))
    values = dict.fromkeys(names, "No") | {"customerID": "A", "tenure": "3", "Contract": "Two year", "PaymentMethod": "Mailed check",
                                           "MonthlyCharges": "9.5", "TotalCharges": "28.5", "SeniorCitizen": "0", "Churn": "Yes"}
    path = write(tmp_path / "raw.csv", ",".join(names) + "\n" + ",".join(values[n] for n in names) + "\n")
    row = cust.read_raw_export(spark, path).first()
    assert (row["customer_id"], row["contract_type"], row["total_charges"], row["internet_service"]) == ("A", "two_year", 28.5, "none")
    with pytest.raises(ValueError):
        cust.read_raw_export(spark, write(tmp_path / "bad.csv", "customerID\nA\n"))


def test_generator_is_repeatable_and_distributed_as_stated(spark):
    a = cust.generate_customers(spark, 4000, seed=123)
    assert a.columns == SNAPSHOT_COLUMNS
    again = cust.generate_customers(spark, 4000, seed=123).repartition(7)
    assert a.exceptAll(again).isEmpty()
    assert not a.drop("customer_id").exceptAll(cust.generate_customers(spark, 4000, seed=5).drop("customer_id")).isEmpty()
    r = a.agg(
        F.avg((F.col("contract_type") == "month_to_month").cast("int")).alias("m2m"),
        F.avg((F.col("internet_service") == "fiber_optic").cast("int")).alias("fiber"),
        F.avg("senior_citizen").alias("senior"), F.avg("tenure_months").alias("tenure"), F.max("tenure_months").alias("top"),
        F.min("monthly_charges").alias("low"), F.avg("churn").alias("churn"),
        F.avg(F.when(F.col("internet_service") == "dsl", F.col("monthly_charges"))).alias("dsl"),
    ).first()
    assert r["m2m"] == pytest.approx(0.55, abs=0.03) and r["fiber"] == pytest.approx(0.45, abs=0.03)
    assert r["senior"] == pytest.approx(0.16, abs=0.03) and r["tenure"] == pytest.approx(35.5, abs=1.5) and r["top"] == 71
    assert r["low"] >= 15 and r["dsl"] == pytest.approx(55, abs=1) and 0.2 < r["churn"] < 0.45


def snapshot_line(cid, day, charge=20.0, payment="mailed_check"):
    row = {"customer_id": cid, "snapshot_date": day, "tenure_months": 5, "contract_type": "one_year", "payment_method": payment,
           "internet_service": "none", "monthly_charges": charge, "total_charges": 100.0}
    return ",".join(str(row.get(c, 0)) for c in SNAPSHOT_COLUMNS)


def csv_text(*lines, columns=SNAPSHOT_COLUMNS):
    return "\n".join([",".join(columns), *lines]) + "\n"


def test_ingest_end_to_end(spark, tmp_path):
    paths = IngestPaths(*[str(tmp_path / n) for n in ("in", "processed", "log", "quarantine")])
    inbox = tmp_path / "in"
    inbox.mkdir()
    assert ingest(spark, paths, 0, "2024-01-01") is None
    # Repeats inside one file and across files: the last row wins.
    write(inbox / "a.csv", csv_text(snapshot_line("C1", "2024-01-01", 1.0), snapshot_line("C1", "2024-01-01", 2.0),
                                    snapshot_line("C2", "2024-01-01", 3.0)))
    write(inbox / "b.csv", csv_text(snapshot_line("C2", "2024-01-01", 4.0), snapshot_line("C2", "2024-01-02", 5.0)))
    # Exactly half NULL is accepted, more is not; a missing column is not.
    write(inbox / "half.csv", csv_text(snapshot_line("C3", "2024-01-03", 6.0, ""), snapshot_line("C4", "2024-01-03", 7.0)))
    write(inbox / "most.csv", csv_text(snapshot_line("C5", "2024-01-03", 8.0, ""), snapshot_line("C6", "2024-01-03", 8.0, ""),
                                       snapshot_line("C7", "2024-01-03")))
    short = [c for c in SNAPSHOT_COLUMNS if c != "contract_type"]
    write(inbox / "short.csv", csv_text(",".join(["C8", "2024-01-03"] + ["1"] * 17), columns=short))
    # Same columns in another order.
    order = list(reversed(SNAPSHOT_COLUMNS))
    values = dict(zip(SNAPSHOT_COLUMNS, snapshot_line("C9", "2024-01-03", 9.0).split(",")))
    write(inbox / "turned.csv", csv_text(",".join(values[c] for c in order), columns=order))

    entry = {r["file_name"]: r for r in ingest(spark, paths, 1, "2024-01-05").collect()}
    assert {n: r["status"] for n, r in entry.items()} == {
        "a.csv": "accepted", "b.csv": "accepted", "half.csv": "accepted", "most.csv": "rejected", "short.csv": "rejected",
        "turned.csv": "accepted"}
    assert entry["short.csv"]["reason"] == "missing: contract_type" and entry["a.csv"]["n_rows"] == 3

    def table():
        df = cust.read_processed(spark, paths.processed)
        return {(r["customer_id"], str(r["snapshot_date"])): r["monthly_charges"] for r in df.collect()}

    want = {("C1", "2024-01-01"): 2.0, ("C2", "2024-01-01"): 4.0, ("C2", "2024-01-02"): 5.0, ("C3", "2024-01-03"): 6.0,
            ("C4", "2024-01-03"): 7.0, ("C9", "2024-01-03"): 9.0}
    assert table() == want
    assert spark.read.parquet(paths.quarantine).count() == 4
    # Nothing new: nothing happens.
    assert ingest(spark, paths, 2, "2024-01-06") is None
    assert table() == want
    # A new delivery replaces one row and leaves other dates alone.
    untouched = {p.name for p in (tmp_path / "processed" / "snapshot_date=2024-01-02").glob("part-*")}
    write(inbox / "c.csv", csv_text(snapshot_line("C1", "2024-01-01", 10.0), snapshot_line("C10", "2024-01-04", 11.0)))
    ingest(spark, paths, 3, "2024-01-07")
    assert table() == want | {("C1", "2024-01-01"): 10.0, ("C10", "2024-01-04"): 11.0}
    assert {p.name for p in (tmp_path / "processed" / "snapshot_date=2024-01-02").glob("part-*")} == untouched
    summary = {(r["batch_seq"], r["status"]): (r["n_files"], r["table_rows_before"], r["table_rows_after"])
               for r in ingest_summary(spark.read.parquet(paths.log)).collect()}
    assert summary == {(1, "accepted"): (4, 0, 6), (1, "rejected"): (2, 0, 6), (3, "accepted"): (1, 6, 7)}


def folder_paths(tmp_path, **more):
    (tmp_path / "in").mkdir()
    return IngestPaths(*[str(tmp_path / n) for n in ("in", "processed", "log", "quarantine")], **more)


@pytest.mark.parametrize("name", ["a b.csv", "a%20b.csv", "c+d.csv", "ü ß.csv", "e[1]{2}.csv", "100%.csv"])
def test_odd_file_names(spark, tmp_path, name):
    paths = folder_paths(tmp_path)
    write(tmp_path / "in" / name, csv_text(snapshot_line("C1", "2024-01-01")))
    write(tmp_path / "in" / "blank.csv", "\n")
    entry = {r["file_name"]: (r["status"], r["n_rows"]) for r in ingest(spark, paths, 1, "2024-01-05").collect()}
    assert entry == {name: ("accepted", 1), "blank.csv": ("rejected", 0)}
    assert spark.read.parquet(paths.processed).first()["file_name"] == name
    assert ingest(spark, paths, 2, "2024-01-06") is None


def test_a_file_that_comes_again_is_ingested_again(spark, tmp_path):
    paths = folder_paths(tmp_path, archive=str(tmp_path / "done"))
    write(tmp_path / "in" / "a.csv", csv_text(snapshot_line("C1", "2024-01-01", 1.0)))
    ingest(spark, paths, 1, "2024-01-05")
    assert not list((tmp_path / "in").glob("*.csv")) and list((tmp_path / "done" / "1").glob("a.csv"))
    write(tmp_path / "in" / "a.csv", csv_text(snapshot_line("C1", "2024-01-01", 2.0), snapshot_line("C2", "2024-01-01", 3.0)))
    ingest(spark, paths, 2, "2024-01-06")
    table = spark.read.parquet(paths.processed)
    assert {r["customer_id"]: r["monthly_charges"] for r in table.collect()} == {"C1": 2.0, "C2": 3.0}


def test_a_run_that_died_before_the_log_is_repeated(spark, tmp_path, monkeypatch):
    from odoscore.plans import ingest as plan

    paths = folder_paths(tmp_path)
    write(tmp_path / "in" / "a.csv", csv_text(snapshot_line("C1", "2024-01-01"), snapshot_line("C2", "2024-01-01")))
    write(tmp_path / "in" / "bad.csv", csv_text(snapshot_line("C3", "2024-01-01", payment=""), snapshot_line("C4", "2024-01-01", payment="")))

    def die(*_):
        raise OSError("gone")

    with monkeypatch.context() as patched:
        patched.setattr(plan, "append_rows", die)
        with pytest.raises(OSError):
            ingest(spark, paths, 1, "2024-01-05")
    ingest(spark, paths, 1, "2024-01-05")
    assert spark.read.parquet(paths.processed).count() == 2 and spark.read.parquet(paths.quarantine).count() == 2
    log = spark.read.parquet(paths.log).filter("status = 'accepted'").first()
    assert log["table_rows_after"] == 2
    write(tmp_path / "in" / "c.csv", csv_text(snapshot_line("C5", "2024-01-02")))
    ingest(spark, paths, 2, "2024-01-06")
    last = spark.read.parquet(paths.log).filter("batch_seq = 2").first()
    assert (last["table_rows_before"], last["table_rows_after"]) == (2, 3)


def test_text_is_scanned_once_and_copies_are_deleted(spark, tmp_path, monkeypatch):
    import glob

    scans, original = [], landing.landing_lines
    monkeypatch.setattr(landing, "landing_lines", lambda *a: scans.append(1) or original(*a))
    paths = folder_paths(tmp_path)
    write(tmp_path / "in" / "a.csv", csv_text(snapshot_line("C1", "2024-01-01")))
    before = set(glob.glob(f"{shared_root(spark)}/stored-*".removeprefix("file:")))
    ingest(spark, paths, 1, "2024-01-05")
    assert len(scans) == 1 and set(glob.glob(f"{shared_root(spark)}/stored-*".removeprefix("file:"))) == before


def test_rows_without_a_date_are_kept_by_merges(spark, customers):
    old = customers({"customer_id": "N1"}).withColumn("batch_seq", F.lit(1))
    new = customers({"customer_id": "N2"}).withColumn("batch_seq", F.lit(2))
    merged = landing.merge_snapshots(landing.touched_dates(old, new), new, ["batch_seq"])
    assert {r["customer_id"] for r in merged.collect()} == {"N1", "N2"}


def test_merge_reads_only_touched_partitions(spark, customers, tmp_path):
    path = str(tmp_path / "t")
    days = [{"customer_id": f"C{i}", "snapshot_date": datetime.date(2024, 1, 1 + i % 9)} for i in range(90)]
    tables.replace_partitions(customers(*days), path, "snapshot_date")
    new = customers({"snapshot_date": datetime.date(2024, 1, 2)}, {"snapshot_date": datetime.date(2024, 1, 7)})
    touched = landing.touched_dates(spark.read.parquet(path), new)
    assert touched.count() == 20
    plan = lineage.executed_plan(touched)
    assert "dynamicpruning" in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_keep_last_prunes_before_the_shuffle_and_is_idempotent(spark, customers):
    df = customers(*[{"customer_id": "hot", "monthly_charges": float(i)} for i in range(50)]).withColumn("row_pos", F.col("monthly_charges"))
    last = landing.keep_last(df, ["row_pos"])
    plan = lineage.executed_plan(last)
    assert plan.count("WindowGroupLimit") == 2
    assert [r["monthly_charges"] for r in last.collect()] == [49.0]
    assert landing.keep_last(last, ["row_pos"]).exceptAll(last).isEmpty()


def test_registry_json(spark, tmp_path):
    record = {"version": "v1", "promoted_model": "candidate", "trained_at_utc": "2024-01-01T00:00:00+00:00"}
    one = write(tmp_path / "one.json", json.dumps(record))
    many = write(tmp_path / "many.json", json.dumps([record, record | {"version": "v2"}], indent=2))
    broken = write(tmp_path / "broken.json", '[{"version": "v1", ')
    got = [sorted(r["version"] for r in tables.read_registry_json(spark, p).collect()) for p in (one, many, broken)]
    assert got == [["v1"], ["v1", "v2"], []]


def test_latest_entry(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z")], "g string, t int, v string")
    assert tables.latest_entry(df, "t").first()["v"] == "y"
    assert {r["v"] for r in tables.latest_entry(df, "t", ["g"]).collect()} == {"y", "z"}
    assert tables.latest_entry(df.filter("false"), "t").count() == 0
    assert tables.read_or_none(spark, "/nowhere/at/all") is None


def test_iteration_cuts_the_plan(spark):
    start = spark.createDataFrame([(99.0,), (150.0,), (-5.0,)], "engine_temp double")
    trace = lineage.depth_trace(start, cycle_step, 15, 5)
    assert [i for i, _, stored in trace if stored] == [5, 10, 15]
    assert all(depth == 1 for _, depth, stored in trace if stored)
    # Between two stored states the plan grows by one node per step.
    assert [d for _, d, _ in trace[6:10]] == [2, 3, 4, 5]
    results = [sorted(r[0] for r in lineage.iterate(start, cycle_step, 15, k, how).collect())
               for k, how in ((0, "checkpoint"), (5, "checkpoint"), (5, "table"))]
    assert results[0] == results[1] == results[2]
    value = 99.0
    for i in range(1, 16):
        value = value + 0.01 if i % 3 == 0 else (value if value > 100 else value * 1.001) if i % 3 == 1 else value
    assert value in results[0] and len(results[0]) == 2


def test_exchange_count_tells_narrow_from_wide(spark):
    df = spark.range(10)
    assert lineage.count_exchanges(df.filter("id > 1")) == 0
    assert lineage.count_exchanges(df.groupBy((F.col("id") % 3).alias("g")).count()) == 1
    with pytest.raises(ValueError):
        lineage.cut_lineage(df, "other")
