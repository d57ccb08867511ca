"""Records of files read in splits, against a parse of the whole file."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from odoscore.operators.lineage import Scratch
from odoscore.plans.ingest import IngestPaths, ingest
from odoscore.schemas import SNAPSHOT_COLUMNS
from odoscore.sources import landing
from odoscore.sources.records import CSV_OPTIONS, open_after, records

BREAKS = ["\n", "\r\n", "\r"]


def whole_file(text):
    """Records as texts and whether the last one is unclosed, by one pass over the characters."""
    out, now, state, i = [], "", "start", 0
    while i < len(text):
        c = text[i]
        if state == "quoted":
            if c == '"' and text[i + 1: i + 2] == '"':
                now, i = now + '""', i + 2
                continue
            state = "plain" if c == '"' else "quoted"
        elif c in "\r\n":
            i += 2 if text[i: i + 2] == "\r\n" else 1
            out, now, state = [*out, now], "", "start"
            continue
        elif c == ",":
            state = "start"
        else:
            state = "quoted" if c == '"' and state == "start" else "plain"
        now, i = now + c, i + 1
    return (out + [now] if now else out), state == "quoted"


def read(spark, path, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        with Scratch(spark) as scratch:
            lines = scratch.store(landing.landing_lines(spark, [str(path)]))
            assert split > 10_000 or lines.select("split_start").distinct().count() > 1
            return sorted(records(lines, scratch.store).collect(), key=lambda r: (r["split_start"], r["row_pos"]))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def some_file(seed, n, tame):
    random.seed(seed)
    brk = random.choice(BREAKS)

    def value():
        kind = random.random()
        if kind < 0.35:
            inner = "".join(random.choice(["x", ",", '""', "\n", "\r\n", "word ", "é", '"",', "\n\n"]) for _ in range(random.randint(0, 9)))
            return f'"{inner}"'
        if kind < 0.45 and not tame:
            return random.choice(['5" disk', 'a""b', 'x"', '"q"rest', '"q"r"s'])
        return random.choice(["", "1", "plain", "two words"])

    return "".join(",".join(value() for _ in range(3)) + brk for _ in range(n))


@pytest.mark.parametrize("seed, split", [(0, 23), (1, 37), (2, 150), (3, 60)])
def test_any_split_gives_the_records_of_the_whole_file(spark, tmp_path, seed, split):
    text = some_file(seed, 30, tame=seed % 2 == 0)
    path = tmp_path / "f.csv"
    path.write_bytes(text.encode())
    want, unclosed = whole_file(text)
    got = read(spark, path, split)
    assert not unclosed and not any(r["unclosed"] for r in got)
    blank = lambda v: v.strip("\r\n") != ""  # noqa: E731  blank lines are no records
    assert [r["value"] for r in got if blank(r["value"])] == [v for v in want if blank(v)]


def test_fields_of_a_large_file_equal_another_parser(spark, tmp_path):
    """Megabyte splits through quoted breaks."""
    text = some_file(11, 90_000, tame=True).replace("\r\n", "\n").replace("\r", "\n")
    path = tmp_path / "f.csv"
    path.write_bytes(text.encode())
    assert len(text) > 1_500_000
    got = read(spark, path, 400_000)
    df = spark.createDataFrame([(i, r["value"]) for i, r in enumerate(got) if r["value"]], "i long, value string")
    parsed = df.select("i", F.from_csv("value", "a string, b string, c string", CSV_OPTIONS).alias("r")).orderBy("i").collect()
    want = [row for row in csv.reader(io.StringIO(text, newline="")) if row]
    assert [[r["r"][c] or "" for c in "abc"] for r in parsed] == want


def test_a_line_as_a_function(spark):
    lines = ['a,b', '"a', 'a"', '"a"', '"a""', '"a"""', 'x,"y', 'x",y', '"a","b', '","', '""', '"', 'a"b', '"a"b"', 'a,"b"c,"d']
    df = spark.createDataFrame([(x,) for x in lines], "v string").select("v", open_after("v", False).alias("o"), open_after("v", True).alias("i"))
    for r in df.collect():
        assert r["o"] == whole_file(r["v"])[1], r
        assert r["i"] == whole_file('"' + r["v"])[1], r


def test_an_unclosed_quote_is_told_and_not_gathered(spark, tmp_path):
    text = 'a,b\n1,"x\ny"\n2,"open\n' + "3,z\n" * 100
    path = tmp_path / "f.csv"
    path.write_text(text)
    got = read(spark, path, 64)
    assert [r["value"] for r in got[:3]] == ["a,b", '1,"x\ny"', '2,"open']
    assert [r["unclosed"] for r in got] == [False, False] + [True] * 101


def snapshot(cid, charge, note):
    row = {"customer_id": cid, "snapshot_date": "2024-01-01", "tenure_months": 5, "contract_type": "one_year", "payment_method": "mailed_check",
           "internet_service": "none", "monthly_charges": charge, "total_charges": 100.0}
    return [note, *[row.get(c, 0) for c in SNAPSHOT_COLUMNS]]


def test_ingest_of_quoted_breaks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    paths = IngestPaths(*[str(tmp_path / n) for n in ("in", "processed", "log", "quarantine")])
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\r\n")
    writer.writerow(["note, free\ntext", *SNAPSHOT_COLUMNS])
    writer.writerows([snapshot("C\n1", 1.0, 'said "yes",\nthen no'), snapshot("C2", 2.0, ""), snapshot('C"3', 3.0, "\n\n")])
    (tmp_path / "in" / "quoted.csv").write_bytes(("﻿" + out.getvalue()).encode())
    plain = ",".join(SNAPSHOT_COLUMNS) + "\n"
    (tmp_path / "in" / "open.csv").write_text(plain + ",".join(map(str, snapshot("C4", 4.0, "")[1:])) + '\n"C5,2024-01-01\n')
    (tmp_path / "in" / "plain.csv").write_text(plain + ",".join(map(str, snapshot("C6", 6.0, "")[1:])) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "90")
    try:
        entry = {r["file_name"]: (r["status"], r["n_rows"], r["reason"]) for r in ingest(spark, paths, 1, "2024-01-05").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert entry == {"quoted.csv": ("accepted", 3, None), "open.csv": ("rejected", 2, "unclosed quote"), "plain.csv": ("accepted", 1, None)}
    table = {r["customer_id"]: r["monthly_charges"] for r in spark.read.parquet(paths.processed).collect()}
    assert table == {"C\n1": 1.0, "C2": 2.0, 'C"3': 3.0, "C6": 6.0}
    assert spark.read.parquet(paths.quarantine).count() == 2
