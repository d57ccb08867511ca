"""Digest comparison of tables against counters."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from odoscore.operators.lineage import Scratch
from odoscore.operators.tablediff import diff_tables, digests, differing

SCHEMA = "k long, `a b` string, x double"


def slow(left, right):
    bags, out = (Counter(left), Counter(right)), {}
    for key in {r[0] for r in [*left, *right]}:
        l, r = ({row: n for row, n in bag.items() if row[0] == key} for bag in bags)
        more = sum((Counter(l) - Counter(r)).values()), sum((Counter(r) - Counter(l)).values())
        if any(more):
            out[key] = ("missing" if not r else "added" if not l else "repeated" if set(l) == set(r) else "changed", *more)
    return out


def diff(spark, left, right, **options):
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in (left, right)]
    with Scratch(spark) as scratch:
        found = diff_tables(*frames, ["k"], scratch, **options)
        got = {r["k"]: (r["change"], r["left_more"], r["right_more"]) for r in found.keys.collect()}
        rows = {(r["k"], r["a b"], r["x"]): (r["left_rows"], r["right_rows"]) for r in found.rows.collect()}
    return found, got, rows


@pytest.fixture(scope="module")
def table():
    random.seed(2)
    return [(random.choice([None, *range(200)]) if i % 3 else 7, random.choice([None, "", "u", "v"]), random.choice([None, 1.5, -2.0])) for i in range(3000)]


@pytest.mark.parametrize("options", [{}, {"buckets": 4, "leaves": 3}, {"buckets": 1, "leaves": 1}])
def test_all_kinds_of_differences(spark, table, options):
    """A third of the rows under one key, nulls, repeats; rows lost, changed, repeated and added."""
    right = [r for i, r in enumerate(table) if i % 400] + [(r[0], r[1], 99.0) for r in table[::500]] + table[5:9] + [(900, "n", None), (901, None, None)]
    right = [(*r[:2], 5.0) if i == 77 else r for i, r in enumerate(right)]
    _, got, rows = diff(spark, table, right, **options)
    assert got == slow(table, right)
    l, r = Counter(table), Counter(right)
    assert rows == {row: (l[row], r[row]) for row in l.keys() | r.keys() if l[row] != r[row]}


def test_work_follows_the_differences(spark):
    left = [(i, f"t{i % 9}", float(i % 4)) for i in range(20_000)]
    right = [r for r in left if r[0] != 5000] + [left[42], (-1, "new", None)]
    right[17] = (17, None, 1.0)
    found, got, _ = diff(spark, left, right)
    assert got == {5000: ("missing", 1, 0), 42: ("repeated", 0, 1), -1: ("added", 0, 1), 17: ("changed", 1, 1)}
    assert found.differing_buckets <= 4 and found.differing_leaves <= 4 and found.compared_rows < 30


def test_null_in_another_column_is_a_difference(spark):
    _, got, _ = diff(spark, [(1, "a", None), (2, None, 1.0)], [(1, None, None), (2, None, 1.0)])
    assert got == {1: ("changed", 1, 1)}
    schema = "k long, x string, y string"
    one, other = (spark.createDataFrame([r], schema) for r in [(1, "a", None), (1, None, "a")])
    assert differing(digests(one, ["k"]), digests(other, ["k"])).count() == 1


def test_equal_empty_and_kept_digests(spark, table):
    found, got, _ = diff(spark, table, random.Random(1).sample(table, len(table)))
    assert not got and found.differing_buckets == 0 and found.compared_rows == 0
    assert diff(spark, [], [])[1] == {} and diff(spark, [], table[:5])[1] == slow([], table[:5])
    kept = digests(spark.createDataFrame(table, SCHEMA), ["k"])
    assert diff(spark, table, table[1:], left_digests=kept)[1] == slow(table, table[1:])


def test_refused_tables(spark):
    df = spark.range(3)
    with Scratch(spark) as scratch:
        with pytest.raises(ValueError, match="columns differ"):
            diff_tables(df, df.withColumn("y", F.lit(1)), ["id"], scratch)
        with pytest.raises(ValueError, match="reserved"):
            diff_tables(df.withColumn("_leaf", F.lit(1)), df.withColumn("_leaf", F.lit(1)), ["id"], scratch)
