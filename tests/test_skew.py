import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from odoscore.operators import lineage
from odoscore.operators import aggregate, skew
from odoscore.operators.reconcile import differences, reconcile

AGGS = {
    "avg_v": ("avg", "v"), "n": ("count", "*"), "n_v": ("count", "v"), "sum_v": ("sum", "v"),
    "min_v": ("min", "v"), "max_v": ("max", "v"),
}
# Fixed trace: vehicle, model, odometer miles.
# A published trace and its totals.
TRACE = [
    ("EV-072", "Kona Electric", 2537.2), ("EV-078", "Nexon EV", 11186.0), ("EV-087", "Model Y", 12351.1),
    ("EV-062", "Model 3", 12838.9), ("EV-053", "Kona Electric", 1497.3), ("EV-024", "Model Y", 12255.0),
    ("EV-026", "Nexon EV", 11952.1), ("EV-089", "XUV400", 6733.2), ("EV-085", "Ioniq 5", 8368.5),
    ("EV-080", "Model 3", 12132.2), ("EV-082", "Model 3", 1927.6), ("EV-040", "Kona Electric", 1604.3),
]
TOTALS = {
    "Kona Electric": 5638.8, "Nexon EV": 23138.1, "Model Y": 24606.1, "Model 3": 26898.7, "Ioniq 5": 8368.5, "XUV400": 6733.2,
}


def frame(spark, rows):
    return spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(rows)], "id long, k string, v double")


def direct(df):
    return df.groupBy("k").agg(
        F.avg("v").alias("avg_v"), F.count("*").alias("n"), F.count("v").alias("n_v"), F.sum("v").alias("sum_v"),
        F.min("v").alias("min_v"), F.max("v").alias("max_v"),
    )


def test_traced_totals(spark):
    df = spark.createDataFrame(TRACE, "vehicle_id string, vehicle_model string, miles double")
    got = {r[0]: round(r[1], 1) for r in aggregate.total_by_key(df).collect()}
    assert got == TOTALS


def test_distance_is_max_minus_min_per_vehicle(spark):
    df = spark.createDataFrame(
        [("a", "m", 10.0), ("a", "m", 25.0), ("b", "m", 7.0), ("c", "n", 1.0), ("c", "n", 4.5)],
        "vehicle_id string, vehicle_model string, miles double",
    )
    assert {tuple(r) for r in aggregate.distance_by_key(df).collect()} == {("m", 15.0, 2), ("n", 3.5, 1)}


def test_keys_with_separators_and_nulls_survive_salting(spark):
    df = frame(spark, [("a_b", 1.0), ("a_c", 2.0), ("a_b", 3.0), ("", 4.0), (None, 5.0), (None, None), ("0_a", None)])
    salted = skew.salted_aggregate(df, ["k"], AGGS, ["id"], 4).select("k", *AGGS)
    want = direct(df).select("k", *AGGS)
    assert sorted(map(str, salted.collect())) == sorted(map(str, want.collect()))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(
    st.sampled_from(["a", "a_b", "b", None]), st.one_of(st.none(), st.integers(-1000, 1000).map(float))), max_size=30))
def test_salted_equals_direct(spark, rows):
    df = frame(spark, rows)
    salted = skew.salted_aggregate(df, ["k"], AGGS, ["id"], 3)
    verdict = reconcile(salted, direct(df), ["k"], "avg_v", "avg_v").first()
    assert verdict["matches"]
    assert sorted(map(str, salted.select("k", "n", "n_v", "sum_v").collect())) == sorted(
        map(str, direct(df).select("k", "n", "n_v", "sum_v").collect()))


def test_salted_distinct(spark):
    df = frame(spark, [("a", 1.0), ("a", 1.0), ("a", 2.0), ("b", None), (None, 3.0), (None, 3.0)])
    got = {r[0]: r[1] for r in skew.salted_distinct(df, ["k"], "v").collect()}
    assert got == {"a": 2, "b": 0, None: 1}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    rows = [("hot", float(i)) for i in range(300)] + [(f"k{i % 40}", float(i)) for i in range(200)] + [(None, 1.0)] * 30
    big = frame(spark, rows)
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k39", 4), ("zz", 5), (None, 6)], "k string, w int")
    got = skew.salted_join(big, small, ["k"], ["id"], how, n_partitions=8, min_rows=20)
    want = big.join(small, ["k"], how)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_salted_join_refuses_other_kinds(spark):
    df = frame(spark, [("a", 1.0)])
    with pytest.raises(ValueError):
        skew.salted_join(df, df, ["k"], ["id"], "full_outer")


def test_heavy_keys_have_more_rows_than_a_fair_part(spark):
    df = frame(spark, [("a", 1.0)] * 60 + [("b", 1.0)] * 30 + [(f"c{i}", 1.0) for i in range(10)])
    assert {r[0]: (r[1], r[2]) for r in skew.heavy_keys(df, ["k"], 5, 1).collect()} == {"a": (60, 3), "b": (30, 2)}
    assert skew.heavy_keys(df, ["k"], 5).count() == 0


def test_join_without_hot_keys_is_the_plain_one(spark):
    df = frame(spark, [(f"k{i % 50}", 1.0) for i in range(500)])
    other = df.select("k").distinct()
    assert "_salt" not in lineage.executed_plan(skew.salted_join(df, other, ["k"], ["id"]))


def test_no_task_holds_a_hot_key(spark):
    df = frame(spark, [("hot", float(i)) for i in range(3000)] + [(f"k{i}", 1.0) for i in range(7000)])
    hot = skew.heavy_keys(df, ["k"], 20, 1).first()
    assert (hot["k"], hot["n_salts"]) == ("hot", 6)
    parts = df.filter("k = 'hot'").groupBy(F.pmod(F.xxhash64("id"), F.lit(6))).count().collect()
    assert max(r[1] for r in parts) < 1.3 * 500


@pytest.mark.parametrize("seed", [1, 2])
def test_no_key_above_the_bound_is_missed(spark, seed):
    """Zipf counts over many keys, rows of very different widths."""
    rows = spark.range(200_000).select(
        F.floor(F.pow(F.rand(seed), F.lit(-0.9))).cast("long").alias("k"), F.expr("repeat('x', cast(rand(7) * 40 AS int) * int(id % 11 = 0))").alias("t"), "id"
    )
    df = lineage.cut_lineage(rows.withColumn("t", F.when(F.col("k") == 23, F.repeat(F.lit("wide"), 9000)).otherwise(F.col("t"))), "table")
    for partitions in (6, 40, 300):
        exact = {r["k"]: r["n"] for r in df.groupBy("k").agg(F.count("*").alias("n")).filter(F.col("n") > 200_000 / partitions).collect()}
        assert exact == {r["k"]: r["n_rows"] for r in skew.heavy_keys(df, ["k"], partitions, 1).collect()}
    units = F.ceil(skew.row_bytes(df) / skew.UNIT_BYTES)
    total = df.agg(F.sum(units)).first()[0]
    heavy = {r["k"] for r in df.groupBy("k").agg(F.sum(units).alias("u")).filter(F.col("u") > total / 20).collect()}
    found = {r["k"]: r["n_salts"] for r in skew.heavy_keys(df, ["k"], 20, min_bytes=1).collect()}
    # Few rows, but wide ones: hot by bytes, not by rows.
    assert set(found) == heavy and 23 in found and 23 not in {r["k"] for r in skew.heavy_keys(df, ["k"], 20, 1).collect()}


def test_a_wide_key_is_salted(spark):
    df = frame(spark, [(f"k{i % 500}", float(i)) for i in range(3000)]).withColumn("t", F.when(F.col("k") == "k7", F.repeat(F.lit("wide"), 9000)))
    small = df.select("k").distinct()
    joined = skew.salted_join(df, small, ["k"], ["id"], n_partitions=8, min_bytes=10_000)
    assert "_salt" in lineage.executed_plan(joined) and joined.count() == 3000
    assert "_salt" not in lineage.executed_plan(skew.salted_join(df, small, ["k"], ["id"], n_partitions=8))


def test_amplify_counts_and_skew(spark):
    df = frame(spark, [("a", 1.0)] * 3 + [("b", 1.0)] * 2 + [("c", 1.0)])
    grown = skew.amplify_top_key(df, "k", 180)
    assert {r[0]: r[1] for r in aggregate.counts_by_key(grown, "k").collect()} == {"a": 543, "b": 2, "c": 1}
    assert grown.filter("k = 'a'").select("id", "copy_no").distinct().count() == 543
    assert aggregate.skew_ratio(grown, "k").first()["skew_ratio"] == 543.0


def test_shares_and_top_key_ties(spark):
    df = frame(spark, [("b", 1.0), ("a", 1.0), ("c", 1.0), ("c", 1.0), ("b", 1.0)])
    shares = {r["k"]: r["pct_of_total"] for r in aggregate.with_share(aggregate.counts_by_key(df, "k")).collect()}
    assert shares == {"a": 20.0, "b": 40.0, "c": 40.0}
    assert aggregate.top_keys(df, "k").first()["k"] == "b"


def test_salting_spreads_the_input(spark):
    df = frame(spark, [("hot", float(i)) for i in range(4000)] + [("cold", 1.0)] * 10)
    balance = {r["k"]: r for r in skew.key_balance(df, "k", ["id"], 8).collect()}
    assert balance["hot"]["n_rows"] == 4000 and balance["hot"]["n_salts"] == 8 and balance["hot"]["largest_part"] < 650
    sizes = [r["n_rows"] for r in skew.partition_sizes(df.repartition(5)).collect()]
    assert len(sizes) == 5 and sum(sizes) == 4010


def test_reconcile_fails_on_missing_key_null_and_difference(spark):
    left = spark.createDataFrame([("a", 1.0), ("b", 2.0), (None, 3.0)], "k string, x double")
    same = reconcile(left, left, ["k"], "x", "x").first()
    assert same["matches"] and same["n_keys"] == 3 and same["max_abs_diff"] == 0.0
    assert not reconcile(left, left.filter("k = 'a'"), ["k"], "x", "x").first()["matches"]
    assert not reconcile(left, left.withColumn("x", F.col("x") + 1e-3), ["k"], "x", "x").first()["matches"]
    holes = left.withColumn("x", F.when(F.col("k") == "a", F.col("x")))
    assert reconcile(left, holes, ["k"], "x", "x").first()["n_unmatched"] == 2
    assert differences(left, left, ["k"], "x", "x").count() == 3


def test_profile(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("c", None)], "vehicle_model string, engine_temp double")
    assert tuple(aggregate.profile(df).first()) == (4, 2, 2, 2)
