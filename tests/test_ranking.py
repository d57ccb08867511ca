import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from odoscore.operators import ranking
from odoscore.operators.lineage import executed_plan


def md5(seed, key):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()


def test_batches_are_near_equal_and_in_hash_order(spark):
    df = spark.range(7043).select(F.concat(F.lit("C"), F.col("id")).alias("customer_id"))
    rows = ranking.stage_batches(df, "customer_id", 10).collect()
    order = sorted((r["customer_id"] for r in rows), key=lambda k: md5(42, k))
    sizes = [705] * 3 + [704] * 7
    want, at = {}, 0
    for day, size in enumerate(sizes, start=1):
        want |= {k: f"2024-01-{day:02d}" for k in order[at:at + size]}
        at += size
    assert {r["customer_id"]: str(r["snapshot_date"]) for r in rows} == want


@pytest.mark.parametrize("n_rows,n_batches", [(0, 3), (1, 3), (2, 3), (3, 3), (5, 1)])
def test_few_rows_many_batches(spark, n_rows, n_batches):
    df = spark.range(n_rows).withColumnRenamed("id", "customer_id")
    rows = ranking.stage_batches(df, "customer_id", n_batches).groupBy("snapshot_date").count().collect()
    assert sum(r["count"] for r in rows) == n_rows
    assert all(r["count"] <= -(-n_rows // n_batches) for r in rows)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(labels=st.lists(st.sampled_from([0, 0, 0, 1, None]), min_size=1, max_size=60))
def test_split_is_complete_disjoint_and_sized(spark, labels):
    df = spark.createDataFrame(list(enumerate(labels)), "customer_id long, churn int")
    rows = ranking.stratified_split(df).collect()
    assert sorted(r["customer_id"] for r in rows) == list(range(len(labels)))
    n = sum(label is not None for label in labels)
    held = -(-round(n * 0.3 * 1e9) // 10**9)
    test = -(-held // 2)
    count = {s: sum(r["split"] == s for r in rows) for s in ("train", "validation", "test")}
    assert count == {"train": n - held, "validation": held - test, "test": test}
    assert all((r["split"] is None) == (r["churn"] is None) for r in rows)


def test_published_split_sizes(spark):
    # 7,043 rows with 1,869 positives: 4930 / 1056 / 1057.
    df = spark.range(7043).select(F.col("id").alias("customer_id"), (F.col("id") < 1869).cast("int").alias("churn"))
    counts = {r[0]: (r[1], r[2]) for r in ranking.stratified_split(df).groupBy("split").agg(
        F.count("*"), F.sum("churn")).collect()}
    assert {k: v[0] for k, v in counts.items()} == {"train": 4930, "validation": 1056, "test": 1057}
    assert counts["validation"][1] in (280, 281) and counts["train"][1] in (1308, 1309)


def test_copies_of_a_key_stay_together(spark):
    df = spark.range(900).select(
        F.when(F.col("id") < 300, 0).otherwise(F.col("id")).alias("customer_id"), F.lit(1).alias("churn"))
    rows = ranking.stratified_split(df).filter("customer_id = 0").select("split").distinct().collect()
    assert len(rows) == 1 and rows[0]["split"] is not None


def test_rows_are_not_shuffled_by_the_split(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select(F.col("id").alias("customer_id"), (F.col("id") % 3 == 0).cast("int").alias("churn")).write.parquet(path)
    plan = executed_plan(ranking.stratified_split(spark.read.parquet(path)))
    main = plan.split("Subquery")[0]
    assert "Exchange" not in main and "Join" not in main


def test_rows_without_a_key_still_get_a_part(spark):
    df = spark.createDataFrame([(None, 1)] + [(i, 1) for i in range(20)], "customer_id long, churn int")
    rows = ranking.stratified_split(df).collect()
    assert len(rows) == 21 and all(r["split"] for r in rows)


def test_shuffled_is_a_permutation(spark):
    rows = [r[0] for r in ranking.shuffled(spark.range(50), "id", 7).collect()]
    assert rows == sorted(range(50), key=lambda k: md5(7, k))
