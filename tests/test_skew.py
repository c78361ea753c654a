from collections import Counter

import pytest
from pyspark.sql import functions as F

from lattica.operators.skew import balanced_aggregate, estimate_load, fragment, fragment_join, heavy_hitters, pack

KEYS = ["hot"] * 600 + ["warm"] * 120 + [f"k{i}" for i in range(200)] + [None] * 80


@pytest.fixture(scope="module")
def rows(spark):
    # the names of two columns look like the operator's own words
    return spark.createDataFrame([(k, i, i % 7) for i, k in enumerate(KEYS)], "key string, task int, n int").repartition(6)


def test_loads_are_even_and_complete(rows):
    plan = estimate_load(rows, F.col("key"), tasks=8)
    assert plan.total == len(KEYS)
    assert round(sum(plan.loads)) == len(KEYS)
    assert max(plan.loads) < 1.5 * len(KEYS) / 8
    assert len(plan.heavy["hot"]) > 1 and len(set(plan.heavy["hot"])) == len(plan.heavy["hot"])
    placed = fragment(rows, F.col("key"), plan).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in placed) == len(KEYS)
    assert max(r["count"] for r in placed) < 2 * len(KEYS) / 8


def test_one_key_with_all_rows(spark):
    df = spark.createDataFrame([("x", i) for i in range(400)], "key string, v int").repartition(5)
    plan = estimate_load(df, F.col("key"), tasks=4)
    assert len(plan.heavy["x"]) == 4
    got = balanced_aggregate(df, F.col("key"), {"n": F.count(F.lit(1)), "m": F.max("v")}, {"n": F.sum("n"), "m": F.max("m")}, plan).collect()
    assert [tuple(r) for r in got] == [("x", 400, 399)]


def test_aggregate_equals_plain_group(rows):
    got = balanced_aggregate(rows, F.col("key"), {"c": F.count(F.lit(1)), "d": F.countDistinct("n")}, {"c": F.sum("c"), "d": F.sum("d")}, salt_by=[F.col("n")]).collect()
    want = rows.groupBy("key").agg(F.count(F.lit(1)), F.countDistinct("n")).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, want))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_equals_plain_join(spark, rows, how):
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k3", 3), (None, 4), ("other", 5)], "rk string, w int")
    got = fragment_join(rows, right, F.col("key"), F.col("rk"), how).collect()
    want = rows.join(right, F.col("key") == F.col("rk"), how).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, want))


def test_other_joins_are_refused(rows):
    with pytest.raises(ValueError):
        fragment_join(rows, rows, F.col("key"), F.col("key"), "full")


def test_heavy_hitters_count_nulls_in_the_total(rows):
    got = {r["key"]: r["n"] for r in heavy_hitters(rows, F.col("key"), 0.1).collect()}
    assert got == {"hot": 600, "warm": 120}
    assert heavy_hitters(rows, F.col("key"), 0.13).count() == 1


def test_empty_table(spark):
    empty = spark.createDataFrame([], "key string, v int")
    assert heavy_hitters(empty, F.col("key"), 0.1).collect() == []
    assert fragment_join(empty, empty.withColumnRenamed("key", "r"), F.col("key"), F.col("r")).collect() == []


def test_pack_puts_the_largest_first():
    plan = pack([10, 10, 10, 10], {}, 2, 20, lambda k: 0, 40)
    assert sorted(plan.loads) == [20, 20]


def test_whole_keys_of_very_many_rows_use_all_tasks(spark):
    from lattica.operators import skew

    rows, tasks = 10_000_000_000, 10_000
    assert skew.default_tasks(spark, rows) == tasks
    buckets = max(skew.LEAST_BUCKETS, skew.BUCKETS_PER_TASK * tasks)
    plan = pack([rows // buckets] * buckets, {}, tasks, rows / tasks, None, rows)
    assert len(set(plan.bucket_task)) == tasks and max(plan.loads) < 1.5 * rows / tasks
