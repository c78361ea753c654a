import random

import pytest
from pyspark.sql import functions as F

from lattica.llm import topn


def brute(rows, n):
    best = {}
    for g, i, s in rows:
        if g is None or i is None or s is None or s != s:
            continue
        best.setdefault(g, {})[i] = max(best.get(g, {}).get(i, -9e9), s)
    return sorted((g, i, k + 1) for g, items in best.items() for k, (i, _) in enumerate(sorted(items.items(), key=lambda x: (-x[1], x[0]))[:n]))


def run(df, n):
    return sorted((r["group_id"], r["item_id"], r["rank_no"]) for r in topn.top_per_group(df, F.col("g"), F.col("i"), F.col("s"), n).collect())


def test_equals_brute_force_with_ties_nulls_and_copies(spark):
    rng = random.Random(8)
    rows = [("big", f"i{rng.randrange(400)}", rng.choice([0.1, 0.5, 0.5, 0.9, -0.0, 0.0, None, float("nan")])) for _ in range(3000)]
    rows += [(rng.choice(["a", "b", "é", None]), rng.choice(["x", "y", "Z", "ü", None]), rng.random()) for _ in range(300)]
    rows += rows[:50] + [("", "", 1.0)]
    df = spark.createDataFrame([(*r, "other") for r in rows], "g string, i string, s double, rank_no string").repartition(5)
    for n in (1, 5):
        assert run(df, n) == brute(rows, n)


def test_row_groups_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(topn, "ROW_GROUP_BYTES", 4096)
    rows = [("one", f"item {k:06d} {'x' * 20}", float(k)) for k in range(20000)]
    path = topn.cluster(spark.createDataFrame(rows, "g string, i string, s double").coalesce(1), 3)
    assert len(spark.read.parquet(path).inputFiles()) == 3
    done = {"read": 0, "skipped": 0}
    for f in spark.read.parquet(path).inputFiles():
        _, x = topn.read_guided(f, 5)
        done = {k: done[k] + x[k] for k in done}
    assert done["skipped"] > done["read"] > 0
    assert run(spark.createDataFrame(rows, "g string, i string, s double"), 2) == brute(rows, 2)


def test_files_follow_the_rows():
    assert [topn.number_of_files(n, 12) for n in (0, 99, 250_000, 3_000_000, 10**11)] == [1, 1, 2, 12, 25_000]


def test_empty_table(spark):
    assert run(spark.createDataFrame([], "g string, i string, s double"), 3) == []


@pytest.mark.parametrize("n", [3])
def test_fewer_items_than_n(spark, n):
    assert run(spark.createDataFrame([("g", "a", 1.0), ("g", "a", 2.0)], "g string, i string, s double"), n) == [("g", "a", 1)]
