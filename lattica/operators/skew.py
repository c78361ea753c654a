"""Per-key work without hot tasks: fragment-replicate by estimated load.

The load of every key is estimated from two narrow, map-side combined scans: rows per hash bucket, then rows per key
inside the few buckets that exceed a fair share. Keys above the fair share of a task are cut into proportionate shards;
all other keys stay whole inside their bucket. Buckets and shards are bin-packed onto tasks (largest first onto the
least loaded task). Rows of the fragmented side travel to the task of their bucket or shard; the matching side is
replicated to the shards of split keys only.

There are at least BUCKETS_PER_TASK hash buckets per task, so that the whole keys of any number of rows spread over all
tasks. The driver sees a number per bucket and at most `tasks * split_below` keys, whatever the number of rows or keys.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lattica.session import INTERNAL

KEY, TASK, SHARDS, SALT, BUCKET = (f"{INTERNAL}{x}" for x in ("key", "task", "shards", "salt", "bucket"))

#: Hash buckets of whole keys: at least so many, and so many per task.
LEAST_BUCKETS, BUCKETS_PER_TASK = 1024, 16


@dataclass
class LoadPlan:
    """Where the rows of each key go.

    bucket_task: task of each hash bucket of unsplit keys. heavy: key -> tasks of its shards (key None is the null key).
    loads: planned rows per task. total: all rows, null keys included. key_rows: rows of each heavy key.
    """

    tasks: int
    bucket_task: list[int]
    heavy: dict[str | None, list[int]] = field(default_factory=dict)
    loads: list[float] = field(default_factory=list)
    total: int = 0
    key_rows: dict[str | None, int] = field(default_factory=dict)


def default_tasks(spark: SparkSession, rows: int, rows_per_task: int = 1_000_000) -> int:
    return max(spark.sparkContext.defaultParallelism, math.ceil(rows / rows_per_task), 1)


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def estimate_load(df: DataFrame, key: Column, tasks: int | None = None, buckets: int | None = None, split_below: int = 4) -> LoadPlan:
    """Plan the tasks for df keyed by `key` (cast to string; null is a key of its own).

    A key is split when it has more than 1/split_below of a task's fair share of rows. An empty df gives an empty plan.
    The number of tasks and buckets follows the number of rows (of a table, a count of its footers).
    """
    tasks = tasks or default_tasks(df.sparkSession, df.count())
    buckets = buckets or max(LEAST_BUCKETS, BUCKETS_PER_TASK * tasks)
    keyed = df.select(key.cast("string").alias(KEY))
    weights = [0] * buckets
    for bucket, n in keyed.groupBy(_bucket(F.col(KEY), buckets).alias("b")).agg(F.count(F.lit(1))).collect():
        weights[bucket] = n
    total = sum(weights)
    fair = max(1.0, total / tasks)
    limit = max(2.0, fair / split_below)
    suspects = [b for b, n in enumerate(weights) if n > limit]
    key_rows: dict[str | None, int] = {}
    if suspects:
        inside = keyed.where(_bucket(F.col(KEY), buckets).isin(suspects)) if len(suspects) < buckets // 2 else keyed
        found = inside.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
        key_rows = {k: n for k, n in found.collect()}  # fewer than total / limit = tasks * split_below keys
    bucket_of = _hash_bucket(df.sparkSession, list(key_rows), buckets) if key_rows else {}
    return pack(weights, key_rows, tasks, fair, bucket_of.__getitem__, total)


def _hash_bucket(spark: SparkSession, keys: list[str | None], buckets: int) -> dict[str | None, int]:
    rows = spark.createDataFrame([(k,) for k in keys], f"`{KEY}` string").select(KEY, _bucket(F.col(KEY), buckets))
    return {k: b for k, b in rows.collect()}


def pack(weights: Sequence[int], key_rows: dict[str | None, int], tasks: int, fair: float, bucket_of, total: int) -> LoadPlan:
    """Bin-pack buckets of whole keys and shards of split keys onto tasks: largest first, onto the least loaded task."""
    rest = list(weights)
    buckets_of = {k: bucket_of(k) for k in key_rows} if key_rows else {}
    for k, n in key_rows.items():
        rest[buckets_of[k]] -= n
    items: list[tuple[float, int, object]] = [(float(n), 0, b) for b, n in enumerate(rest)]
    for k, n in key_rows.items():
        shards = min(tasks, max(1, math.ceil(n / (fair / 2))))
        items += [(n / shards, 1 + s, k) for s in range(shards)]
    items.sort(key=lambda x: (-x[0], x[1], str(x[2])))
    heap = [(0.0, t) for t in range(tasks)]
    plan = LoadPlan(tasks, [0] * len(rest), total=total, key_rows=dict(key_rows))
    loads = [0.0] * tasks
    for load, shard, what in items:
        spare: list[tuple[float, int]] = []
        at, t = heapq.heappop(heap)
        if shard:
            held = plan.heavy.setdefault(what, [])  # type: ignore[arg-type]
            while t in held and heap:  # two shards of a key on one task would be one larger shard
                spare.append((at, t))
                at, t = heapq.heappop(heap)
            held.append(t)
        else:
            plan.bucket_task[what] = t  # type: ignore[index]
        loads[t] = at + load
        heapq.heappush(heap, (at + load, t))
        for x in spare:
            heapq.heappush(heap, x)
    plan.loads = loads
    return plan


def _heavy_table(spark: SparkSession, plan: LoadPlan) -> DataFrame:
    """Shards of split keys: at most tasks * split_below rows, so it may be broadcast."""
    schema = T.StructType([T.StructField(f"{KEY}_h", T.StringType()), T.StructField(SHARDS, T.ArrayType(T.IntegerType()))])
    return spark.createDataFrame(list(plan.heavy.items()), schema)


def _bucket_table(spark: SparkSession, plan: LoadPlan) -> DataFrame:
    """Task of each bucket: BUCKETS_PER_TASK rows of two numbers per task, so it may be broadcast."""
    tasks = pa.table({BUCKET: pa.array(range(len(plan.bucket_task)), pa.int32()), f"{TASK}_b": pa.array(plan.bucket_task, pa.int32())})
    return F.broadcast(spark.createDataFrame(tasks))


def _salt(df: DataFrame, by: Sequence[Column] | None) -> Column:
    """What chooses the shard of a row: the columns given, else all columns and the place of reading.

    Both give the same shard when a task is run again after an executor is lost.
    """
    if by:
        return F.xxhash64(*by)
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not _unhashable(f.dataType)]
    return F.xxhash64(*plain, F.spark_partition_id())


def _unhashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_unhashable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _unhashable(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))


def fragment(df: DataFrame, key: Column, plan: LoadPlan, salt_by: Sequence[Column] | None = None) -> DataFrame:
    """df with its rows on the planned tasks; adds the columns KEY (string) and TASK."""
    spark = df.sparkSession
    salted = df.withColumns({KEY: key.cast("string"), SALT: _salt(df, salt_by)}).withColumn(BUCKET, _bucket(F.col(KEY), len(plan.bucket_task)))
    light = salted.join(_bucket_table(spark, plan), BUCKET)
    if plan.heavy:
        joined = light.join(F.broadcast(_heavy_table(spark, plan)), F.col(KEY).eqNullSafe(F.col(f"{KEY}_h")), "left")
        shard = F.get(SHARDS, F.pmod(F.col(SALT), F.size(SHARDS).cast("bigint")).cast("int"))
        placed = joined.withColumn(TASK, F.coalesce(shard, f"{TASK}_b")).drop(f"{KEY}_h", SHARDS)
    else:
        placed = light.withColumn(TASK, F.col(f"{TASK}_b"))
    return placed.drop(SALT, BUCKET, f"{TASK}_b").repartitionById(plan.tasks, F.col(TASK))


def replicate(df: DataFrame, key: Column, plan: LoadPlan) -> DataFrame:
    """The matching side: one copy of a row for each shard of a split key, a single copy for all others."""
    spark = df.sparkSession
    keyed = df.withColumn(KEY, key.cast("string")).withColumn(BUCKET, _bucket(F.col(KEY), len(plan.bucket_task))).join(_bucket_table(spark, plan), BUCKET)
    if plan.heavy:
        joined = keyed.join(F.broadcast(_heavy_table(spark, plan)), F.col(KEY).eqNullSafe(F.col(f"{KEY}_h")), "left").drop(f"{KEY}_h")
        keyed = joined.withColumn(TASK, F.explode(F.coalesce(F.col(SHARDS), F.array(f"{TASK}_b")))).drop(SHARDS)
    else:
        keyed = keyed.withColumn(TASK, F.col(f"{TASK}_b"))
    return keyed.drop(BUCKET, f"{TASK}_b").repartitionById(plan.tasks, F.col(TASK))


def balanced_aggregate(
    df: DataFrame,
    key: Column,
    partial: dict[str, Column],
    final: dict[str, Column],
    plan: LoadPlan | None = None,
    salt_by: Sequence[Column] | None = None,
    name: str = "key",
) -> DataFrame:
    """One row per key: `partial` aggregates run per task, `final` aggregates merge the shards of split keys.

    partial and final map output columns to aggregate Columns; final refers to the columns of partial. With salt_by, all
    rows equal in those columns meet in one shard, so distinct counts over them may be summed. Null keys form one row.
    Ties and repeated rows are left to the aggregates. An empty df gives no rows.
    """
    plan = plan or estimate_load(df, key)
    parts = fragment(df, key, plan, salt_by).groupBy(KEY, TASK).agg(*(c.alias(k) for k, c in partial.items()))
    return parts.groupBy(F.col(KEY).alias(name)).agg(*(c.alias(k) for k, c in final.items()))


def fragment_join(
    left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, how: str = "inner", plan: LoadPlan | None = None, salt_by: Sequence[Column] | None = None
) -> DataFrame:
    """left joined with right on equal keys; left is fragmented, right replicated to the shards of split keys.

    how: inner, left, left_semi or left_anti (a right or full join would count replicated rows once per shard). Null keys
    match nothing. Columns of equal name on both sides are all kept, as in any join on a condition.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"fragment_join cannot do a {how} join")
    plan = plan or estimate_load(left, left_key)
    a = fragment(left, left_key, plan, salt_by).withColumnsRenamed({KEY: f"{KEY}_l", TASK: f"{TASK}_l"})
    b = replicate(right, right_key, plan).withColumnsRenamed({KEY: f"{KEY}_r", TASK: f"{TASK}_r"})
    on = (F.col(f"{TASK}_l") == F.col(f"{TASK}_r")) & (F.col(f"{KEY}_l") == F.col(f"{KEY}_r"))
    return a.join(b, on, how).drop(f"{KEY}_l", f"{TASK}_l", f"{KEY}_r", f"{TASK}_r")


def heavy_hitters(df: DataFrame, key: Column, share: float, plan: LoadPlan | None = None, salt_by: Sequence[Column] | None = None, name: str = "key") -> DataFrame:
    """Keys that hold at least `share` of all rows (null keys count in the total but are not reported): key, n."""
    plan = plan or estimate_load(df, key)
    counts = balanced_aggregate(df, key, {"n": F.count(F.lit(1))}, {"n": F.sum("n")}, plan, salt_by, name)
    return counts.where(F.col(name).isNotNull() & (F.col("n") >= F.lit(share * plan.total)))
