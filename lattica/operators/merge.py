"""Keyed upserts: a batch replaces the properties it has, keeps those it lacks, and removes those it gives as null.

A batch is a DataFrame; the columns it has are the properties it writes. Batches carry an order column, and for every
property the value of the highest order among the batches that have the property wins. Of all rows of a key from batches
with the same properties only the last one counts, and it is chosen before the shuffle as well (a group limit of 1), so
hot keys cost no more than others; a second step over one row per kind of batch puts the properties together.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lattica.session import INTERNAL

KIND, SEQ, LAST = f"{INTERNAL}kind", f"{INTERNAL}seq", f"{INTERNAL}last"


def _marked(batch: DataFrame, keys: Sequence[str], schema: T.StructType, order: str | None, kind: T.DataType | None, rank: int, number: int) -> DataFrame:
    """The batch with all columns of the schema, the number of its kind, and (rank, order) as its place in time."""
    at = F.col(f"`{order}`") if order and order in batch.columns else F.lit(None)
    place = F.struct(F.lit(rank).alias("rank"), at.cast(kind or T.LongType()).alias("at"))
    columns = [F.col(f"`{k}`") for k in keys]
    for f in schema.fields:
        if f.name not in keys:
            columns.append((F.col(f"`{f.name}`") if f.name in batch.columns else F.lit(None)).cast(f.dataType).alias(f.name))
    return batch.select(*columns, F.lit(number).alias(KIND), place.alias(SEQ))


def merge(current: DataFrame | None, batches: Sequence[DataFrame], keys: Sequence[str], schema: T.StructType, order: str | None = None) -> DataFrame:
    """current with the batches merged in, the later batch last; inside a batch the row with the highest `order` (any type that sorts) wins.

    Rows with a null key are left out. Rows of equal order and key must be equal, else one of them wins. An empty batch
    changes nothing; merging a batch twice gives the same as once.
    """
    parts = ([] if current is None else [current.select(*(f.name for f in schema.fields))]) + list(batches)
    first = 0 if current is None else -1
    properties = [f.name for f in schema.fields if f.name not in keys]
    on = [F.col(f"`{k}`") for k in keys]
    kinds: dict[frozenset[str], int] = {}
    for p in parts:
        kinds.setdefault(frozenset(p.columns) & frozenset(properties), len(kinds))
    time = next((b.schema[order].dataType for b in batches if order and order in b.columns), None)
    marked = [_marked(p, keys, schema, order if i + first >= 0 else None, time, i + first, kinds[frozenset(p.columns) & frozenset(properties)]) for i, p in enumerate(parts)]
    rows = reduce(DataFrame.unionByName, marked).where(reduce(lambda a, b: a & b, (k.isNotNull() for k in on)))
    if not properties:
        return rows.select(*on).distinct()
    latest = Window.partitionBy(*on, F.col(KIND)).orderBy(F.col(SEQ).desc())
    kept = rows.withColumn(LAST, F.row_number().over(latest)).where(F.col(LAST) == 1)
    if len(kinds) > 1:
        # a row per kind of batch: each property from the last of the kinds that have it
        every = Window.partitionBy(*on).orderBy(F.col(SEQ).desc(), F.col(KIND)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        merged = {}
        for name in properties:
            having = [k for has, k in kinds.items() if name in has]
            if having:
                value = F.when(F.col(KIND).isin(having), F.struct(F.col(f"`{name}`").alias("v")))
                merged[name] = F.first(value, ignorenulls=True).over(every).getField("v")
        kept = kept.withColumn(LAST, F.row_number().over(Window.partitionBy(*on).orderBy(F.col(SEQ).desc(), F.col(KIND)))).withColumns(merged).where(F.col(LAST) == 1)
    return kept.select(*(f"`{f.name}`" for f in schema.fields))


def with_endpoints(edges: DataFrame, sources: DataFrame, source_key: str, targets: DataFrame, target_key: str) -> DataFrame:
    """Edges whose two ends are known nodes; the others are dropped."""
    a = sources.select(F.col(source_key).alias("src"))
    b = targets.select(F.col(target_key).alias("dst"))
    return edges.join(a, "src", "left_semi").join(b, "dst", "left_semi").select(*edges.columns)
