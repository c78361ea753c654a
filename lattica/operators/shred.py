"""Columnar shredding of nested records, and flat tables rebuilt from the level sequences.

`shred` turns a nested column into one column per leaf path: an array of (r, d, v), with r the repetition level (which
repeated ancestor starts anew; 0: the record), d the definition level (how much of the path is present) and v the value.
It is a Catalyst expression, so it runs in the JVM beside the scan. `assemble` reads the sequences of whole Arrow batches
at once and rebuilds the table of any repeated ancestor: a row for each element, its place at every level above, and the
leaves of the ancestor and of all its parents. No shuffle is needed for either.

Levels: a struct or a leaf that is present adds 1 to d; a list adds 1 for being there, 1 for having the element and 1 for
the element not being null. So a null list, an empty list, a null element and an element without leaves all differ, and
each keeps its place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lattica.session import INTERNAL

LEAF = f"{INTERNAL}leaf_"


@dataclass(frozen=True)
class Leaf:
    """A leaf path. steps: field names, "[]" for a repeated level. element_d: definition level at which the element of the innermost list is there."""

    steps: tuple[str, ...]
    max_r: int
    max_d: int
    element_d: int

    @property
    def name(self) -> str:
        return ".".join(self.steps)

    @property
    def repeated(self) -> tuple[str, ...]:
        """The path of the innermost repeated ancestor."""
        last = max((i for i, s in enumerate(self.steps) if s == "[]"), default=-1)
        return self.steps[: last + 1]


def leaves(kind: T.DataType, steps: tuple[str, ...] = (), r: int = 0, d: int = 0, element_d: int = 0) -> list[Leaf]:
    """All leaf paths below a type; maps are not shredded (turn them into lists of entries first)."""
    if isinstance(kind, T.StructType):
        return [x for f in kind.fields for x in leaves(f.dataType, (*steps, f.name), r, d + 1, element_d)]
    if isinstance(kind, T.ArrayType):
        return leaves(kind.elementType, (*steps, "[]"), r + 1, d + 2, d + 2)
    return [Leaf(steps, r, d + 1, element_d)]


def _entry(r: Column, d: int, v: Column) -> Column:
    return F.struct(r.cast("int").alias("r"), F.lit(d).alias("d"), v.cast("string").alias("v"))


def _levels(value: Column, kind: T.DataType, steps: Sequence[str], r: Column, level: int, d: int) -> Column:
    """The sequence of (r, d, v) below value, an array with at least one entry."""
    absent = F.array(_entry(r, d, F.lit(None)))
    if isinstance(kind, T.StructType):
        inner = _levels(value.getField(steps[0]), kind[steps[0]].dataType, steps[1:], r, level, d + 1)
        return F.when(value.isNull(), absent).otherwise(inner)
    if isinstance(kind, T.ArrayType):

        def element(x: Column, i: Column) -> Column:
            return _levels(x, kind.elementType, steps[1:], F.when(i == 0, r).otherwise(F.lit(level + 1)), level + 1, d + 2)

        empty = F.array(_entry(r, d + 1, F.lit(None)))
        return F.when(value.isNull(), absent).when(F.size(value) == 0, empty).otherwise(F.flatten(F.transform(value, element)))
    return F.when(value.isNull(), absent).otherwise(F.array(_entry(r, d + 1, value)))


def shred(df: DataFrame, keys: Sequence[str], column: str) -> tuple[DataFrame, list[Leaf]]:
    """keys and, for every leaf below `column`, its level sequence as column LEAF + position in the list returned."""
    kind = df.schema[column].dataType
    found = leaves(kind)
    levels = [_levels(F.col(f"`{column}`"), kind, x.steps, F.lit(0), 0, 0).alias(f"{LEAF}{i}") for i, x in enumerate(found)]
    return df.select(*(F.col(f"`{k}`") for k in keys), *levels), found


def places(r: np.ndarray, level: int) -> list[np.ndarray]:
    """For every entry of a level sequence its place, from 0, at the repeated levels 1..level."""
    out = []
    for j in range(1, level + 1):
        seen = np.cumsum(r == j)
        at_start = np.maximum.accumulate(np.where(r < j, seen, -1)) if len(r) else seen
        out.append((seen - at_start).astype(np.int32))
    return out


def assemble(shredded: DataFrame, all_leaves: list[Leaf], keys: Sequence[str], ancestor: Sequence[str], wanted: dict[str, str]) -> DataFrame:
    """The table of one repeated ancestor: keys, pos_1..pos_n, and the leaves in wanted (output name -> leaf name).

    ancestor is a path that ends in "[]". Leaves must belong to it or to a parent of it (the record included). Null
    elements give no row but keep their place; an element whose leaves are null gives a row of nulls.
    """
    ancestor = tuple(ancestor)
    depth = sum(s == "[]" for s in ancestor)
    by_name = {x.name: (i, x) for i, x in enumerate(all_leaves)}
    for name in wanted.values():
        rep = by_name[name][1].repeated
        if ancestor[: len(rep)] != rep:
            raise ValueError(f"{name} is not a leaf of {'.'.join(ancestor)} or of a parent of it")
    guide = next((i for i, x in enumerate(all_leaves) if x.repeated == ancestor), None)
    if guide is None:  # the ancestor has no leaf of its own: any leaf below has its levels too
        guide = next(i for i, x in enumerate(all_leaves) if x.steps[: len(ancestor)] == ancestor)
    below = all_leaves[guide]
    need_d = _element_level(below.steps, ancestor)
    picks = [(name, *by_name[leaf]) for name, leaf in wanted.items()]
    schema = T.StructType(
        [shredded.schema[k] for k in keys]
        + [T.StructField(f"pos_{j}", T.IntegerType()) for j in range(1, depth + 1)]
        + [T.StructField(name, T.StringType()) for name in wanted]
    )
    used = sorted({guide, *(i for _, i, _ in picks)})
    narrow = shredded.select(*(F.col(f"`{k}`") for k in keys), *(F.col(f"{LEAF}{i}") for i in used))
    return narrow.mapInArrow(_assembler(list(keys), used, guide, depth, need_d, picks), schema)


def _element_level(steps: Sequence[str], ancestor: Sequence[str]) -> int:
    """Definition level from which a not-null element of the ancestor is there, in a sequence of the leaf with these steps.

    A list adds 2 for an element to exist; the struct inside adds 1 when it is not null, a bare leaf 1 as well.
    """
    d = 0
    for s in steps[: len(ancestor)]:
        d += 2 if s == "[]" else 1
    return d + 1


def _assembler(keys: list[str], used: list[int], guide: int, depth: int, need_d: int, picks: list[tuple[str, int, Leaf]]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            streams = {}
            for n, i in enumerate(used):
                lists = batch.column(len(keys) + n)
                entries = lists.flatten()
                r, d = (entries.field(x).to_numpy(zero_copy_only=False) for x in (0, 1))
                streams[i] = (np.diff(lists.offsets.to_numpy()), r, d, entries.field(2))
            sizes, r, d, _ = streams[guide]
            record = np.repeat(np.arange(batch.num_rows), sizes)
            # in the guide's sequence each element of the ancestor starts where r <= depth
            heads = np.flatnonzero((r <= depth) & (d >= need_d))
            pos = [p[heads] for p in places(r, depth)]
            columns = [batch.column(k).take(pa.array(record[heads])) for k in range(len(keys))]
            columns += [pa.array(p, pa.int32()) for p in pos]
            for _, i, leaf in picks:
                # an entry of a parent's sequence starts wherever the guide's r is at most the parent's level
                at = (np.cumsum(r <= leaf.max_r) - 1)[heads]
                columns.append(streams[i][3].take(pa.array(at)))
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, *(f"pos_{j + 1}" for j in range(depth)), *(p[0] for p in picks)])

    return run
