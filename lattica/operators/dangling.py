"""References to records that do not exist at the time, found with a skew-aware split.

References are pre-aggregated per key and period. Keys that carry a large share of the raw references are checked against
a broadcast of their own target rows (both sides bounded: few keys, each with at most periods x periods rows); all other
keys take a shuffled anti-join. The orphans of both ways are united.

Periods are months, counted as year * 12 + month - 1. A target row is there in a month if it was loaded before the next
month began and was not deleted before the next month began.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.session import INTERNAL, staged

REF, MONTH, ROWS, FROM, TO = (f"{INTERNAL}{x}" for x in ("ref", "month", "rows", "from", "to"))

#: Month from which a row that is never deleted is gone.
NEVER = 2_000_000


def month_number(at: Column) -> Column:
    return F.year(at) * 12 + F.month(at) - 1


def month_text(number: Column) -> Column:
    return F.format_string("%04d-%02d", F.floor(number / 12), number % 12 + 1)


def references(df: DataFrame, ref: Column, at: Column) -> DataFrame:
    """Pre-aggregated references: (REF, MONTH, ROWS), written once, as every use reads them again. Null references and rows without a time are left out."""
    rows = df.select(ref.cast("string").alias(REF), month_number(at).alias(MONTH))
    return staged(rows.where(F.col(REF).isNotNull() & F.col(MONTH).isNotNull()).groupBy(REF, MONTH).agg(F.count(F.lit(1)).alias(ROWS)), "refs")


def presence(df: DataFrame, key: Column, loaded: Column, deleted: Column) -> DataFrame:
    """Distinct (REF, FROM, TO): the target key is there in months FROM <= m < TO. Rows delivered twice or short-lived within a month vanish."""
    rows = df.select(key.cast("string").alias(REF), month_number(loaded).alias(FROM), F.coalesce(month_number(deleted), F.lit(NEVER)).alias(TO))
    return rows.where(F.col(REF).isNotNull() & (F.col(FROM) < F.col(TO))).distinct()


def heavy_refs(refs: DataFrame, share: float) -> list[str]:
    """Keys with more than `share` of the raw references: fewer than 1/share, so they fit the driver and a broadcast."""
    total = refs.agg(F.sum(ROWS)).first()[0] or 0
    found = refs.groupBy(REF).agg(F.sum(ROWS).alias("n")).where(F.col("n") > F.lit(max(1.0, share * total)))
    return [r[0] for r in found.collect()]


def _absent(refs: DataFrame, target: DataFrame) -> DataFrame:
    t = target.withColumnRenamed(REF, f"{REF}_t")
    return refs.join(t, (F.col(REF) == F.col(f"{REF}_t")) & (F.col(MONTH) >= F.col(FROM)) & (F.col(MONTH) < F.col(TO)), "left_anti")


def orphans(refs: DataFrame, target: DataFrame, share: float = 0.01) -> DataFrame:
    """Pre-aggregated references without a target in their month: (REF, MONTH, ROWS), each pair once.

    refs comes from `references`, target from `presence`. Empty refs give no rows; an empty target makes every reference
    an orphan.
    """
    heavy = heavy_refs(refs, share)
    if not heavy:
        return _absent(refs, target)
    keys = F.broadcast(refs.sparkSession.createDataFrame([(k,) for k in heavy], f"`{REF}` string"))
    rare = _absent(refs.join(keys, REF, "left_anti"), target.join(keys, REF, "left_anti"))
    # at most 1/share keys with a presence per pair of months
    often = _absent(refs.join(keys, REF, "left_semi"), F.broadcast(target.join(keys, REF, "left_semi")))
    return rare.unionByName(often)


def orphan_report(found: DataFrame, all_refs: DataFrame, table_name: str) -> DataFrame:
    """Per period: distinct references, orphans among them, and the rows behind both."""
    total = all_refs.groupBy(MONTH).agg(F.count(F.lit(1)).alias("n_refs"), F.sum(ROWS).alias("n_rows"))
    lost = found.groupBy(MONTH).agg(F.count(F.lit(1)).alias("n_orphans"), F.sum(ROWS).alias("n_orphan_rows"))
    joined = total.join(F.broadcast(lost), MONTH, "left")  # a row per month
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return joined.select(F.lit(table_name).alias("src_table"), month_text(F.col(MONTH)).alias("period"), "n_refs", F.col("n_rows").cast("bigint").alias("n_rows"), zero("n_orphans"), zero("n_orphan_rows"))
