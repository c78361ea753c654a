"""Traversal: neighbours within some hops, breadth-first growth in first-in-first-out order, closures of ontologies.

All run level by level: one join of the frontier with the edges per level, then an anti-join with what is known. The
state of a level is written to the shared folder, so lineage stays short and a lost executor costs one level at most.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lattica.operators.graph import undirected
from lattica.session import INTERNAL, staged


def neighbors(edges: DataFrame, starts: DataFrame, max_hops: int = 1, closed_only: bool = False) -> DataFrame:
    """(start, accession, hops): nodes reached from each start over 1..max_hops undirected edges, with the least number; closed_only: the starts themselves only.

    The start itself is reached if a closed trail, which uses no edge twice, is short enough: a self-loop in one hop, two
    parallel edges in two, or an edge (start, x) and another way from x back that does not use it.
    """
    base = starts.select(F.col("accession").alias("start")).where("start is not null").distinct()
    stored = edges.select("src", "dst").where("src is not null and dst is not null").withColumn("edge", F.struct("src", "dst"))
    both = staged(undirected(stored), "edges")  # read once per hop
    if closed_only:
        return closed_trails(both, base, max_hops)
    step = both.select("src", "dst").distinct()
    known = staged(base.select("start", F.col("start").alias("accession"), F.lit(0).alias("hops")), "near")
    frontier = known
    for hop in range(1, max_hops + 1):
        reached = frontier.select("start", F.col("accession").alias("src")).join(step, "src").select("start", F.col("dst").alias("accession")).distinct()
        fresh = staged(reached.join(known.select("start", "accession"), ["start", "accession"], "left_anti").withColumn("hops", F.lit(hop)), "near")
        if not fresh.head(1):
            break
        known, frontier = known.unionByName(fresh), fresh
    return known.where("hops > 0").unionByName(closed_trails(both, base, max_hops))


def closed_trails(both: DataFrame, base: DataFrame, max_hops: int) -> DataFrame:
    """(start, accession = start, hops) of the shortest closed trail through each start, if it has at most max_hops edges.

    A start that is closed walks no further, and the last hop takes only edges that lead home, so that the partners of the
    partners of a hub are not multiplied once more.
    """
    leave = base.join(both.withColumnRenamed("src", "start"), "start").select("start", F.col("edge").alias("first"), F.col("dst").alias("at"))
    walk = staged(leave.distinct(), "trail")
    found = walk.where("at = start").select("start", F.lit(1).alias("hops"))
    seen = walk
    step = both.select(F.col("src").alias("at"), F.col("dst").alias("to"), "edge")
    home = step.join(base.withColumnRenamed("start", "to"), "to")
    for hop in range(2, max_hops + 1):
        left = walk.join(found.select("start"), "start", "left_anti")
        onward = (left.join(step, "at") if hop < max_hops else left.join(home.withColumn("start", F.col("to")), ["at", "start"])).where("edge <> first")
        walk = staged(onward.select("start", "first", F.col("to").alias("at")).distinct().join(seen, ["start", "first", "at"], "left_anti"), "trail")
        if not walk.head(1):
            break
        found = found.unionByName(walk.where("at = start").select("start", F.lit(hop).alias("hops")))
        seen = seen.unionByName(walk)
    return found.groupBy("start").agg(F.min("hops").alias("hops")).select("start", F.col("start").alias("accession"), "hops")


def numbered(df: DataFrame, order: list[str | Column], name: str, after: int = 0) -> tuple[DataFrame, int]:
    """df with its rows numbered in order from after + 1 on, and their number; a lost task gives the same numbers again.

    The rows are sorted into ranges and written; each range is numbered by itself and shifted by the rows of the ranges
    before it. The driver sees one count per range.
    """
    part, at = f"{INTERNAL}part", f"{INTERNAL}at"
    ranged = staged(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "numbered")
    counts = sorted(ranged.groupBy(part).count().collect())
    before, total = [], after
    for p, n in counts:
        before.append((p, total))
        total += n
    shift = df.sparkSession.createDataFrame(before, f"{part} int, {at} bigint")
    row = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    return ranged.join(F.broadcast(shift), part).withColumn(name, (row + F.col(at)).cast("bigint")).drop(part, at), total - after


@dataclass
class Expansion:
    """order: (accession, seq, level, processed); seq is the place in the queue from 1."""

    order: DataFrame
    processed: int
    discovered: int


def expand(partners: DataFrame, seeds: list[str], max_nodes: int | None = None) -> Expansion:
    """Breadth-first growth from seeds over partners (src, dst, rank), in the order a queue would give.

    Seeds are taken in the order given, each once. The first max_nodes of the queue are processed; partners of processed
    nodes are discovered, partners of others are not. A node without partners is processed all the same.
    """
    spark = partners.sparkSession
    first = [(a, i + 1, 0) for i, a in enumerate(dict.fromkeys(seeds))]
    known = spark.createDataFrame(first, "accession string, seq bigint, level int")
    frontier, last, level = known, len(first), 0
    limit = max_nodes if max_nodes is not None else 1 << 62
    step = staged(partners.select(F.col("src").alias("accession"), "dst", "rank").where("dst is not null"), "edges")  # read once per level
    while last:
        level += 1
        met = frontier.where(F.col("seq") <= limit).join(step, "accession").groupBy(F.col("dst").alias("accession")).agg(F.min(F.struct("seq", "rank")).alias("at"))
        fresh = met.join(known.select("accession"), "accession", "left_anti")
        placed, n = numbered(fresh, ["at.seq", "at.rank", "accession"], "seq", last)
        if not n:
            break
        frontier = placed.select("accession", "seq", F.lit(level).alias("level"))
        known, last = known.unionByName(frontier), last + n
        if last - n >= limit:
            break
    order = known.withColumn("processed", F.col("seq") <= limit)
    return Expansion(order, min(last, limit), last)


def closure(edges: DataFrame, starts: DataFrame, relations: list[str] | None = None, down: bool = False, max_depth: int | None = None) -> DataFrame:
    """(start, term, depth): ancestors of each start over child -> parent edges (child, parent, relation), or descendants if down.

    relations limits the kinds of edges. The least depth is given; cycles end where nothing new is met. Starts are not
    their own ancestors unless a cycle leads back. Runs until nothing new is met, or to max_depth if that is given.
    """
    used = edges if relations is None else edges.where(F.col("relation").isin(*relations))
    a, b = ("parent", "child") if down else ("child", "parent")
    step = staged(used.select(F.col(a).alias("at"), F.col(b).alias("to")).where("at is not null and to is not null").distinct(), "edges")
    frontier = starts.select(F.col("term").alias("start"), F.col("term").alias("at")).distinct()
    known: DataFrame | None = None
    for depth in count(1):
        if max_depth is not None and depth > max_depth:
            break
        met = frontier.join(step, "at").select("start", F.col("to").alias("term")).distinct()
        if known is not None:
            met = met.join(known.select("start", "term"), ["start", "term"], "left_anti")
        fresh = staged(met.withColumn("depth", F.lit(depth)), "closure")
        if not fresh.head(1):
            break
        known = fresh if known is None else known.unionByName(fresh)
        if depth % 16 == 0:
            known = staged(known, "closure")  # deep ontologies: a short plan
        frontier = fresh.select("start", F.col("term").alias("at"))
    return known if known is not None else starts.sparkSession.createDataFrame([], "start string, term string, depth int")
