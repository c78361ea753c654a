"""Traversal over the whole graph against brute force: no edge of a hub is left out."""

import random
from collections import deque

import duckdb
import pytest

from lattica.operators import traverse
from lattica.plans import graph_queries as q
from tests.test_graph import random_edges, trail_answer
from tests.test_queries import SF


@pytest.fixture(scope="module")
def edge():
    """{src: [(dst, score)]} of the smallest tables, the best first, and the seed."""
    c = duckdb.connect()
    for t in ("string_interaction",):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    rows = c.execute(f"with {q._SQL_EDGE} select src, dst, score from edge order by src, score desc, dst").fetchall()
    by = {}
    for a, b, s in rows:
        by.setdefault(a, []).append((b, s))
    return by, min(by, key=lambda a: (-len(by[a]), a))


def test_neighbors_over_every_edge(spark, edge):
    by, seed = edge
    near = {}
    for a, found in by.items():
        for b, _ in found:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    hops, queue = {seed: 0}, deque([seed])
    while queue:
        at = queue.popleft()
        for b in near[at] if hops[at] < 3 else ():
            if b not in hops:
                hops[b] = hops[at] + 1
                queue.append(b)
    assert len(by[seed]) > 6
    assert {r["accession"]: r["hops"] for r in q.QUERIES["neighbors_khop"](spark, SF).collect()} == {a: n for a, n in hops.items() if n}
    mutual = {a for a, found in by.items() if any(a in dict(by.get(b, ())) for b, _ in found)}
    assert mutual and {tuple(r) for r in q.QUERIES["neighbors_closed_trail"](spark, SF).collect()} == {(a, 2) for a in mutual}


def grown(by, seed, cap=None):
    order, level, done, queue = [seed], {seed: 0}, set(), deque([seed])
    while queue and (cap is None or len(done) < cap):
        at = queue.popleft()
        done.add(at)
        for b, _ in [x for x in by.get(at, ()) if x[1] >= 0.7][:50]:
            if b not in level:
                level[b] = level[at] + 1
                order.append(b)
                queue.append(b)
    return order, level, done


def test_growth_over_the_partners_of_the_ingest(spark, edge):
    by, seed = edge
    order, level, done = grown(by, seed, 40)
    assert [(r["accession"], r["level"], r["processed"]) for r in q.QUERIES["bfs_capped"](spark, SF).orderBy("seq").collect()] == [(a, level[a], a in done) for a in order]
    order, level, _ = grown(by, seed)
    assert {r["accession"]: r["level"] for r in q.QUERIES["bfs_levels"](spark, SF).collect()} == level
    counts = list(level.values())
    assert {r["level"]: r["n"] for r in q.QUERIES["bfs_stats"](spark, SF).collect()} == {n: counts.count(n) for n in set(counts)}


@pytest.mark.parametrize("seed", [1, 2])
def test_trails_of_several_starts(spark, seed):
    edges = random_edges(random.Random(seed), 7, 8)
    names = sorted({x for e in edges for x in e})[:3]
    got = traverse.neighbors(spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame([(n,) for n in names], "accession string"), 4)
    assert {(r["start"], r["accession"], r["hops"]) for r in got.collect()} == {(n, a, h) for n in names for a, h in trail_answer(edges, n, 4).items()}


def test_closure_has_no_silent_depth(spark):
    edges = spark.createDataFrame([(f"{i}", f"{i + 1}", "is_a") for i in range(103)], "child string, parent string, relation string")
    got = traverse.closure(edges, spark.createDataFrame([("0",)], "term string"))
    assert {r["term"]: r["depth"] for r in got.collect()} == {f"{i}": i for i in range(1, 104)}


def test_induced_edges_of_every_taxon(spark, edge):
    by, _ = edge
    fold = lambda x: x.strip(" \t\n\r\x0b\x0c\xa0").upper()
    taxa = {}
    for i, t in duckdb.sql(f"select stringId, ncbiTaxonId from '{SF}/string_mapping.parquet' where stringId is not null and ncbiTaxonId is not null").fetchall():
        taxa.setdefault(fold(i), set()).add(t)
    want = sorted((t, a, b, s) for a, found in by.items() for b, s in found for t in taxa.get(a, set()) & taxa.get(b, set()))
    assert len({x[0] for x in want}) > 1
    assert sorted(tuple(r) for r in q.QUERIES["induced_edges_by_taxon"](spark, SF).collect()) == want
