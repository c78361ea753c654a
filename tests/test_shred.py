import json
import random

import pytest
from pyspark.sql import functions as F

from lattica.functions.nested import citation_authors, cross_references, domain_matches
from lattica.operators.shred import assemble, leaves, places, shred
from lattica.plans.core_problems import citation_author_rows, domain_fragments, reference_properties

DDL = "id int, extra string, n array<struct<a: string, b: array<struct<c: array<string>, d: int>>>>"


def some(rng, depth):
    if rng.random() < 0.2:
        return None
    if depth == 2:
        return [rng.choice([None, "x", "", "ü"]) for _ in range(rng.randrange(3))]
    if depth == 1:
        return [None if rng.random() < 0.2 else (some(rng, 2), rng.choice([None, 1, 2])) for _ in range(rng.randrange(4))]
    return [None if rng.random() < 0.2 else (rng.choice([None, "a"]), some(rng, 1)) for _ in range(rng.randrange(4))]


@pytest.fixture(scope="module")
def records():
    rng = random.Random(4)
    return [(i, "e", some(rng, 0)) for i in range(150)]


def test_levels_lose_nothing_at_any_depth(spark, records):
    df = spark.createDataFrame(records, DDL).repartition(3)
    shredded, found = shred(df, ["id"], "n")
    assert [x.name for x in found] == ["[].a", "[].b.[].c.[]", "[].b.[].d"]
    top, mid, low = [], [], []
    for i, _, n in records:
        for p, x in enumerate(n or []):
            if x is None:
                continue
            top.append((i, p, x[0]))
            for q, y in enumerate(x[1] or []):
                if y is None:
                    continue
                mid.append((i, p, q, x[0], None if y[1] is None else str(y[1])))
                for r, z in enumerate(y[0] or []):
                    if z is not None:
                        low.append((i, p, q, r, x[0], z))
    key = lambda t: tuple((v is None, v) for v in t)
    rows = lambda *a: sorted(map(tuple, assemble(shredded, found, ["id"], *a).collect()), key=key)
    assert rows(("[]",), {"a": "[].a"}) == sorted(top, key=key)
    assert rows(("[]", "b", "[]"), {"a": "[].a", "d": "[].b.[].d"}) == sorted(mid, key=key)
    assert rows(("[]", "b", "[]", "c", "[]"), {"a": "[].a", "c": "[].b.[].c.[]"}) == sorted(low, key=key)


def test_a_leaf_below_the_table_is_refused(spark, records):
    shredded, found = shred(spark.createDataFrame(records, DDL), ["id"], "n")
    with pytest.raises(ValueError):
        assemble(shredded, found, ["id"], ("[]",), {"d": "[].b.[].d"})


def test_empty_table_and_key_of_any_name(spark):
    df = spark.createDataFrame([], "`my id` string, n array<struct<x: string>>")
    shredded, found = shred(df, ["my id"], "n")
    assert assemble(shredded, found, ["my id"], ("[]",), {"x": "[].x"}).collect() == []
    assert len(leaves(df.schema["n"].dataType)) == 1


def test_places():
    import numpy as np

    first, second = places(np.array([0, 2, 2, 1, 2, 0, 1]), 2)
    assert first.tolist() == [0, 0, 0, 1, 1, 0, 1]
    assert second.tolist() == [0, 1, 2, 0, 1, 0, 0]


def test_domain_matches_of_every_shape(spark):
    loc = lambda *f: {"fragments": list(f)}
    pages = [
        (1, {"results": [{"metadata": {"accession": "A"}, "proteins": [{"entry_protein_locations": []}, {"entry_protein_locations": [loc({"start": 1, "end": 2}, None, {"begin": "3", "end": "4"})]}]}]}),
        (2, {"results": [{"metadata": {"accession": "B"}, "proteins": {"entry_protein_locations": [{"start": 5, "end": "6", "fragments": []}]}, "entry_protein_locations": [loc({"start": 9, "end": 9})]}]}),
        (3, {"results": [{"metadata": {"accession": "C"}, "proteins": None, "entry_protein_locations": [{"begin": 7, "end": "?"}, loc({"start": 8, "end": 8})]}]}),
        (4, {"results": []}),
    ]
    df = spark.createDataFrame([(i, json.dumps(p)) for i, p in pages] + [(5, '{"results"'), (6, None), (7, ""), (8, "[1]")], "rec_id int, payload string")
    got = sorted(map(tuple, domain_fragments(df).select("rec_id", "pos_1", "pos_2", "pos_3", "accession", "start", "end").collect()))
    assert got == [(1, 0, 0, 0, "A", "1", "2"), (1, 0, 0, 2, "A", "3", "4"), (2, 0, 0, 0, "B", "5", "6"), (3, 0, 0, 0, "C", "7", "?"), (3, 0, 1, 0, "C", "8", "8")]
    assert df.select(domain_matches(F.col("payload"))).count() == 8


def test_cross_references_newer_before_older(spark):
    ddl = "rec_id int, uniProtKBCrossReferences array<struct<database: string, id: string, properties: array<struct<key: string, value: string>>>>, dbReferences string"
    old = [{"type": "PDB", "id": "1", "properties": {"k": "v", "e": None}}, {"database": "GO", "id": "2", "properties": [{"key": "x"}, {"key": "x"}]}, {"type": "Z", "id": "3"}]
    df = spark.createDataFrame([(1, None, json.dumps(old)), (2, [("N", "9", None), ("N", "8", [("p", None)])], json.dumps(old)), (3, [], json.dumps(old)), (4, None, None), (5, None, "{")], ddl)
    got = sorted((tuple(r) for r in reference_properties(df).collect()), key=str)
    assert got == sorted(
        [(1, 0, 0, "PDB", "1", "e", None), (1, 0, 1, "PDB", "1", "k", "v"), (1, 1, 0, "GO", "2", "x", None), (1, 1, 1, "GO", "2", "x", None), (1, 2, 0, "Z", "3", None, None), (2, 0, 0, "N", "9", None, None), (2, 1, 0, "N", "8", "p", None)],
        key=str,
    )
    assert df.select(cross_references(F.col("uniProtKBCrossReferences"), F.col("dbReferences"))).count() == 5


def test_citation_authors_of_mixed_form(spark):
    cites = ['{"rcsb_authors": ["A", {"name": "B"}, {"ordinal": 3}, null, "C"]}', "{}", '{"rcsb_authors": []}', None, "oops"]
    df = spark.createDataFrame(list(enumerate(cites)), "rec_id int, rcsb_primary_citation string")
    assert sorted(map(tuple, citation_author_rows(df).where("name is not null").collect())) == [(0, 0, "A"), (0, 1, "B"), (0, 4, "C")]
    assert df.select(citation_authors(F.col("rcsb_primary_citation"))).count() == 5
