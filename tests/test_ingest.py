import json

import pytest

from lattica.__main__ import arguments, main, network
from lattica.operators.graph import PropertyGraph
from lattica.operators.ingest import entry_table, expand_graph

CHANNELS = ("escore", "dscore", "tscore", "ascore", "nscore", "fscore", "pscore")


@pytest.fixture(scope="module")
def sources(spark):
    entries = [(a, f"name {a}", f"G{a}", 1, a != "D", f"net{a}") for a in "ABCD"]
    links = [("A", "B", 0.9), ("A", "C", 0.75), ("A", "C", 0.2), ("B", "A", 0.9), ("C", "D", 0.8), ("A", "Z", 0.99), ("D", "A", 0.71)]
    ddl = "a string, b string, preferred_name_b string, taxon int, score double, " + ", ".join(f"{c} double" for c in CHANNELS)
    return {
        "entries": spark.createDataFrame(entries, "accession string, name string, gene_name string, taxon_id int, is_reviewed boolean, string_id string"),
        "interactions": spark.createDataFrame([(f"net{a}", f"net{b}", f"G{b}", 1, s, 0.1, 0.5, *[0.0] * 5) for a, b, s in links], ddl),
        "annotations": spark.createDataFrame([("A", "GO:1", "q", "IDA", "ECO:1", "PMID:5|pmid 6", "x", True), ("D", "GO:2", "q", "IEA", "ECO:2", None, "x", False)], "accession string, go_id string, qualifier string, evidence_code string, eco_code string, reference string, assigned_by string, is_experimental boolean"),
        "terms": spark.createDataFrame([("GO:1", "one", "MF", "text", False)], "go_id string, name string, aspect string, definition string, is_obsolete boolean"),
        "features": spark.createDataFrame([("A", "F", "f", "pfam", "domain", "", 1, 9, None, "m", "PMID:5"), ("B", "F", "f", "pfam", "domain", "", None, None, None, "m", None)], "accession string, feature string, name string, source_database string, type string, integrated string, start int, end int, score double, model string, reference string"),
        "articles": spark.createDataFrame([("5", "title")], "pmid string, title string"),
    }


def test_whole_growth(spark, sources):
    r = expand_graph(spark, sources, ["A"])
    assert r.stats == {"proteins_processed": 4, "proteins_discovered": 4}
    assert [x["accession"] for x in r.order.orderBy("seq").collect()] == ["A", "B", "C", "D"]  # Z has no accession
    g = r.graph
    assert {(x["src"], x["dst"], x["dominant_source"]) for x in g.edges("INTERACTS_WITH").collect()} == {(a, b, "database") for a, b in ("AB", "AC", "BA", "CD", "DA")}
    assert {(x["pmid"], x["title"]) for x in g.nodes("PubMedArticle").collect()} == {("5", "title"), ("6", None)}
    assert {(x["go_id"], x["name"]) for x in g.nodes("GOTerm").collect()} == {("GO:1", "one"), ("GO:2", "")}
    assert {tuple(x) for x in g.edges("CITED_IN").collect()} == {("A", "5"), ("A", "6")} and [tuple(x) for x in g.edges("EVIDENCED_BY").collect()] == [("F", "5")]
    assert {(x["src"], x["start"], x["end"]) for x in g.edges("HAS_FEATURE").collect()} == {("A", 1, 9), ("B", 0, 0)}


def test_capped_growth_leaves_placeholders(spark, sources, tmp_path):
    path = str(tmp_path / "g")
    r = expand_graph(spark, sources, ["A"], max_nodes=1, path=path)
    assert r.stats == {"proteins_processed": 1, "proteins_discovered": 3}
    assert {x["accession"]: x["name"] for x in PropertyGraph(spark, path).nodes("Protein").collect()} == {"A": "name A", "B": None, "C": None}
    assert network(spark, r.graph, ["A", "B"]).first()["completion"].startswith("Describe each of these proteins in moderate detail")
    with pytest.raises(ValueError):
        network(spark, r.graph, ["A", "Q"])
    main([path, "describe", "--accession", "A", "--out", str(tmp_path / "out")])
    assert json.loads((tmp_path / "out" / "A" / "messages.json").read_text())[0]["role"] == "system"
    assert arguments(["g", "network", "--accessions", "A,B"]).max_proteins == 5


def test_unknown_seed(spark, sources):
    r = expand_graph(spark, {k: sources[k] for k in ("entries", "interactions")}, ["nobody"])
    assert r.stats == {"proteins_processed": 1, "proteins_discovered": 1}
    assert [tuple(x) for x in r.graph.counts().collect()] == [("Protein", 1)]


def test_entry_table(spark):
    raw = spark.read.parquet("/root/testdata/sf0.001/uniprot_entry.parquet")
    assert entry_table(raw).count() == raw.count()
