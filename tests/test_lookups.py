import pytest
from pyspark.sql import functions as F

from lattica.sources import lookups as lk


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def test_structures(spark):
    e = frame(spark, [("S", 3), ("T", 1)], "entry_id string, polymer_entity_count int")
    x = frame(spark, [("S", "1"), ("S", "3"), ("T", "1"), ("T", "2"), ("S", "x")], "entry_id string, entity_id string")
    assert {tuple(r) for r in lk.polymer_entities(e, x).collect()} == {("S", "1"), ("T", "1")}  # S has a gap at 2
    refs = frame(spark, [("P", f"S{k}", float(k % 3)) for k in range(5)] + [("P", "S1", 9.0)], "accession string, entry_id string, score double")
    got = lk.structures_of(refs, frame(spark, [("P",), ("Q",)], "accession string"), 2).orderBy("place").collect()
    assert [(r["entry_id"], r["total_count"]) for r in got] == [("S1", 5), ("S2", 5)]
    assert [r[0] for r in lk.by_key(frame(spark, [("1ABC",)], "id string"), frame(spark, [("1abc",)], "id string"), "id", upper=True).collect()] == ["1ABC"]


def test_predictions(spark):
    p = frame(spark, [("AF-P-F2", "P", None, "p2"), ("AF-P-F1", "P", "c1", "p1")], "entryId string, uniprotAccession string, cifUrl string, pdbUrl string")
    assert lk.best_prediction(p).first()["prediction"]["entryId"] == "AF-P-F1"
    u = lk.prediction_urls(p).first()
    assert (u["alphafold_entry_ids"], u["alphafold_cif_urls"], u["alphafold_cif_url"]) == (["AF-P-F1", "AF-P-F2"], ["c1", ""], "c1")
    names = frame(spark, [("P",), ("P-2",), ("PX",)], "primaryAccession string")
    assert {r["isoform"] for r in lk.isoforms(names, frame(spark, [("P",)], "accession string")).collect()} == {"P", "P-2"}


def test_annotations_by_evidence(spark):
    a = frame(spark, [("1", "ECO:0000269", "F"), ("2", "ECO:9", "F"), ("3", "ECO:5", "F"), ("4", "ECO:9", "P")], "id string, evidenceCode string, goAspect string")
    eco = frame(spark, [("ECO:7", "ECO:0000269", "is_a"), ("ECO:9", "ECO:7", "is_a")], "child string, parent string, relation string")
    ids = lambda df: sorted(r["id"] for r in df.collect())
    assert ids(lk.annotations(a, eco)) == ["1", "2", "3", "4"]
    assert ids(lk.annotations(a, eco, aspect="F", experimental_only=True)) == ["1", "2"]
    assert ids(lk.annotations(a, eco, evidence_code="ECO:5", experimental_only=True)) == ["3"]
    assert [r["child"] for r in lk.children(eco, frame(spark, [("ECO:7",)], "term string")).collect()] == ["ECO:9"]


def test_networks_genes_and_articles(spark):
    i = frame(spark, [("a", "b", 0.5), ("a", "c", 0.9), ("a", "b", 0.3)], "a string, b string, score double")
    assert lk.network(i, frame(spark, [("a",), ("b",)], "id string")).count() == 1
    g = lk.genes_entries(frame(spark, [("P", "hsa:1")], "accession string, gene_id string"), frame(spark, [("hsa:1", "raw")], "entry_id string, raw string"), frame(spark, [("P",), ("Q",)], "accession string"))
    assert {tuple(r) for r in g.collect()} == {("P", "hsa:1", "raw"), ("Q", None, None)}
    n = lk.named_pathways(frame(spark, [("g", "p1"), ("g", "p2")], "id string, linked string"), frame(spark, [("p1", "one")], "id string, value string"))
    assert {(r["pathway"], r["name"]) for r in n.collect()} == {("p1", "one"), ("p2", "p2")}
    t = frame(spark, [("1", "2001", "PMC1"), ("2", "2003 Spring", "2"), ("3", None, None), ("4", "1999", "")], "pmid string, year string, pmc string")
    assert [r["pmid"] for r in lk.article_search(t, F.lit(True), 2, (1990, 2010)).orderBy("place").collect()] == ["2", "1"]
    x = frame(spark, [("PMC1", "abc"), ("PMC2", "")], "pmc string, text string")
    assert [tuple(r) for r in lk.full_text(x, t, 2).collect()] == [("1", "ab")]
    with pytest.raises(ValueError, match="not found: Q"):
        lk.required(frame(spark, [("P",)], "k string"), frame(spark, [("Q",), ("P",)], "k string"), "k")
