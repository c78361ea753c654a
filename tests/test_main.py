"""The command: every file of a run, structures by their manifest, and an ingest."""

import json

from lattica.__main__ import main
from lattica.operators.graph import PropertyGraph
from tests.test_graph import line


def test_runs_write_every_file(spark, tmp_path):
    path, source, out = str(tmp_path / "graph"), tmp_path / "structures", tmp_path / "runs"
    g = PropertyGraph(spark, path)
    g.merge_nodes("Protein", spark.createDataFrame([("P", ["1ABC", "2ABC"]), ("Q", None)], "accession string, pdb_ids array<string>"))
    g.merge_nodes("ProteinFeature", spark.createDataFrame([("F",)], "accession string"))
    g.merge_edges("HAS_FEATURE", spark.createDataFrame([("P", "F", 2, 3), ("P", "F", 5, 6)], "src string, dst string, start int, end int"))
    g.merge_edges("INTERACTS_WITH", spark.createDataFrame([("P", "Q", 0.9)], "src string, dst string, score double"))
    source.mkdir()
    for pdb in ("1ABC", "2ABC"):
        (source / f"{pdb}.pdb").write_text("\n".join(line(i, "A", i) for i in range(1, 9)))
    (source / "P_1ABC.json").write_text('{"mappings": [{"chain_id": "A", "unp_start": 1, "unp_end": 3, "pdb_start": 4, "pdb_end": 6}]}')
    main([path, "describe", "--accession", "P", "--structures", str(source), "--max-structures", "1", "--out", str(out)])
    assert {f.name for f in (out / "P").iterdir()} == {"description.txt", "messages.json", "context.json", "structure_manifest.json", "structure"}
    manifest = json.loads((out / "P/structure_manifest.json").read_text())
    assert [e["filename"] for e in manifest] == ["pdb_1ABC.pdb", "feature_F_2_3_pdb_1ABC_chain_A.pdb", "feature_F_5_6.pdb"]
    assert manifest[1]["chain_ranges"] == [{"chain_id": "A", "pdb_start": 5, "pdb_end": 6}]
    assert all((out / "P" / e["path"]).exists() for e in manifest)
    assert (out / "P" / manifest[1]["path"]).read_text() == "\n".join([line(5, "A", 5), line(6, "A", 6), "END", ""])
    assert "feature_F_5_6.pdb" in (out / "P/messages.json").read_text()
    assert json.loads((out / "P/context.json").read_text())["protein"]["accession"] == "P"
    main([path, "network", "--accessions", "P,Q", "--structures", str(source), "--out", str(out)])
    run = out / "P-Q"
    assert {f.name for f in run.iterdir()} == {"description.txt", "messages.json", "selected_accessions.json", "contexts_by_accession.json", "interaction_edges.json", "structure_manifest.json", "structure"}
    assert json.loads((run / "selected_accessions.json").read_text()) == ["P", "Q"] and len(json.loads((run / "interaction_edges.json").read_text())) == 2
    assert "P/pdb_2ABC.pdb" in (run / "messages.json").read_text() and (run / "structure/P/pdb_2ABC.pdb").exists()


def test_ingest(spark, tmp_path, monkeypatch):
    entry = "accession string, name string, gene_name string, taxon_id int, is_reviewed boolean, string_id string"
    spark.createDataFrame([("A", "a", "GA", 9, True, "9.A"), ("B", "b", "GB", 9, True, "9.B")], entry).write.parquet(str(tmp_path / "in/entries.parquet"))
    channels = ("escore", "dscore", "tscore", "nscore", "ascore", "fscore", "pscore")
    link = "a string, b string, preferred_name_b string, taxon int, score double, " + ", ".join(f"{c} double" for c in channels)
    spark.createDataFrame([("9.A", "9.B", "GB", 9, 0.8, *[0.1] * len(channels))], link).write.parquet(str(tmp_path / "in/interactions.parquet"))
    monkeypatch.setenv("SEEDS", "A")
    main([str(tmp_path / "graph"), "ingest", "--sources", str(tmp_path / "in")])
    g = PropertyGraph(spark, str(tmp_path / "graph"))
    assert {r["accession"] for r in g.accessions().collect()} == {"A", "B"} and g.edges("INTERACTS_WITH").count() == 1
