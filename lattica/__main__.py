"""python -m lattica <graph> describe --accession A | network --accessions A,B or --seed A [--max-proteins N] | counts | ingest --sources DIR.

describe and network write a folder with description.txt, messages.json, the contexts (context.json, or contexts_by_accession.json
with selected_accessions.json and interaction_edges.json), structure_manifest.json and structure/. Structures come from the
folder --structures: <pdb id>.pdb, the files named by the protein's AlphaFold URLs, and residue mappings <accession>_<pdb id>.json.
ingest grows the graph from DIR/<source>.parquet (the sources of expand_graph); SEEDS, STRING_SCORE and MAX_PROTEINS are read from the environment.
"""

from __future__ import annotations

import argparse
import json
import os
import re
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lattica.functions import text
from lattica.operators import interval
from lattica.operators.complete import complete, describe
from lattica.operators.graph import PropertyGraph, selected
from lattica.operators.ingest import expand_graph


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="lattica", description=__doc__)
    p.add_argument("graph", help="directory of a stored graph")
    p.add_argument("what", choices=("describe", "network", "counts", "ingest"))
    p.add_argument("--accession")
    p.add_argument("--accessions", default="")
    p.add_argument("--seed")
    p.add_argument("--max-proteins", type=int, default=5)
    p.add_argument("--max-structures", type=int, help="per protein and kind; 5 for describe, 3 for network")
    p.add_argument("--structures", help="folder of structure files and residue mappings")
    p.add_argument("--sources", help="folder of the sources of ingest")
    p.add_argument("--out", default="runs")
    return p.parse_args(given)


def ingest(spark: SparkSession, path: str, sources: str) -> dict[str, int]:
    names = ("entries", "interactions", "features", "annotations", "terms", "articles", "structures", "predictions", "full_texts")
    found = {n: spark.read.parquet(f"{sources}/{n}.parquet") for n in names if Path(sources, f"{n}.parquet").exists()}
    seeds = [x.strip() for x in os.environ.get("SEEDS", "P04637").split(",") if x.strip()]
    cap = os.environ.get("MAX_PROTEINS")
    return expand_graph(spark, found, seeds, int(os.environ.get("STRING_SCORE", "700")), int(cap) if cap else None, path).stats


def structure_files(spark: SparkSession, context, source: Path, out: Path, subdir: str, cap: int) -> list[dict]:
    """The manifest of one protein's structures (whole files, then a slice per feature edge), whose files are written below out/structure."""
    accession = context["protein"]["accession"]
    safe = lambda x: re.sub(r"[^A-Za-z0-9._-]+", "_", str(x)).strip("_")
    at = "/".join(("structure", safe(subdir))) if subdir else "structure"
    manifest: list[dict] = []

    def write(name: str, content: str, **more) -> None:
        Path(out, at).mkdir(parents=True, exist_ok=True)
        Path(out, at, name).write_text(content)
        manifest.append({"filename": name, "placeholder": f"[{at}/{name}]", **more, "path": f"{at}/{name}"})

    p, files, segs = context["protein"], [], []
    for pdb in [x for x in p["pdb_ids"] or [] if x][: max(1, cap)]:
        if (f := source / f"{safe(pdb)}.pdb").exists():
            files.append((pdb, f"pdb_{safe(pdb)}.pdb", f.read_text()))
            write(files[-1][1], files[-1][2], source="pdb", pdb_id=pdb)
            if (m := source / f"{safe(accession)}_{safe(pdb)}.json").exists():
                row = spark.createDataFrame([(m.read_text(),)], "p string").select(F.coalesce(F.nullif(interval.segments(F.col("p"), F.lit(pdb), F.lit(accession)), F.array().cast(interval.BOUNDS)), interval.segments(F.col("p")))).first()[0]
                segs += [(accession, pdb, *s) for s in row or []]
    for i, url in enumerate([x for x in p["alphafold_pdb_urls"] or [] if x][: max(1, cap)] or [x for x in [p["alphafold_pdb_url"]] if x], 1):
        if (f := source / safe(url.rsplit("/", 1)[-1])).exists():
            files.append((f"alphafold {i}", f"alphafold_{i}.pdb", f.read_text()))
            write(files[-1][1], files[-1][2], source="alphafold", url=url)
    spans = {f"{n}": e for n, e in enumerate(context["feature_relationships"]) if (e["dst"] or "").strip()}
    if not files or not spans:
        return manifest
    named = {k: name for k, name, _ in files}
    features = spark.createDataFrame([(accession, n, e["start"], e["end"]) for n, e in spans.items()], "accession string, feature string, start int, end int")
    structures = spark.createDataFrame([(accession, k, i) for i, (k, _, _) in enumerate(files)], "accession string, structure string, place int")
    segments = spark.createDataFrame(segs, "accession string, structure string, chain_id string, unp_start int, unp_end int, pdb_start int, pdb_end int")
    lines = spark.createDataFrame([(k, i, v) for k, _, content in files for i, v in enumerate(content.splitlines())], "structure string, line_no int, value string")
    for r in sorted(interval.structure_manifest(features, structures, segments, lines, len(files), files=True).collect(), key=lambda r: int(r["feature"])):
        e, mapped = spans[r["feature"]], r["kind"] == "mapped"
        name = f"feature_{safe(e['dst'])}_{e['start']}_{e['end']}" + (f"_pdb_{safe(r['structure'])}_chain_{safe(r['chain_tag'])}" if mapped else "") + ".pdb"
        more = {"pdb_id": r["structure"], "chain_ranges": [c.asDict() for c in r["chain_ranges"]]} if mapped else {}
        method = "chain_aware_sifts_mapping" if mapped else "naive_residue_number_fallback"
        write(name, r["content"], source="feature_slice", method=method, feature_accession=e["dst"], start=e["start"], end=e["end"], **more, reference_structure=f"{at}/{named[r['structure']]}")
    return manifest


def network(spark: SparkSession, g: PropertyGraph, accessions: list[str], files: list[str] | None = None):
    """(prompt, messages, completion) for several proteins; an unknown one is an error."""
    members = spark.createDataFrame([(a,) for a in accessions], "accession string")
    missing = [r[0] for r in members.join(g.accessions(), "accession", "left_anti").collect()]
    if missing:
        raise ValueError(f"not in the graph: {', '.join(sorted(missing))}")
    contexts = g.context(members).agg(F.array_sort(F.collect_list(text.network_context(F.col("context")))).alias("contexts"))  # at most five
    edges = g.induced_edges(members).agg(F.array_sort(F.collect_list(F.struct("src", "dst", "score"))).alias("edges"))
    one = contexts.withColumn("one", F.lit(1)).join(edges.withColumn("one", F.lit(1)), "one")  # a row each
    prompt = text.network_prompt(F.array(*map(F.lit, accessions)), F.col("contexts"), F.col("edges"), F.array(*map(F.lit, files or [])).cast("array<string>"))
    return complete(one.select(prompt.alias("prompt")).withColumn("messages", text.messages(F.col("prompt"))))


def main(given: list[str] | None = None) -> None:
    a = arguments(given)
    spark = SparkSession.builder.appName("lattica").getOrCreate()
    if a.what == "ingest":
        if not a.sources:
            raise SystemExit("--sources is missing")
        print(json.dumps(ingest(spark, a.graph, a.sources)))
        return
    g = PropertyGraph(spark, a.graph)
    if a.what == "counts":
        for label, n in g.counts().collect():
            print(label, n)
        return
    if a.what == "describe":
        if not a.accession:
            raise SystemExit("--accession is missing")
        asked, name = [a.accession], a.accession
    else:
        asked = selected([x.strip() for x in a.accessions.split(",") if x.strip()], a.max_proteins)
        if a.seed and not asked:
            asked = [r["accession"] for r in g.partners(a.seed, a.max_proteins).collect()]
        if not asked:
            raise SystemExit("no protein of that name")
        name = "-".join(asked)
    members = spark.createDataFrame([(x,) for x in asked], "accession string")
    found = {r["accession"]: r for r in g.context(members).select("accession", "context", F.to_json("context", {"ignoreNullFields": "false"}).alias("text")).collect()}  # at most five
    if missing := [x for x in asked if found[x]["context"]["protein"] is None]:
        raise ValueError(f"not in the graph: {', '.join(sorted(missing))}")
    out, single = Path(a.out, name), a.what == "describe"
    (out / "structure").mkdir(parents=True, exist_ok=True)
    cap = a.max_structures if a.max_structures is not None else 5 if single else 3
    manifest = [e for x in asked if a.structures for e in structure_files(spark, found[x]["context"], Path(a.structures), out, "" if single else x, cap)]
    names = [e["path"].removeprefix("structure/") for e in manifest]
    if single:
        files = spark.createDataFrame([(a.accession, names)], "accession string, files array<string>")
        row = describe(g.context(members), files=files).first()
        written = {"context": json.loads(found[a.accession]["text"])}
    else:
        row = network(spark, g, asked, names).first()
        edges = [json.loads(r[0]) for r in g.induced_edges(members).select(F.to_json(F.struct("*")).alias("e")).orderBy("e").collect()]  # among at most five
        written = {"selected_accessions": asked, "contexts_by_accession": {x: json.loads(found[x]["text"]) for x in asked}, "interaction_edges": edges}
    for file, content in (written | {"structure_manifest": manifest}).items():
        (out / f"{file}.json").write_text(json.dumps(content, indent=1))
    (out / "description.txt").write_text(row["completion"] + "\n")
    (out / "messages.json").write_text(json.dumps([m.asDict() for m in row["messages"]], indent=1))
    print(row["completion"])


if __name__ == "__main__":
    main()
