import random
from collections import deque

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lattica.operators import enrich, graph, growth, interval, merge, traverse
from lattica.operators.complete import Config, complete, describe
from lattica.schemas import EDGES, NODES, edge_schema, node_schema


def struct(ddl):
    from lattica.schemas import struct

    return struct(ddl)


# ---- merges


def test_properties_replace_stay_and_vanish(spark):
    schema = struct("k string, a string, b string")
    first = spark.createDataFrame([("x", "1", "1"), ("y", "1", "1"), (None, "1", "1")], "k string, a string, b string")
    second = spark.createDataFrame([("x", "2"), ("z", "2")], "k string, a string")  # has no b
    third = spark.createDataFrame([("y", None)], "k string, b string")  # removes b
    got = merge.merge(None, [first, second, third], ["k"], schema)
    want = {("x", "2", "1"), ("y", "1", None), ("z", "2", None)}
    assert set(map(tuple, got.collect())) == want
    again = merge.merge(got, [second, third], ["k"], schema)
    assert set(map(tuple, again.collect())) == want


def test_last_of_a_batch_wins_by_order(spark):
    schema = struct("k string, a string")
    batch = spark.createDataFrame([("x", "old", 1), ("x", "new", 9), ("x", "mid", 5)], "k string, a string, at int")
    assert [tuple(r) for r in merge.merge(None, [batch], ["k"], schema, "at").collect()] == [("x", "new")]
    assert merge.merge(None, [batch.limit(0)], ["k"], schema, "at").count() == 0


def test_edges_need_both_ends_and_have_one_pair(spark):
    g = graph.PropertyGraph(spark)
    g.merge_nodes("Protein", spark.createDataFrame([("A",), ("B",)], "accession string"))
    g.merge_edges("INTERACTS_WITH", spark.createDataFrame([("A", "B", 0.9), ("B", "A", 0.8), ("A", "Z", 0.7)], "src string, dst string, score double"))
    got = {(r["src"], r["dst"], r["string_pair"], r["score"]) for r in g.edges("INTERACTS_WITH").collect()}
    assert got == {("A", "B", "A:B", 0.9), ("B", "A", "A:B", 0.8)}
    assert [tuple(r) for r in g.counts().collect()] == [("INTERACTS_WITH", 2), ("Protein", 2)]
    assert g.setup() is g


def test_feature_evidence_gives_two_edges(spark):
    g = graph.PropertyGraph(spark)
    for label, key, ids in (("Protein", "accession", ["P", "Q"]), ("ProteinFeature", "accession", ["F"]), ("PubMedArticle", "pmid", ["1"])):
        g.merge_nodes(label, spark.createDataFrame([(i,) for i in ids], f"{key} string"))
    g.merge_feature_evidence(spark.createDataFrame([("P", "F", "1"), ("Q", "F", "2"), ("P", "X", "1")], "protein string, feature string, article string"))
    assert [tuple(r) for r in g.edges("CITED_IN").collect()] == [("P", "1")]
    assert [tuple(r) for r in g.edges("EVIDENCED_BY").collect()] == [("F", "1")]


def test_versions_on_disk(spark, tmp_path):
    path = str(tmp_path / "graph")
    g = graph.PropertyGraph(spark, path)
    g.merge_nodes("Protein", spark.createDataFrame([("A", "x")], "accession string, name string"))
    before = graph.PropertyGraph(spark, path)
    g.merge_nodes("Protein", spark.createDataFrame([("A", "y"), ("B", "z")], "accession string, name string"))
    assert before.nodes("Protein").select("name").first()[0] == "x"  # a reader keeps its version
    assert graph.PropertyGraph(spark, path).nodes("Protein").count() == 2
    graph.PropertyGraph(spark, path).register_views()
    assert spark.sql("select count(*) from protein").first()[0] == 2
    assert graph.PropertyGraph(spark, path).clear().nodes("Protein").count() == 0


def test_schemas_name_every_key():
    for key, ddl in NODES.values():
        assert f"{key} STRING" in ddl
    for kind, (_, _, keys, ddl) in EDGES.items():
        assert all(k in ddl for k in keys), kind


# ---- reads


@pytest.fixture(scope="module")
def ppi(spark):
    return spark.createDataFrame([("S", "A", 0.5), ("B", "S", 0.9), ("S", "B", 0.2), ("S", "C", None), ("S", "S", 1.0), ("A", "B", 0.1), ("D", "E", 0.4)], "src string, dst string, score double")


def nodes(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "accession string")


def test_partners(spark, ppi):
    every = nodes(spark, *"SABCDE")
    assert [(r["accession"], r["score"]) for r in graph.partners(every, ppi, "S", 5).collect()] == [("S", None), ("B", 0.9), ("A", 0.5), ("C", 0.0)]
    assert [r["accession"] for r in graph.partners(every, ppi, "S", 2).collect()] == ["S", "B"]
    assert graph.partners(every, ppi, "none", 5).count() == 0
    assert [r["accession"] for r in graph.partners(nodes(spark, "lone"), ppi, "lone", 9).collect()] == ["lone"]


def test_induced_edges_come_twice_or_once(spark, ppi):
    members = nodes(spark, "S", "B", "B")
    got = sorted((r["src"], r["dst"]) for r in graph.induced_edges(ppi, members).collect())
    assert got == [("B", "S"), ("B", "S"), ("S", "B"), ("S", "B"), ("S", "S")]
    assert graph.induced_edges(ppi, members, distinct=True).count() == 3


def test_selected():
    assert graph.selected(["B", "A", "B", "C"], 2) == ["B", "A"]
    assert graph.selected(["B"], 99) == ["B"] and graph.selected([], 0) == []


def test_context_of_known_and_unknown(spark):
    g = graph.PropertyGraph(spark)
    g.merge_nodes("Protein", spark.createDataFrame([("P", "p")], "accession string, name string"))
    g.merge_nodes("ProteinFeature", nodes(spark, "F"))
    g.merge_nodes("GOTerm", spark.createDataFrame([("G", "g")], "go_id string, name string"))
    g.merge_nodes("PubMedArticle", spark.createDataFrame([("1", "t"), ("2", "u")], "pmid string, title string"))
    g.merge_edges("HAS_FEATURE", spark.createDataFrame([("P", "F", 1, 5), ("P", "F", 7, 9)], "src string, dst string, start int, end int"))
    g.merge_edges("HAS_GO_ANNOTATION", spark.createDataFrame([("P", "G", "G", "q")], "src string, dst string, go_id string, qualifier string"))
    g.merge_edges("CITED_IN", spark.createDataFrame([("P", "1"), ("P", "2")], "src string, dst string"))
    g.merge_edges("EVIDENCED_BY", spark.createDataFrame([("F", "1")], "src string, dst string"))
    got = {r["accession"]: r["context"] for r in g.context(nodes(spark, "P", "no")).collect()}
    p = got["P"]
    assert p["protein"]["name"] == "p" and len(p["features"]) == 2 and len(p["go_terms"]) == 1  # a feature per location
    assert sorted(a["pmid"] for a in p["articles"]) == ["1", "2"]
    assert len(p["article_relationships"]["feature_evidenced_by"]) == 2  # repeats per location
    assert got["no"]["protein"] is None and got["no"]["features"] == [] and got["no"]["articles"] == []
    out = describe(g.context(nodes(spark, "P"))).first()
    assert out["prompt"].startswith("Describe protein P") and out["completion"].startswith("Describe protein P")
    with pytest.raises(Exception, match="not in the graph"):
        describe(g.context(nodes(spark, "no"))).collect()


def test_sampled_contexts_are_those_of_whole_ones(spark):
    from lattica.operators.complete import describe_sampled
    from lattica.plans.graph_queries import small_graph

    g = small_graph(spark, "/root/testdata/sf0.001")
    rows = [("P", f"F{k % 30:03d}", k, k + 5) for k in range(70)] + [("Q", "F001", 1, 2)]
    h = graph.PropertyGraph(spark)
    h.merge_nodes("Protein", nodes(spark, "P", "Q", "R"))
    h.merge_nodes("ProteinFeature", nodes(spark, *{r[1] for r in rows}))
    h.merge_nodes("PubMedArticle", spark.createDataFrame([(str(k), f"title {k}") for k in range(60)], "pmid string, title string"))
    h.merge_edges("HAS_FEATURE", spark.createDataFrame(rows, "src string, dst string, start int, end int"))
    h.merge_edges("CITED_IN", spark.createDataFrame([("P", str(k)) for k in range(50)], "src string, dst string"))
    h.merge_edges("EVIDENCED_BY", spark.createDataFrame([("F001", str(k)) for k in range(45, 60)], "src string, dst string"))
    for one in (g, h):
        whole = {r["accession"]: r["prompt"] for r in describe(one.context(one.accessions())).collect()}
        assert whole and {r["accession"]: r["prompt"] for r in describe_sampled(graph.sampled_context(one, one.accessions())).collect()} == whole
    unknown = graph.sampled_context(h, nodes(spark, "no")).first()["context"]
    assert unknown["protein"] is None and unknown["features"] == [] and unknown["counts"]["articles"] == 0


def test_prompts_hold_whole_articles(spark):
    from lattica.__main__ import network

    g = graph.PropertyGraph(spark)
    g.merge_nodes("Protein", nodes(spark, "P", "Q"))
    article = [("1", "t", "an abstract", "10.1/x", ["A B"], ["Mice"], "x" * 3000), ("2", "u", None, None, None, None, None)]
    g.merge_nodes("PubMedArticle", spark.createDataFrame(article, "pmid string, title string, abstract string, doi string, authors array<string>, mesh_terms array<string>, full_text string"))
    g.merge_edges("CITED_IN", spark.createDataFrame([("P", "1"), ("P", "2"), ("Q", "2")], "src string, dst string"))
    found = {a["pmid"]: a.asDict() for a in g.context(nodes(spark, "P")).first()["context"]["articles"]}
    assert set(found["1"]) == set(node_schema("PubMedArticle").names)
    assert (found["1"]["abstract"], found["1"]["doi"], found["1"]["authors"], found["1"]["mesh_terms"]) == ("an abstract", "10.1/x", ["A B"], ["Mice"])
    assert "an abstract" in describe(g.context(nodes(spark, "P"))).first()["prompt"]
    prompt = network(spark, g, ["P", "Q"]).first()["prompt"]
    assert "an abstract" in prompt and '"full_text_char_count":3000' in prompt and f'"full_text_excerpt":"{"x" * 1200}"' in prompt and '"full_text"' not in prompt


# ---- traversal


def random_edges(rng, n, m):
    return sorted({(f"n{rng.randrange(n):02d}", f"n{rng.randrange(n):02d}") for _ in range(m)})


def trail_answer(edges, start, hops):
    """All nodes at the end of an undirected trail (no edge twice) of 1..hops edges, with the least length."""
    found, stack = {}, [(start, frozenset(), 0)]
    while stack:
        at, used, n = stack.pop()
        if n == hops:
            continue
        for k, (a, b) in enumerate(edges):
            if k in used or at not in (a, b):
                continue
            to = b if at == a else a
            found[to] = min(found.get(to, 99), n + 1)
            stack.append((to, used | {k}, n + 1))
    return found


@pytest.mark.parametrize("edges", [[("a", "a")], [("a", "b"), ("b", "a")], [("a", "b"), ("b", "c"), ("c", "a")], [("a", "b"), ("b", "c")], random_edges(random.Random(2), 7, 9)])
def test_neighbors_are_ends_of_trails(spark, edges):
    start = edges[0][0]
    df = spark.createDataFrame([*edges, ("zz", None)], "src string, dst string")
    got = {r["accession"]: r["hops"] for r in traverse.neighbors(df, nodes(spark, start), 3).collect()}
    assert got == trail_answer(edges, start, 3)


@pytest.mark.parametrize("cap", [None, 1, 5, 12])
def test_expansion_is_first_in_first_out(spark, cap):
    rng = random.Random(6)
    partners = [(a, b, k) for k, (a, b) in enumerate(random_edges(rng, 25, 60))]
    by = {}
    for a, b, k in partners:
        by.setdefault(a, []).append((k, b))
    seeds = ["n01", "n02", "n01"]
    queue, order, done = deque(dict.fromkeys(seeds)), list(dict.fromkeys(seeds)), 0
    while queue and (cap is None or done < cap):
        done += 1
        for _, b in sorted(by.get(queue.popleft(), [])):
            if b not in order:
                order.append(b)
                queue.append(b)
    got = traverse.expand(spark.createDataFrame(partners, "src string, dst string, rank int"), seeds, cap)
    assert [r["accession"] for r in got.order.orderBy("seq").collect()] == order
    assert (got.processed, got.discovered) == (done, len(order))


def test_closure_ends_on_cycles(spark):
    edges = spark.createDataFrame([("a", "b", "is_a"), ("b", "c", "is_a"), ("c", "a", "is_a"), ("a", "d", "part_of")], "child string, parent string, relation string")
    start = spark.createDataFrame([("a",)], "term string")
    assert sorted((r["term"], r["depth"]) for r in traverse.closure(edges, start, ["is_a"]).collect()) == [("a", 3), ("b", 1), ("c", 2)]
    assert sorted(r["term"] for r in traverse.closure(edges, start).collect()) == ["a", "b", "c", "d"]
    assert [r["term"] for r in traverse.closure(edges, spark.createDataFrame([("d",)], "term string"), down=True, max_depth=1).collect()] == ["a"]
    assert traverse.closure(edges.limit(0), start).count() == 0


def test_growth(spark, tmp_path):
    new = growth.first_seen(spark.createDataFrame([("a", 1), ("a", 3), ("b", 3)], "k string, seq int"), ["k"], "L")
    log = growth.cumulative(new, spark.createDataFrame([(1,), (2,), (3,)], "seq int"), ["L"])
    assert sorted((r["seq"], r["total"]) for r in log.collect()) == [(1, 1), (2, 1), (3, 2)]
    path = str(tmp_path / "log")
    growth.write_log(log, path)
    (tmp_path / "log" / "part-bad.json").write_text("{oops\n")
    assert [r["total"] for r in growth.read_log(spark, path).collect()] == [1, 1, 2]
    assert growth.series(log, ["L"]).columns == ["seq", "L"]


# ---- intervals


def test_projection_both_ways(spark):
    features = spark.createDataFrame([("P", 1, 5, 12), ("P", 2, 90, 95)], "accession string, feature int, start int, end int")
    segments = spark.createDataFrame([("P", "A", 10, 20, 110, 120), ("P", "B", 1, 10, 50, 41), ("Q", "C", 1, 99, 1, 99)], "accession string, chain_id string, unp_start int, unp_end int, pdb_start int, pdb_end int")
    got = sorted((r["feature"], r["chain_id"], r["lo"], r["hi"]) for r in interval.project_features(features, segments, ["accession"]).collect())
    assert got == [(1, "A", 110, 112), (1, "B", 41, 46)]
    bad = spark.createDataFrame([("P", 1, 0, 12), ("P", 2, 15, 12), ("P", 3, -5, -1)], "accession string, feature int, start int, end int")
    assert interval.project_features(bad, segments, ["accession"]).count() == 0


def test_bins_find_every_overlap_once(spark):
    rng = random.Random(1)
    a = [(i, s := rng.randrange(100), s + rng.randrange(30)) for i in range(40)]
    b = [(i, s := rng.randrange(100), s + rng.randrange(30)) for i in range(40)]
    x, y = spark.createDataFrame(a, "i int, s int, e int"), spark.createDataFrame(b, "j int, t int, f int")
    got = sorted((r["i"], r["j"]) for r in interval.bin_join(x, y, ("s", "e"), ("t", "f"), 10).collect())
    assert got == sorted((i, j) for i, s, e in a for j, t, f in b if s <= f and e >= t)


def line(n, chain, residue, record="ATOM"):
    return f"{record:<6}{n:>5}  CA  GLY {chain}{residue:>4}    "


def test_slices_and_manifest(spark):
    rows = [("S1", i, line(i, "A", i)) for i in range(1, 9)] + [("S1", 20, line(20, "B", 3, "HETATM")), ("S1", 21, "TER"), ("S1", 22, line(22, "A", "x"))] + [("S2", i, line(i, "A", i)) for i in range(1, 4)]
    lines = spark.createDataFrame(rows, "structure string, line_no int, value string")
    got = {r["structure"]: r for r in interval.slice_by_range(lines, 2, 3).collect()}
    assert got["S1"]["n_atoms"] == 3 and got["S1"]["content"].endswith("\nEND\n")
    assert interval.slice_by_range(lines, 5, 2).count() == 0 and interval.slice_by_range(lines, 50, 60).count() == 0
    features = spark.createDataFrame([("P", "f1", 2, 3), ("P", "f2", 1, 2), ("P", "f3", None, 2), (" ", "f4", 1, 2), ("P", "f5", 70, 80), ("P", "f1", 3, 3), ("P", "f1", 3, 3), ("P", "f6", 3, 2), ("P", "f7", 0, 2)], "accession string, feature string, start int, end int")
    structures = spark.createDataFrame([("P", "S1", 1), ("P", "S2", 2)], "accession string, structure string, place int")
    segs = spark.createDataFrame([("P", "S2", "A", 2, 3, 2, 3), ("P", "S1", "Z", 2, 3, 2, 3)], "accession string, structure string, chain_id string, unp_start int, unp_end int, pdb_start int, pdb_end int")
    m = sorted(tuple(r) for r in interval.structure_manifest(features, structures, segs, lines).collect())
    assert m == [("P", "f1", 2, 3, "S2", "mapped", "A", 2), ("P", "f1", 3, 3, "S2", "mapped", "A", 1), ("P", "f2", 1, 2, "S2", "mapped", "A", 1)]
    names = {(r["start"], r["filename"], r["placeholder"]) for r in interval.slice_names(interval.structure_manifest(features, structures, segs, lines)).where("feature = 'f1'").collect()}
    assert names == {(2, "feature_f1_2_3_pdb_S2_chain_A.pdb", "[structure/feature_f1_2_3_pdb_S2_chain_A.pdb]"), (3, "feature_f1_3_3_pdb_S2_chain_A.pdb", "[structure/feature_f1_3_3_pdb_S2_chain_A.pdb]")}
    only = interval.structure_manifest(features, structures, segs.where("structure = 'none'"), lines).collect()
    assert {(r["feature"], r["structure"], r["kind"], r["n_atoms"]) for r in only} == {("f1", "S1", "plain", 3), ("f1", "S1", "plain", 2), ("f2", "S1", "plain", 2)}


def test_atom_lines_stay_off_the_driver(spark):
    """Few short rows that become many lines look small to Spark: the lines must neither be broadcast nor hits shuffled before they are counted."""
    known = spark.createDataFrame([("S", 300), ("T", 40)], "structure string, n int")
    value = F.format_string("ATOM  %5d  CA  GLY %s%4d    ", F.col("line_no"), F.when(F.col("line_no") <= 50, "A").otherwise("B"), F.col("line_no"))
    lines = known.select("structure", F.explode(F.sequence(F.lit(1), "n")).alias("line_no")).withColumn("value", value)
    lines = lines.unionByName(lines.where("line_no = 45"))  # a repeated line counts once
    features = spark.createDataFrame([("P", 1, 40, 60), ("P", 2, 250, 400), ("Q", 1, 41, 90), ("Q", 1, 39, 90)], "accession string, feature int, start int, end int")
    structures = spark.createDataFrame([("P", "S", 1), ("Q", "T", 1)], "accession string, structure string, place int")
    segs = spark.createDataFrame([("P", "S", "A", 30, 55, 30, 55), ("P", "S", "A", 44, 70, 44, 70), ("P", "S", "B", 30, 52, 30, 52)], "accession string, structure string, chain_id string, unp_start int, unp_end int, pdb_start int, pdb_end int")
    found = interval.structure_manifest(features, structures, segs, lines)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 2 and plan.count("Exchange ") <= 8, plan  # lines (a union of two) are read for the rest alone: the mapped slices are staged
    assert sorted(tuple(r) for r in found.collect()) == [("P", 1, 40, 60, "S", "mapped", "A_B", 13), ("P", 2, 250, 400, "S", "plain", "", 51), ("Q", 1, 39, 90, "T", "plain", "", 2)]
    ranges = spark.createDataFrame([("S", 1, "A", 40, 50)], "structure string, feature int, chain_id string, lo int, hi int")
    plan = interval.slice_by_chains(lines, ranges).select("structure", "feature", "n_atoms")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    moved = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert len(moved) == 3, plan  # lines, ranges and counts


def test_residue_mapping_payload(spark):
    payload = '{"mappings": [{"chain_id": "A", "unp_start": 1, "unp_end": 9, "start": {"author_residue_number": 0, "residue_number": 4}, "end": {"author_residue_number": 12}}, {"chain_id": "B", "unp_start": 1}]}'
    got = spark.createDataFrame([(payload,), ("x",), (None,)], "p string").select(interval.segments(F.col("p"))).collect()
    whole = '{"1abc": {"UniProt": {"P1": {"mappings": [{"chain_id": " A", "unp_start": 0, "unp_start_residue_number": 5, "unp_end": 9, "start": {"residue_number": 2}, "end": {"residue_number": 6}}, {"chain_id": " ", "unp_start": 1, "unp_end": 2, "start": {"residue_number": 2}, "end": {"residue_number": 6}}, {"chain_id": "B", "start": {"author_residue_number": 3, "residue_number": 7}, "end": {"residue_number": 8}}]}, "P2": {"mappings": []}}}, "2xyz": {"UniProt": null}}'
    df = spark.createDataFrame([(whole,)], "p string")
    every = df.select(F.explode(interval.mapping_segments(F.col("p"))).alias("s")).select("s.*").collect()
    assert [tuple(r) for r in every] == [("1ABC", "P1", "A", 5, 9, 2, 6), ("1ABC", "P1", "B", 7, 8, 3, 8)]
    assert len(df.select(interval.segments(F.col("p"), F.lit("1Abc"), F.lit("P1"))).first()[0]) == 2 and df.select(interval.segments(F.col("p"), F.lit("1abc"), F.lit("P2"))).first()[0] == []
    assert [tuple(x) for x in got[0][0]] == [("A", 1, 9, 4, 12)] and got[1][0] is None and got[2][0] is None
    tag = spark.createDataFrame([(["B", "A", "B"],)], "c array<string>").select(interval.chain_tag(F.col("c"))).first()[0]
    assert tag == "A_B"


# ---- enrichment and completion


def test_tail_against_counting():
    from math import comb

    for k, n, big_k, big_n in ((2, 5, 4, 12), (0, 3, 2, 9), (3, 3, 3, 9), (1, 8, 9, 10)):
        want = sum(comb(big_k, i) * comb(big_n - big_k, n - i) for i in range(k, min(n, big_k) + 1)) / comb(big_n, n)
        assert enrich.tail(k, n, big_k, big_n) == pytest.approx(want)


def test_enrichment(spark):
    rows = [(g, "c", "t1") for g in "abcd"] + [(g, "c", "t2") for g in "abefgh"] + [("a", "c", "t1"), (None, "c", "t1"), ("x", "c", None)]
    got = {r["term"]: r for r in enrich.enrichment(spark.createDataFrame(rows, "gene string, category string, term string"), spark.createDataFrame([("a",), ("b",), ("c",)], "gene string")).collect()}
    assert (got["t1"]["number_of_genes"], got["t1"]["number_of_genes_in_background"], got["t1"]["input_genes"]) == (3, 4, ["a", "b", "c"])
    assert got["t1"]["p_value"] == pytest.approx(enrich.tail(3, 3, 4, 8)) and got["t1"]["fdr"] == pytest.approx(min(1, 2 * got["t1"]["p_value"]))


def test_completion_settings(spark):
    with pytest.raises(ValueError):
        Config.from_env(env={})
    assert Config.from_env(env={"COMPLETION_API_KEY": "k", "COMPLETION_MAX_TOKENS": "9"}).max_tokens == 9
    df = spark.createDataFrame([(1, [("user", "hi")]), (2, None)], "id int, messages array<struct<role: string, content: string>>")
    got = {r["id"]: r["completion"] for r in complete(df, lambda m: m[0]["content"].upper()).collect()}
    assert got == {1: "HI", 2: None}


def test_schema_helpers(spark):
    assert edge_schema("CITED_IN").names == ["src", "dst"] and "pmid" in node_schema("PubMedArticle").names


def test_old_versions_are_removed_and_writers_do_not_lose_labels(spark, tmp_path):
    path = str(tmp_path / "g")
    a, b = graph.PropertyGraph(spark, path), graph.PropertyGraph(spark, path)
    a.merge_nodes("Protein", nodes(spark, "P"))
    b.merge_nodes("ProteinFeature", nodes(spark, "F"))  # opened before the first write
    a.merge_nodes("Protein", nodes(spark, "Q"))
    again = graph.PropertyGraph(spark, path)
    assert {r["accession"] for r in again.nodes("Protein").collect()} == {"P", "Q"} and again.nodes("ProteinFeature").count() == 1
    assert again.vacuum(keep=1) == 0  # all are young
    assert again.vacuum(keep=1, hours=-1) == 1 and again.vacuum(keep=1, hours=-1) == 0
    assert graph.PropertyGraph(spark, path).nodes("Protein").count() == 2
    again.clear()
    assert graph.PropertyGraph(spark, path).counts().collect() == []
