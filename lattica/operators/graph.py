"""A property graph as DataFrames, one per node label and edge type, kept as versioned Parquet directories."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lattica.functions.records import string_pair
from lattica.functions.text import LINK_SAMPLE, SAMPLES
from lattica.operators.merge import merge, with_endpoints
from lattica.schemas import EDGES, NODES, edge_schema, node_schema


class PropertyGraph:
    """Nodes by label and edges by type. With a path, every write makes a new version and then a new manifest, by number.

    A version is never overwritten while it may be read; a reader sees the manifest it opened. Without a path the graph
    lives in its DataFrames.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path
        self.tables: dict[str, DataFrame] = {}
        if path:
            for name, version in self._manifest().items():
                self.tables[name] = spark.read.schema(self._schema(name)).parquet(f"{path}/{name}/{version}")

    def _schema(self, name: str):
        return node_schema(name) if name in NODES else edge_schema(name)

    def _fs(self):
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _manifests(self) -> list[int]:
        """Numbers of the manifests that are there; the highest one holds."""
        jvm, fs = self._fs()
        found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest-*.json")) or []
        return sorted(int(f.getPath().getName()[len("manifest-") : -len(".json")]) for f in found)

    def _manifest(self, number: int | None = None) -> dict[str, str]:
        number = max(self._manifests(), default=0) if number is None else number
        return json.loads(self.spark.read.text(f"{self.path}/manifest-{number:012d}.json", wholetext=True).first()[0]) if number else {}

    def _publish(self, changed: dict[str, str] | None) -> None:
        """The next manifest: the last one with what changed (None: nothing is left).

        It is written whole and then takes the next free number by a rename, which fails where another writer was first;
        then that writer's manifest is what this one is added to. No manifest is ever without content, and none is lost.
        """
        jvm, fs = self._fs()
        path = jvm.org.apache.hadoop.fs.Path
        while True:
            last = max(self._manifests(), default=0)
            fresh, target = path(f"{self.path}/fresh-{uuid.uuid4().hex}"), path(f"{self.path}/manifest-{last + 1:012d}.json")
            out = fs.create(fresh)
            out.write(bytearray(json.dumps({} if changed is None else self._manifest(last) | changed).encode()))
            out.close()
            if not fs.exists(target) and fs.rename(fresh, target):
                return
            fs.delete(fresh, False)

    def put(self, name: str, df: DataFrame) -> PropertyGraph:
        """Make df the content of a label or type."""
        if self.path:
            version = uuid.uuid4().hex
            df.write.parquet(f"{self.path}/{name}/{version}")
            self._publish({name: version})
            df = self.spark.read.schema(self._schema(name)).parquet(f"{self.path}/{name}/{version}")
        self.tables[name] = df
        return self

    def vacuum(self, keep: int = 2, hours: float = 24.0) -> int:
        """Delete versions that the last `keep` manifests do not name and that are older than `hours`, and the manifests before; the number of versions deleted.

        Younger ones may belong to a writer that has not published yet, or to a reader of an earlier manifest.
        """
        jvm, fs = self._fs()
        path = jvm.org.apache.hadoop.fs.Path
        numbers = self._manifests()
        live = {(name, version) for n in numbers[-keep:] for name, version in self._manifest(n).items()}
        before, deleted = (time.time() - hours * 3600) * 1000, 0
        for found in fs.globStatus(path(f"{self.path}/*/*")) or []:
            at = found.getPath()
            name = at.getParent().getName()
            if name in (*NODES, *EDGES) and found.isDirectory() and (name, at.getName()) not in live and found.getModificationTime() <= before:
                deleted += bool(fs.delete(at, True))
        for n in numbers[:-keep]:
            fs.delete(path(f"{self.path}/manifest-{n:012d}.json"), False)
        return deleted

    def nodes(self, label: str) -> DataFrame:
        return self.tables.get(label) if label in self.tables else self.spark.createDataFrame([], node_schema(label))

    def edges(self, kind: str) -> DataFrame:
        return self.tables.get(kind) if kind in self.tables else self.spark.createDataFrame([], edge_schema(kind))

    def merge_nodes(self, label: str, *batches: DataFrame, order: str | None = None) -> PropertyGraph:
        return self.put(label, merge(self.tables.get(label), batches, [NODES[label][0]], node_schema(label), order))

    def merge_edges(self, kind: str, *batches: DataFrame, order: str | None = None, dangling: bool = False) -> PropertyGraph:
        """Merge edge batches; edges with an unknown end are dropped unless `dangling`."""
        a, b, keys, _ = EDGES[kind]
        if kind == "INTERACTS_WITH":
            batches = tuple(x.withColumn("string_pair", string_pair(F.col("src"), F.col("dst"))) for x in batches)
        if not dangling:
            batches = tuple(with_endpoints(x, self.nodes(a), NODES[a][0], self.nodes(b), NODES[b][0]) for x in batches)
        return self.put(kind, merge(self.tables.get(kind), batches, ["src", "dst", *keys], edge_schema(kind), order))

    def merge_feature_evidence(self, triples: DataFrame) -> PropertyGraph:
        """(protein, feature, article) triples give an edge from the protein and one from the feature, if all three are known."""
        known = triples
        for column, label in (("protein", "Protein"), ("feature", "ProteinFeature"), ("article", "PubMedArticle")):
            known = known.join(self.nodes(label).select(F.col(NODES[label][0]).alias(column)), column, "left_semi")
        self.merge_edges("CITED_IN", known.select(F.col("protein").alias("src"), F.col("article").alias("dst")))
        return self.merge_edges("EVIDENCED_BY", known.select(F.col("feature").alias("src"), F.col("article").alias("dst")))

    def clear(self) -> PropertyGraph:
        self.tables = {}
        if self.path:
            self._publish(None)
        return self

    def setup(self) -> PropertyGraph:
        """Raise if a label has two nodes of one key; may be called again at any time."""
        for label, (key, _) in NODES.items():
            if label in self.tables and self.tables[label].groupBy(key).count().where("count > 1").head(1):
                raise ValueError(f"{label} has several nodes with one {key}")
        return self

    def register_views(self) -> None:
        for name in [*NODES, *EDGES]:
            (self.nodes(name) if name in NODES else self.edges(name)).createOrReplaceTempView(name.lower())

    # ---- reads

    def accessions(self) -> DataFrame:
        return self.nodes("Protein").select("accession")

    def counts(self) -> DataFrame:
        """(label, cnt) of every label and type that is there, the largest first."""
        kinds = [(n, self.tables[n]) for n in [*NODES, *EDGES] if n in self.tables]
        if not kinds:
            return self.spark.createDataFrame([], "label string, cnt bigint")
        parts = [df.groupBy().agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(n).alias("label"), "cnt") for n, df in kinds]
        return reduce(DataFrame.unionAll, parts).where("cnt > 0").orderBy(F.col("cnt").desc(), "label")

    def all_edges(self) -> DataFrame:
        """All edges as (src_label, src, type, dst_label, dst)."""
        parts = [self.edges(k).select(F.lit(a).alias("src_label"), "src", F.lit(k).alias("type"), F.lit(b).alias("dst_label"), "dst") for k, (a, b, _, _) in EDGES.items()]
        return reduce(DataFrame.unionByName, parts)

    def partners(self, seed: str, k: int = 5) -> DataFrame:
        return partners(self.accessions(), self.edges("INTERACTS_WITH"), seed, k)

    def induced_edges(self, members: DataFrame, distinct: bool = False) -> DataFrame:
        return induced_edges(self.edges("INTERACTS_WITH"), members, distinct)

    def context(self, members: DataFrame) -> DataFrame:
        return context(self, members)


def undirected(edges: DataFrame) -> DataFrame:
    """Every edge in both directions, self-loops once."""
    turned = edges.where("src <> dst").select(*(F.col(x).alias(y) for x, y in (("dst", "src"), ("src", "dst"))), *(c for c in edges.columns if c not in ("src", "dst")))
    return edges.unionByName(turned)


def selected(accessions: Sequence[str], cap: int = 5) -> list[str]:
    """Accessions asked for, each once in the order of asking, at most cap (between 1 and 5) of them."""
    return list(dict.fromkeys(accessions))[: max(1, min(5, cap))]


def partners(nodes: DataFrame, edges: DataFrame, seed: str, k: int = 5) -> DataFrame:
    """(accession, score, place): the seed and its partners by falling score, k rows in all; none if the seed is unknown.

    Edges count in both directions; a partner reached twice counts with its better score; a missing score counts as 0.
    """
    k = max(1, min(5, k))
    start = nodes.where(F.col("accession") == seed).select(F.col("accession").alias("src")).distinct()
    near = undirected(edges.select("src", "dst", "score")).where(F.col("src") == seed)
    found = start.join(near, "src", "left").where("dst is not null and dst <> src")
    best = found.groupBy(F.col("dst").alias("accession")).agg(F.max(F.coalesce("score", F.lit(0.0))).alias("score"))
    top = best.orderBy(F.col("score").desc(), "accession").limit(k - 1)
    both = start.select(F.col("src").alias("accession"), F.lit(None).cast("double").alias("score"), F.lit(0).alias("group")).unionByName(top.withColumn("group", F.lit(1)))
    ordered = both.orderBy("group", F.col("score").desc(), "accession")
    return ordered.select("accession", "score", "group")


def induced_edges(edges: DataFrame, members: DataFrame, distinct: bool = False) -> DataFrame:
    """Edges with both ends among members (column accession). Each comes in both directions, as an undirected match returns it; distinct gives stored edges once."""
    m = members.select("accession").distinct()
    inside = edges.join(m.withColumnRenamed("accession", "src"), "src", "left_semi").join(m.withColumnRenamed("accession", "dst"), "dst", "left_semi").select(*edges.columns)
    return inside if distinct else undirected(inside)


def context_counts(graph: PropertyGraph, members: DataFrame) -> DataFrame:
    """(accession, n_features, n_terms, n_cited): how many entries the lists of `context` have, each counted by its own group."""
    m = members.select("accession").distinct()

    def counted(kind: str, target: str, key: str, name: str) -> DataFrame:
        known = graph.nodes(target).select(F.col(key).alias("dst"))
        return graph.edges(kind).select("src", "dst").join(known, "dst", "left_semi").groupBy(F.col("src").alias("accession")).agg(F.count(F.lit(1)).alias(name))

    parts = [("HAS_FEATURE", "ProteinFeature", "accession", "n_features"), ("HAS_GO_ANNOTATION", "GOTerm", "go_id", "n_terms"), ("CITED_IN", "PubMedArticle", "pmid", "n_cited")]
    found = reduce(lambda a, b: a.join(counted(*b), "accession", "left"), parts, m)
    return found.select("accession", *(F.coalesce(name, F.lit(0).cast("bigint")).alias(name) for *_, name in parts))


#: Columns of the entries of a context's lists.
ENTRIES = {
    "features": "dst name source_database type integrated", "feature_relationships": "dst start end score model", "go_terms": "dst name aspect definition is_obsolete",
    "go_relationships": "dst qualifier evidence_code eco_code reference assigned_by is_experimental", "cited_in": "dst", "feature_evidenced_by": "feature dst",
}


def context_rows(graph: PropertyGraph, members: DataFrame) -> dict[str, DataFrame]:
    """The entries of every list of the members' contexts, one row each with the member as src; articles as (src, dst, group), the cited ones in group 0."""
    asked = members.select(F.col("accession").alias("src")).distinct()
    features = graph.edges("HAS_FEATURE").join(asked, "src", "left_semi").join(graph.nodes("ProteinFeature").withColumnRenamed("accession", "dst"), "dst")
    terms = graph.edges("HAS_GO_ANNOTATION").drop("go_id").join(asked, "src", "left_semi").join(graph.nodes("GOTerm").withColumnRenamed("go_id", "dst"), "dst")
    stored = graph.nodes("PubMedArticle").select(F.col("pmid").alias("dst"))
    cited = graph.edges("CITED_IN").join(asked, "src", "left_semi").join(stored, "dst", "left_semi")
    chain = graph.edges("HAS_FEATURE").join(asked, "src", "left_semi").select("src", F.col("dst").alias("feature"))
    evidence = chain.join(graph.edges("EVIDENCED_BY").select(F.col("src").alias("feature"), "dst"), "feature").join(stored, "dst", "left_semi")
    # each article once per protein, the cited ones first
    met = cited.select("src", "dst", F.lit(0).alias("group")).unionByName(evidence.select("src", "dst", F.lit(1).alias("group"))).groupBy("src", "dst").agg(F.min("group").alias("group"))
    rows = {"features": features, "feature_relationships": features, "go_terms": terms, "go_relationships": terms, "cited_in": cited, "feature_evidenced_by": evidence}
    return {name: df.select("src", *ENTRIES[name].split()) for name, df in rows.items()} | {"articles": met.where("coalesce(btrim(dst), '') <> ''")}


def context(graph: PropertyGraph, members: DataFrame) -> DataFrame:
    """(accession, context) of every member; context holds the protein, its features, terms and articles and the edges to them.

    All members are answered in one job: a chain of joins per list, grouped once. A feature is repeated per location, as
    there is one edge per location. A member that is not in the graph has a null protein and empty lists. The lists are
    whole; for many members, of which some have very long lists, sampled_context holds what a prompt shows of them.
    """
    m = members.select("accession").distinct()
    protein, article = graph.nodes("Protein"), graph.nodes("PubMedArticle")
    rows = context_rows(graph, m)
    rows["articles"] = rows["articles"].join(article.select(F.col("pmid").alias("dst"), F.struct(*article.columns).alias("article")), "dst")
    found = m.join(protein.select("accession", F.struct(*protein.columns).alias("protein")), "accession", "left")
    for name, df in rows.items():
        entry = F.struct(*ENTRIES.get(name, "group dst article").split())
        found = found.join(df.groupBy(F.col("src").alias("accession")).agg(F.array_sort(F.collect_list(entry)).alias(name)), "accession", "left")
    found = found.withColumns({c: F.coalesce(F.col(c), F.array().cast(found.schema[c].dataType)) for c in rows})
    articles = F.transform("articles", lambda a: a.getField("article"))
    links = F.struct("cited_in", "feature_evidenced_by").alias("article_relationships")
    return found.select("accession", F.struct("protein", "features", "feature_relationships", "go_terms", "go_relationships", articles.alias("articles"), links).alias("context"))


def sampled_context(graph: PropertyGraph, members: DataFrame) -> DataFrame:
    """(accession, context) as text.prompt_context makes it of whole contexts, without ever holding a whole list.

    Entries are counted by groups, and the first ones of every list are chosen by a group limit before the shuffle, so a
    protein with millions of them costs no more than others. Properties of articles are fetched for the chosen ones only.
    """
    m = members.select("accession").distinct()
    protein, article = graph.nodes("Protein"), graph.nodes("PubMedArticle")
    sizes = dict(SAMPLES) | {"cited_in": LINK_SAMPLE, "feature_evidenced_by": LINK_SAMPLE}
    found = m.join(protein.select("accession", F.struct(*protein.columns).alias("protein")), "accession", "left")
    for name, df in context_rows(graph, m).items():
        columns = ENTRIES[name].split() if name in ENTRIES else ["dst"]
        first = df.withColumn("place", F.row_number().over(Window.partitionBy("src").orderBy(*columns))).where(F.col("place") <= sizes[name])
        entry = F.struct(*columns)
        if name == "articles":
            first = first.join(article.select(F.col("pmid").alias("dst"), F.struct(*article.columns).alias("article")), "dst")
            entry = F.col("article")
        found = found.join(first.groupBy(F.col("src").alias("accession")).agg(F.array_sort(F.collect_list(entry)).alias(name)), "accession", "left")
        found = found.join(df.groupBy(F.col("src").alias("accession")).agg(F.count(F.lit(1)).cast("int").alias(f"n_{name}")), "accession", "left")
    lists = {c: F.coalesce(F.col(c), F.array().cast(found.schema[c].dataType)) for c in sizes}
    counts = F.struct(*(F.coalesce(f"n_{name}", F.lit(0)).alias(name) for name in sizes)).alias("counts")
    return found.withColumns(lists).select("accession", F.struct("protein", counts, *sizes).alias("context"))
