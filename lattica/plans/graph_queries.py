"""The graph engine's queries over the test tables, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lattica.functions import flatfile, records, text
from lattica.functions.nested import cross_references, one_or_many, parsed
from lattica.operators import enrich, graph, growth, interval, merge, traverse
from lattica.plans.core_problems import _FRAGMENTS, _PRODUCT, _VALID, _fold, _trim, domain_fragments, pathway_gene, product_id, pubmed_numbers, valid_score
from lattica.schemas import edge_schema, node_schema
from lattica.session import folded_id, staged, staging_path, table, trimmed
from lattica.sources.lookups import MATCH_DATABASES as DATABASES
from lattica.sources.lookups import all_matches, match_terms

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL twin."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# ---- views over the tables

_LAST = "loaded_at desc nulls last, rec_id desc"

_SQL_PROTEIN = f"""
protein as (select primaryAccession as accession, proteinDescription.recommendedName.fullName.value as name, genes[1].geneName.value as gene_name,
    organism.scientificName as organism, organism.taxonId as taxon_id, sequence.value as sequence, sequence.length as length, sequence.molWeight as mol_weight,
    coalesce(entryType like '%Swiss-Prot%' or regexp_matches(lower(entryType), '(^|[^a-z])reviewed'), false) as is_reviewed,
    list_transform(coalesce(proteinDescription.recommendedName.ecNumbers, []), lambda e: e.value) as ec_numbers
  from (select *, row_number() over (partition by primaryAccession order by {_LAST}) as rn from uniprot_entry where primaryAccession is not null) where rn = 1)
"""


def protein_batch(spark: SparkSession, sf: str) -> DataFrame:
    u = table(spark, sf, "uniprot_entry")
    d, s = F.col("proteinDescription"), F.col("sequence")
    return u.select(
        F.col("primaryAccession").alias("accession"), records.protein_name(d).alias("name"), records.gene_name(F.col("genes")).alias("gene_name"), F.col("organism.scientificName").alias("organism"),
        F.col("organism.taxonId").alias("taxon_id"), s.getField("value").alias("sequence"), s.getField("length").alias("length"), s.getField("molWeight").alias("mol_weight"),
        records.is_reviewed(F.col("entryType")).alias("is_reviewed"), records.function_text(F.col("comments")).alias("function_text"), records.ec_numbers(d).alias("ec_numbers"),
        F.struct("loaded_at", "rec_id").alias("seq"),
    )


def proteins(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merge(None, [protein_batch(spark, sf)], ["accession"], node_schema("Protein"), "seq")


_SQL_ARTICLE = f"""
article as (select * exclude (rn, pmid), {_trim('pmid')} as pmid from (select *, row_number() over (partition by {_trim('pmid')} order by {_LAST}) as rn from pubmed_article where pmid is not null) where rn = 1)
"""


def articles(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "pubmed_article")
    batch = a.select(
        trimmed("pmid").alias("pmid"), *("title", "abstract", "journal", "journal_abbrev", "year", "volume", "issue", "pages", "doi", "pmc"), records.author_names(F.col("authors")).alias("authors"),
        "mesh_terms", "publication_types", F.struct("loaded_at", "rec_id").alias("seq"),
    )
    return merge.merge(None, [batch], ["pmid"], node_schema("PubMedArticle"), "seq")


_SQL_EDGE = f"""
edge as (select a as src, b as dst, max(s) as score from (select {_fold('stringId_A')} as a, {_fold('stringId_B')} as b, {_VALID} as s from string_interaction)
  where a is not null and b is not null and a <> b and s is not null group by a, b)
"""
_SQL_PARTNERS = f"{_SQL_EDGE}, top as (select src, dst, score, row_number() over (partition by src order by score desc, dst) as rank from edge where score >= 0.7 qualify rank <= 50)"
_SQL_SEED = "seed as (select src as id from edge group by src order by count(*) desc, src limit 1)"


def best_edges(spark: SparkSession, sf: str) -> DataFrame:
    si = table(spark, sf, "string_interaction").select(folded_id("stringId_A").alias("src"), folded_id("stringId_B").alias("dst"), valid_score("score").alias("score"))
    return si.where("src is not null and dst is not null and src <> dst and score is not null").groupBy("src", "dst").agg(F.max("score").alias("score"))


def partner_ranks(spark: SparkSession, sf: str, threshold: int = 700, limit: int = 50) -> DataFrame:
    """Per protein the best `limit` partners with a score from threshold / 1000, as the ingest takes them, between network ids."""
    order = Window.partitionBy("src").orderBy(F.col("score").desc(), "dst")
    strong = best_edges(spark, sf).where(F.col("score") >= threshold / 1000)
    return strong.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def seed_of(edges: DataFrame) -> str:
    return edges.groupBy("src").count().orderBy(F.col("count").desc(), "src").first()[0]


_SQL_GO = f"""
go as (select {_PRODUCT} as src, goId as dst, goId as go_id, coalesce(qualifier, '') as qualifier, goEvidence as evidence_code, evidenceCode as eco_code, reference, assignedBy as assigned_by,
    coalesce(goEvidence, '') in ('EXP','IDA','IPI','IMP','IGI','IEP','HTP','HDA','HMP','HGI','HEP') as is_experimental, loaded_at, id from go_annotation
  where {_PRODUCT} is not null and goId is not null),
goe as (select * exclude (rn) from (select *, row_number() over (partition by src, dst, qualifier order by loaded_at desc nulls last, id desc) as rn from go) where rn = 1)
"""


def go_edges(spark: SparkSession, sf: str) -> DataFrame:
    g = table(spark, sf, "go_annotation")
    batch = g.select(
        product_id("geneProductId").alias("src"), F.col("goId").alias("dst"), F.col("goId").alias("go_id"), F.coalesce("qualifier", F.lit("")).alias("qualifier"), F.col("goEvidence").alias("evidence_code"),
        F.col("evidenceCode").alias("eco_code"), "reference", F.col("assignedBy").alias("assigned_by"), records.is_experimental(F.col("goEvidence")).alias("is_experimental"), F.struct("loaded_at", "id").alias("seq"),
    )
    return merge.merge(None, [batch], ["src", "dst", "go_id", "qualifier"], edge_schema("HAS_GO_ANNOTATION"), "seq")


_SQL_TERM = "term as (select goId as go_id, max(goName) as name, max(goAspect) as aspect from go_annotation where goId is not null group by goId)"


def terms(spark: SparkSession, sf: str) -> DataFrame:
    g = table(spark, sf, "go_annotation").where("goId is not null")
    found = g.groupBy(F.col("goId").alias("go_id")).agg(F.max("goName").alias("name"), F.max("goAspect").alias("aspect"))
    return found.select("go_id", "name", "aspect", F.lit("").alias("definition"), F.lit(False).alias("is_obsolete"))


_WHOLE = "'\\s*[+-]?[0-9]+\\s*'"
_SQL_FEATURE = f"""
{_FRAGMENTS},
hf as (select distinct accession as src, x ->> '$.metadata.accession' as dst, coalesce(fr ->> '$.start', fr ->> '$.begin')::int as "start", (fr ->> '$.end')::int as "end", loc ->> '$.model' as model
  from (select f.*, l.loc from f join l using (rec_id, n1, n2)) join (select distinct rec_id, accession from interpro_match) using (rec_id)
  where accession is not null and x ->> '$.metadata.accession' is not null
    and regexp_full_match(coalesce(fr ->> '$.start', fr ->> '$.begin'), {_WHOLE}) and regexp_full_match(fr ->> '$.end', {_WHOLE}))
"""


def feature_edges(spark: SparkSession, sf: str) -> DataFrame:
    """(src, dst, start, end, model), each once."""
    m = table(spark, sf, "interpro_match")
    rows = domain_fragments(m).withColumnRenamed("accession", "dst").join(m.select("rec_id", F.col("accession").alias("src")).distinct(), "rec_id")
    number = lambda c: trimmed(c).try_cast("int").alias(c)
    return rows.select("src", "dst", number("start"), number("end"), "model").where("src is not null and dst is not null and start is not null and end is not null").distinct()


# ---- upserts


@query(f"with {_SQL_PROTEIN} select accession, name, gene_name, organism, taxon_id, length, mol_weight, is_reviewed, array_to_string(ec_numbers, ' ') as ec_numbers from protein")
def merge_proteins(spark, sf):
    p = proteins(spark, sf)
    return p.select("accession", "name", "gene_name", "organism", "taxon_id", "length", "mol_weight", "is_reviewed", F.array_join("ec_numbers", " ").alias("ec_numbers"))


@query(f"""
with n as (select {_fold('stringId')} as accession, preferredName as name, ncbiTaxonId as taxon_id, loaded_at, queryIndex from string_mapping where stringId is not null),
l as (select * from (select *, row_number() over (partition by accession order by loaded_at desc nulls last, queryIndex desc nulls last) as rn from n) where rn = 1),
p as (select {_fold('stringId_B')} as accession from string_interaction where stringId_B is not null union select accession from l)
select accession, name, taxon_id from p left join l using (accession)
""")  # fmt: skip
def merge_node_placeholder_fill(spark, sf):
    """Known ids give names; partners that are only named in an interaction stay as keys without properties."""
    m = table(spark, sf, "string_mapping").where("stringId is not null")
    batch = m.select(folded_id("stringId").alias("accession"), F.col("preferredName").alias("name"), F.col("ncbiTaxonId").alias("taxon_id"), F.struct("loaded_at", "queryIndex").alias("seq"))
    bare = table(spark, sf, "string_interaction").select(folded_id("stringId_B").alias("accession"))
    merged = merge.merge(None, [batch, bare], ["accession"], node_schema("Protein"), "seq")
    return merged.select("accession", "name", "taxon_id")


@query(f"with {_SQL_GO} select src, dst, qualifier, evidence_code, eco_code, reference, assigned_by, is_experimental from goe")
def merge_last_wins_go(spark, sf):
    return go_edges(spark, sf).drop("go_id")


@query(f"with {_SQL_FEATURE} select src, dst, \"start\", \"end\", max(model) as model from hf group by all")
def merge_has_feature(spark, sf):
    batch = feature_edges(spark, sf).withColumn("seq", F.col("model"))
    return merge.merge(None, [batch], ["src", "dst", "start", "end"], edge_schema("HAS_FEATURE"), "seq").select("src", "dst", "start", "end", "model")


@query(f"with {_SQL_EDGE}, m as (select distinct {_fold('stringId')} as id from string_mapping where stringId is not null) select src, dst, score from edge where src in (select id from m) and dst in (select id from m)")
def edge_drop_dangling(spark, sf):
    known = table(spark, sf, "string_mapping").select(folded_id("stringId").alias("accession")).where("accession is not null")
    return merge.with_endpoints(best_edges(spark, sf), known, "accession", known, "accession")


@query(f"with {_SQL_EDGE} select least(src, dst) || ':' || greatest(src, dst) as string_pair, count(*) as n_edges, max(score) as best from edge group by 1")
def ppi_string_pair(spark, sf):
    return best_edges(spark, sf).groupBy(records.string_pair(F.col("src"), F.col("dst")).alias("string_pair")).agg(F.count(F.lit(1)).alias("n_edges"), F.max("score").alias("best"))


@query("""
with u as (select 'Protein' as label, count(distinct primaryAccession) as cnt from uniprot_entry union all select 'GOTerm', count(distinct goId) from go_annotation
  union all select 'PubMedArticle', count(distinct trim(pmid)) from pubmed_article union all select 'Pathway', count(distinct entry_id) from kegg_pathway)
select label, cnt from u where cnt > 0
""")
def counts_by_label(spark, sf):
    g = graph.PropertyGraph(spark)
    g.tables = {"Protein": proteins(spark, sf), "GOTerm": terms(spark, sf), "PubMedArticle": articles(spark, sf), "Pathway": table(spark, sf, "kegg_pathway").select(F.col("entry_id").alias("kegg_id")).where("kegg_id is not null").distinct()}
    return g.counts()


# ---- pattern reads


@query(f"with {_SQL_EDGE} select src, dst, score from edge where score >= 0.7 qualify row_number() over (partition by src order by score desc, dst) <= 10")
def ppi_topk(spark, sf):
    order = Window.partitionBy("src").orderBy(F.col("score").desc(), "dst")
    strong = best_edges(spark, sf).where(records.is_high_confidence(F.col("score")))
    return strong.withColumn("n", F.row_number().over(order)).where("n <= 10").drop("n")


_SQL_MEMBERS = f"members as (select distinct {_fold('stringId')} as id from string_mapping where stringId is not null)"


def members(spark: SparkSession, sf: str) -> DataFrame:
    """Every known id."""
    return table(spark, sf, "string_mapping").where("stringId is not null").select(folded_id("stringId").alias("accession")).distinct()


@query(f"with {_SQL_EDGE}, {_SQL_MEMBERS}, i as (select * from edge where src in (select id from members) and dst in (select id from members)) select src, dst, score from i union all select dst, src, score from i")
def induced_edges_doubled(spark, sf):
    return graph.induced_edges(best_edges(spark, sf), members(spark, sf))


@query(f"with {_SQL_EDGE}, {_SQL_MEMBERS} select src, dst, score from edge where src in (select id from members) and dst in (select id from members)")
def induced_edges_distinct(spark, sf):
    return graph.induced_edges(best_edges(spark, sf), members(spark, sf), distinct=True)


@query(f"""
with {_SQL_EDGE}, m as (select distinct ncbiTaxonId as taxon_id, {_fold('stringId')} as id from string_mapping where ncbiTaxonId is not null and stringId is not null)
select a.taxon_id, src, dst, score from edge join m a on a.id = src join m b on b.id = dst and b.taxon_id = a.taxon_id
""")  # fmt: skip
def induced_edges_by_taxon(spark, sf):
    """Stored edges inside every taxon, with the taxon as key."""
    known = table(spark, sf, "string_mapping").select(F.col("ncbiTaxonId").alias("taxon_id"), folded_id("stringId").alias("accession")).where("taxon_id is not null and accession is not null").distinct()
    starts = best_edges(spark, sf).join(known.withColumnRenamed("accession", "src"), "src")
    return starts.join(known.withColumnRenamed("accession", "dst"), ["taxon_id", "dst"]).select("taxon_id", "src", "dst", "score")


@query(f"""
with {_SQL_EDGE}, {_SQL_SEED},
bothways as (select src, dst, score from edge union all select dst, src, score from edge),
b as (select dst as accession, max(score) as score from bothways where src = (select id from seed) group by dst order by score desc, accession limit 4)
select id as accession, null::double as score from seed union all select * from b
""")  # fmt: skip
def partners_of_seed(spark, sf):
    e = best_edges(spark, sf)
    return graph.partners(e.select(F.col("src").alias("accession")).distinct(), e, seed_of(e), 5).select("accession", "score")


@query(f"""
with recursive {_SQL_EDGE}, {_SQL_SEED},
bothways as (select src, dst from edge union select dst, src from edge),
w as (select id, 0 as hops from seed union select b.dst, w.hops + 1 from w join bothways b on b.src = w.id where w.hops < 3),
r as (select id as accession, min(hops) as hops from w group by id having min(hops) > 0)
select accession, hops from r where accession <> (select id from seed)
""")  # fmt: skip
def neighbors_khop(spark, sf):
    """What the protein with the most partners reaches within three hops over every edge."""
    e = best_edges(spark, sf)
    found = traverse.neighbors(e.select("src", "dst"), spark.createDataFrame([(seed_of(e),)], "accession string"), 3)
    return found.where(F.col("accession") != F.col("start")).select("accession", "hops")


@query(f"""
with {_SQL_EDGE}, pair as (select distinct a.src as start from edge a join edge b on a.src = b.dst and a.dst = b.src) select start, 2 as hops from pair
""")  # fmt: skip
def neighbors_closed_trail(spark, sf):
    """Every protein that two parallel edges, one in each direction, lead back to."""
    e = best_edges(spark, sf)
    found = traverse.neighbors(e.select("src", "dst"), e.select(F.col("src").alias("accession")), 2, closed_only=True)
    return found.select("start", "hops")


_SQL_BFS = f"""
with recursive {_SQL_PARTNERS}, {_SQL_SEED},
w as (select id, 0 as level from seed union select t.dst, w.level + 1 from w join top t on t.src = w.id where w.level < 30),
lev as (select id, min(level) as level from w group by id)
"""


def expansion(spark: SparkSession, sf: str, cap: int | None = None) -> traverse.Expansion:
    """Growth from the protein with the most partners over the partners the ingest takes (score from 0.7, at most 50)."""
    return traverse.expand(partner_ranks(spark, sf).select("src", "dst", "rank"), [seed_of(best_edges(spark, sf))], cap)


@query(f"{_SQL_BFS} select id as accession, level from lev")
def bfs_levels(spark, sf):
    return expansion(spark, sf).order.select("accession", "level")


@query(f"{_SQL_BFS} select level, count(*) as n from lev group by level")
def bfs_stats(spark, sf):
    return expansion(spark, sf).order.groupBy("level").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
with {_SQL_PARTNERS}, {_SQL_SEED},
first as (select dst as id, rank + 1 as seq from top where src = (select id from seed) and dst <> (select id from seed)),
numbered as (select id, row_number() over (order by seq) + 1 as seq from first),
met as (select t.dst as id, min((n.seq, t.rank)) as place from numbered n join top t on t.src = n.id where n.seq <= 40 and t.dst <> (select id from seed) and t.dst not in (select id from numbered) group by t.dst),
q as (select id, 1 as seq, 0 as level from seed union all select id, seq, 1 from numbered
  union all select id, (select count(*) from numbered) + 1 + row_number() over (order by place), 2 from met)
select id as accession, seq::bigint as seq, level::int as level, seq <= 40 as processed from q
""")  # fmt: skip
def bfs_capped(spark, sf):
    """The queue of a growth of which the first 40 proteins are processed; the twin holds for a first protein with 39 partners or more."""
    return expansion(spark, sf, 40).order


@query("""
with n as (
  select 'Protein' as label, primaryAccession as k, loaded_at from uniprot_entry union all select 'GOTerm', goId, loaded_at from go_annotation
  union all select 'PubMedArticle', trim(pmid), loaded_at from pubmed_article),
f as (select label, k, min(year(loaded_at) * 12 + month(loaded_at) - 1) as seq from n where k is not null and loaded_at is not null group by all),
c as (select label, seq, count(*) as n from f group by all), s as (select distinct seq from c), l as (select distinct label from c)
select label, seq::int as seq, sum(coalesce(n, 0)) over (partition by label order by seq)::bigint as total from l cross join s left join c using (label, seq)
""")
def growth_cumulative(spark, sf):
    month = (F.year("loaded_at") * 12 + F.month("loaded_at") - 1).alias("seq")
    parts = []
    for label, name, key in (("Protein", "uniprot_entry", F.col("primaryAccession")), ("GOTerm", "go_annotation", F.col("goId")), ("PubMedArticle", "pubmed_article", trimmed("pmid"))):
        rows = table(spark, sf, name).select(key.alias("k"), month).where("k is not null and seq is not null")
        parts.append(growth.first_seen(rows, ["k"], label))
    new = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return growth.cumulative(new, new.select("seq"), ["Protein", "GOTerm", "PubMedArticle"])


@query(f"with {_SQL_FEATURE}, {_SQL_PROTEIN} select src, dst, \"start\", \"end\", p.name as protein_name from (select distinct src, dst, \"start\", \"end\" from hf) join protein p on p.accession = src")
def features_of_protein(spark, sf):
    p = proteins(spark, sf).select(F.col("accession").alias("src"), F.col("name").alias("protein_name"))
    return feature_edges(spark, sf).drop("model").distinct().join(p, "src")


@query(f"with {_SQL_GO}, {_SQL_TERM} select src, dst, qualifier, name, case aspect when 'molecular_function' then 'MF' when 'biological_process' then 'BP' when 'cellular_component' then 'CC' else '?' end as aspect from goe join term on term.go_id = dst")
def go_of_protein(spark, sf):
    t = terms(spark, sf).select(F.col("go_id").alias("dst"), "name", records.aspect_short(F.col("aspect")).alias("aspect"))
    return go_edges(spark, sf).select("src", "dst", "qualifier").join(t, "dst")


_SQL_CITED = f"cited as (select distinct {_PRODUCT} as src, unnest(regexp_extract_all(reference, '(?i)PMID[:\\s]*([0-9]+)', 1)) as dst from go_annotation where {_PRODUCT} is not null)"


def cited_edges(spark: SparkSession, sf: str) -> DataFrame:
    g = table(spark, sf, "go_annotation").select(product_id("geneProductId").alias("src"), F.explode(pubmed_numbers("reference")).alias("dst"))
    return g.where("src is not null").distinct()


@query(f"with {_SQL_CITED}, {_SQL_ARTICLE} select src, dst, title, journal, year from cited join article on pmid = dst")
def cited_articles(spark, sf):
    a = articles(spark, sf).select(F.col("pmid").alias("dst"), "title", "journal", "year")
    return cited_edges(spark, sf).join(a, "dst").select("src", "dst", "title", "journal", "year")


@query(f"""
with {_SQL_FEATURE}, {_SQL_CITED}, ev as (select distinct hf.dst as feature, cited.dst as article from hf join cited on hf.src = cited.src),
chain as (select h.src as protein, ev.article from (select distinct src, dst, "start", "end" from hf) h join ev on ev.feature = h.dst)
select protein, count(*) as n_rows, count(distinct article) as n_articles from chain group by protein
""")  # fmt: skip
def evidence_chain(spark, sf):
    """protein -> feature -> article: the feature's evidence is shared by all its proteins, and repeats per location."""
    hf, cited = feature_edges(spark, sf).drop("model").distinct(), cited_edges(spark, sf)
    ev = hf.select("src", F.col("dst").alias("feature")).join(cited.withColumnRenamed("dst", "article"), "src").select("feature", "article").distinct()
    chain = hf.select(F.col("src").alias("protein"), F.col("dst").alias("feature")).join(ev, "feature")
    return chain.groupBy("protein").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("article").alias("n_articles"))


def small_graph(spark: SparkSession, sf: str) -> graph.PropertyGraph:
    g = graph.PropertyGraph(spark)
    m = table(spark, sf, "interpro_match")
    feature = domain_fragments(m).select("accession").where("accession is not null").distinct()
    g.tables = {
        "Protein": proteins(spark, sf), "GOTerm": terms(spark, sf), "PubMedArticle": articles(spark, sf),
        "ProteinFeature": feature.select("accession", *(F.lit("").alias(c) for c in ("name", "source_database", "type", "integrated"))),
        "HAS_FEATURE": feature_edges(spark, sf).select("src", "dst", "start", "end", F.lit(None).cast("double").alias("score"), "model"),
        "HAS_GO_ANNOTATION": go_edges(spark, sf), "CITED_IN": cited_edges(spark, sf),
    }
    return g


@query(f"""
with {_SQL_PROTEIN}, {_SQL_FEATURE}, {_SQL_GO}, {_SQL_CITED}, {_SQL_ARTICLE},
nf as (select src, count(*) as n from hf group by src), nt as (select src, count(*) as n from goe group by src), nc as (select src, count(*) as n from cited join article on pmid = dst group by src)
select accession, coalesce(nf.n, 0)::int as n_features, coalesce(nt.n, 0)::int as n_terms, coalesce(nc.n, 0)::int as n_cited
from protein left join nf on nf.src = accession left join nt on nt.src = accession left join nc on nc.src = accession
""")  # fmt: skip
def context_counts(spark, sf):
    g = small_graph(spark, sf)
    n = graph.context_counts(g, g.accessions())
    return n.select("accession", *(F.col(c).cast("int").alias(c) for c in ("n_features", "n_terms", "n_cited")))


@query()
def prompt_render(spark, sf):
    """A completion for every protein, by the offline stand-in."""
    from lattica.operators.complete import describe_sampled

    g = small_graph(spark, sf)
    return describe_sampled(graph.sampled_context(g, g.accessions())).select("accession", F.length("prompt").alias("prompt_length"), "completion")


@query(f"""
with {_SQL_PROTEIN}, q as (select distinct preferredName as gene_name, ncbiTaxonId as taxon_id from string_mapping where preferredName is not null and ncbiTaxonId is not null)
select q.gene_name, q.taxon_id, p.accession from q left join (select *, row_number() over (partition by gene_name, taxon_id order by is_reviewed desc, accession) as rn from protein) p
  on p.gene_name = q.gene_name and p.taxon_id = q.taxon_id and rn = 1
""")  # fmt: skip
def resolve_gene_taxon(spark, sf):
    order = Window.partitionBy("gene_name", "taxon_id").orderBy(F.col("is_reviewed").desc(), "accession")
    dim = proteins(spark, sf).where("gene_name is not null").withColumn("n", F.row_number().over(order)).where("n = 1").select("gene_name", "taxon_id", "accession")
    q = table(spark, sf, "string_mapping").select(F.col("preferredName").alias("gene_name"), F.col("ncbiTaxonId").alias("taxon_id")).where("gene_name is not null and taxon_id is not null").distinct()
    return q.join(dim, ["gene_name", "taxon_id"], "left")


@query("""
with t as (select goId, max(goName) as name from go_annotation where goName is not null group by goId),
a as (select distinct goId as go_id, coalesce(goAspect, '') as aspect from go_annotation where goId is not null)
select go_id, coalesce(name, go_id) as name, aspect, name is null as is_fallback from a left join t on t.goId = go_id
""")
def term_fallback_join(spark, sf):
    g = table(spark, sf, "go_annotation")
    t = g.where("goName is not null").groupBy(F.col("goId").alias("go_id")).agg(F.max("goName").alias("found"))
    a = g.where("goId is not null").select(F.col("goId").alias("go_id"), F.coalesce("goAspect", F.lit("")).alias("aspect")).distinct()
    return a.join(t, "go_id", "left").select("go_id", F.coalesce("found", "go_id").alias("name"), "aspect", F.col("found").isNull().alias("is_fallback"))


_SQL_PATHWAY = f"""
pg as (select distinct entry_id, case when regexp_matches(g, '^[0-9]') then lower(left(entry_id, 3)) || ':' || regexp_extract(g, '^[0-9]+') else regexp_extract(g, '^[a-z][a-z0-9]*:[0-9]+') end as gene
  from (select entry_id, lower({_trim('g')}) as g from (select entry_id, unnest(genes) as g from kegg_pathway)) where g is not null),
cv as (select distinct lower({_trim('entry_id')}) as gene, regexp_replace(uniprot_id, '^up:', '') as accession from kegg_conv where uniprot_id is not null)
"""


def pathway_genes(spark: SparkSession, sf: str) -> DataFrame:
    kp = table(spark, sf, "kegg_pathway").select("entry_id", F.explode("genes").alias("g"))
    return kp.select("entry_id", pathway_gene(F.col("g"), F.col("entry_id")).alias("gene")).where("gene is not null").distinct()


def converted(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "kegg_conv").where("uniprot_id is not null")
    return c.select(F.lower(trimmed("entry_id")).alias("gene"), F.regexp_replace("uniprot_id", "^up:", "").alias("accession")).distinct()


@query(f"with {_SQL_PATHWAY} select distinct entry_id as pathway, accession from pg join cv using (gene)")
def pathway_members(spark, sf):
    return pathway_genes(spark, sf).join(converted(spark, sf), "gene").select(F.col("entry_id").alias("pathway"), "accession").distinct()


@query(f"""
with {_SQL_PATHWAY}, {_SQL_PROTEIN}, e as (select accession, unnest(ec_numbers) as ec from protein union select accession, '1.1.1.' || right(accession, 1) from cv),
m as (select distinct entry_id as pathway, accession, ec from pg join cv using (gene) join e using (accession))
select a.accession as src, b.accession as dst, a.ec as ec_number, a.pathway as pathway_id from m a join m b on a.pathway = b.pathway and a.ec = b.ec and a.accession < b.accession
""")  # fmt: skip
def enzymatic_pairs(spark, sf):
    """Proteins that share a pathway and an enzyme number; beside those of the entries, every known gene has one by its last character."""
    known = converted(spark, sf)
    planted = known.select("accession", F.concat(F.lit("1.1.1."), F.right("accession", F.lit(1))).alias("ec_number"))
    e = proteins(spark, sf).select("accession", F.explode("ec_numbers").alias("ec_number")).unionByName(planted).distinct()
    m = pathway_genes(spark, sf).join(known, "gene").join(e, "accession").select(F.col("entry_id").alias("pathway_id"), "accession", "ec_number").distinct()
    a, b = m.withColumnRenamed("accession", "src"), m.withColumnRenamed("accession", "dst")
    return a.join(b, ["pathway_id", "ec_number"]).where("src < dst").select("src", "dst", "ec_number", "pathway_id")


@query(f"""
with {_SQL_EDGE}, {_SQL_GO}, {_SQL_CITED},
u as (select 'Protein' as src_label, src, 'INTERACTS_WITH' as type, 'Protein' as dst_label, dst from edge union all
  select 'Protein', src, 'HAS_GO_ANNOTATION', 'GOTerm', dst from goe union all select 'Protein', src, 'CITED_IN', 'PubMedArticle', dst from cited)
select * from u order by type, src, dst limit 100
""")  # fmt: skip
def heterogeneous_edges(spark, sf):
    g = graph.PropertyGraph(spark)
    g.tables = {"INTERACTS_WITH": best_edges(spark, sf), "HAS_GO_ANNOTATION": go_edges(spark, sf), "CITED_IN": cited_edges(spark, sf)}
    return g.all_edges().orderBy("type", "src", "dst").limit(100)


@query(f"with {_SQL_PROTEIN} select distinct {_PRODUCT} as accession from go_annotation where {_PRODUCT} is not null and {_PRODUCT} not in (select accession from protein)")
def missing_accessions(spark, sf):
    asked = table(spark, sf, "go_annotation").select(product_id("geneProductId").alias("accession")).where("accession is not null").distinct()
    return asked.join(proteins(spark, sf).select("accession"), "accession", "left_anti")


@query(f"with {_SQL_EDGE} select src, dst, score from edge order by src, dst limit 25")
def ppi_sample(spark, sf):
    """The demo's sample of 25 interactions."""
    return best_edges(spark, sf).orderBy("src", "dst").limit(25)


_SQL_XREFS = f"""
xr as (select {_trim('primaryAccession')} as accession, unnest(case when uniProtKBCrossReferences is not null then list_transform(uniProtKBCrossReferences, lambda x: {{'d': x.database, 'i': x.id}})
  else list_transform(json_extract(dbReferences, '$[*]'), lambda x: {{'d': coalesce(x ->> '$.database', x ->> '$.type'), 'i': x ->> '$.id'}}) end) as x from uniprot_entry where primaryAccession is not null),
pdb as (select distinct accession, x.i as id from xr where x.d = 'PDB' and x.i is not null), af as (select distinct accession, x.i as id from xr where x.d = 'AlphaFoldDB' and x.i is not null)
"""


def reference_ids(spark: SparkSession, sf: str, database: str) -> DataFrame:
    """(accession, id) of the cross-references of all versions of an entry to one database."""
    u = table(spark, sf, "uniprot_entry").where("primaryAccession is not null")
    refs = cross_references(F.col("uniProtKBCrossReferences"), F.col("dbReferences"))
    return u.select(trimmed("primaryAccession").alias("accession"), F.explode(records.ref_ids(refs, database)).alias("id")).where("id is not null").distinct()


@query(f"""
with {_SQL_XREFS}, p as (select accession, list(id order by id) as ids from pdb group by accession), f as (select accession, list(id order by id) as ids from af group by accession)
select accession, array_to_string(p.ids, ' ') as pdb_ids, 'https://files.rcsb.org/download/' || p.ids[1] || '.cif' as first_cif, coalesce(array_to_string(f.ids, ' '), '') as alphafold_entry_ids,
  coalesce('https://alphafold.ebi.ac.uk/files/AF-' || f.ids[1] || '-F1-model_v4.pdb', '') as alphafold_pdb_url from p left join f using (accession)
""")  # fmt: skip
def protein_structures(spark, sf):
    """The demo's proteins with structures, from the properties that the ingest gives a protein."""
    from lattica.operators.ingest import structure_properties

    pdb, af = reference_ids(spark, sf, "PDB"), reference_ids(spark, sf, "AlphaFoldDB")
    file = lambda form: F.concat(F.lit("https://alphafold.ebi.ac.uk/files/AF-"), F.col("id"), F.lit(f"-F1-model_v4.{form}"))
    predictions = af.select(F.col("accession").alias("uniprotAccession"), F.col("id").alias("entryId"), file("cif").alias("cifUrl"), file("pdb").alias("pdbUrl"))
    found = structure_properties(proteins(spark, sf), pdb.select("accession", F.col("id").alias("entry_id"), F.lit(1).alias("place")), predictions)
    some = found.where(F.size("pdb_ids") > 0)
    return some.select("accession", F.array_join("pdb_ids", " ").alias("pdb_ids"), records.first(F.col("pdb_cif_urls")).alias("first_cif"), F.array_join("alphafold_entry_ids", " ").alias("alphafold_entry_ids"), "alphafold_pdb_url")


@query(f"with {_SQL_ARTICLE} select pmid, 'https://pubmed.ncbi.nlm.nih.gov/' || pmid || '/' as pubmed_url, coalesce('text of ' || nullif(pmc, ''), '') as full_text from article")
def article_nodes(spark, sf):
    """Articles with their address and the full text of their pmc, here a made one."""
    from lattica.operators.ingest import article_table

    a = articles(spark, sf)
    texts = a.where("pmc <> ''").select("pmc", F.concat(F.lit("text of "), F.col("pmc")).alias("full_text")).distinct()
    return article_table(a, texts).select("pmid", "pubmed_url", "full_text")


# ---- records and functions

_CHANNELS = ", ".join(f"coalesce({c}, 0)" for c, _ in records.CHANNELS)


@query("select distinct interaction_id, case " + " ".join(f"when coalesce({c}, 0) = greatest({_CHANNELS}) then '{n}'" for c, n in records.CHANNELS) + " end as dominant_source from string_interaction")
def dominant_channel(spark, sf):
    return table(spark, sf, "string_interaction").select("interaction_id", records.dominant_source().alias("dominant_source")).distinct()


@query("""
select case goAspect when 'molecular_function' then 'MF' when 'biological_process' then 'BP' when 'cellular_component' then 'CC' else '?' end as aspect,
  coalesce(goEvidence, '') in ('EXP','IDA','IPI','IMP','IGI','IEP','HTP','HDA','HMP','HGI','HEP') as is_experimental, count(*) as n from go_annotation group by all
""")
def annotation_kinds(spark, sf):
    g = table(spark, sf, "go_annotation")
    return g.groupBy(records.aspect_short(F.col("goAspect")).alias("aspect"), records.is_experimental(F.col("goEvidence")).alias("is_experimental")).agg(F.count(F.lit(1)).alias("n"))


@query("select distinct id, array_to_string(list_sort(list_distinct(regexp_extract_all(coalesce(reference, ''), '(?i)PMID[:\\s]?(\\d+)', 1))), ' ') as pmids, case when starts_with(reference, 'PMID:') then replace(reference, 'PMID:', '') end as pmid from go_annotation")
def pmid_extract(spark, sf):
    g = table(spark, sf, "go_annotation")
    return g.select("id", F.array_join(text.pmids(F.col("reference")), " ").alias("pmids"), records.pmid(F.col("reference")).alias("pmid")).distinct()


@query("""
with u as (select distinct rec_id, case when uniProtKBCrossReferences is not null then list_transform(uniProtKBCrossReferences, lambda x: {'d': x.database, 'i': x.id})
  else list_transform(json_extract(dbReferences, '$[*]'), lambda x: {'d': coalesce(x ->> '$.database', x ->> '$.type'), 'i': x ->> '$.id'}) end as xs from uniprot_entry),
l as (select rec_id, coalesce(xs, []) as xs from u)
select rec_id, array_to_string(list_transform(list_filter(xs, lambda x: x.d = 'PDB'), lambda x: x.i), ' ') as pdb_ids, array_to_string(list_transform(list_filter(xs, lambda x: x.d = 'AlphaFoldDB'), lambda x: x.i), ' ') as alphafold_ids,
  list_filter(xs, lambda x: x.d = 'STRING')[1].i as string_id, len(list_filter(xs, lambda x: x.d = 'GO'))::int as n_go, 'https://files.rcsb.org/download/' || list_filter(xs, lambda x: x.d = 'PDB')[1].i || '.cif' as first_file from l
""")
def xref_filter_transform(spark, sf):
    u = table(spark, sf, "uniprot_entry").withColumn("x", cross_references(F.col("uniProtKBCrossReferences"), F.col("dbReferences")))
    x = F.col("x")
    pdb = records.ref_ids(x, "PDB")
    return u.select(
        "rec_id", F.array_join(pdb, " ").alias("pdb_ids"), F.array_join(records.ref_ids(x, "AlphaFold", "AlphaFoldDB"), " ").alias("alphafold_ids"), records.first(records.ref_ids(x, "STRING")).alias("string_id"),
        F.size(records.ref_ids(x, "GO")).alias("n_go"), records.first(records.urls(records.STRUCTURE_FILE, pdb, ".cif")).alias("first_file"),
    ).distinct()


@query("""
select distinct rec_id, genes[1].geneName.value as gene_name, proteinDescription.recommendedName.fullName.value as protein_name,
  case when len(list_filter(comments, lambda c: c.commentType = 'FUNCTION' and len(c.texts) > 0)) > 0 then coalesce(list_filter(comments, lambda c: c.commentType = 'FUNCTION' and len(c.texts) > 0)[1].texts[1].value, '') end as function_text,
  array_to_string(list_transform(coalesce(proteinDescription.recommendedName.ecNumbers, []), lambda e: e.value), ' ') as ec_numbers,
  coalesce(entryType like '%Swiss-Prot%' or regexp_matches(lower(entryType), '(^|[^a-z])reviewed'), false) as is_reviewed from uniprot_entry
""")
def record_accessors(spark, sf):
    u = table(spark, sf, "uniprot_entry")
    d = F.col("proteinDescription")
    return u.select("rec_id", records.gene_name(F.col("genes")).alias("gene_name"), records.protein_name(d).alias("protein_name"), records.function_text(F.col("comments")).alias("function_text"), F.array_join(records.ec_numbers(d), " ").alias("ec_numbers"), records.is_reviewed(F.col("entryType")).alias("is_reviewed")).distinct()


@query("select distinct rec_id, struct.title as title, rcsb_entry_info.resolution_combined[1] as resolution, rcsb_entry_info.experimental_method as experimental_method from pdb_entry")
def structure_accessors(spark, sf):
    p = table(spark, sf, "pdb_entry")
    return p.select("rec_id", F.col("struct.title").alias("title"), records.first(F.col("rcsb_entry_info.resolution_combined")).alias("resolution"), F.col("rcsb_entry_info.experimental_method").alias("experimental_method")).distinct()


@query("""
with n as (select distinct rec_id, list_transform(authors, lambda a: array_to_string(list_filter([nullif(a.last_name, ''), nullif(a.fore_name, '')], lambda x: x is not null), ' ')) as names, title, journal, journal_abbrev, year from pubmed_article)
select rec_id, coalesce(array_to_string(names[1:3], ', '), '') || case when len(names) > 3 then ' et al.' else '' end || '. ' || coalesce(title, '') || '. ' || coalesce(nullif(journal_abbrev, ''), nullif(journal, ''), '') || '. ' || coalesce(year, '') || '.' as citation from n
""")
def article_citation(spark, sf):
    a = table(spark, sf, "pubmed_article")
    return a.select("rec_id", records.citation(F.col("authors"), F.col("title"), F.col("journal_abbrev"), F.col("journal"), F.col("year")).alias("citation")).distinct()


@query(f"with {_SQL_ARTICLE} select pmid, title, journal, year, doi, pmc from article")
def articles_dedup(spark, sf):
    return articles(spark, sf).select("pmid", "title", "journal", "year", "doi", "pmc")


@query("select distinct rec_id, trim(regexp_replace(title, '[^A-Za-z0-9._-]+', '_', 'g'), '_') as name from pubmed_article")
def safe_names(spark, sf):
    return table(spark, sf, "pubmed_article").select("rec_id", text.safe_name(F.col("title")).alias("name")).distinct()


@query("select doc_id, substring(text, 1, 1200) as excerpt, coalesce(length(text), 0)::int as characters from documents")
def excerpt_and_length(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.excerpt(F.col("text")).alias("e")).select("doc_id", "e.*")


@query("""
with k as (select distinct entry_id, raw from kegg_pathway where raw is not null),
l as (select entry_id, raw, unnest(string_split(raw, chr(10))) as line, unnest(range(len(string_split(raw, chr(10))))) as pos from k),
e as (select *, max(case when starts_with(line, '///') then 1 else 0 end) over (partition by entry_id, raw order by pos) as ended, case when regexp_matches(line, '^\\S') then regexp_extract(line, '^\\S+') end as opens from l),
s as (select *, last_value(opens ignore nulls) over (partition by entry_id, raw order by pos) as section, trim(case when opens is not null then regexp_replace(line, '^\\S+', '') else line end) as body from e where ended = 0),
t as (select entry_id, raw, section, count(*) as n, string_agg(string_split_regex(body, '\\s+')[1], ' ' order by pos) as firsts from s where section is not null and body <> '' group by all)
select entry_id, section, n, firsts from t
""")
def flatfile_sections(spark, sf):
    k = table(spark, sf, "kegg_pathway").select("entry_id", "raw").where("raw is not null").distinct()
    s = k.select("entry_id", "raw", F.posexplode(flatfile.sections(F.col("raw"))).alias("pos", "x"))
    first = F.get(flatfile.tokens(F.col("x.line")), F.lit(0))
    listed = F.array_sort(F.collect_list(F.struct("pos", first.alias("t"))))
    return s.groupBy("entry_id", "raw", F.col("x.name").alias("section")).agg(F.count(F.lit(1)).alias("n"), F.array_join(F.transform(listed, lambda y: y.getField("t")), " ").alias("firsts")).drop("raw")


@query("""
with b as (select distinct rec_id, payload from interpro_match where payload is not null and json_valid(payload)),
r as (select rec_id, unnest(json_extract(payload, '$.results[*]')) as x, unnest(range(len(json_extract(payload, '$.results[*]'))))::int as n1 from b)
select rec_id, n1, x ->> '$.metadata.accession' as accession, x ->> '$.metadata.source_database' as source_database, x ->> '$.metadata.integrated' as integrated,
  coalesce(array_to_string(list_transform(json_extract(x, '$.metadata.go_terms[*]'), lambda t: t ->> '$.identifier'), ' '), '') as go_terms from r
""")
def json_members(spark, sf):
    m = table(spark, sf, "interpro_match").select("rec_id", "payload").distinct()
    r = m.select("rec_id", F.posexplode(F.try_variant_get(parsed(F.col("payload")), "$.results", "array<variant>")).alias("n1", "x"))
    get = lambda p, kind="string": F.try_variant_get("x", f"$.metadata.{p}", kind)
    go = F.transform(get("go_terms", "array<variant>"), lambda t: F.try_variant_get(t, "$.identifier", "string"))
    return r.select("rec_id", "n1", get("accession").alias("accession"), get("source_database").alias("source_database"), get("integrated").alias("integrated"), F.coalesce(F.array_join(go, " "), F.lit("")).alias("go_terms"))


@query("""
with b as (select distinct rec_id, accession, payload from interpro_match where payload is not null and json_valid(payload)),
r as (select rec_id, accession as protein, unnest(json_extract(payload, '$.results[*]')) as x, unnest(range(len(json_extract(payload, '$.results[*]'))))::int as n1 from b),
d as (select rec_id, protein, x ->> '$.metadata.accession' as entry, list_position(['interpro', 'pfam', 'smart', 'prosite'], x ->> '$.metadata.source_database') as place, n1, x ->> '$.metadata.name' as name from r)
select rec_id, protein, entry, name from d where place is not null and entry is not null qualify row_number() over (partition by rec_id, entry order by place, n1) = 1
""")
def matches_first_wins(spark, sf):
    """The entries of a page from four databases, in their order; the first of one accession counts."""
    found = all_matches(match_results(spark, sf), ["rec_id", "protein"], DATABASES)
    return found.select("rec_id", "protein", "entry", "name")


def match_results(spark: SparkSession, sf: str) -> DataFrame:
    """(rec_id, protein, place, database, entry, name, terms) of every result of every page."""
    m = table(spark, sf, "interpro_match").select("rec_id", F.col("accession").alias("protein"), "payload").distinct()
    r = m.select("rec_id", "protein", F.posexplode(F.try_variant_get(parsed(F.col("payload")), "$.results", "array<variant>")).alias("place", "x"))
    get = lambda p, kind="string": F.try_variant_get("x", f"$.metadata.{p}", kind)
    terms = F.transform(get("go_terms", "array<variant>"), lambda t: F.struct(F.try_variant_get(t, "$.identifier", "string").alias("identifier"), F.try_variant_get(t, "$.name", "string").alias("name")))
    return r.select("rec_id", "protein", "place", get("source_database").alias("database"), get("accession").alias("entry"), get("name").alias("name"), terms.alias("terms"))


@query("""
with b as (select distinct rec_id, payload from interpro_match where payload is not null and json_valid(payload)),
r as (select rec_id, unnest(json_extract(payload, '$.results[*]')) as x, unnest(range(len(json_extract(payload, '$.results[*]'))))::int as place from b),
t as (select rec_id, place, unnest(json_extract(x, '$.metadata.go_terms[*]')) as t, unnest(range(len(json_extract(x, '$.metadata.go_terms[*]')))) as pos from r)
select rec_id, t ->> '$.identifier' as identifier, max_by(t ->> '$.name', place * 1000 + pos) as name from t where t ->> '$.identifier' is not null group by all
""")
def terms_of_matches(spark, sf):
    """The terms that the matches of a page bring along; of repeated ones the last name counts."""
    return match_terms(match_results(spark, sf), ["rec_id"])


@query("""
with b as (select distinct rec_id, payload from interpro_match where payload is not null and json_valid(payload)),
r as (select rec_id, unnest(json_extract(payload, '$.results[*]')) as x, unnest(range(len(json_extract(payload, '$.results[*]'))))::int as n1 from b),
p as (select rec_id, n1, case json_type(x, '$.proteins') when 'ARRAY' then json_extract(x, '$.proteins[0].protein_length') when 'OBJECT' then json_extract(x, '$.proteins.protein_length') end as len from r)
select rec_id, n1, last_value(case when json_type(len) <> 'NULL' then len::int end ignore nulls) over (partition by rec_id order by n1) as protein_length from p
""")
def protein_length_carry(spark, sf):
    """The protein's length of each result; a result without one takes that of the result before."""
    m = table(spark, sf, "interpro_match").select("rec_id", "payload").distinct()
    r = m.select("rec_id", F.posexplode(F.try_variant_get(parsed(F.col("payload")), "$.results", "array<variant>")).alias("n1", "x"))
    own = F.try_variant_get(records.first(one_or_many(F.col("x"), "proteins")), "$.protein_length", "int")
    return r.select("rec_id", "n1", F.last(own, ignorenulls=True).over(Window.partitionBy("rec_id").orderBy("n1")).alias("protein_length"))


@query("""
with c as (select lower(trim(entry_id)) as gene_id, regexp_replace(uniprot_id, '^up:', '') as accession, loaded_at from kegg_conv where uniprot_id is not null and entry_id is not null)
select accession, min_by(gene_id, (loaded_at, gene_id)) as gene_id from c group by accession
""")
def first_conversion(spark, sf):
    from lattica.sources.readers import conversions

    c = table(spark, sf, "kegg_conv").where("uniprot_id is not null and entry_id is not null")
    return conversions(c.select(F.col("uniprot_id").alias("id"), F.lower(trimmed("entry_id")).alias("value"), F.struct(F.col("loaded_at"), F.lower(trimmed("entry_id"))).alias("line")))


@query("""
with k as (select distinct entry_id, raw from kegg_pathway where raw is not null),
f as (select entry_id, raw, 'ENTRY       ' || entry_id || '  CDS' || chr(10) || 'ORTHOLOGY   K0 kinase of ' || entry_id || ' [EC:2.7.11.1 2.7.1.1]' || chr(10) || 'DISEASE     H1 big  disease' || chr(10) || '            Rickets' as x from k)
select entry_id, 'K0' as ko, 'kinase of ' || entry_id || ' [EC:2.7.11.1 2.7.1.1]' as ko_definition, '2.7.11.1' as ec_numbers, 'big  disease|Rickets' as diseases, '1ABC 2XYZ' as pdb_ids, 'P1' as uniprot from f
""")
def gene_entries(spark, sf):
    """Gene entries parsed from flat files made of the pathways' ids."""
    k = table(spark, sf, "kegg_pathway").where("raw is not null").select("entry_id", "raw").distinct()
    head = F.concat(F.lit("ENTRY       "), F.col("entry_id"), F.lit("  CDS\nORTHOLOGY   K0 kinase of "), F.col("entry_id"))
    raw = F.concat(head, F.lit(" [EC:2.7.11.1 2.7.1.1]\nDISEASE     H1 big  disease\n            Rickets\nSTRUCTURE   PDB: 1ABC 2XYZ\nDBLINKS     UniProt: P1 P2\n///\nDISEASE     H9 not read"))
    g = k.select("entry_id", flatfile.gene_entry(raw).alias("g"))
    return g.select("entry_id", "g.ko", "g.ko_definition", F.array_join("g.ec_numbers", " ").alias("ec_numbers"), F.array_join("g.diseases", "|").alias("diseases"), F.array_join("g.pdb_ids", " ").alias("pdb_ids"), "g.uniprot")


@query("select distinct rec_id, primaryAccession as header, regexp_replace(sequence.value, '\\s', '', 'g') as sequence from uniprot_entry where primaryAccession is not null and sequence.value <> ''")
def fasta_round_trip(spark, sf):
    """Sequences written as FASTA, sixty letters a line and with `>` inside the header, and read back."""
    from lattica.sources.readers import read_fasta

    u = table(spark, sf, "uniprot_entry").where("primaryAccession is not null and sequence.value <> ''").select("rec_id", "primaryAccession", F.regexp_replace("sequence.value", r"\s", "").alias("s")).distinct()
    path = staging_path(spark, "fasta")
    u.select(F.concat(F.lit(">"), F.col("rec_id").cast("string"), F.lit(" 5'->3' "), F.col("primaryAccession"), F.lit("\n"), F.regexp_replace("s", "(.{60})", "$1\n"))).write.text(path)
    parts = F.split("header", " ")
    return read_fasta(spark, path).select(parts[0].cast("bigint").alias("rec_id"), parts[2].alias("header"), "sequence")


@query(f"""
with q as (select distinct preferredName_A as query from string_interaction where preferredName_A is not null),
a as (select preferredName as alias, {_fold('stringId')} as string_id, max(loaded_at) as ts from string_mapping where preferredName is not null and stringId is not null group by all)
select query, string_id from q join a on lower(query) = lower(alias) qualify row_number() over (partition by query order by ts desc, string_id) = 1
""")  # fmt: skip
def map_identifiers(spark, sf):
    from lattica.sources.readers import best_matches

    q = table(spark, sf, "string_interaction").select(F.col("preferredName_A").alias("query")).where("query is not null").distinct().withColumn("queryIndex", F.col("query"))
    a = table(spark, sf, "string_mapping").where("preferredName is not null and stringId is not null").groupBy(F.col("preferredName").alias("alias"), folded_id("stringId").alias("stringId")).agg(F.max("loaded_at").alias("quality"))
    return best_matches(a, q).select("query", F.col("stringId").alias("string_id"))


# ---- intervals and structure files


def entry_features(spark: SparkSession, sf: str) -> DataFrame:
    u = table(spark, sf, "uniprot_entry").select("rec_id", F.col("primaryAccession").alias("accession"), F.posexplode("features").alias("feature", "f"))
    at = lambda side: F.try_variant_get(parsed(F.col("f.location")), f"$.{side}.value", "int")
    return u.select("rec_id", "accession", "feature", at("start").alias("start"), at("end").alias("end")).where("start is not null and end is not null and accession is not null").distinct()


_SQL_OVERLAP = f"""
with {_SQL_FEATURE},
u as (select distinct rec_id, primaryAccession as accession, features from uniprot_entry where primaryAccession is not null),
ef as (select rec_id, accession, unnest(range(len(features)))::int as feature, unnest(features) as f from u),
ft as (select rec_id, accession, feature, try_cast(f.location ->> '$.start.value' as int) as s, try_cast(f.location ->> '$.end.value' as int) as e from ef),
sg as (select distinct src as accession, dst as chain_id, "start" as us, "end" as ue, case when ("start" + "end") % 2 = 0 then "start" + 100 else "end" + 100 end as ps, case when ("start" + "end") % 2 = 0 then "end" + 100 else "start" + 100 end as pe from hf),
j as (select ft.*, chain_id, greatest(s, us) as lo, least(e, ue) as hi, us, ps, case when pe >= ps then 1 else -1 end as way from ft join sg using (accession) where s > 0 and e >= s and s <= ue and e >= us)
select rec_id, accession, feature, chain_id, least(ps + way * (lo - us), ps + way * (hi - us)) as lo, greatest(ps + way * (lo - us), ps + way * (hi - us)) as hi from j
"""


@query(_SQL_OVERLAP)
def interval_overlap_project(spark, sf):
    """Features on segments made of the domain fragments, of which every other one is numbered backwards."""
    e = feature_edges(spark, sf).drop("model").distinct()
    forward = (F.col("start") + F.col("end")) % 2 == 0
    shift = lambda a, b: F.when(forward, F.col(a) + 100).otherwise(F.col(b) + 100)
    segments = e.select(F.col("src").alias("accession"), F.col("dst").alias("chain_id"), F.col("start").alias("unp_start"), F.col("end").alias("unp_end"), shift("start", "end").alias("pdb_start"), shift("end", "start").alias("pdb_end"))
    return interval.project_features(entry_features(spark, sf), segments, ["accession"]).select("rec_id", "accession", "feature", "chain_id", "lo", "hi")


_SQL_MANIFEST = f"""
with {_SQL_FEATURE}, {_SQL_PROTEIN},
u as (select distinct primaryAccession as accession, unnest(range(len(features)))::int as feature, unnest(features) as f from (select primaryAccession, features from uniprot_entry where primaryAccession is not null)),
planted as (select accession, 9000 as feature, 0 as s, 60 as e from protein union all select accession, 9001, 60, 40 from protein union all select accession, 9002, 30, 70 from protein),
ft as (select distinct * from (select accession, feature, try_cast(f.location ->> '$.start.value' as int) as s, try_cast(f.location ->> '$.end.value' as int) as e from u union all select * from planted) where s is not null and e is not null),
sg as (select distinct src as accession, case when "start" <= 50 then 'A' else 'B' end as chain_id, "start" as us, "end" as ue from hf),
rng as (select ft.*, chain_id, greatest(s, us) as lo, least(e, ue) as hi from ft join sg using (accession) where s > 0 and e >= s and s <= ue and e >= us),
atom as (select accession, unnest(range(1, length(sequence) + 1))::int as i from protein where length(sequence) > 0),
hit as (select distinct accession, feature, s, e, i from rng join atom using (accession) where i between lo and hi and chain_id = case when i <= 50 then 'A' else 'B' end),
mapped as (select accession, feature, s, e, count(*) as n_atoms from hit group by all),
tag as (select accession, feature, s, e, string_agg(distinct chain_id, '_' order by chain_id) as tag from rng group by all),
plain as (select accession, feature, s, e, count(*) as n_atoms from ft anti join mapped using (accession, feature, s, e) join atom using (accession) where s > 0 and i between s and e group by all),
m as (select accession, feature, s, e, 'mapped' as kind, tag, n_atoms from mapped join tag using (accession, feature, s, e) union all select accession, feature, s, e, 'plain', '', n_atoms from plain)
select accession, feature, s as "start", e as "end", kind, n_atoms, 'feature_' || feature || '_' || s || '_' || e || case kind when 'mapped' then '_pdb_' || trim(regexp_replace(accession, '[^A-Za-z0-9._-]+', '_', 'g'), '_') || '_chain_' || tag else '' end || '.pdb' as filename from m
"""


@query(_SQL_MANIFEST)
def structure_manifest(spark, sf):
    """The slice of each location of a feature from its protein's made structure, beside planted locations that lie on nothing."""
    e = feature_edges(spark, sf).drop("model").distinct()
    chain = F.when(F.col("start") <= 50, "A").otherwise("B")
    segs = e.select(F.col("src").alias("accession"), F.col("src").alias("structure"), chain.alias("chain_id"), F.col("start").alias("unp_start"), F.col("end").alias("unp_end"), F.col("start").alias("pdb_start"), F.col("end").alias("pdb_end")).distinct()
    p = staged(proteins(spark, sf).select("accession", "sequence"), "sequences")
    known = p.select("accession")
    planted = F.array(*(F.struct(F.lit(9000 + k).alias("feature"), F.lit(s).alias("start"), F.lit(t).alias("end")) for k, (s, t) in enumerate(((0, 60), (60, 40), (30, 70)))))
    features = entry_features(spark, sf).select("accession", "feature", "start", "end").unionByName(known.select("accession", F.explode(planted).alias("p")).select("accession", "p.*"))
    structures = known.select("accession", F.col("accession").alias("structure"), F.lit(1).alias("place"))
    found = interval.structure_manifest(features, structures, segs, structure_lines(p))
    return interval.slice_names(found).select("accession", "feature", "start", "end", "kind", "n_atoms", "filename")


@query("""
with p as (select distinct rec_id, primaryAccession as accession, sequence.length as n from uniprot_entry where primaryAccession is not null and sequence.length > 9),
s as (select rec_id, accession, 'A' as chain_id, 1 as unp_start, n // 2 as unp_end, 11 as pdb_start, n // 2 + 10 as pdb_end, 0 as k from p union all select rec_id, accession, 'B', n // 2 + 1, n, n // 2 + 1, n, 1 from p)
select rec_id, '1ABC' as structure, accession, chain_id, unp_start::int as unp_start, unp_end::int as unp_end, pdb_start::int as pdb_start, pdb_end::int as pdb_end from s
""")
def sifts_segments(spark, sf):
    """Segments read back from mapping payloads made of the entries, in every field a bound may stand in, beside segments that lack one or a chain."""
    u = table(spark, sf, "uniprot_entry").select("rec_id", F.col("primaryAccession").alias("accession"), F.col("sequence.length").alias("n")).where("accession is not null and n > 9").distinct()
    half = F.floor(F.col("n") / 2).cast("int")
    none = F.lit(None).cast("int")
    at = lambda author, label: F.struct(author.alias("author_residue_number"), label.alias("residue_number"))
    part = lambda chain, us, ue, us2, ue2, start, end: F.struct(F.lit(chain).alias("chain_id"), us.alias("unp_start"), ue.alias("unp_end"), us2.alias("unp_start_residue_number"), ue2.alias("unp_end_residue_number"), start.alias("start"), end.alias("end"))
    one = F.lit(1)
    mappings = F.array(
        part("A ", one, half, none, none, at(F.lit(11), one), at(half + 10, half)), part("B", none, none, half + 1, F.col("n"), at(F.lit(0), half + 1), at(none, F.col("n"))),
        part("", one, half, none, none, at(one, one), at(half, half)), part("C", one, none, none, none, at(one, one), at(none, none)),
    )
    payload = F.to_json(F.create_map(F.lit("1abc"), F.create_map(F.lit("UniProt"), F.create_map(F.col("accession"), F.struct(mappings.alias("mappings"))))))
    return u.select("rec_id", F.explode(interval.mapping_segments(payload)).alias("s")).select("rec_id", "s.*")


def structure_lines(known: DataFrame) -> DataFrame:
    """Fixed-width atom lines, one per residue of each protein, on chain A up to residue 50 and B after it."""
    p = known.where("length(sequence) > 0").select(F.col("accession").alias("structure"), F.explode(F.sequence(F.lit(1), F.length("sequence"))).alias("line_no"))
    chain = F.when(F.col("line_no") <= 50, "A").otherwise("B")
    return p.select("structure", "line_no", F.concat(F.lit("ATOM  "), F.lpad(F.col("line_no").cast("string"), 5, " "), F.lit("  CA  GLY "), chain, F.lpad(F.col("line_no").cast("string"), 4, " "), F.lit("    ")).alias("value"))


@query(f"with {_SQL_PROTEIN} select accession as structure, (least(length(sequence), 40) - 19)::bigint as n_atoms from protein where length(sequence) >= 20")
def fixedwidth_slice(spark, sf):
    return interval.slice_by_range(structure_lines(proteins(spark, sf)), 20, 40).select("structure", "n_atoms")


# ---- enrichment and closures

_SQL_SET = f"ann as (select distinct src as gene, coalesce(goAspect, '') as category, dst as term from (select {_PRODUCT} as src, goAspect, goId as dst from go_annotation) where src is not null and dst is not null), inset as (select distinct primaryAccession as gene from uniprot_entry where primaryAccession is not null)"


def annotation_rows(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    a = table(spark, sf, "go_annotation").select(product_id("geneProductId").alias("gene"), F.coalesce("goAspect", F.lit("")).alias("category"), F.col("goId").alias("term"))
    return a, table(spark, sf, "uniprot_entry").select(F.col("primaryAccession").alias("gene")).where("gene is not null").distinct()


@query(f"with {_SQL_SET} select category, term, count(distinct gene) as number_of_genes_in_background, count(distinct case when gene in (select gene from inset) then gene end) as number_of_genes from ann group by category, term having number_of_genes > 0")
def enrichment_counts(spark, sf):
    return enrich.enrichment(*annotation_rows(spark, sf)).select("category", "term", "number_of_genes_in_background", "number_of_genes")


@query(f"""
with {_SQL_SET}, size as (select category, count(distinct gene) as big_n, count(distinct case when gene in (select gene from inset) then gene end) as n from ann group by category),
t as (select category, term, count(distinct gene) as big_k, count(distinct case when gene in (select gene from inset) then gene end) as k from ann group by category, term having k > 0),
x as (select category, term, k, big_k, n, big_n, unnest(range(greatest(k, n - (big_n - big_k)), least(n, big_k) + 1)) as i from t join size using (category)),
p as (select category, term, k, big_k, least(1, sum(exp(lgamma(big_k + 1) - lgamma(i + 1) - lgamma(big_k - i + 1) + lgamma(big_n - big_k + 1) - lgamma(n - i + 1) - lgamma(big_n - big_k - n + i + 1)
  - lgamma(big_n + 1) + lgamma(n + 1) + lgamma(big_n - n + 1)))) as p from x group by all),
r as (select *, row_number() over (partition by category order by p) as rk, count(*) over (partition by category) as m from p)
select category, term, k as number_of_genes, big_k as number_of_genes_in_background, round(p, 7) as p_value, round(least(1, min(p * m / rk) over (partition by category order by rk desc rows unbounded preceding)), 7) as fdr from r
""")  # fmt: skip
def enrichment(spark, sf):
    found = enrich.enrichment(*annotation_rows(spark, sf))
    return found.select("category", "term", "number_of_genes", "number_of_genes_in_background", F.round("p_value", 7).alias("p_value"), F.round("fdr", 7).alias("fdr"))


@query("""
with p as (select distinct interaction_id, ncbiTaxonId, 1 - tscore as p_value from string_interaction where tscore is not null and not isnan(tscore)),
r as (select *, row_number() over (partition by ncbiTaxonId order by p_value, interaction_id) as rk, count(*) over (partition by ncbiTaxonId) as m from p)
select interaction_id, least(1, min(p_value * m / rk) over (partition by ncbiTaxonId order by rk desc rows unbounded preceding)) as fdr from r
""")
def false_discovery_rate(spark, sf):
    p = table(spark, sf, "string_interaction").where("tscore is not null and not isnan(tscore)").select("interaction_id", "ncbiTaxonId", (1 - F.col("tscore")).alias("p_value")).distinct()
    return enrich.with_fdr(p, by=["ncbiTaxonId"]).select("interaction_id", "fdr")


_SQL_ONTOLOGY = "n as (select distinct substring(goId, 4)::bigint as i from go_annotation where regexp_full_match(goId, 'GO:[0-9]+'))"


@query(f"""
with recursive {_SQL_ONTOLOGY}, w as (select i as start, i // 10 as term, 1 as depth from n where i >= 10 union select start, term // 10, depth + 1 from w where term >= 10)
select start, term, min(depth) as depth from w group by start, term
""")  # fmt: skip
def ontology_closure(spark, sf):
    """Ancestors in a tree over the terms: a number's parent is the number without its last digit."""
    ids = table(spark, sf, "go_annotation").where("goId rlike '^GO:[0-9]+$'").select(F.substring("goId", 4, 20).cast("bigint").alias("term")).distinct()
    parts = [ids.select(F.floor(F.col("term") / F.lit(10**k)).cast("bigint").alias("child")) for k in range(8)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    edges = every.where("child >= 10").distinct().select("child", F.floor(F.col("child") / 10).cast("bigint").alias("parent"), F.lit("is_a").alias("relation"))
    return traverse.closure(edges, ids, ["is_a"])


# ---- streams


@query("select distinct user_id from events")
def stream_visited_dedup(spark, sf):
    """First visits over the event stream, read to its end."""
    from lattica.streaming.upsert import first_visits

    events = table(spark, sf, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    at = next(f.name for f in events.schema.fields if f.dataType.typeName().startswith("timestamp"))
    out = staging_path(spark, "stream")
    first_visits(stream.select("user_id", at), "user_id", at, "10000 days").writeStream.format("parquet").option("checkpointLocation", f"{out}-state").trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema("user_id bigint").parquet(out).select("user_id").distinct()
