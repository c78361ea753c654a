"""Growth of a graph from source tables: breadth-first from seeds, then one bulk write per label and type.

Missing source rows are the failures of a service: a protein without an entry is processed and has no partners, parts
without rows get their empty values, and nothing stops the run.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lattica.functions import records, text
from lattica.functions.nested import cross_references
from lattica.operators import traverse
from lattica.operators.graph import PropertyGraph
from lattica.sources.lookups import prediction_urls


@dataclass
class Result:
    graph: PropertyGraph
    order: DataFrame
    stats: dict[str, int]


def partner_edges(interactions: DataFrame, strings: DataFrame, threshold: int = 700, limit: int = 50) -> DataFrame:
    """(src, dst, rank, score, channels) between accessions: per protein the best `limit` partners with a score from threshold / 1000.

    interactions (a, b, preferred_name_b, taxon, score and channels) are between network ids; strings (accession,
    string_id, gene_name, taxon_id, is_reviewed) resolves a protein's network id, and a partner by name and taxon, reviewed
    entries first. Partners without an accession are dropped after the limit, as they count for the service.
    """
    channels = [c for c, _ in records.CHANNELS]
    best = Window.partitionBy("a").orderBy(F.col("score").desc(), "b")
    top = interactions.where(F.col("score") >= threshold / 1000).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= limit)
    first = Window.partitionBy("gene_name", "taxon_id").orderBy(F.col("is_reviewed").desc(), "accession")
    named = strings.where("gene_name is not null").withColumn("n", F.row_number().over(first)).where("n = 1")
    dst = named.select(F.col("accession").alias("dst"), F.col("gene_name").alias("preferred_name_b"), F.col("taxon_id").alias("taxon"))
    src = strings.where("string_id is not null").select(F.col("accession").alias("src"), F.col("string_id").alias("a"))
    return top.join(src, "a").join(dst, ["preferred_name_b", "taxon"]).select("src", "dst", "rank", "score", *channels)


def expand_graph(spark: SparkSession, sources: Mapping[str, DataFrame], seeds: list[str], threshold: int = 700, max_nodes: int | None = None, path: str | None = None) -> Result:
    """Grow a graph from seeds over sources: entries, interactions, and optionally features, annotations, terms, articles.

    entries: accession, name, gene_name, organism, taxon_id, sequence, length, mol_weight, is_reviewed, function_text,
    ec_numbers, string_id. features: accession, feature, name, source_database, type, integrated, start, end, score, model,
    reference. annotations: accession, go_id, qualifier, evidence_code, eco_code, reference, assigned_by, is_experimental.
    structures: accession, entry_id, place. predictions: as delivered, with uniprotAccession, entryId, cifUrl and pdbUrl.
    full_texts: pmc, full_text. Articles get their address, and the full text of their pmc where there is one.
    Partners of the last processed proteins stay as keys without properties. Articles that are cited but not delivered
    become nodes with a number only.
    """
    entries = sources["entries"]
    partners = partner_edges(sources["interactions"], entries, threshold)
    grown = traverse.expand(partners.select("src", "dst", "rank"), seeds, max_nodes)
    done = grown.order.where("processed").select("accession")
    g = PropertyGraph(spark, path)
    g.merge_nodes("Protein", grown.order.select("accession"), entries.join(done, "accession", "left_semi"), structure_properties(done, sources.get("structures"), sources.get("predictions")))
    edges = partners.join(done.withColumnRenamed("accession", "src"), "src", "left_semi")
    g.merge_edges("INTERACTS_WITH", edges.select("src", "dst", "score", F.col("score").alias("confidence"), "escore", "dscore", "tscore", "nscore", "ascore", "fscore", records.dominant_source().alias("dominant_source")))
    cited: list[DataFrame] = []
    if "annotations" in sources:
        a = sources["annotations"].join(done, "accession", "left_semi")
        known = sources.get("terms")
        ids = a.select("go_id").where("go_id is not null").distinct()
        empty = {"name": F.lit(""), "aspect": F.lit("?"), "definition": F.lit(""), "is_obsolete": F.lit(False)}
        g.merge_nodes("GOTerm", ids.withColumns(empty), *([] if known is None else [known.join(ids, "go_id", "left_semi")]))
        g.merge_edges("HAS_GO_ANNOTATION", a.select(F.col("accession").alias("src"), F.col("go_id").alias("dst"), "go_id", "qualifier", "evidence_code", "eco_code", "reference", "assigned_by", "is_experimental"))
        cited.append(a.select(F.col("accession").alias("protein"), F.lit(None).cast("string").alias("feature"), F.explode(text.pmids(F.col("reference"))).alias("article")))
    if "features" in sources:
        f = sources["features"].join(done, "accession", "left_semi")
        g.merge_nodes("ProteinFeature", f.select(F.col("feature").alias("accession"), "name", "source_database", "type", "integrated"))
        g.merge_edges("HAS_FEATURE", f.select(F.col("accession").alias("src"), F.col("feature").alias("dst"), F.coalesce("start", F.lit(0)).alias("start"), F.coalesce("end", F.lit(0)).alias("end"), "score", "model"))
        cited.append(f.select(F.col("accession").alias("protein"), "feature", F.explode(text.pmids(F.col("reference"))).alias("article")))
    for rows in cited:
        ids = rows.select(F.col("article").alias("pmid")).distinct()
        delivered = [article_table(sources["articles"].join(ids, "pmid", "left_semi"), sources.get("full_texts"))] if "articles" in sources else []
        g.merge_nodes("PubMedArticle", ids, *delivered)
        g.merge_edges("CITED_IN", rows.select(F.col("protein").alias("src"), F.col("article").alias("dst")))
        g.merge_edges("EVIDENCED_BY", rows.where("feature is not null").select(F.col("feature").alias("src"), F.col("article").alias("dst")))
    return Result(g, grown.order, {"proteins_processed": grown.processed, "proteins_discovered": grown.discovered})


def structure_properties(proteins: DataFrame, structures: DataFrame | None, predictions: DataFrame | None) -> DataFrame:
    """(accession, ...): ids and addresses of the structures and predictions of every protein; [] and '' where there are none."""
    found = proteins.select("accession").distinct()
    if structures is None:
        found = found.withColumn("pdb_ids", F.array().cast("array<string>"))
    else:
        ordered = F.array_sort(F.collect_list(F.struct("place", F.col("entry_id").alias("id"))))
        listed = structures.where("entry_id is not null").groupBy("accession").agg(F.transform(ordered, lambda x: x.getField("id")).alias("pdb_ids"))
        found = found.join(listed, "accession", "left").withColumn("pdb_ids", F.coalesce("pdb_ids", F.array().cast("array<string>")))
    ids = F.col("pdb_ids")
    found = found.withColumns({"pdb_entry_urls": records.urls(records.STRUCTURE_PAGE, ids), "pdb_cif_urls": records.urls(records.STRUCTURE_FILE, ids, ".cif"), "pdb_pdb_urls": records.urls(records.STRUCTURE_FILE, ids, ".pdb")})
    lists, texts = ("alphafold_entry_ids", "alphafold_cif_urls", "alphafold_pdb_urls"), ("alphafold_cif_url", "alphafold_pdb_url")
    if predictions is not None:
        found = found.join(prediction_urls(predictions), "accession", "left")
    have = lambda c, none: F.coalesce(F.col(c), none) if predictions is not None else none
    return found.withColumns({c: have(c, F.array().cast("array<string>")) for c in lists} | {c: have(c, F.lit("")) for c in texts})


def article_table(articles: DataFrame, full_texts: DataFrame | None = None) -> DataFrame:
    """Delivered articles with pubmed_url and, by their pmc, full_text ('' without)."""
    named = articles.withColumn("pubmed_url", records.pubmed_url(F.col("pmid")))
    if full_texts is None or "pmc" not in articles.columns:
        return named
    texts = full_texts.where("pmc is not null").groupBy("pmc").agg(F.max("full_text").alias("full_text"))
    return named.drop("full_text").join(texts, "pmc", "left").withColumn("full_text", F.coalesce("full_text", F.lit("")))


def entry_table(raw: DataFrame) -> DataFrame:
    """Entries for expand_graph from delivered protein records."""
    d, s = F.col("proteinDescription"), F.col("sequence")
    refs = cross_references(F.col("uniProtKBCrossReferences"), F.col("dbReferences"))
    empty = lambda c: F.coalesce(c, F.lit(""))
    return raw.select(
        F.col("primaryAccession").alias("accession"), empty(records.protein_name(d)).alias("name"), empty(records.gene_name(F.col("genes"))).alias("gene_name"), empty(F.col("organism.scientificName")).alias("organism"),
        F.col("organism.taxonId").alias("taxon_id"), empty(s.getField("value")).alias("sequence"), s.getField("length").alias("length"), s.getField("molWeight").alias("mol_weight"),
        records.is_reviewed(F.col("entryType")).alias("is_reviewed"), empty(records.function_text(F.col("comments"))).alias("function_text"), records.ec_numbers(d).alias("ec_numbers"),
        records.first(records.ref_ids(refs, "STRING")).alias("string_id"),
    )
