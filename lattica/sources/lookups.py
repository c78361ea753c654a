"""What the public services compute for a client, computed from tables: lookups, searches, filters and conversions.

All take DataFrames and give DataFrames, for any number of keys at once; a key without a row simply has no row, unless
`required` makes that an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lattica.functions.records import first
from lattica.operators.traverse import closure, numbered

#: The evidence term under which all experimental evidence stands, and the kinds of edges that descend to it.
EXPERIMENTAL_EVIDENCE = "ECO:0000269"


def required(found: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """found, or an error naming some of the keys that have no row."""
    missing = [r[0] for r in keys.select(on).distinct().join(found.select(on), on, "left_anti").limit(5).collect()]
    if missing:
        raise ValueError(f"not found: {', '.join(map(str, missing))}")
    return found


def by_key(table: DataFrame, keys: DataFrame, on: str, upper: bool = False) -> DataFrame:
    """Rows of a table whose key is asked for; upper: keys are asked for in any case and stored in capitals."""
    asked = keys.select((F.upper(on) if upper else F.col(on)).alias(on)).distinct()
    return table.join(asked, on, "left_semi")


def isoforms(entries: DataFrame, base: DataFrame) -> DataFrame:
    """(accession, isoform): entries named <accession>-<number>, and the accession itself."""
    e = entries.select(F.col("primaryAccession").alias("isoform"), F.regexp_replace("primaryAccession", r"-\d+$", "").alias("accession"))
    return e.join(base.select("accession").distinct(), "accession", "left_semi").select("accession", "isoform")


def polymer_entities(entries: DataFrame, entities: DataFrame) -> DataFrame:
    """Entities 1..count of each structure (entries: entry_id, polymer_entity_count; entities: entry_id, entity_id, ...), up to the first gap."""
    numbered = entities.withColumn("__lt_n", F.col("entity_id").try_cast("int"))
    inside = numbered.join(entries.select("entry_id", "polymer_entity_count").distinct(), "entry_id").where(F.col("__lt_n").between(1, F.col("polymer_entity_count")))
    place = F.dense_rank().over(Window.partitionBy("entry_id").orderBy("__lt_n"))
    return inside.withColumn("__lt_p", place).where("__lt_p = __lt_n").drop("__lt_n", "__lt_p", "polymer_entity_count")


def structures_of(references: DataFrame, accessions: DataFrame, max_rows: int = 100) -> DataFrame:
    """(accession, entry_id, place, total_count): the best max_rows structures of each protein among references (accession, entry_id, score)."""
    r = references.join(accessions.select("accession").distinct(), "accession", "left_semi").groupBy("accession", "entry_id").agg(F.max("score").alias("score"))
    each = Window.partitionBy("accession")
    ranked = r.withColumns({"place": F.row_number().over(each.orderBy(F.col("score").desc(), "entry_id")), "total_count": F.count(F.lit(1)).over(each)})
    return ranked.where(F.col("place") <= max_rows).select("accession", "entry_id", "place", "total_count")


def best_prediction(predictions: DataFrame) -> DataFrame:
    """(accession, prediction): the first prediction of each protein, by its number of fragment and id."""
    from lattica.functions.records import fragment_number

    order = F.struct(fragment_number(F.col("entryId")), F.col("entryId"))
    return predictions.groupBy(F.col("uniprotAccession").alias("accession")).agg(F.min_by(F.struct(*predictions.columns), order).alias("prediction"))


def prediction_urls(predictions: DataFrame) -> DataFrame:
    """Per protein the ids and addresses of its predictions in order, and those of the first one ('' without)."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    listed = F.array_sort(F.collect_list(F.struct("entryId", text("cifUrl").alias("cif"), text("pdbUrl").alias("pdb"))))
    p = predictions.groupBy(F.col("uniprotAccession").alias("accession")).agg(listed.alias("p"))
    part = lambda name: F.transform("p", lambda x: x.getField(name))
    return p.select(
        "accession", part("entryId").alias("alphafold_entry_ids"), part("cif").alias("alphafold_cif_urls"), part("pdb").alias("alphafold_pdb_urls"),
        F.coalesce(first(part("cif")), F.lit("")).alias("alphafold_cif_url"), F.coalesce(first(part("pdb")), F.lit("")).alias("alphafold_pdb_url"),
    )


def network(interactions: DataFrame, members: DataFrame, required_score: int = 400) -> DataFrame:
    """Interactions (a, b, score) with both ends among members (id) and a score of required_score / 1000."""
    m = members.select("id").distinct()
    inside = interactions.where(F.col("score") >= required_score / 1000)
    return inside.join(m.withColumnRenamed("id", "a"), "a", "left_semi").join(m.withColumnRenamed("id", "b"), "b", "left_semi").select(*interactions.columns)


def annotations(table: DataFrame, evidence: DataFrame, aspect: str | None = None, evidence_code: str | None = None, experimental_only: bool = False) -> DataFrame:
    """Annotations by aspect and by evidence: a code and all its descendants over evidence (child, parent, relation). A code goes before experimental_only."""
    found = table if aspect is None else table.where(F.col("goAspect") == aspect)
    code = evidence_code or (EXPERIMENTAL_EVIDENCE if experimental_only else None)
    if code is None:
        return found
    start = table.sparkSession.createDataFrame([(code,)], "term string")
    under = closure(evidence, start, down=True).select(F.col("term").alias("evidenceCode")).unionByName(start.withColumnRenamed("term", "evidenceCode")).distinct()
    return found.join(under, "evidenceCode", "left_semi").select(*found.columns)


def children(edges: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, child, relation): direct children over edges (child, parent, relation)."""
    return edges.join(terms.select(F.col("term").alias("parent")).distinct(), "parent", "left_semi").select(F.col("parent").alias("term"), "child", "relation")


def genes_entries(conversions: DataFrame, entries: DataFrame, accessions: DataFrame) -> DataFrame:
    """(accession, gene_id, raw): accessions with the entry of their gene; nulls where there is none."""
    a = accessions.select("accession").distinct()
    return a.join(conversions.select("accession", "gene_id"), "accession", "left").join(entries.select(F.col("entry_id").alias("gene_id"), "raw"), "gene_id", "left").select("accession", "gene_id", "raw")


#: Databases of domain matches, in the order in which their entries count.
MATCH_DATABASES = ("interpro", "pfam", "smart", "prosite")


def all_matches(results: DataFrame, keys: list[str], databases: tuple[str, ...] = MATCH_DATABASES) -> DataFrame:
    """One row per protein (keys) and entry over the pages of several databases: of equal entries the first, by the order of the databases and the place in the page.

    results has the keys, database, place, entry and any more columns, which stay. Entries of other databases and without
    an accession are left out; a database without rows is a page that failed and changes nothing for the others.
    """
    rank = F.array_position(F.array(*map(F.lit, databases)), F.col("database"))
    first_of = Window.partitionBy(*keys, "entry").orderBy("__lt_rank", "place")
    known = results.withColumn("__lt_rank", rank).where("__lt_rank > 0 and entry is not null")
    return known.withColumn("__lt_n", F.row_number().over(first_of)).where("__lt_n = 1").drop("__lt_n", "__lt_rank")


def match_terms(results: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, identifier, name) of the terms of all matches of a protein: of repeated terms the name that comes last. results has the keys, place and terms (array of identifier and name)."""
    each = results.select(*keys, "place", F.posexplode("terms").alias("pos", "t")).where("t.identifier is not null")
    return each.groupBy(*keys, F.col("t.identifier").alias("identifier")).agg(F.max_by("t.name", F.struct("place", "pos")).alias("name"))


def named_pathways(links: DataFrame, pathways: DataFrame) -> DataFrame:
    """(id, pathway, name): pathway links with names from a list (id, value); a pathway without one keeps its id."""
    names = pathways.select(F.col("id").alias("pathway"), F.col("value").alias("found"))
    return links.select("id", F.col("linked").alias("pathway")).join(names, "pathway", "left").select("id", "pathway", F.coalesce("found", "pathway").alias("name"))


def article_search(articles: DataFrame, condition: Column, max_results: int = 20, years: tuple[int, int] | None = None, order: str = "year", most: int | None = None) -> DataFrame:
    """(pmid, place): the max_results articles that meet a condition, published within years, the latest first. A service's own bound, `most`, is an error to go beyond."""
    if most is not None and max_results > most:
        raise ValueError(f"{max_results} results asked for, {most} are given at most")
    year = F.regexp_extract("year", r"(\d{4})", 1).try_cast("int")
    found = articles.where(condition)
    if years:
        found = found.where(year.between(*years))
    key = year.desc_nulls_last() if order == "year" else F.col(order)
    top = found.orderBy(key, "pmid").limit(max_results)
    return numbered(top, [key, "pmid"], "place")[0].select("pmid", F.col("place").cast("int").alias("place"))


def full_text(texts: DataFrame, articles: DataFrame, limit: int | None = None) -> DataFrame:
    """(pmid, full_text): full texts (pmc, text) of articles (pmid, pmc), whose number may lack its prefix; empty ones are left out. Whole, unless a limit is given."""
    number = F.concat(F.lit("PMC"), F.regexp_replace("pmc", "^PMC", ""))
    a = articles.where("pmc is not null and pmc <> ''").select("pmid", number.alias("pmc"))
    return a.join(texts.where("text is not null and text <> ''"), "pmc").select("pmid", (F.col("text") if limit is None else F.substring("text", 1, limit)).alias("full_text"))
