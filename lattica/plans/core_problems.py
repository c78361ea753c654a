"""Queries over skewed keys (p1), nested records (p2) and dangling references (p3), with their SQL twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.functions.nested import citation_authors, cross_references, domain_matches
from lattica.operators import dangling as dg
from lattica.operators.shred import assemble, shred
from lattica.operators.skew import balanced_aggregate, estimate_load, fragment_join, heavy_hitters
from lattica.session import folded_id, staged, table, trimmed

#: Share of a table's rows from which a key counts as holding much of it.
LARGE_SHARE = 0.03


def product_id(column: str) -> Column:
    """A gene product without what stands up to its first colon."""
    return trimmed(F.regexp_replace(F.col(column), "^[^:]*:", ""))


def valid_score(column: str) -> Column:
    """A score on the 0-1 scale; null where it is null, not a number or negative."""
    c = F.col(column)
    return F.when(~F.isnan(c) & (c >= 0), F.when(c > 1, c / 1000).otherwise(c))


# ---- p1: a few keys holding most records


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    si, go = table(spark, sf, "string_interaction"), table(spark, sf, "go_annotation")
    parts = []
    for name, df, key, row in (("string_interaction", si, folded_id("stringId_A"), "interaction_id"), ("go_annotation", go, product_id("geneProductId"), "id")):
        narrow = df.select(key.alias("k"), F.col(row))
        plan = estimate_load(narrow, F.col("k"))
        # rows delivered twice share their id; the time they came is not needed to spread them
        found = heavy_hitters(narrow, F.col("k"), LARGE_SHARE, plan, salt_by=[F.col(row)], name="key_id")
        parts.append(found.select(F.lit(name).alias("src_table"), "key_id"))
    return parts[0].unionByName(parts[1])


def p1_interaction_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Per protein: rows, distinct partners, best valid score, and the rows of proteins that are known ids (by fragment_join).

    Rows of one pair are put together before anything travels, so neither a protein nor a pair is hot; the pairs are
    fragmented once, and what leaves a task is one row per key.
    """
    si = table(spark, sf, "string_interaction").select(folded_id("stringId_A").alias("a"), folded_id("stringId_B").alias("b"), valid_score("score").alias("s"))
    pairs = staged(si.where("a is not null").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("s").alias("s")), "pairs")
    known = table(spark, sf, "string_mapping").select(folded_id("stringId").alias("id")).where("id is not null").distinct()
    linked = fragment_join(pairs, known, F.col("a"), F.col("id"), "left", estimate_load(pairs, F.col("a")), salt_by=[F.col("b")])
    own = F.sum(F.when(F.col("id").isNotNull(), F.col("n")).otherwise(0)).alias("n_known_rows")
    return linked.groupBy(F.col("a").alias("key_id")).agg(F.sum("n").alias("n_rows"), F.count("b").alias("n_partners"), F.max("s").alias("best_score"), own)


def p1_annotation_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Per gene product: rows, distinct terms and distinct (term, evidence) pairs. Equal rows are put together before anything travels."""
    go = table(spark, sf, "go_annotation").select(product_id("geneProductId").alias("k"), F.col("goId").alias("t"), F.col("goEvidence").alias("e"))
    rows = staged(go.where("k is not null").groupBy("k", "t", "e").agg(F.count(F.lit(1)).alias("n")), "terms")
    partial = {"rows": F.sum("n"), "terms": F.countDistinct("t"), "pairs": F.count_if(F.col("t").isNotNull() & F.col("e").isNotNull())}
    final = {"n_rows": F.sum("rows"), "n_terms": F.sum("terms"), "n_pairs": F.sum("pairs")}
    return balanced_aggregate(rows, F.col("k"), partial, final, salt_by=[F.col("t")], name="key_id")


# ---- p2: deeply nested records

FRAGMENT = "[].locations.[].fragments.[]"


def domain_fragments(df: DataFrame) -> DataFrame:
    """rec_id, pos_1..3 (result, location, fragment), accession, model, start, end."""
    shredded, leaves = shred(df.select("rec_id", domain_matches(F.col("payload")).alias("n")), ["rec_id"], "n")
    wanted = {"accession": "[].accession", "model": "[].locations.[].model", "start": f"{FRAGMENT}.start", "end": f"{FRAGMENT}.end"}
    return assemble(shredded, leaves, ["rec_id"], FRAGMENT.split("."), wanted)


def reference_properties(df: DataFrame) -> DataFrame:
    """rec_id, pos_1..2 (cross-reference, property), database, id, key, value; one row of null key and value where there is no property."""

    def padded(x: Column) -> Column:
        none = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("value")))
        some = F.exists(x.getField("properties"), lambda p: p.isNotNull())
        return F.when(x.isNotNull(), x.withField("properties", F.when(some, x.getField("properties")).otherwise(none)))

    nested = F.transform(cross_references(F.col("uniProtKBCrossReferences"), F.col("dbReferences")), padded)
    shredded, leaves = shred(df.select("rec_id", nested.alias("n")), ["rec_id"], "n")
    wanted = {"database": "[].database", "id": "[].id", "key": "[].properties.[].key", "value": "[].properties.[].value"}
    return assemble(shredded, leaves, ["rec_id"], ("[]", "properties", "[]"), wanted)


def citation_author_rows(df: DataFrame) -> DataFrame:
    """rec_id, pos_1 (author), name."""
    shredded, leaves = shred(df.select("rec_id", citation_authors(F.col("rcsb_primary_citation")).alias("n")), ["rec_id"], "n")
    return assemble(shredded, leaves, ["rec_id"], ("[]",), {"name": "[].name"})


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    none = F.lit(-1).cast("int")
    whole = lambda c: F.col(c).rlike(r"^\s*[+-]?[0-9]+\s*$")
    number = lambda c: trimmed(c).try_cast("bigint").cast("string")
    ip = domain_fragments(table(spark, sf, "interpro_match")).where(whole("start") & whole("end"))
    ip = ip.select(F.lit("interpro_match").alias("src_table"), "rec_id", F.col("pos_1").alias("n1"), F.col("pos_2").alias("n2"), F.col("pos_3").alias("n3"), F.concat_ws("-", number("start"), number("end")).alias("leaf"))
    up = reference_properties(table(spark, sf, "uniprot_entry"))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    base = F.concat_ws("|", text("database"), text("id"))
    leaf = F.when(F.col("key").isNull() & F.col("value").isNull(), base).otherwise(F.concat(base, F.lit("|"), text("key"), F.lit("="), text("value")))
    up = up.select(F.lit("uniprot_entry").alias("src_table"), "rec_id", F.col("pos_1").alias("n1"), none.alias("n2"), none.alias("n3"), leaf.alias("leaf"))
    pdb = citation_author_rows(table(spark, sf, "pdb_entry")).where("name is not null")
    pdb = pdb.select(F.lit("pdb_entry").alias("src_table"), "rec_id", F.col("pos_1").alias("n1"), none.alias("n2"), none.alias("n3"), F.col("name").alias("leaf"))
    return ip.unionByName(up).unionByName(pdb).distinct()


def p2_locations(spark: SparkSession, sf: str) -> DataFrame:
    """The parent table of the fragments: one row per distinct location, with its place, its entry and its number of fragments."""
    rows = domain_fragments(table(spark, sf, "interpro_match").dropDuplicates(["rec_id"]))
    return rows.groupBy("rec_id", F.col("pos_1").alias("n1"), F.col("pos_2").alias("n2")).agg(F.max("accession").alias("accession"), F.count(F.lit(1)).alias("n_fragments"))


# ---- p3: references to records that do not exist


def pubmed_numbers(column: str) -> Column:
    """Every number after PMID, in any case, with colons and blanks between."""
    return F.regexp_extract_all(F.col(column), F.lit(r"(?i)PMID[:\s]*([0-9]+)"), F.lit(1))


def pathway_gene(gene: Column, entry_id: Column) -> Column:
    """A gene as code:digits in lower case; a bare number takes the pathway's organism code."""
    g = F.lower(trimmed(gene))
    code = F.regexp_extract(g, r"^([a-z][a-z0-9]*)\s*:\s*([0-9]+)", 1)
    number = F.regexp_extract(g, r"^(?:[a-z][a-z0-9]*\s*:\s*)?([0-9]+)", 1)
    organism = F.when(code != "", code).otherwise(F.lower(F.substring(trimmed(entry_id), 1, 3)))
    bare = trimmed(F.regexp_replace(g, r"\(.*$", ""))
    return F.when(g.isNull(), F.lit(None)).when(number == "", bare).otherwise(F.concat(organism, F.lit(":"), number))


def p3_sources(spark: SparkSession, sf: str) -> list[tuple[str, DataFrame, DataFrame]]:
    """(table, pre-aggregated references, presence of their targets)."""
    at = F.col("loaded_at")
    life = lambda df, key: dg.presence(df, key, at, F.col("deleted_at"))
    si = dg.references(table(spark, sf, "string_interaction"), folded_id("stringId_B"), at)
    go = table(spark, sf, "go_annotation").select(F.explode(pubmed_numbers("reference")).alias("ref"), "loaded_at")
    kp = table(spark, sf, "kegg_pathway").select(F.explode("genes").alias("gene"), "entry_id", "loaded_at")
    return [
        ("string_interaction", si, life(table(spark, sf, "string_mapping"), folded_id("stringId"))),
        ("go_annotation", dg.references(go, F.col("ref"), at), life(table(spark, sf, "pubmed_article"), trimmed("pmid"))),
        ("kegg_pathway", dg.references(kp, pathway_gene(F.col("gene"), F.col("entry_id")), at), life(table(spark, sf, "kegg_conv"), F.lower(trimmed("entry_id")))),
    ]


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    parts = [dg.orphans(refs, target).select(F.lit(name).alias("src_table"), dg.month_text(F.col(dg.MONTH)).alias("period"), F.col(dg.REF).alias("ref_id")) for name, refs, target in p3_sources(spark, sf)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p3_orphan_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Per table and month: references and orphans, distinct and in rows."""
    parts = [dg.orphan_report(dg.orphans(refs, target), refs, name) for name, refs, target in p3_sources(spark, sf)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


QUERIES = {f.__name__: f for f in (p1_found, p1_interaction_summary, p1_annotation_summary, p2_found, p2_locations, p3_found, p3_orphan_counts)}

# ---- SQL twins (DuckDB)

_BLANKS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(160)"


def _trim(x: str) -> str:
    return f"trim({x}, {_BLANKS})"


def _fold(x: str) -> str:
    return f"upper({_trim(x)})"


_PRODUCT = _trim("regexp_replace(geneProductId, '^[^:]*:', '')")
_VALID = "case when isnan(score) or score < 0 then null when score > 1 then score / 1000 else score end"

_P1 = f"""
with k as (
  select 'string_interaction' as src_table, {_fold('stringId_A')} as key_id from string_interaction
  union all select 'go_annotation', {_PRODUCT} from go_annotation),
t as (select src_table, count(*) as total from k group by src_table)
select src_table, key_id from k join t using (src_table) where key_id is not null
group by src_table, key_id, total having count(*) >= {LARGE_SHARE} * total
"""

_P1_INTERACTIONS = f"""
with s as (select {_fold('stringId_A')} as key_id, {_fold('stringId_B')} as b, {_VALID} as s from string_interaction),
m as (select distinct {_fold('stringId')} as id from string_mapping)
select key_id, count(*) as n_rows, count(distinct b) as n_partners, max(s) as best_score,
  case when key_id in (select id from m where id is not null) then count(*) else 0 end as n_known_rows
from s where key_id is not null group by key_id
"""

_P1_ANNOTATIONS = f"""
select {_PRODUCT} as key_id, count(*) as n_rows, count(distinct goId) as n_terms,
  count(distinct case when goId is not null and goEvidence is not null then (goId, goEvidence) end) as n_pairs
from go_annotation where {_PRODUCT} is not null group by 1
"""

_FRAGMENTS = """
b as (select distinct rec_id, payload from interpro_match where payload is not null and json_valid(payload)),
r0 as (select rec_id, json_extract(payload, '$.results[*]') as rs from b),
r as (select rec_id, unnest(rs) as x, unnest(range(len(rs))) as n1 from r0),
l0 as (select rec_id, n1, x, case json_type(x, '$.proteins')
    when 'ARRAY' then list_filter(list_transform(json_extract(x, '$.proteins[*]'), lambda p: json_extract(p, '$.entry_protein_locations[*]')), lambda l: len(l) > 0)[1]
    when 'OBJECT' then json_extract(x, '$.proteins.entry_protein_locations[*]') end as ls from r),
l1 as (select rec_id, n1, x, case when len(ls) > 0 then ls else json_extract(x, '$.entry_protein_locations[*]') end as ls from l0),
l as (select rec_id, n1, x, unnest(ls) as loc, unnest(range(len(ls))) as n2 from l1),
f0 as (select rec_id, n1, n2, x, case when len(json_extract(loc, '$.fragments[*]')) > 0 then json_extract(loc, '$.fragments[*]') else [loc] end as fs from l),
f as (select rec_id, n1, n2, x, unnest(fs) as fr, unnest(range(len(fs))) as n3 from f0)
"""

_P2 = f"""
with {_FRAGMENTS},
ip as (select rec_id, n1, n2, n3, coalesce(fr ->> '$.start', fr ->> '$.begin') as s, fr ->> '$.end' as e from f),
u0 as (select distinct rec_id, uniProtKBCrossReferences as newer, dbReferences as older from uniprot_entry),
u1 as (select rec_id, case when newer is not null then list_transform(newer, lambda x: {{'d': x.database, 'i': x.id,
      'p': list_transform(x.properties, lambda p: {{'k': p.key, 'v': p.value}})}})
    else list_transform(json_extract(older, '$[*]'), lambda x: {{'d': coalesce(x ->> '$.database', x ->> '$.type'), 'i': x ->> '$.id',
      'p': case json_type(x, '$.properties')
        when 'ARRAY' then list_transform(json_extract(x, '$.properties[*]'), lambda p: {{'k': p ->> '$.key', 'v': p ->> '$.value'}})
        when 'OBJECT' then list_transform(json_keys(x, '$.properties'), lambda k: {{'k': k, 'v': json_extract_string(x, '$.properties."' || k || '"')}}) end}}) end as xs from u0),
u2 as (select rec_id, unnest(xs) as x, unnest(range(len(xs))) as n1 from u1),
u3 as (select rec_id, n1, coalesce(x.d, '') || '|' || coalesce(x.i, '') as base, unnest(case when len(x.p) > 0 then x.p else [null] end) as p from u2),
a0 as (select distinct rec_id, json_extract(rcsb_primary_citation, '$.rcsb_authors[*]') as xs from pdb_entry),
a1 as (select rec_id, unnest(xs) as a, unnest(range(len(xs))) as n1 from a0)
select distinct * from (
  select 'interpro_match' as src_table, rec_id, n1::int as n1, n2::int as n2, n3::int as n3, s::bigint || '-' || e::bigint as leaf
  from ip where regexp_full_match(s, '\\s*[+-]?[0-9]+\\s*') and regexp_full_match(e, '\\s*[+-]?[0-9]+\\s*')
  union all select 'uniprot_entry', rec_id, n1::int, -1, -1, case when p is null then base else base || '|' || coalesce(p.k, '') || '=' || coalesce(p.v, '') end from u3
  union all select 'pdb_entry', rec_id, n1::int, -1, -1, case json_type(a) when 'OBJECT' then a ->> '$.name' else a ->> '$' end
  from a1 where case json_type(a) when 'OBJECT' then a ->> '$.name' else a ->> '$' end is not null)
"""

_P2_LOCATIONS = f"""
with {_FRAGMENTS}
select rec_id, n1::int as n1, n2::int as n2, max(x ->> '$.metadata.accession') as accession, count(*) as n_fragments
from f where json_type(fr) <> 'NULL' group by rec_id, n1, n2
"""

_P3_BASE = f"""
refs as (
  select 'string_interaction' as src_table, {_fold('stringId_B')} as ref_id, loaded_at from string_interaction
  union all select 'go_annotation', unnest(regexp_extract_all(reference, '(?i)PMID[:\\s]*([0-9]+)', 1)), loaded_at from go_annotation
  union all select 'kegg_pathway', case when regexp_matches(g, '^[0-9]') then lower(left(entry_id, 3)) || ':' || regexp_extract(g, '^[0-9]+') else regexp_extract(g, '^[a-z][a-z0-9]*:[0-9]+') end, loaded_at
    from (select lower({_trim('g')}) as g, entry_id, loaded_at from (select unnest(genes) as g, entry_id, loaded_at from kegg_pathway))),
targets as (
  select 'string_interaction' as src_table, {_fold('stringId')} as ref_id, loaded_at, deleted_at from string_mapping
  union all select 'go_annotation', {_trim('pmid')}, loaded_at, deleted_at from pubmed_article
  union all select 'kegg_pathway', lower({_trim('entry_id')}), loaded_at, deleted_at from kegg_conv),
per as (select src_table, ref_id, date_trunc('month', loaded_at) + interval 1 month as until, count(*) as n from refs where ref_id is not null and loaded_at is not null group by all),
lost as (select * from per p where not exists (select 1 from targets t where t.src_table = p.src_table and t.ref_id = p.ref_id
  and t.loaded_at < p.until and (t.deleted_at is null or t.deleted_at >= p.until)))
"""

_P3 = f"with {_P3_BASE} select src_table, strftime(until - interval 1 month, '%Y-%m') as period, ref_id from lost"

_P3_COUNTS = f"""
with {_P3_BASE},
a as (select src_table, until, count(*) as n_refs, sum(n)::bigint as n_rows from per group by all),
b as (select src_table, until, count(*) as n_orphans, sum(n)::bigint as n_orphan_rows from lost group by all)
select src_table, strftime(until - interval 1 month, '%Y-%m') as period, n_refs, n_rows, coalesce(n_orphans, 0) as n_orphans, coalesce(n_orphan_rows, 0)::bigint as n_orphan_rows
from a left join b using (src_table, until)
"""

ORACLE = {
    "p1_found": _P1, "p1_interaction_summary": _P1_INTERACTIONS, "p1_annotation_summary": _P1_ANNOTATIONS,
    "p2_found": _P2, "p2_locations": _P2_LOCATIONS, "p3_found": _P3, "p3_orphan_counts": _P3_COUNTS,
}
