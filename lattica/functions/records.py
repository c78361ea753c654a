"""Accessors of source records as Column functions: no Python runs per row, and nested pruning reads only the fields used."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Evidence codes that stand for an experiment; names of the three aspects; order in which equal channels win.
EXPERIMENTAL = ("EXP", "IDA", "IPI", "IMP", "IGI", "IEP", "HTP", "HDA", "HMP", "HGI", "HEP")
ASPECTS = {"molecular_function": "MF", "biological_process": "BP", "cellular_component": "CC"}
CHANNELS = (("escore", "experimental"), ("dscore", "database"), ("tscore", "text_mining"), ("ascore", "co_expression"), ("nscore", "neighborhood"), ("fscore", "fusion"), ("pscore", "cooccurrence"))


def first(array: Column) -> Column:
    """The first element, or null for null and empty arrays."""
    return F.get(array, F.lit(0))


# ---- protein entries


def refs_of(refs: Column, database: str) -> Column:
    """Cross-references (structs with database) of one database, in order; [] for null."""
    return F.coalesce(F.filter(refs, lambda r: r.getField("database") == database), F.expr("array()").cast("array<struct<database:string,id:string,properties:array<struct<key:string,value:string>>>>"))


def ref_ids(refs: Column, *databases: str) -> Column:
    """Ids of the cross-references of the databases, one database after the other."""

    def of(database: str) -> Column:
        return F.transform(F.filter(refs, lambda r: r.getField("database") == database), lambda r: r.getField("id"))

    return F.coalesce(F.concat(*map(of, databases)), F.array().cast("array<string>"))


def properties_map(properties: Column) -> Column:
    """Properties as a map; of repeated keys the last one counts, as the reverse list is searched first."""
    known = F.filter(properties, lambda p: p.isNotNull() & p.getField("key").isNotNull())
    keys = F.array_distinct(F.transform(known, lambda p: p.getField("key")))
    last = lambda k: F.element_at(F.filter(known, lambda p: p.getField("key") == k), -1).getField("value")
    return F.map_from_arrays(keys, F.transform(keys, last))


def gene_name(genes: Column) -> Column:
    return first(genes).getField("geneName").getField("value")


def protein_name(description: Column) -> Column:
    return description.getField("recommendedName").getField("fullName").getField("value")


def function_text(comments: Column) -> Column:
    """Text of the first FUNCTION comment that has texts; '' if its value is missing, null if there is no such comment."""
    found = first(F.filter(comments, lambda c: (c.getField("commentType") == "FUNCTION") & (F.size(c.getField("texts")) > 0)))
    return F.when(found.isNotNull(), F.coalesce(first(found.getField("texts")).getField("value"), F.lit("")))


def ec_numbers(description: Column) -> Column:
    found = F.transform(description.getField("recommendedName").getField("ecNumbers"), lambda e: e.getField("value"))
    return F.coalesce(found, F.array().cast("array<string>"))


def is_reviewed(entry_type: Column, strict_compat: bool = False) -> Column:
    """Whether the entry is reviewed. strict_compat also accepts 'unreviewed', which holds the word."""
    word = F.contains(F.lower(entry_type), F.lit("reviewed")) if strict_compat else F.lower(entry_type).rlike(r"(^|[^a-z])reviewed")
    return F.coalesce(F.contains(entry_type, F.lit("Swiss-Prot")) | word, F.lit(False))


# ---- annotations


def without_prefix(identifier: Column) -> Column:
    return F.regexp_replace(identifier, "^[^:]*:", "")


def is_experimental(evidence: Column) -> Column:
    return F.coalesce(evidence, F.lit("")).isin(*EXPERIMENTAL)


def aspect_short(aspect: Column) -> Column:
    """MF, BP or CC; ? for any other value."""
    names = F.create_map(*(F.lit(x) for pair in ASPECTS.items() for x in pair))
    return F.coalesce(F.try_element_at(names, aspect), F.lit("?"))


def pmid(reference: Column) -> Column:
    return F.when(F.startswith(reference, F.lit("PMID:")), F.replace(reference, F.lit("PMID:"), F.lit("")))


def definition_text(definition: Column) -> Column:
    """Text of a definition given as an object or as plain text; '' without one."""
    plain = F.when(F.schema_of_variant(definition) == "STRING", F.try_variant_get(definition, "$", "string"))
    return F.coalesce(F.try_variant_get(definition, "$.text", "string"), plain, F.lit(""))


def go_term(term: Column) -> Column:
    """A term given as a variant, with its defaults: struct<id, name, definition, definition_xrefs, aspect, is_obsolete, synonyms, comment, children>.

    A definition is an object or plain text; synonyms that are no objects are left out; '' or [] stands for what is missing,
    null for an aspect, a comment or a definition that is not given.
    """
    get = lambda path, kind="string": F.try_variant_get(term, path, kind)
    text = lambda v, path: F.coalesce(F.try_variant_get(v, path, "string"), F.lit(""))
    listed = lambda path: F.coalesce(get(path, "array<variant>"), F.array().cast("array<variant>"))
    found = get("$.definition", "variant")
    given = found.isNotNull() & (F.schema_of_variant(found) != "VOID")
    objects = F.filter(listed("$.synonyms"), lambda v: F.startswith(F.schema_of_variant(v), F.lit("OBJECT")))
    return F.struct(
        text(term, "$.id").alias("id"), text(term, "$.name").alias("name"), F.nullif(F.when(given, definition_text(found)), F.lit("")).alias("definition"),
        F.coalesce(get("$.definition.xrefs", "array<string>"), F.array().cast("array<string>")).alias("definition_xrefs"), get("$.aspect").alias("aspect"),
        F.coalesce(get("$.isObsolete", "boolean"), F.lit(False)).alias("is_obsolete"), F.transform(objects, lambda v: F.struct(text(v, "$.name").alias("name"), text(v, "$.type").alias("type"))).alias("synonyms"),
        get("$.comment").alias("comment"), F.transform(listed("$.children"), lambda v: text(v, "$.id")).alias("children"),
    )


# ---- interactions


def string_pair(a: Column, b: Column) -> Column:
    return F.concat(F.least(a, b), F.lit(":"), F.greatest(a, b))


def dominant_source(row: dict[str, Column] | None = None) -> Column:
    """The channel with the highest score; of equal ones the first of CHANNELS."""
    score = {c: F.coalesce((row or {}).get(c, F.col(c)), F.lit(0.0)) for c, _ in CHANNELS}
    best = F.greatest(*score.values())
    out = F.when(F.lit(False), F.lit(""))
    for c, name in CHANNELS:
        out = out.when(score[c] == best, F.lit(name))
    return out


def is_high_confidence(score: Column) -> Column:
    return score >= 0.7


# ---- articles


def full_name(author: Column) -> Column:
    """Last and fore name, without the empty ones."""
    return F.concat_ws(" ", F.nullif(author.getField("last_name"), F.lit("")), F.nullif(author.getField("fore_name"), F.lit("")))


def author_names(authors: Column) -> Column:
    return F.transform(authors, full_name)


def citation(authors: Column, title: Column, abbreviation: Column, journal: Column, year: Column) -> Column:
    """`A, B, C et al.. Title. Journal. Year.`: three authors at most, the short journal name before the long one, '' for what is missing."""
    text = lambda c: F.coalesce(c, F.lit(""))
    names = text(F.array_join(F.slice(author_names(authors), 1, 3), ", "))
    more = F.when(F.size(authors) > 3, F.lit(" et al.")).otherwise(F.lit(""))
    where = F.coalesce(F.nullif(abbreviation, F.lit("")), F.nullif(journal, F.lit("")), F.lit(""))
    return F.concat(names, more, F.lit(". "), text(title), F.lit(". "), where, F.lit(". "), text(year), F.lit("."))


def pubmed_url(number: Column) -> Column:
    return url(ARTICLE_PAGE, number, "/")


# ---- structures and predictions


def polymer(entity: Column) -> Column:
    """(uniprot_ids, sequence) of a polymer entity; [] and null where it does not say."""
    ids = entity.getField("rcsb_polymer_entity_container_identifiers").getField("uniprot_ids")
    return F.struct(F.coalesce(ids, F.array().cast("array<string>")).alias("uniprot_ids"), entity.getField("entity_poly").getField("pdbx_seq_one_letter_code_can").alias("sequence"))


def ligand(entity: Column) -> Column:
    """(ligand_id, ligand_name) of a non-polymer entity given as a variant; null where it does not say."""
    return F.struct(F.try_variant_get(entity, "$.pdbx_entity_nonpoly.comp_id", "string").alias("ligand_id"), F.try_variant_get(entity, "$.chem_comp.name", "string").alias("ligand_name"))


# Addresses of public structure files.
STRUCTURE_PAGE, STRUCTURE_FILE = "https://www.rcsb.org/structure/", "https://files.rcsb.org/download/"
PREDICTION_FILE, ARTICLE_PAGE = "https://alphafold.ebi.ac.uk/files/", "https://pubmed.ncbi.nlm.nih.gov/"


def url(prefix: str, identifier: Column, suffix: str = "") -> Column:
    return F.concat(F.lit(prefix), identifier, F.lit(suffix))


def urls(prefix: str, identifiers: Column, suffix: str = "") -> Column:
    return F.transform(identifiers, lambda x: url(prefix, x, suffix))


def prediction_url(entry_id: Column, version: Column, form: str = "cif") -> Column:
    """Address of a prediction's file: cif, pdb, bcif, or pae for the matrix of position errors."""
    middle, suffix = ("-predicted_aligned_error_v", ".json") if form == "pae" else ("-model_v", f".{form}")
    return F.concat(F.lit(PREDICTION_FILE), entry_id, F.lit(middle), version.cast("string"), F.lit(suffix))


def error_matrix(json: Column) -> Column:
    """The matrix of a payload that is an object or a list with one object."""
    v = F.try_parse_json(json)
    return F.coalesce(F.try_variant_get(v, "$.predicted_aligned_error", "array<array<double>>"), F.try_variant_get(v, "$[0].predicted_aligned_error", "array<array<double>>"))


def fragment_number(entry_id: Column) -> Column:
    """The number in a part -F<number>- of a prediction's id; 1 without one."""
    return F.coalesce(F.nullif(F.regexp_extract(entry_id, r"(?:^|-)F(\d+)(?:-|$)", 1), F.lit("")).try_cast("int"), F.lit(1))


def sequence_length(start: Column, end: Column, sequence: Column) -> Column:
    return F.coalesce(end - start + 1, F.nullif(F.length(sequence), F.lit(0)))


def is_square(matrix: Column) -> Column:
    return F.forall(matrix, lambda r: F.size(r) == F.size(matrix))


def all_positions(locations: Column) -> Column:
    """(start, end) of every fragment of every location, in order."""
    each = lambda l: F.transform(l.getField("fragments"), lambda f: F.struct(f.getField("start").alias("start"), f.getField("end").alias("end")))
    return F.flatten(F.transform(locations, each))
