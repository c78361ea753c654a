"""Flat files of sections: a line that starts with a word opens a section, indented lines go on with it, `///` ends the file."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EMPTY = "array()"


def lines(raw: Column) -> Column:
    """Lines before the first one that starts with ///; Unicode line ends count as well."""
    every = F.split(raw, r"\R")
    end = F.array_position(F.transform(every, lambda x: F.startswith(x, F.lit("///"))), True)
    return F.when(end > 0, F.slice(every, F.lit(1), (end - 1).cast("int"))).otherwise(every)


def sections(raw: Column) -> Column:
    """Sections in order, as array<struct<name, line>>: one element per line that is not blank. Lines before any section are dropped.

    One pass with the open section's name as state, inside the row, so no shuffle is needed.
    """
    kind = "struct<name:string,found:array<struct<name:string,line:string>>>"
    start = F.struct(F.lit(None).cast("string").alias("name"), F.expr(_EMPTY).cast("array<struct<name:string,line:string>>").alias("found")).cast(kind)

    def step(state: Column, x: Column) -> Column:
        opens = x.rlike(r"^\S")
        name = F.when(opens, F.regexp_extract(x, r"^(\S+)", 1)).otherwise(state.getField("name"))
        line = F.btrim(F.when(opens, F.regexp_replace(x, r"^\S+", "")).otherwise(x), F.lit(" \t"))
        here = F.array(F.struct(name.alias("name"), line.alias("line")))
        found = F.when(name.isNotNull() & (line != ""), F.concat(state.getField("found"), here)).otherwise(state.getField("found"))
        return F.struct(name.alias("name"), found.alias("found")).cast(kind)

    return F.aggregate(lines(raw), start, step, lambda s: s.getField("found"))


def section(found: Column, name: str) -> Column:
    """Lines of a section, repeated sections one after the other; [] without it."""
    return F.transform(F.filter(found, lambda x: x.getField("name") == name), lambda x: x.getField("line"))


def tokens(line: Column) -> Column:
    return F.filter(F.split(line, r"\s+"), lambda t: t != "")


def first_tokens(rows: Column) -> Column:
    return F.transform(rows, lambda x: F.get(tokens(x), F.lit(0)))


def db_links(rows: Column) -> Column:
    """`db: id id` lines as map<string, array<string>>; the last of repeated names counts."""
    valid = F.filter(rows, lambda x: F.contains(x, F.lit(":")))
    name = lambda x: F.btrim(F.split(x, ":", 2)[0])
    keys = F.array_distinct(F.transform(valid, name))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: tokens(F.split(F.element_at(F.filter(valid, lambda x: name(x) == k), -1), ":", 2)[1])))


def ec_numbers(rows: Column) -> Column:
    """Distinct EC numbers after `EC:`, in order; of several in one bracket only the first."""
    return F.array_distinct(F.flatten(F.transform(rows, lambda x: F.regexp_extract_all(x, F.lit(r"EC:([\d.\-]+)"), F.lit(1)))))


def gene_entry(raw: Column) -> Column:
    """A gene's flat file as a struct."""
    s = sections(raw)
    part = lambda name: section(s, name)
    two = lambda rows: F.transform(F.filter(rows, lambda x: F.size(F.split(x, r"\s+", 2)) == 2), lambda x: F.struct(F.split(x, r"\s+", 2)[0].alias("id"), F.split(x, r"\s+", 2)[1].alias("name")))
    organism = F.get(part("ORGANISM"), F.lit(0))
    links = db_links(part("DBLINKS"))
    return F.struct(
        F.get(tokens(F.get(part("ENTRY"), F.lit(0))), F.lit(0)).alias("entry_id"),
        F.get(part("NAME"), F.lit(0)).alias("name"),
        F.array_join(part("DEFINITION"), " ").alias("definition"),
        F.get(tokens(F.get(part("ORTHOLOGY"), F.lit(0))), F.lit(0)).alias("ko"),
        F.array_join(F.slice(tokens(F.get(part("ORTHOLOGY"), F.lit(0))), 2, F.greatest(F.size(tokens(F.get(part("ORTHOLOGY"), F.lit(0)))) - 1, F.lit(0))), " ").alias("ko_definition"),
        F.get(F.split(organism, r"\s+", 2), F.lit(0)).alias("organism_code"),
        F.get(F.split(organism, r"\s+", 2), F.lit(1)).alias("organism_name"),
        two(part("PATHWAY")).alias("pathways"),
        two(part("MODULE")).alias("modules"),
        F.array_distinct(F.concat(ec_numbers(part("ORTHOLOGY")), ec_numbers(part("DEFINITION")))).alias("ec_numbers"),
        F.transform(part("DISEASE"), lambda x: F.coalesce(F.get(F.split(x, r"\s+", 2), F.lit(1)), x)).alias("diseases"),
        links.alias("db_links"),
        F.flatten(F.transform(F.filter(part("STRUCTURE"), lambda x: F.startswith(x, F.lit("PDB:"))), lambda x: tokens(F.regexp_replace(x, "PDB:", "")))).alias("pdb_ids"),
        F.get(F.coalesce(F.try_element_at(links, F.lit("UniProt")), F.try_element_at(links, F.lit("Uniprot"))), F.lit(0)).alias("uniprot"),
    )


def pathway_entry(raw: Column) -> Column:
    """A pathway's flat file as a struct."""
    s = sections(raw)
    line = lambda name: F.get(section(s, name), F.lit(0))
    return F.struct(
        F.get(tokens(line("ENTRY")), F.lit(0)).alias("entry_id"),
        line("NAME").alias("name"),
        F.array_join(section(s, "DESCRIPTION"), " ").alias("description"),
        line("CLASS").alias("pathway_class"),
        first_tokens(section(s, "GENE")).alias("genes"),
        first_tokens(section(s, "COMPOUND")).alias("compounds"),
        F.get(tokens(line("KO_PATHWAY")), F.lit(0)).alias("ko_pathway"),
    )


def enzyme_entry(raw: Column) -> Column:
    """An enzyme's flat file as a struct; genes as organism (lower case) -> ids without names in brackets."""
    s = sections(raw)
    genes = F.filter(section(s, "GENES"), lambda x: F.contains(x, F.lit(":")))
    code = lambda x: F.lower(F.btrim(F.split(x, ":", 2)[0]))
    codes = F.array_distinct(F.transform(genes, code))
    ids = lambda x: F.transform(tokens(F.split(x, ":", 2)[1]), lambda g: F.regexp_replace(g, r"\(.*", ""))
    before = lambda name: F.transform(section(s, name), lambda x: F.btrim(F.split(x, r"\[", 2)[0]))
    return F.struct(
        F.regexp_extract(F.get(section(s, "ENTRY"), F.lit(0)), r"([\d.\-]+)", 1).alias("ec"),
        section(s, "NAME").alias("names"),
        before("SUBSTRATE").alias("substrates"),
        before("PRODUCT").alias("products"),
        first_tokens(section(s, "PATHWAY")).alias("pathways"),
        F.map_from_arrays(codes, F.transform(codes, lambda k: ids(F.element_at(F.filter(genes, lambda x: code(x) == k), -1)))).alias("genes"),
    )
