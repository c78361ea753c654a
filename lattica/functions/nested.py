"""Column functions that bring records of several shapes into one nested form, ready for shredding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(json: Column | str) -> Column:
    """JSON text as a variant; null where it cannot be read."""
    return F.try_parse_json(json)


def member(v: Column, name: str, kind: str = "string") -> Column:
    """A member of a variant as the type given; null where it is absent, null or of another kind."""
    return F.try_variant_get(v, f"$.{name}", kind)


def kind_of(v: Column) -> Column:
    """The kind of a variant in capitals, as in STRING, OBJECT<...>, ARRAY<...>, BIGINT, VOID."""
    return F.schema_of_variant(v)


def present(v: Column) -> Column:
    """Whether a variant is there and is not JSON's null."""
    return v.isNotNull() & ~F.is_variant_null(v)


def one_or_many(v: Column, name: str) -> Column:
    """A member that may be a list or a single object, as a list of variants; null where it is neither."""
    single = member(v, name, "variant")
    return F.coalesce(member(v, name, "array<variant>"), F.when(kind_of(single).startswith("OBJECT"), F.array(single)))


def domain_matches(payload: Column) -> Column:
    """A page of domain matches as array<struct<accession, locations: array<struct<model, fragments: array<struct<start, end>>>>>>.

    Locations are those of the first protein that has any, else the result's own. A location without fragments is its
    own fragment. `begin` serves where `start` is absent. Positions stay text, as delivered.
    """

    def fragment(f: Column) -> Column:
        found = F.struct(F.coalesce(member(f, "start"), member(f, "begin")).alias("start"), member(f, "end").alias("end"))
        return F.when(present(f), found)

    def location(x: Column) -> Column:
        inner = member(x, "fragments", "array<variant>")
        fragments = F.transform(F.when(F.size(inner) > 0, inner).otherwise(F.array(x)), fragment)
        return F.when(present(x), F.struct(member(x, "model").alias("model"), fragments.alias("fragments")))

    def result(x: Column) -> Column:
        by_protein = F.transform(one_or_many(x, "proteins"), lambda p: member(p, "entry_protein_locations", "array<variant>"))
        first = F.get(F.filter(by_protein, lambda locations: F.size(locations) > 0), F.lit(0))
        locations = F.coalesce(first, member(x, "entry_protein_locations", "array<variant>"))
        accession = F.try_variant_get(x, "$.metadata.accession", "string")
        return F.when(present(x), F.struct(accession.alias("accession"), F.transform(locations, location).alias("locations")))

    return F.transform(F.try_variant_get(parsed(payload), "$.results", "array<variant>"), result)


def cross_references(newer: Column, older: Column) -> Column:
    """Cross-references as array<struct<database, id, properties: array<struct<key, value>>>>.

    The newer field is taken if it is not null, else the older one: JSON, with the database also as `type` and the
    properties as a list of pairs or as an object, whose members come in the order of their names.
    """

    def pair(p: Column) -> Column:
        return F.when(p.isNotNull(), F.struct(p.getField("key").alias("key"), p.getField("value").alias("value")))

    def native(x: Column) -> Column:
        inner = F.struct(x.getField("database").alias("database"), x.getField("id").alias("id"), F.transform(x.getField("properties"), pair).alias("properties"))
        return F.when(x.isNotNull(), inner)

    def listed(x: Column) -> Column:
        as_list = F.transform(member(x, "properties", "array<variant>"), lambda p: F.when(present(p), F.struct(member(p, "key").alias("key"), member(p, "value").alias("value"))))
        entries = F.map_entries(member(x, "properties", "map<string,string>"))
        as_object = F.transform(entries, lambda e: F.struct(e.getField("key").alias("key"), e.getField("value").alias("value")))
        inner = F.struct(F.coalesce(member(x, "database"), member(x, "type")).alias("database"), member(x, "id").alias("id"), F.coalesce(as_list, as_object).alias("properties"))
        return F.when(present(x), inner)

    old = F.transform(F.try_variant_get(parsed(older), "$", "array<variant>"), listed)
    return F.when(newer.isNotNull(), F.transform(newer, native)).otherwise(old)


def citation_authors(citation: Column) -> Column:
    """Names of a citation's `rcsb_authors`, which may be texts or objects with a name, as array<struct<name>>."""

    def author(a: Column) -> Column:
        plain = F.when(kind_of(a) == "STRING", F.try_variant_get(a, "$", "string"))
        return F.when(present(a), F.struct(F.coalesce(plain, member(a, "name")).alias("name")))

    return F.transform(member(parsed(citation), "rcsb_authors", "array<variant>"), author)
