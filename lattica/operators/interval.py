"""Residue intervals: projection of features onto structures, and slices of fixed-width structure files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lattica.functions.text import safe_name
from lattica.session import staged


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], a: tuple[str, str] = ("start", "end"), b: tuple[str, str] = ("unp_start", "unp_end")) -> DataFrame:
    """Pairs of equal keys whose intervals (both ends inclusive) overlap. The keys make it a hash or merge join with a residual filter."""
    r = right.withColumnsRenamed({k: f"__lt_r_{k}" for k in keys})
    on = [F.col(k) == F.col(f"__lt_r_{k}") for k in keys] + [F.col(a[0]) <= F.col(b[1]), F.col(a[1]) >= F.col(b[0])]
    return left.join(r, on).drop(*(f"__lt_r_{k}" for k in keys))


def bin_join(left: DataFrame, right: DataFrame, a: tuple[str, str], b: tuple[str, str], width: int) -> DataFrame:
    """Overlapping pairs without an equal key: both sides go into bins of `width`, and a pair counts in its first common bin."""
    bins = lambda s, e: F.explode(F.sequence(F.floor(F.col(s) / width), F.floor(F.col(e) / width)))
    x = left.where(F.col(a[0]) <= F.col(a[1])).withColumn("__lt_bin", bins(*a))
    y = right.where(F.col(b[0]) <= F.col(b[1])).withColumn("__lt_bin", bins(*b))
    first = F.floor(F.greatest(F.col(a[0]), F.col(b[0])) / width)
    return x.join(y, "__lt_bin").where((F.col(a[0]) <= F.col(b[1])) & (F.col(a[1]) >= F.col(b[0])) & (F.col("__lt_bin") == first)).drop("__lt_bin")


def projected(start: Column, end: Column, unp_start: Column, unp_end: Column, pdb_start: Column, pdb_end: Column) -> Column:
    """(lo, hi): the residues of a structure that a feature's overlap with a mapped segment falls on; numbering may run backwards."""
    lo, hi = F.greatest(start, unp_start), F.least(end, unp_end)
    way = F.when(pdb_end >= pdb_start, 1).otherwise(-1)
    x, y = pdb_start + way * (lo - unp_start), pdb_start + way * (hi - unp_start)
    return F.struct(F.least(x, y).alias("lo"), F.greatest(x, y).alias("hi"))


def project_features(features: DataFrame, segments: DataFrame, keys: list[str]) -> DataFrame:
    """Features (keys, start, end) on structures: one row per feature and mapped segment it overlaps, with chain_id, lo and hi.

    A feature that does not start and end at 1 or beyond, or ends before it starts, lies on nothing.
    """
    p = projected(*(F.col(c) for c in ("start", "end", "unp_start", "unp_end", "pdb_start", "pdb_end")))
    real = features.where((F.col("start") > 0) & (F.col("end") >= F.col("start")))
    joined = overlap_join(real, segments, keys).withColumn("p", p)
    return joined.withColumns({"lo": F.col("p.lo"), "hi": F.col("p.hi")}).drop("p", "unp_start", "unp_end", "pdb_start", "pdb_end")


def _segment(v: Column) -> Column:
    whole = lambda *names: F.coalesce(*(F.nullif(F.try_variant_get(v, f"$.{n}", "int"), F.lit(0)) for n in names))
    return F.struct(
        F.trim(F.try_variant_get(v, "$.chain_id", "string")).alias("chain_id"),
        whole("unp_start", "unp_start_residue_number", "start.residue_number").alias("unp_start"), whole("unp_end", "unp_end_residue_number", "end.residue_number").alias("unp_end"),
        whole("start.author_residue_number", "start.residue_number", "pdb_start").alias("pdb_start"), whole("end.author_residue_number", "end.residue_number", "pdb_end").alias("pdb_end"),
    )


def _whole(s: Column) -> Column:
    found = (s.getField("chain_id") != "") & s.getField("unp_start").isNotNull() & s.getField("unp_end").isNotNull() & s.getField("pdb_start").isNotNull() & s.getField("pdb_end").isNotNull()
    return F.coalesce(found, F.lit(False))


def mapping_segments(payload: Column) -> Column:
    """All segments of a residue mapping payload {structure: {UniProt: {accession: {mappings: [...]}}}}.

    array<struct<structure, accession, chain_id, unp_start, unp_end, pdb_start, pdb_end>>, structures in upper case. A
    bound is taken from the first of its fields that is neither missing nor 0; segments without a chain or without four
    whole bounds are dropped. Null where the payload cannot be read.
    """
    members = lambda v, path: F.map_entries(F.try_variant_get(v, path, "map<string, variant>"))
    listed = lambda x: F.coalesce(x, F.array().cast(_SEGMENTS))

    def of_entry(structure: Column, accession: Column, v: Column) -> Column:
        named = lambda s: F.struct(F.upper(structure).alias("structure"), accession.alias("accession"), *(s.getField(c).alias(c) for c in _BOUNDS))
        return listed(F.transform(F.filter(F.transform(F.try_variant_get(v, "$.mappings", "array<variant>"), _segment), _whole), named))

    def of_structure(e: Column) -> Column:
        of = F.transform(members(e.getField("value"), "$.UniProt"), lambda a: of_entry(e.getField("key"), a.getField("key"), a.getField("value")))
        return listed(F.flatten(of))

    return F.flatten(F.transform(members(F.try_parse_json(payload), "$"), of_structure))


BOUNDS = "array<struct<chain_id: string, unp_start: int, unp_end: int, pdb_start: int, pdb_end: int>>"
_BOUNDS = ("chain_id", "unp_start", "unp_end", "pdb_start", "pdb_end")
_SEGMENTS = "array<struct<structure: string, accession: string, chain_id: string, unp_start: int, unp_end: int, pdb_start: int, pdb_end: int>>"


def segments(payload: Column, structure: Column | None = None, accession: Column | None = None) -> Column:
    """Segments of a mapping payload, as array<struct<chain_id, unp_start, unp_end, pdb_start, pdb_end>>: those of a structure and an accession.

    Without these, the payload is the entry of one accession itself: {mappings: [...]}, or a whole payload of which all
    segments count.
    """
    bounds = lambda s: F.struct(*(s.getField(c).alias(c) for c in _BOUNDS))
    every = mapping_segments(payload)
    if structure is not None and accession is not None:
        return F.transform(F.filter(every, lambda s: (s.getField("structure") == F.upper(structure)) & (s.getField("accession") == accession)), bounds)
    own = F.filter(F.transform(F.try_variant_get(F.try_parse_json(payload), "$.mappings", "array<variant>"), _segment), _whole)
    return F.coalesce(own, F.transform(every, bounds))


def atoms(lines: DataFrame) -> DataFrame:
    """Atom lines of structure files (structure, line_no, value) with chain and residue number; other lines, and those whose number is not whole, are dropped."""
    v = F.col("value")
    parsed = lines.where(v.startswith("ATOM") | v.startswith("HETATM"))
    number = F.trim(F.substring(v, 23, 4)).try_cast("int")
    return parsed.withColumns({"chain_id": F.trim(F.substring(v, 22, 1)), "residue": number}).where("residue is not null")


def _files(kept: DataFrame, keys: list[str]) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "value")))
    text = F.concat(F.array_join(F.transform(ordered, lambda x: x.getField("value")), "\n"), F.lit("\nEND\n"))
    return kept.groupBy(*keys).agg(text.alias("content"), F.count(F.lit(1)).alias("n_atoms"))


def slice_by_range(lines: DataFrame, start: int, end: int) -> DataFrame:
    """(structure, content, n_atoms): atoms with a residue number in the range, then END; structures without any give no row, nor does an empty range."""
    return _files(atoms(lines).where(F.col("residue").between(start, end) & F.lit(0 < start <= end)), ["structure"])


def slice_by_chains(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """(structure, feature, content, n_atoms): atoms inside any range (structure, feature, chain_id, lo, hi) of their chain; ranges with a bound below 1 are ignored.

    Lines are never broadcast, as their number may be far above what their source lets Spark expect. A line has one
    chain, so hits are distinct where the join leaves them.
    """
    r = ranges.where("lo > 0 and hi > 0").select(F.col("structure").alias("s"), "feature", F.trim("chain_id").alias("c"), "lo", "hi")
    a = atoms(lines).hint("merge")
    hit = a.join(r, (F.col("structure") == F.col("s")) & (F.col("chain_id") == F.col("c")) & F.col("residue").between(F.col("lo"), F.col("hi")))
    return _files(hit.select("structure", "chain_id", "feature", "line_no", "value").distinct(), ["structure", "feature"])


def chain_tag(chains: Column) -> Column:
    """Distinct chains in order, joined by underscores."""
    return F.array_join(F.array_sort(F.array_distinct(chains)), "_")


def structure_manifest(features: DataFrame, structures: DataFrame, segs: DataFrame, lines: DataFrame, max_structures: int = 5, files: bool = False) -> DataFrame:
    """The slice of each location of a feature: (accession, feature, start, end, structure, kind, chain_tag, n_atoms).

    structures (accession, structure, place) lists the structures of a protein in order of preference; the first
    max_structures count. A location (accession, feature, start, end) takes the first structure whose mapping gives a
    slice that is not empty (kind mapped); else the plain slice of the protein's first structure (kind plain); else no
    row. Repeated rows count once. files adds the slice's content and its chain_ranges. Locations, their ranges and the
    mapped slices are staged, so that each is made once and no plan holds them all.
    """
    at = ["accession", "feature", "start", "end"]
    ranked = structures.withColumn("n", F.row_number().over(Window.partitionBy("accession").orderBy("place", "structure"))).where(F.col("n") <= max_structures)
    valid = features.select(*at).where("accession is not null and trim(accession) <> '' and start is not null and end is not null").distinct()
    on = project_features(valid.join(ranked, "accession"), segs, ["accession", "structure"])
    cut = slice_by_chains(lines, on.select("structure", F.struct(*at).alias("feature"), "chain_id", "lo", "hi").distinct())
    tags = on.groupBy(*at, "structure", "n").agg(chain_tag(F.collect_list("chain_id")).alias("chain_tag"), F.array_sort(F.collect_set(F.struct("chain_id", F.col("lo").alias("pdb_start"), F.col("hi").alias("pdb_end")))).alias("chain_ranges"))
    extra = ["content", "chain_ranges"] if files else []
    mapped = cut.select("feature.*", "structure", "n_atoms", "content").join(tags, [*at, "structure"])
    best = mapped.groupBy(*at).agg(F.min_by(F.struct("structure", "chain_tag", "n_atoms", *extra), "n").alias("b"))
    found = staged(best.select(*at, "b.structure", F.lit("mapped").alias("kind"), "b.chain_tag", "b.n_atoms", *(f"b.{c}" for c in extra)), "slices")
    rest = valid.join(found.select(*at), at, "left_anti").join(ranked.where("n = 1").select("accession", "structure"), "accession")
    plain = rest.join(atoms(lines).select("structure", "residue", "line_no", "value").hint("merge"), "structure").where(F.col("residue").between(F.col("start"), F.col("end")) & (F.col("start") > 0))
    naive = _files(plain, [*at, "structure"]).withColumn("chain_ranges", F.array().cast(tags.schema["chain_ranges"].dataType))
    return found.unionByName(naive.select(*at, "structure", F.lit("plain").alias("kind"), F.lit("").alias("chain_tag"), "n_atoms", *extra))


def slice_names(manifest: DataFrame, folder: str = "structure") -> DataFrame:
    """A manifest of slices with the columns filename, path and placeholder of each slice's file."""
    span = F.concat_ws("_", F.lit("feature"), safe_name(F.col("feature").cast("string")), F.col("start").cast("string"), F.col("end").cast("string"))
    mapped = F.concat(span, F.lit("_pdb_"), safe_name(F.col("structure")), F.lit("_chain_"), safe_name(F.col("chain_tag")))
    named = manifest.withColumn("filename", F.concat(F.when(F.col("kind") == "mapped", mapped).otherwise(span), F.lit(".pdb")))
    return named.withColumn("path", F.concat(F.lit(f"{folder}/"), F.col("filename"))).withColumn("placeholder", F.concat(F.lit("["), F.col("path"), F.lit("]")))
