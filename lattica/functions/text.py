"""Text: references to articles, file names, excerpts, samples and prompts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Samples that go into a prompt: (member of the context, longest sample).
SAMPLES = (("features", 20), ("feature_relationships", 30), ("go_terms", 30), ("go_relationships", 40), ("articles", 25))
LINK_SAMPLE = 40
FULL_TEXT_LIMIT, EXCERPT = 100_000, 1_200


def pmids(*values: Column) -> Column:
    """Distinct article numbers in any number of text columns, ascending; every spelling of the label counts."""
    found = [F.coalesce(F.regexp_extract_all(v, F.lit(r"(?i)PMID[:\s]?(\d+)"), F.lit(1)), F.array().cast("array<string>")) for v in values]
    return F.array_sort(F.array_distinct(F.concat(*found)))


def pmids_in(nested: Column) -> Column:
    """Distinct article numbers anywhere in a nested value, found in its JSON form."""
    return pmids(F.to_json(nested))


def safe_name(name: Column) -> Column:
    """A name for a file: runs of other characters than letters, digits, dot, underscore and hyphen become one underscore."""
    return F.btrim(F.regexp_replace(name, r"[^A-Za-z0-9._-]+", "_"), F.lit("_"))


def limited(text: Column, n: int = FULL_TEXT_LIMIT) -> Column:
    return F.substring(text, 1, n)


def excerpt(text: Column) -> Column:
    """(excerpt, characters): the beginning of a text and its whole length."""
    return F.struct(F.substring(text, 1, EXCERPT).alias("excerpt"), F.coalesce(F.length(text), F.lit(0)).alias("characters"))


def prompt_context(context: Column) -> Column:
    """Counts of the full lists of a context and bounded samples of them, in the order of the sorted lists."""
    links = context.getField("article_relationships")
    cited, evidenced = links.getField("cited_in"), links.getField("feature_evidenced_by")
    counts = F.struct(*(F.size(context.getField(name)).alias(name) for name, _ in SAMPLES), F.size(cited).alias("cited_in"), F.size(evidenced).alias("feature_evidenced_by"))
    samples = [F.slice(F.array_sort(context.getField(name)), 1, n).alias(name) for name, n in SAMPLES]
    return F.struct(context.getField("protein").alias("protein"), counts.alias("counts"), *samples, F.slice(F.array_sort(cited), 1, LINK_SAMPLE).alias("cited_in"), F.slice(F.array_sort(evidenced), 1, LINK_SAMPLE).alias("feature_evidenced_by"))


SYSTEM = "You describe proteins for biologists. Use only the data given, name the records you rely on and say what is missing."


def network_context(context: Column) -> Column:
    """A whole context, but full texts of its articles by their beginning (full_text_excerpt) and length (full_text_char_count)."""

    def packed(a: Column) -> Column:
        found = excerpt(a.getField("full_text"))
        count = F.when(a.getField("full_text").isNotNull(), found.getField("characters"))
        return a.withField("full_text_excerpt", found.getField("excerpt")).withField("full_text_char_count", count).dropFields("full_text")

    return context.withField("articles", F.transform(context.getField("articles"), packed))


def user_prompt(accession: Column, context: Column, files: Column) -> Column:
    """The prompt for one protein: the data as JSON, structure files by their names in the manifest."""
    return F.concat(
        F.lit("Describe protein "), accession, F.lit(".\nCover function, domains and sites, annotation, structures and literature.\nRefer to a structure file as [structure/<file name>].\nData:\n"),
        F.to_json(context), F.lit("\nStructure files:\n"), F.coalesce(F.to_json(files), F.lit("[]")),
    )


def network_prompt(accessions: Column, contexts: Column, edges: Column, files: Column) -> Column:
    """The prompt for several proteins, their contexts as network_context gives them; up to two are to be described in moderate detail, more of them briefly."""
    detail = F.when(F.size(accessions) <= 2, F.lit("in moderate detail")).otherwise(F.lit("briefly"))
    return F.concat(
        F.lit("Describe each of these proteins "), detail, F.lit(" and how they act together: "), F.array_join(accessions, ", "),
        F.lit(".\nRefer to a structure file as [structure/<file name>].\nProteins:\n"), F.to_json(contexts), F.lit("\nInteractions:\n"), F.coalesce(F.to_json(edges), F.lit("[]")),
        F.lit("\nStructure files:\n"), F.coalesce(F.to_json(files), F.lit("[]")),
    )


def messages(prompt: Column) -> Column:
    """System and user message, in order."""
    one = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(one("system", F.lit(SYSTEM)), one("user", prompt))
