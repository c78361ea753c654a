"""Article and full-text XML. Parsing needs mixed content and namespaces, so it runs in Arrow batches."""

from __future__ import annotations

import re
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lattica.schemas import struct

ARTICLE = (
    "pmid STRING, title STRING, abstract STRING, journal STRING, journal_abbrev STRING, year STRING, volume STRING, issue STRING, pages STRING, doi STRING, pmc STRING, "
    "authors ARRAY<STRUCT<last_name: STRING, fore_name: STRING, initials: STRING, affiliation: STRING>>, mesh_terms ARRAY<STRING>, publication_types ARRAY<STRING>"
)
_DOCTYPE = re.compile(r"<!DOCTYPE[^>\[]*(\[[^\]]*\])?[^>]*>", re.S)


def root_of(text: str | None) -> ElementTree.Element | None:
    """The document's root; null for null, empty and malformed text. A document type is taken off, nothing external is read."""
    if not text:
        return None
    try:
        return ElementTree.fromstring(_DOCTYPE.sub("", text).strip())
    except ElementTree.ParseError:
        return None


def _text(parent: ElementTree.Element | None, path: str, plain: bool) -> str | None:
    """Text at a path: all of it, or (plain) only what stands before the first inner tag."""
    node = None if parent is None else parent.find(path)
    if node is None:
        return None
    return (node.text if plain else "".join(node.itertext())) or None


def article(node: ElementTree.Element, compat: bool = False) -> dict | None:
    """An article element as a record, null without a number. compat: texts end at the first inner tag, and the last id of a kind anywhere counts, even of a cited article."""
    number = _text(node, ".//PMID", compat)
    if number is None:
        return None
    parts = []
    for a in node.iterfind(".//AbstractText"):
        text = (a.text if compat else "".join(a.itertext())) or ""
        label = a.get("Label")
        if text or label:
            parts.append(f"{label}: {text}" if label else text)
    own = node.iterfind(".//ArticleId") if compat else node.iterfind("./PubmedData/ArticleIdList/ArticleId")
    ids: dict[str, str | None] = {}
    for x in own:
        kind = x.get("IdType", "")
        if compat or kind not in ids:
            ids[kind] = x.text
    journal = node.find(".//Journal")
    people = [
        {"last_name": _text(p, "LastName", compat) or "", "fore_name": _text(p, "ForeName", compat) or "", "initials": _text(p, "Initials", compat) or "", "affiliation": _text(p, ".//Affiliation", compat)}
        for p in node.iterfind(".//AuthorList/Author")
    ]
    return {
        "pmid": number, "title": _text(node, ".//ArticleTitle", compat), "abstract": " ".join(parts) or None, "journal": _text(journal, "Title", compat), "journal_abbrev": _text(journal, "ISOAbbreviation", compat),
        "year": _text(journal, ".//PubDate/Year", compat) or _text(journal, ".//PubDate/MedlineDate", compat), "volume": _text(journal, ".//Volume", compat), "issue": _text(journal, ".//Issue", compat),
        "pages": _text(node, ".//MedlinePgn", compat), "doi": ids.get("doi"), "pmc": ids.get("pmc"), "authors": people,
        "mesh_terms": [t for m in node.iterfind(".//MeshHeading") if (t := _text(m, "DescriptorName", compat))], "publication_types": [t.text for t in node.iterfind(".//PublicationType") if t.text],
    }


def articles_of(text: str | None, compat: bool = False) -> list[dict]:
    """All articles of a document; [] if it cannot be read. Articles without a number are skipped."""
    root = root_of(text)
    if root is None:
        return []
    found = [root] if root.tag == "PubmedArticle" else root.iterfind(".//PubmedArticle")
    return [r for x in found if (r := article(x, compat))]


def parse_articles(documents: Column | str, compat: bool = False) -> Column:
    """Articles of each document, as an array of structs."""

    def parse(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: articles_of(t, compat))

    return F.pandas_udf(parse, T.ArrayType(struct(ARTICLE)))(documents)


def paragraphs_of(text: str | None) -> str | None:
    """Paragraphs of a full text in any namespace, white space collapsed, blank ones left out, with a blank line between; null without any.

    A paragraph inside another one comes out twice, once in each.
    """
    root = root_of(text)
    if root is None:
        return None
    found = (" ".join("".join(p.itertext()).split()) for p in root.iter() if isinstance(p.tag, str) and p.tag.rpartition("}")[2] == "p")
    return "\n\n".join(x for x in found if x) or None


@F.pandas_udf(T.StringType())
def paragraphs(documents: pd.Series) -> pd.Series:
    return documents.map(paragraphs_of)
