"""Readers of source records: files of each source's format into DataFrames with explicit schemas, and a source of requests."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lattica.schemas import RECORDS
from lattica.sources.transport import Limits, Requester, Transport


def read(spark: SparkSession, source: str, path: str, **options: str) -> DataFrame:
    """Records of a source. Parquet by default; format=json for lines or pages, tsv, xml or flat for the others."""
    form = options.pop("format", "parquet")
    if form == "json":
        return spark.read.schema(RECORDS[source]).options(**options).json(path)
    if form == "tsv":
        return read_tsv(spark, path)
    if form == "xml":
        return read_articles(spark, path)
    if form == "flat":
        return read_flat(spark, path)
    return spark.read.options(**options).parquet(path)


def read_pages(spark: SparkSession, path: str, record: str, member: str = "results") -> DataFrame:
    """Records of paged JSON: files of {member: [record, ...], next}; one row per record, in no order."""
    pages = spark.read.schema(f"{member} array<struct<{_fields(record)}>>").option("multiLine", True).json(path)
    return pages.select(F.explode(member).alias("r")).select("r.*")


def _fields(record: str) -> str:
    from lattica.schemas import struct

    return ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in struct(record).fields)


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """(line, id, value, file): lines of exactly two fields; line sorts as they stand in the file, which may be read in blocks."""
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), at.alias("line"), F.col("value").alias("text"))
    parts = F.split("text", "\t")
    return text.where(F.size(parts) == 2).select("line", F.trim(parts[0]).alias("id"), F.trim(parts[1]).alias("value"), "file")


def conversions(pairs: DataFrame, batch: bool = False) -> DataFrame:
    """(accession, gene_id) from lines (line, id, value and, of several files, file): the first line of an accession counts, in a batch the last one.

    Files count in the order of their names. `up:` is taken off.
    """
    pick = F.max_by if batch else F.min_by
    at = F.struct(*(c for c in ("file", "line") if c in pairs.columns))
    return pairs.groupBy(F.regexp_replace("id", "^up:", "").alias("accession")).agg(pick("value", at).alias("gene_id"))


def links(pairs: DataFrame) -> DataFrame:
    """(id, linked): link lines without `path:` and `ec:`; a link has no name of its own, so its id stands for it."""
    clean = F.regexp_replace("value", "^(path|ec):", "")
    return pairs.select("id", clean.alias("linked"), clean.alias("name"))


def find(pairs: DataFrame, query: str) -> DataFrame:
    return pairs.where(F.contains(F.lower("value"), F.lit(query.lower())) | (F.lower("id") == query.lower()))


def read_flat(spark: SparkSession, path: str) -> DataFrame:
    """(entry_id, raw): one row per file, the id from its name."""
    name = F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^./]*)?$", 1)
    return spark.read.text(path, wholetext=True).select(name.alias("entry_id"), F.col("value").alias("raw"))


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    from lattica.functions.xml import parse_articles

    return spark.read.text(path, wholetext=True).select(F.explode(parse_articles("value")).alias("a")).select("a.*")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(header, sequence) of FASTA files."""
    records = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("value")).where("trim(value) <> ''")
    parts = F.split("value", r"\R", 2)
    return records.select(F.trim(parts[0]).alias("header"), F.regexp_replace(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), r"\s", "").alias("sequence"))


def read_structures(spark: SparkSession, path: str) -> DataFrame:
    """(structure, line_no, value): lines of structure files, the structure from the file's name in upper case."""
    name = F.upper(F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^./]*)?$", 1))
    return spark.read.text(path, wholetext=True).select(name.alias("structure"), F.posexplode(F.split("value", r"\R")).alias("line_no", "value"))


# ---- queries over entries, as the services offer them

FIELDS = {"accession": "primaryAccession", "gene": "gene_name", "organism_id": "organism.taxonId", "reviewed": "is_reviewed"}


def where(query: str, reviewed_only: bool = False) -> Column:
    """`field:value AND field:value` as a condition on entries with gene_name and is_reviewed; unknown fields are an error."""
    condition = F.lit(True)
    for part in filter(str.strip, query.replace("(", " ").replace(")", " ").split(" AND ")):
        name, _, value = part.strip().partition(":")
        if name not in FIELDS:
            raise ValueError(f"cannot search by {name}")
        column = F.col(FIELDS[name])
        condition &= column == (value.lower() == "true" if name == "reviewed" else int(value) if name == "organism_id" else value)
    return condition & F.col("is_reviewed") if reviewed_only else condition


def search(entries: DataFrame, query: str, fields: list[str] | None = None, reviewed_only: bool = False, words: str = "search_text") -> DataFrame:
    """Entries that meet a query, with the columns of `fields` (all without). A query is `field:value` parts and free words, joined by AND or blanks.

    Free words are looked for in the column `words`, in any case; fields are those of `where`. All hits come, in no order;
    paging is left to the reader of the result.
    """
    plain = query.replace("(", " ").replace(")", " ").replace(" AND ", " ")
    named = [x for x in plain.split() if ":" in x]
    free = [x.lower() for x in plain.split() if ":" not in x]
    found = entries.where(where(" AND ".join(named), reviewed_only)) if named or reviewed_only else entries
    for word in free:
        found = found.where(F.contains(F.lower(words), F.lit(word)))
    return found.select(*fields) if fields else found


def keyword_hits(terms: DataFrame, query: str, limit: int = 25) -> DataFrame:
    """Terms (id, name) by the number of words of the query in their name; those without any are left out."""
    asked = F.array(*(F.lit(w) for w in sorted({w for w in query.lower().split()})))
    hits = F.size(F.array_intersect(F.split(F.lower("name"), r"\W+"), asked))
    return terms.withColumn("hits", hits).where("hits > 0").orderBy(F.col("hits").desc(), "id").limit(limit)


def best_matches(aliases: DataFrame, queries: DataFrame, limit: int = 1) -> DataFrame:
    """The best `limit` ids for each query (queryIndex, query) among aliases (alias, stringId, preferredName, quality)."""
    joined = queries.join(aliases, F.lower("query") == F.lower("alias"))
    order = Window.partitionBy("queryIndex").orderBy(F.col("quality").desc(), "stringId")
    return joined.withColumn("n", F.row_number().over(order)).where(F.col("n") <= limit).drop("n")


# ---- requests as a data source


class RequestPartition(InputPartition):
    def __init__(self, addresses: list[str]):
        super().__init__(addresses)
        self.addresses = addresses


class RequestReader(DataSourceReader):
    """One task per request allowed at a time, each keeping the spacing for its share."""

    def __init__(self, options: dict[str, str], transport: Transport):
        self.addresses = json.loads(options.get("addresses", "[]"))
        at_once = int(options.get("at_once", "1"))
        self.limits = Limits(float(options.get("delay", "0.5")) * at_once, None, int(options.get("attempts", "3")))
        self.at_once, self.transport = at_once, transport

    def partitions(self) -> list[RequestPartition]:
        n = max(1, min(self.at_once, len(self.addresses)))
        return [RequestPartition(self.addresses[k::n]) for k in range(n)]

    def read(self, partition: RequestPartition) -> Iterator[tuple]:
        from lattica.sources.transport import ServiceError

        requester = Requester(self.transport, self.limits)
        for address in partition.addresses:
            try:
                answer = requester.get(address)
                yield (address, answer.status, answer.body.decode("utf-8", "replace"), None)
            except ServiceError as e:  # one failed record does not end the read
                yield (address, e.status, None, str(e))


def request_source(transport: Transport) -> type[DataSource]:
    """A data source named `requests` over a transport: options addresses (JSON list), delay, at_once, attempts."""

    class Requests(DataSource):
        @classmethod
        def name(cls) -> str:
            return "requests"

        def schema(self) -> str:
            return "address string, status int, body string, error string"

        def reader(self, schema) -> DataSourceReader:
            return RequestReader(dict(self.options), transport)

    return Requests
