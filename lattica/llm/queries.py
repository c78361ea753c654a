"""Queries of the training-data operators, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.llm.abuse import scored_documents
from lattica.llm.leakage import leaked_items
from lattica.llm.packing import packed, packed_with_place, spread_within
from lattica.llm.topn import top_per_group
from lattica.llm.truncation import truncated
from lattica.session import folded_id, staged, table


def valid_score(column: str) -> Column:
    """A score on the 0-1 scale; null where it is null, not a number or negative."""
    c = F.col(column)
    return F.when(~F.isnan(c) & (c >= 0), F.when(c > 1, c / 1000).otherwise(c))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    si = table(spark, sf, "string_interaction").select("stringId_A", "stringId_B", "score")
    return top_per_group(si, folded_id("stringId_A"), folded_id("stringId_B"), valid_score("score"), 5).select("group_id", "item_id", "rank_no")


#: Score from which a value counts as cut.
CUT_SCORE = 0.5


def p5_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The truncation score of every delivery with an abstract."""
    scored = truncated(table(spark, sf, "pubmed_article"), "rec_id", "source", "abstract")
    return scored.groupBy("rec_id", "source").agg(F.max("score").alias("score"))  # rows delivered twice


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    scored = truncated(table(spark, sf, "pubmed_article"), "rec_id", "source", "abstract")
    return scored.where(F.col("score") >= CUT_SCORE).select("rec_id").distinct()


def p5_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Per source: deliveries with an abstract, those cut off, and their share."""
    per = p5_scores(spark, sf).groupBy("source").agg(F.count(F.lit(1)).alias("n_values"), F.count_if(F.col("score") >= CUT_SCORE).alias("n_truncated"))
    return per.withColumn("share", F.round(F.col("n_truncated") / F.col("n_values"), 4))


def p6_packed(spark: SparkSession, sf: str) -> DataFrame:
    """The container of every text, or of every piece of a text above the capacity, for every pack."""
    return packed(table(spark, sf, "documents"), table(spark, sf, "pack_target"))


def p6_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Per pack: containers, tokens, the share of the space that is used and the spread within containers (1: as in shuffled order)."""
    placed = staged(packed_with_place(table(spark, sf, "documents"), table(spark, sf, "pack_target")), "packed")
    used = placed.groupBy("pack_id").agg(F.countDistinct("container_id").alias("n_containers"), F.sum("n_tokens").alias("n_tokens"))
    packs = table(spark, sf, "pack_target").select("pack_id", "capacity_tokens").distinct()
    share = F.round(F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")), 4).alias("share_used")
    spread = spread_within(placed).select("pack_id", F.round("spread", 3).alias("spread"))
    return used.join(packs, "pack_id").join(spread, "pack_id").select("pack_id", "capacity_tokens", "n_containers", "n_tokens", share, "spread")


def p7_leaks(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and the items that leaked into them, with the shares of question and answer they hold."""
    return leaked_items(table(spark, sf, "documents"), table(spark, sf, "test_item"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return p7_leaks(spark, sf).select("doc_id", "item_id")


#: Probability from which a document counts as abusive, hateful or sexual.
ABUSE_SCORE = 0.5


def p8_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its score, its worst sentence and the nearest labelled example."""
    return scored_documents(table(spark, sf, "documents"), table(spark, sf, "review_label"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    """The documents of p8_scores from ABUSE_SCORE on; what cannot reach it is not searched."""
    return scored_documents(table(spark, sf, "documents"), table(spark, sf, "review_label"), least=ABUSE_SCORE).select("doc_id").distinct()


def p8_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Per source: documents, cases and their share."""
    docs = table(spark, sf, "documents")
    cases = scored_documents(docs, table(spark, sf, "review_label"), least=ABUSE_SCORE).select("source", F.lit(True).alias("case"))
    every = docs.select(F.col("source").cast("string").alias("source"), F.lit(False).alias("case")).unionByName(cases)
    per = every.groupBy("source").agg(F.count_if(~F.col("case")).alias("n_docs"), F.count_if("case").alias("n_cases"))
    return per.withColumn("share", F.round(F.col("n_cases") / F.col("n_docs"), 4))


QUERIES = {f.__name__: f for f in (p4_found, p5_found, p5_scores, p5_rates, p6_packed, p6_fill, p7_found, p7_leaks, p8_found, p8_scores, p8_rates)}

_BLANKS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(160)"

_P4 = f"""
with v as (select upper(trim(stringId_A, {_BLANKS})) as group_id, upper(trim(stringId_B, {_BLANKS})) as item_id,
    case when isnan(score) or score < 0 then null when score > 1 then score / 1000 else score end as s from string_interaction),
b as (select group_id, item_id, max(s) as s from v where group_id is not null and item_id is not null and s is not null group by all),
r as (select group_id, item_id, row_number() over (partition by group_id order by s desc, item_id) as rank_no from b)
select group_id, item_id, rank_no::int as rank_no from r where rank_no <= 5
"""

ORACLE = {"p4_found": _P4}
