"""Enrichment of terms in a set: hypergeometric tail per term, false discovery rate by Benjamini and Hochberg.

The columns are those of the public service; the statistic is this library's choice.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


_SMALL = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 64)))])


def log_factorial(n: np.ndarray) -> np.ndarray:
    """Logarithm of n!, by a table for small n and by Stirling's series beyond."""
    x = np.maximum(n, 1).astype(np.float64)
    series = x * np.log(x) - x + 0.5 * np.log(2 * np.pi * x) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return np.where(n < len(_SMALL), _SMALL[np.minimum(n, len(_SMALL) - 1)], series)


def tails(k: np.ndarray, n: np.ndarray, big_k: np.ndarray, big_n: np.ndarray, at_once: int = 1 << 20) -> np.ndarray:
    """P(X >= k) for n draws from big_n of which big_k count, for many tests: sums of the probabilities from k on, `at_once` of them together."""
    choose = lambda a, b: log_factorial(a) - log_factorial(b) - log_factorial(a - b)
    low, top = np.maximum(k, n - (big_n - big_k)), np.minimum(n, big_k)
    sizes = np.maximum(top - low + 1, 0)
    out = np.zeros(len(k))
    ends = np.cumsum(sizes)
    whole = choose(big_n, n)
    for s in range(0, int(ends[-1]) if len(ends) else 0, at_once):
        flat = np.arange(s, min(s + at_once, int(ends[-1])))
        row = np.searchsorted(ends, flat, side="right")
        i = low[row] + flat - (ends[row] - sizes[row])
        logs = choose(big_k[row], i) + choose((big_n - big_k)[row], n[row] - i) - whole[row]
        out += np.bincount(row, weights=np.exp(logs), minlength=len(k))
    return np.where(k <= 0, 1.0, np.minimum(1.0, out))


def tail(k: int, n: int, big_k: int, big_n: int) -> float:
    return float(tails(*(np.array([x], np.int64) for x in (k, n, big_k, big_n)))[0])


@F.pandas_udf(T.DoubleType())
def tail_column(k: pd.Series, n: pd.Series, big_k: pd.Series, big_n: pd.Series) -> pd.Series:
    return pd.Series(tails(*(x.to_numpy(np.int64) for x in (k, n, big_k, big_n))))


def with_fdr(df: DataFrame, p: str = "p_value", by: list[str] | None = None) -> DataFrame:
    """df with the column fdr over its p-values (one row per term; per group of `by`)."""
    groups = by or []
    total = Window.partitionBy(*groups)
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(F.col(p).asc()))
    ranked = df.withColumns({"__lt_rank": rank, "__lt_m": F.count(F.lit(1)).over(total)})
    below = Window.partitionBy(*groups).orderBy(F.col("__lt_rank").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return ranked.withColumn("fdr", F.least(F.lit(1.0), F.min(F.col(p) * F.col("__lt_m") / F.col("__lt_rank")).over(below))).drop("__lt_rank", "__lt_m")


def enrichment(annotations: DataFrame, members: DataFrame) -> DataFrame:
    """(category, term, number_of_genes, number_of_genes_in_background, input_genes, p_value, fdr) of every term that a member has.

    annotations has gene, category and term; members has gene. The background is every gene with an annotation in the
    category. Repeated rows and nulls do not count. fdr is per category.
    """
    a = annotations.select("gene", "category", "term").where("gene is not null and term is not null").distinct()
    m = members.select("gene").distinct().withColumn("__lt_in", F.lit(True))
    marked = a.join(m, "gene", "left")
    sizes = marked.groupBy("category").agg(F.countDistinct("gene").alias("big_n"), F.countDistinct(F.when(F.col("__lt_in"), F.col("gene"))).alias("n"))
    inside = F.when(F.col("__lt_in"), F.col("gene"))
    terms = marked.groupBy("category", "term").agg(F.count(F.lit(1)).alias("number_of_genes_in_background"), F.count(inside).alias("number_of_genes"), F.array_sort(F.collect_set(inside)).alias("input_genes"))
    tested = terms.where("number_of_genes > 0").join(sizes, "category")
    scored = tested.withColumn("p_value", tail_column("number_of_genes", "n", "number_of_genes_in_background", "big_n"))
    return with_fdr(scored, by=["category"]).select("category", "term", "number_of_genes", "number_of_genes_in_background", "input_genes", "p_value", "fdr")
