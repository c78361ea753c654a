from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lattica.operators import dangling as dg
from lattica.plans.core_problems import pathway_gene, pubmed_numbers


def day(text):
    return datetime.strptime(text, "%Y-%m-%d") if text else None


@pytest.fixture(scope="module")
def data(spark):
    refs = [("a", "2023-01-05"), ("a", "2023-01-05"), ("a", "2023-02-10"), ("b", "2023-01-01"), ("c", "2023-03-31"), (None, "2023-01-01"), ("d", None), ("e", "2023-01-31")] + [("hot", "2023-01-09")] * 300
    life = [("a", "2023-01-31", "2023-03-01"), ("a", "2023-01-31", "2023-03-01"), ("b", "2023-02-01", None), ("c", "2022-01-01", "2023-03-15"), ("c", "2023-03-20", None), ("e", "2023-01-31", "2023-02-01"), ("hot", None, None), (None, "2020-01-01", None)]
    r = spark.createDataFrame([(k, day(t), 1) for k, t in refs], "ref string, at timestamp, rows int")
    t = spark.createDataFrame([(k, day(a), day(b)) for k, a, b in life], "ref string, loaded timestamp, deleted timestamp")
    return r, t


def pairs(df):
    return sorted((r[dg.REF], f"{r[dg.MONTH] // 12}-{r[dg.MONTH] % 12 + 1:02d}", r[dg.ROWS]) for r in df.collect())


def test_orphans_per_month(data):
    r, t = data
    refs, life = dg.references(r, F.col("ref"), F.col("at")), dg.presence(t, F.col("ref"), F.col("loaded"), F.col("deleted"))
    want = [("b", "2023-01", 1), ("hot", "2023-01", 300)]
    # a is gone at the end of February only in March; c came back; e lives until the next month's start
    assert pairs(dg.orphans(refs, life)) == want
    assert pairs(dg.orphans(refs, life, share=1.0)) == want  # no key is heavy
    assert pairs(dg.orphans(refs, life, share=1e-9)) == want  # all repeated keys are


def test_month_bounds(spark):
    refs = dg.references(spark.createDataFrame([("x", day("2023-12-31"))], "r string, t timestamp"), F.col("r"), F.col("t"))
    for loaded, deleted, lost in (("2024-01-01", None, True), ("2023-12-31", None, False), ("2023-01-01", "2024-01-01", False), ("2023-01-01", "2023-12-31", True)):
        t = spark.createDataFrame([("x", day(loaded), day(deleted))], "k string, a timestamp, b timestamp")
        assert dg.orphans(refs, dg.presence(t, F.col("k"), F.col("a"), F.col("b"))).count() == lost


def test_empty_tables(data, spark):
    r, t = data
    refs, life = dg.references(r, F.col("ref"), F.col("at")), dg.presence(t, F.col("ref"), F.col("loaded"), F.col("deleted"))
    assert dg.orphans(refs.limit(0), life).count() == 0
    assert dg.orphans(refs, life.limit(0)).count() == refs.count()


def test_report(data):
    r, t = data
    refs = dg.references(r, F.col("ref"), F.col("at"))
    lost = dg.orphans(refs, dg.presence(t, F.col("ref"), F.col("loaded"), F.col("deleted")))
    got = {x["period"]: (x["n_refs"], x["n_rows"], x["n_orphans"], x["n_orphan_rows"]) for x in dg.orphan_report(lost, refs, "t").collect()}
    assert got == {"2023-01": (4, 304, 2, 301), "2023-02": (1, 1, 0, 0), "2023-03": (1, 1, 0, 0)}


def test_spellings(spark):
    df = spark.createDataFrame([("pmid:1|PMID:: 2 Pmid3",), ("GO_REF:1",), ("",), (None,)], "r string")
    assert [x[0] for x in df.select(pubmed_numbers("r")).collect()] == [["1", "2", "3"], [], [], None]
    genes = spark.createDataFrame([(" HSA:12 ",), ("34",), ("mmu:5(ABC)",), (None,)], "g string")
    assert [x[0] for x in genes.select(pathway_gene(F.col("g"), F.lit("dre0001"))).collect()] == ["hsa:12", "dre:34", "mmu:5", None]
