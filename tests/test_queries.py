import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"

#: Queries held against their SQL twin on the smallest tables.
CHECKED = ("p1_found", "p1_annotation_summary", "p2_found", "p3_found", "p3_orphan_counts", "merge_last_wins_go", "growth_cumulative", "flatfile_sections", "interval_overlap_project", "xref_filter_transform", "structure_manifest", "sifts_segments", "merge_node_placeholder_fill", "context_counts")


@pytest.fixture(scope="module")
def con():
    import os

    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for f in os.listdir(SF):
        c.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, name):
    df = __spark_entry__.queries()[name](spark, SF)
    got = sorted(map(str, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))
    twin = con.execute(__spark_entry__.oracle_sql()[name])
    names = [d[0] for d in twin.description]
    assert sorted(names) == sorted(df.columns)
    assert got == sorted(map(str, (tuple(r[names.index(c)] for c in sorted(names)) for r in twin.fetchall())))


def test_contract(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).columns == ["src_table", "key_id"]


def test_staged_tables_can_be_cleared(spark):
    from lattica.session import clear_staging, shared_dir, staged

    clear_staging(spark)
    df = staged(spark.range(3).toDF("n"), "some")
    assert df.count() == 3 and shared_dir(spark).removeprefix("file:").lstrip("/") in df.inputFiles()[0]
    assert clear_staging(spark) == 1 and clear_staging(spark) == 0


def test_streams(spark, tmp_path):
    from lattica.operators.graph import PropertyGraph
    from lattica.streaming.upsert import arrivals, upsert_stream

    spark.createDataFrame([("A", "x"), ("B", "y")], "accession string, name string").write.parquet(str(tmp_path / "in"))
    path = str(tmp_path / "graph")
    for _ in range(2):  # a batch that comes again changes nothing
        stream = spark.readStream.schema("accession string, name string").parquet(str(tmp_path / "in"))
        upsert_stream(stream, PropertyGraph(spark, path), "Protein", str(tmp_path / f"state{_}")).awaitTermination()
        assert {(r["accession"], r["name"]) for r in PropertyGraph(spark, path).nodes("Protein").collect()} == {("A", "x"), ("B", "y")}
    events = spark.read.parquet(f"{SF}/events.parquet")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(SF)
    q = arrivals(stream, "event_type", "ts").writeStream.format("memory").queryName("arrivals").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("select sum(n) from arrivals").first()[0] == events.count()
