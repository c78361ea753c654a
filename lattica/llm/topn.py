"""Top N items of every group, with statistics-guided skipping of row groups.

The rows are clustered by group: range-partitioned by (group, hash of item), so that a group of any size spreads over as
many files as it needs and all rows of one (group, item) pair meet in one file, sorted by group and falling score, and
written with small row groups. One task per file then reads the footers only, visits row groups in the order of falling
maximum score, and skips each whose maximum lies strictly below the current N-th score of every group it contains. At
most N rows per group and file go on to the final ranking.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lattica.session import staging_path

#: Bytes in which the writer closes a row group; small ones can be skipped more often.
ROW_GROUP_BYTES = 256 * 1024

#: Rows of a file at most (about 256 MB), and at least where that would leave cores idle.
ROWS_PER_FILE, LEAST_ROWS_PER_FILE = 4_000_000, 100_000


def number_of_files(rows: int, cores: int) -> int:
    """Files for so many rows: one task reads a file, so all cores get one unless files would be tiny."""
    return max(1, math.ceil(rows / ROWS_PER_FILE), min(cores, rows // LEAST_ROWS_PER_FILE))


def cluster(rows: DataFrame, files: int) -> str:
    """Write (g, i, s) clustered by group into so many files in the shared folder; the path."""
    path = staging_path(rows.sparkSession, "topn")
    placed = rows.repartitionByRange(files, "g", F.xxhash64("i")).sortWithinPartitions("g", F.col("s").desc(), "i")
    placed.write.option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.row.count.limit", 5000).parquet(path)
    return path


def best_of_rows(gid: np.ndarray, item: pd.Series, score: np.ndarray, n: int) -> pd.DataFrame:
    """The first n distinct items per group by score descending, then item ascending."""
    df = pd.DataFrame({"g": gid, "i": item, "s": score})
    df = df.sort_values(["g", "s", "i"], ascending=[True, False, True], kind="stable").drop_duplicates(["g", "i"])
    return df[df.groupby("g", sort=False).cumcount() < n]


def read_guided(path: str, n: int) -> tuple[pa.Table, dict[str, int]]:
    """Top n rows per group of one clustered file, and how many row groups were read and skipped."""
    import pyarrow.fs
    import pyarrow.parquet as pq

    fs, name = pyarrow.fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    ids: dict[str, int] = {}
    names: list[str] = []
    threshold = np.full(0, -np.inf)
    kept: list[pd.DataFrame] = []
    done = {"read": 0, "skipped": 0}
    with fs.open_input_file(name) as f:
        file = pq.ParquetFile(f)
        meta = file.metadata
        place = {meta.schema.column(c).name: c for c in range(len(meta.schema))}

        def stats(k: int, column: str):
            found = meta.row_group(k).column(place[column]).statistics
            return found if found is not None and found.has_min_max else None

        tops = [x.max if (x := stats(k, "s")) else np.inf for k in range(meta.num_row_groups)]
        for k in sorted(range(meta.num_row_groups), key=lambda k: -tops[k]):
            held, of_rows = stats(k, "g"), None
            if held and held.min == held.max:
                groups = [held.min]
            else:  # several groups: this narrow column tells which
                of_rows = file.read_row_group(k, ["g"]).column(0).combine_chunks()
                groups = of_rows.unique().to_pylist()
            for g in groups:
                if g not in ids:
                    ids[g] = len(names)
                    names.append(g)
            if len(threshold) < len(names):
                threshold = np.concatenate([threshold, np.full(len(names) * 2 - len(threshold), -np.inf)])
            here = np.fromiter((ids[g] for g in groups), np.int64, len(groups))
            if tops[k] < threshold[here].min():
                done["skipped"] += 1
                continue
            done["read"] += 1
            t = file.read_row_group(k, ["g", "i", "s"] if of_rows is None else ["i", "s"]).combine_chunks()
            codes = (t.column("g").combine_chunks() if of_rows is None else of_rows).dictionary_encode()
            by_code = np.fromiter((ids[g] for g in codes.dictionary.to_pylist()), np.int64, len(codes.dictionary))
            gid, score = by_code[codes.indices.to_numpy()], t.column("s").to_numpy()
            may = np.flatnonzero(score >= threshold[gid])
            top = best_of_rows(gid[may], t.column("i").take(pa.array(may)).to_pandas(), score[may], n)
            kept.append(top)
            size = top.groupby("g")["s"].agg(["size", "min"])
            full = size[size["size"] >= n]
            at = full.index.to_numpy()
            threshold[at] = np.maximum(threshold[at], full["min"].to_numpy())
    if not kept:
        return pa.table({"g": pa.array([], pa.string()), "i": pa.array([], pa.string()), "s": pa.array([], pa.float64())}), done
    every = pd.concat(kept)
    every = best_of_rows(every["g"].to_numpy(), every["i"].reset_index(drop=True), every["s"].to_numpy(), n)
    group = pa.array(names).take(pa.array(every["g"].to_numpy()))
    return pa.table({"g": group, "i": pa.array(every["i"], pa.string()), "s": pa.array(every["s"].to_numpy(), pa.float64())}), done


def _reader(n: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                yield from read_guided(path, n)[0].to_batches()

    return run


def top_per_group(df: DataFrame, group: Column, item: Column, score: Column, n: int) -> DataFrame:
    """(group_id, item_id, score, rank_no): per group the n distinct items with the highest scores.

    An item's score is its highest; rows with a null group, item or score, or a score that is not a number, do not take
    part. Order: score descending, then item ascending by code point, so ties and repeated rows always come out the same
    way. Groups with fewer than n items give what they have; an empty df gives no rows. Other columns are not looked at.
    """
    rows = df.select(group.cast("string").alias("g"), item.cast("string").alias("i"), score.cast("double").alias("s"))
    rows = rows.where(F.col("g").isNotNull() & F.col("i").isNotNull() & F.col("s").isNotNull() & ~F.isnan("s"))
    spark = df.sparkSession
    files = number_of_files(df.count(), spark.sparkContext.defaultParallelism)  # of a table, a count of its footers
    path = cluster(rows.withColumn("s", F.col("s") + F.lit(0.0)), files)  # -0.0 and 0.0 are one score
    written = spark.read.schema("g string, i string, s double").parquet(path).inputFiles()  # a name per partition
    listed = spark.createDataFrame([(p, k) for k, p in enumerate(written)], "path string, k int")
    local = listed.repartitionById(max(1, len(written)), F.col("k")).select("path").mapInArrow(_reader(n), "g string, i string, s double")
    order = Window.partitionBy("g").orderBy(F.col("s").desc(), F.col("i"))
    ranked = local.withColumn("rank_no", F.row_number().over(order)).where(F.col("rank_no") <= n)
    return ranked.select(F.col("g").alias("group_id"), F.col("i").alias("item_id"), F.col("s").alias("score"), "rank_no")
