"""Growth of a graph over the order in which its nodes were processed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_seen(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """(label, seq, n): things first seen at each step; rows has keys and seq."""
    return rows.groupBy(*keys).agg(F.min("seq").alias("seq")).groupBy("seq").agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("label"), "seq", "n")


def cumulative(new: DataFrame, steps: DataFrame, labels: list[str]) -> DataFrame:
    """(label, seq, total) for each of the labels at every step (column seq): the running sum of what is new.

    Labels are some of a graph's schema, a dozen; the steps are one series per run, and rows of a label pass through one
    window of that length.
    """
    grid = steps.select("seq").distinct().select(F.explode(F.array(*map(F.lit, labels)).cast("array<string>")).alias("label"), "seq")
    dense = grid.join(new, ["label", "seq"], "left")
    w = Window.partitionBy("label").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return dense.select("label", "seq", F.sum(F.coalesce("n", F.lit(0))).over(w).alias("total"))


def series(log: DataFrame, labels: list[str]) -> DataFrame:
    """The log as one column per label, by step: what a chart shows."""
    return log.groupBy("seq").pivot("label", labels).agg(F.max("total")).orderBy("seq")


def write_log(log: DataFrame, path: str) -> None:
    log.orderBy("seq", "label").write.mode("append").json(path)


def read_log(spark, path: str) -> DataFrame:
    """A stored log; lines that are not JSON are skipped."""
    return spark.read.schema("label string, seq bigint, total bigint").option("mode", "DROPMALFORMED").json(path).orderBy("seq", "label")


def chart(log: DataFrame, labels: list[str], path: str) -> bool:
    """Draw the series as PNG; False where no plotting library is installed."""
    try:
        import matplotlib

        matplotlib.use("Agg")
        from matplotlib import pyplot
    except ImportError:
        return False
    rows = series(log, labels).toPandas()  # one row per step
    figure, axis = pyplot.subplots()
    for label in labels:
        axis.plot(rows["seq"], rows[label], label=label)
    axis.legend()
    figure.savefig(path)
    pyplot.close(figure)
    return True
