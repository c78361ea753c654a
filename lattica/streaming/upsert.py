"""Streams of batches into a graph, and windows over streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lattica.operators.graph import PropertyGraph
from lattica.schemas import NODES


def upsert_stream(stream: DataFrame, graph: PropertyGraph, name: str, checkpoint: str, order: str | None = None, dangling: bool = False) -> StreamingQuery:
    """Merge every micro-batch of a stream into a label or type; edges with an unknown end are dropped unless `dangling`. A batch that comes twice changes nothing, so a restart is safe."""

    def put(batch: DataFrame, _: int) -> None:
        if name in NODES:
            graph.merge_nodes(name, batch, order=order)
        else:
            graph.merge_edges(name, batch, order=order, dangling=dangling)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_visits(stream: DataFrame, key: str, at: str, delay: str = "1 hour") -> DataFrame:
    """Rows whose key was not seen before within the watermark; state older than that is dropped."""
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def arrivals(stream: DataFrame, label: str, at: str, width: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Rows per label in tumbling windows; late rows count up to the watermark."""
    timed = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)
    return timed.groupBy(F.window(at, width), label).agg(F.count(F.lit(1)).alias("n"))
