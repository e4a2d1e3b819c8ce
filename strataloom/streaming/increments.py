"""Increments as streams: new files merged by key, and running counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strataloom.sources.ingest import merge_partitions


def merge_new_files(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> StreamingQuery:
    """Parquet files that arrive in ``source`` are merged into ``target`` by repository, each batch once; ends when what
    has arrived is merged."""
    fresh = spark.readStream.schema(schema).parquet(source)

    def merge(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            merge_partitions(spark, prepare(batch), target)

    return fresh.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_counts(stream: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Counts and sums per key over a stream, for the update or complete mode."""
    return stream.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"))


def windowed_counts(stream: DataFrame, at: str, width: str, late: str, *keys: str) -> DataFrame:
    """Counts per window of event time and key; rows later than ``late`` are dropped."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width), *keys).agg(F.count("*").alias("n"))
