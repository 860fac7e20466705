"""Streams: exactly-once ingest of events by key (STR-3), with a checkpoint in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.sources.archive import new_path


def deduplicated(events: DataFrame, key: list[str], time: str, lateness: str) -> DataFrame:
    """A stream with the first row of each key inside the watermark."""
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness).dropDuplicatesWithinWatermark(key)


def drain(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over all that is there, and read what it wrote."""
    spark, path = stream.sparkSession, new_path(stream.sparkSession, label)
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}-checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by user and type of the events that a deduplicating stream let through."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    kept = drain(deduplicated(events, ["event_id"], "ts", "40 days"), "events")
    return kept.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
