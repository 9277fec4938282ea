"""Metric events as streams: windows with watermarks, duplicates, a static side.

The functions take a DataFrame and work on batch and stream alike; ``replay`` runs a function
over files as a stream with ``availableNow`` and returns what it has written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch


def with_time(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    return events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", delay)


def tumbling(events: DataFrame, size: str = "1 day") -> DataFrame:
    w = with_time(events).groupBy(F.window("at", size), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return w.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, size: str = "1 day", step: str = "12 hours") -> DataFrame:
    w = with_time(events).groupBy(F.window("at", size, step), "event_type").agg(F.count("*").alias("n"))
    return w.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "6 hours") -> DataFrame:
    w = with_time(events).groupBy(F.session_window("at", gap), "user_id").agg(F.count("*").alias("n"))
    return w.select(F.col("session_window.start").cast("timestamp_ntz").alias("start"), "user_id", "n")


def deduplicated(events: DataFrame) -> DataFrame:
    return with_time(events).dropDuplicatesWithinWatermark(["event_id"]).select("event_id", "event_type")


def with_static(events: DataFrame, targets: DataFrame) -> DataFrame:
    """Events above their type's target. targets: event_type, target; a few rows."""
    return events.join(targets, "event_type").where(F.col("value") > F.col("target")).select("event_id", "event_type", "value")


def replay(spark: SparkSession, path: str, function: Callable[[DataFrame], DataFrame], mode: str = "complete") -> DataFrame:
    """What a stream over the files has put out once all are read. Each batch is a table in the shared
    folder (in complete mode one, written anew), so a batch that is done again after a failure
    replaces itself; offsets and state are there too."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path) if not name.endswith(".parquet") else spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)
    out, at = function(stream), scratch(spark, "stream")

    def put(batch: DataFrame, k: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/rows/{'all' if mode == 'complete' else f'batch-{k}'}")

    run = out.writeStream.foreachBatch(put).option("checkpointLocation", f"{at}/state").outputMode(mode).trigger(availableNow=True).start()
    run.awaitTermination()
    written = spark.read.schema(out.schema).option("recursiveFileLookup", True)
    return written.parquet(f"{at}/rows") if run.lastProgress else spark.createDataFrame([], out.schema)
