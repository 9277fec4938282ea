"""Metric events that arrive late, over many batches: windows, sessions and duplicates in append mode.

Watermarks follow the latest event time of the batches read so far, less ``delay``. A batch drops
rows whose window (or session, or time) lies before the watermark of the batch before it, and
closes what lies before its own; results are what has been closed once all files are read.

A row that is not late itself may follow a session that has been put out by less than the gap. It is
then a part of that session, though Spark makes a new one of it: ``joined`` makes one session of such
parts, which is closed when all of them are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DELAY = "12 hours"


def arriving(events: DataFrame, again: bool = False) -> DataFrame:
    """The events with ``slice``, the day of arrival (days since 1970): each twentieth comes three days
    late. again: each tenth comes a second time on the next day, each thirtieth after five days too."""
    late = F.when(F.col("event_id") % 20 == 0, 3).otherwise(0)
    rows = events.withColumn("at", F.col("ts").cast("timestamp")).withColumn("slice", (F.unix_date(F.col("ts").cast("date")) + late).cast("int"))
    if not again:
        return rows
    more = rows.where("event_id % 10 = 0").withColumn("slice", F.col("slice") + 1)
    most = rows.where("event_id % 30 = 0").withColumn("slice", F.col("slice") + 5)
    return rows.unionByName(more).unionByName(most)


def windows(events: DataFrame, size: str, step: str | None = None, delay: str = DELAY) -> DataFrame:
    w = F.window("at", size, step) if step else F.window("at", size)
    out = events.withWatermark("at", delay).groupBy(w, "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return out.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "6 hours", delay: str = DELAY) -> DataFrame:
    """start, end (the gap after the last event), user_id, n of what the batches close, in parts that ``joined`` puts together."""
    out = events.withWatermark("at", delay).groupBy(F.session_window("at", gap), "user_id").agg(F.count("*").alias("n"))
    return out.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "user_id", "n")


def open_sessions(state: DataFrame) -> DataFrame:
    """start, end, user_id, n of what the stream of ``sessions`` has not closed. state: of ``replay.state``."""
    return state.select("value.session_window.start", "value.session_window.end", "value.user_id", F.col("value.count").alias("n"))


def joined(closed: DataFrame, still_open: DataFrame) -> DataFrame:
    """start, user_id, n of the closed sessions. Parts that come less than the gap apart are one session;
    one with an open part is open."""
    parts = closed.withColumn("open", F.lit(0)).unionByName(still_open.withColumn("open", F.lit(1)))
    user = Window.partitionBy("user_id").orderBy("start", "end")
    parts = parts.withColumn("new", F.when(F.col("start") < F.lag("end").over(user), 0).otherwise(1))
    parts = parts.withColumn("k", F.sum("new").over(user.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    whole = parts.groupBy("user_id", "k").agg(F.min("start").alias("start"), F.sum("n").alias("n"), F.max("open").alias("open"))
    return whole.where("open = 0").select(F.col("start").cast("timestamp_ntz").alias("start"), "user_id", "n")


def once(events: DataFrame, delay: str = DELAY) -> DataFrame:
    """Each event the first time it comes."""
    return events.withWatermark("at", delay).dropDuplicatesWithinWatermark(["event_id"]).select("event_id", "event_type", "slice")
