"""Alerts on arriving metric values: a fall against the value before, and a metric that falls silent.

Each metric's last value is keyed state; a timer in event time tells that nothing has come for
``silent`` hours. Values of a metric come in the order of their time over the batches (those of
one batch in any order); late ones are dropped by the watermark. What a batch puts out can go to
callbacks too: ``notified`` calls them once for every batch that is written, and a batch that is
done again after a failure calls them again with the same batch number.

Cases: null values and times are left out. A value before which there is none, or one of 0, gives no
fall. A metric of one value can fall silent. Metrics without a name are one metric.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

HOUR = 3_600_000
ALERTS = "metric string, at timestamp, kind string, change double"


class Watch(StatefulProcessor):
    """One metric: its last time and value, and whether its silence has been told."""

    def __init__(self, fall: float, silent: int) -> None:
        self.fall, self.silent = fall, silent * HOUR

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long, value double, told boolean")

    def alerts(self, metric: str, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            at = pd.to_datetime([r[0] for r in rows], unit="ms")
            yield pd.DataFrame({"metric": metric, "at": at, "kind": [r[1] for r in rows], "change": pd.Series([r[2] for r in rows], dtype="float64")})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, out = self.last.get() if self.last.exists() else None, []
        values = pd.concat(rows).sort_values("at")
        for at, value in zip((values["at"].astype("datetime64[ms]").astype("int64")).tolist(), values["value"].tolist(), strict=True):
            if last:
                if at - last[0] > self.silent and not last[2]:
                    out.append((last[0] + self.silent, "silent", None))
                if last[1] and (change := (last[1] - value) / last[1]) > self.fall:
                    out.append((at, "fall", change))
            last = (at, value, False)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer if isinstance(timer, int) else timer[0])
        self.handle.registerTimer(last[0] + self.silent)
        self.last.update(last)
        yield from self.alerts(key[0], out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at, value, told = self.last.get()
        if not told and expiredTimerInfo.getExpiryTimeInMs() == at + self.silent:
            self.last.update((at, value, True))
            yield from self.alerts(key[0], [(at + self.silent, "silent", None)])

    def close(self) -> None:
        pass


def watched(values: DataFrame, fall: float = 0.15, silent: int = 3, delay: str = "30 minutes") -> DataFrame:
    """metric, at, kind (fall, silent), change. values: metric, at (timestamp), value; a stream."""
    rows = values.where("at IS NOT NULL AND value IS NOT NULL").select(F.coalesce("metric", F.lit("")).alias("metric"), "at", F.col("value").cast("double").alias("value")).withWatermark("at", delay)
    return rows.groupBy("metric").transformWithStateInPandas(Watch(fall, silent), ALERTS, "Append", "EventTime")


def notified(*callbacks: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], DataFrame]:
    """For ``replay.run(each=...)``: every callback gets each batch's alerts and the batch's number."""

    def each(batch: DataFrame, k: int) -> DataFrame:
        batch = batch.persist()
        for call in callbacks:
            call(batch, k)
        return batch

    return each


def hourly(events: DataFrame) -> DataFrame:
    """The hourly means of each type as a metric's values, with ``slice``, the day (days since 1970): the
    watch sees a row an hour, however many events there are."""
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    out = events.groupBy(F.col("event_type").alias("metric"), hour.alias("at")).agg(F.avg("value").alias("value"))
    return out.withColumn("slice", F.unix_date(F.col("at").cast("date")).cast("int"))
