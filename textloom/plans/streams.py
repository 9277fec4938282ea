"""Streams of many batches over the tables, with SQL that restates what they close and drop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch, table
from ..streaming import alerts, dedup, late, replay
from .evaluation import JON5

Query = Callable[[SparkSession, str], DataFrame]


def _late(function: Callable[[DataFrame], DataFrame], again: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = late.arriving(table(spark, sf_dir, "events"), again)
        return replay.run(spark, replay.arrivals(rows), rows.schema, function)

    return query


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, at = late.arriving(table(spark, sf_dir, "events")), scratch(spark, "stream")
    closed = replay.run(spark, replay.arrivals(rows), rows.schema, late.sessions, at=at)
    held = replay.state(spark, at)
    return late.joined(closed, closed.limit(0) if held is None else late.open_sessions(held))


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alerts.hourly(table(spark, sf_dir, "events"))
    out = replay.run(spark, replay.arrivals(rows), rows.schema, alerts.watched)
    return out.select("metric", F.col("at").cast("timestamp_ntz").alias("moment"), "kind", F.round("change", 6).alias("change"))


def stream_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup.sliced(table(spark, sf_dir, "documents").select("doc_id", "text"))
    parts = dedup.parts_for(rows.count())
    return replay.run(spark, replay.arrivals(rows), rows.schema, lambda d: dedup.probed(d, parts=parts), each=dedup.least)


def queries() -> dict[str, Query]:
    return {
        "stream_late_tumbling": _late(lambda e: late.windows(e, "1 day")),
        "stream_late_sliding": _late(lambda e: late.windows(e, "1 day", "12 hours")),
        "stream_late_sessions": stream_sessions,
        "stream_late_once": _late(late.once, again=True),
        "rpt13_stream_alerts": stream_alerts,
        "dup1_stream_index": stream_index,
    }


#: e: events with their slice; w: the time before which a slice's rows are late (the watermark of the
#: batch before: what had come two batches ago); z: the time before which all is closed at the end.
_E = "SELECT *, (ts::DATE - DATE '1970-01-01') + CASE WHEN event_id % 20 = 0 THEN 3 ELSE 0 END AS slice FROM events"
_TWICE = f"SELECT * FROM ({_E}) a UNION ALL SELECT * REPLACE (slice + 1 AS slice) FROM ({_E}) b WHERE event_id % 10 = 0 UNION ALL SELECT * REPLACE (slice + 5 AS slice) FROM ({_E}) c WHERE event_id % 30 = 0"
_W = """w AS (SELECT slice, max(max(ts)) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - INTERVAL 12 HOUR AS late FROM e GROUP BY slice),
z AS (SELECT max(ts) - INTERVAL 12 HOUR AS closed FROM e)"""


def oracle_sql() -> dict[str, str]:
    return {
        "stream_late_tumbling": f"""WITH e AS ({_E}), {_W}, x AS (SELECT date_trunc('day', ts)::TIMESTAMP AS start, e.* FROM e)
SELECT start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM x JOIN w USING (slice), z WHERE coalesce(start + INTERVAL 1 DAY > late, true) AND start + INTERVAL 1 DAY <= closed GROUP BY start, event_type""",
        "stream_late_sliding": f"""WITH e AS ({_E}), {_W}, x AS (SELECT time_bucket(INTERVAL '12 hours', ts, TIMESTAMP '1970-01-01') - k * INTERVAL '12 hours' AS start, e.* FROM e, (VALUES (0), (1)) v(k))
SELECT start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM x JOIN w USING (slice), z WHERE coalesce(start + INTERVAL 1 DAY > late, true) AND start + INTERVAL 1 DAY <= closed GROUP BY start, event_type""",
        "stream_late_sessions": f"""WITH e AS ({_E}), {_W}, x AS (SELECT user_id, ts FROM e JOIN w USING (slice) WHERE coalesce(ts + INTERVAL 6 HOUR > late, true)),
l AS (SELECT *, CASE WHEN ts - lag(ts) OVER u < INTERVAL '6 hours' THEN 0 ELSE 1 END AS new FROM x WINDOW u AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM l)
SELECT min(ts) AS start, user_id, count(*) AS n FROM s GROUP BY user_id, k HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT closed FROM z)""",
        "stream_late_once": f"""WITH e AS ({_TWICE}), {_W} SELECT event_id, event_type, min(slice)::INT AS slice FROM e JOIN w USING (slice) WHERE coalesce(ts > late, true) GROUP BY event_id, event_type""",
        "rpt13_stream_alerts": """WITH h AS (SELECT event_type AS metric, date_trunc('hour', ts)::TIMESTAMP AS moment, avg(value) AS v FROM events GROUP BY 1, 2),
l AS (SELECT *, lag(v) OVER m AS before, lead(moment) OVER m AS next FROM h WINDOW m AS (PARTITION BY metric ORDER BY moment))
SELECT metric, moment, 'fall' AS kind, round((before - v) / before, 6) AS change FROM l WHERE (before - v) / before > 0.15
UNION ALL SELECT metric, moment + INTERVAL 3 HOUR, 'silent', NULL FROM l WHERE coalesce(next, (SELECT max(moment) - INTERVAL 30 MINUTE FROM h)) > moment + INTERVAL 3 HOUR""",
        "dup1_stream_index": JON5,
    }
