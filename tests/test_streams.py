"""Streams of several batches: recovery after a failure, expiry, callbacks, against one batch."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from textloom.operators import minhash
from textloom.session import scratch
from textloom.streaming import alerts, dedup, late, replay


class Stop(Exception):
    pass


def failing(each, at):
    """Fails once, after batch ``at`` has been worked out."""
    left = [at]

    def call(batch, k):
        out = each(batch, k) if each else batch
        if k == at and left:
            left.clear()
            raise Stop
        return out

    return call


def texts(spark):
    base = [" ".join(f"w{(k * 7 + j) % 97}" for j in range(40)) for k in range(8)]
    rows = [(k, base[k % 8] if k % 3 else f"{base[k % 8]} tail{k}") for k in range(40)] + [(40, None), (41, ""), (42, " \n"), (43, "short text"), (44, "short text"), (None, base[0])]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_index_goes_on_after_a_failure_and_equals_one_batch(spark):
    docs = dedup.sliced(texts(spark), slices=4)
    path, at = replay.arrivals(docs), scratch(spark, "index")
    with pytest.raises(Exception, match="Stop"):
        replay.run(spark, path, docs.schema, dedup.probed, at=at, each=failing(dedup.least, 2))
    part = spark.read.parquet(f"{at}/rows").count()
    got = {r.doc: r["first"] for r in replay.run(spark, path, docs.schema, dedup.probed, at=at, each=dedup.least).collect()}
    want = {r.doc: r["first"] for r in minhash.probe(texts(spark).where("doc_id IS NOT NULL"), "doc_id", "text").collect()}
    assert got == want and 0 < part < len(want) and sum(d != f for d, f in got.items()) > 20
    # a later run finds what earlier ones have put in
    more = spark.createDataFrame([(100, texts(spark).where("doc_id = 1").first().text, 9)], docs.schema)
    more.write.partitionBy("slice").mode("append").parquet(path)
    again = {r.doc: r["first"] for r in replay.run(spark, path, docs.schema, dedup.probed, at=at, each=dedup.least).collect()}
    assert again == want | {100: want[1]}


def test_keys_are_forgotten(spark):
    import pandas as pd

    class Held:
        def __init__(self):
            self.value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    class Handle:
        def getValueState(self, name, schema, ttl=None):  # noqa: N802
            self.ttl = ttl
            return Held()

    handle, holder = Handle(), dedup.FirstHolder(5000)
    holder.init(handle)
    row = lambda d: iter([pd.DataFrame({"band": [0], "key": ["k"], "doc": [d], "first": [d]})])
    firsts = [next(holder.handleInputRows((0, "k", 0), row(d), None))["first"][0] for d in (7, 9)]
    holder.first.value = None
    assert handle.ttl == 5000 and firsts == [7, 7] and next(holder.handleInputRows((0, "k", 0), row(9), None))["first"][0] == 9


def test_one_key_of_all_documents_is_spread(spark):
    import pyarrow as pa

    hashes = pa.array([[1, 2, 3]] * 50, pa.list_(pa.int64()))
    rows = next(dedup.local_firsts(iter([pa.RecordBatch.from_arrays([pa.array(range(50), pa.int64()), hashes], names=["doc", "hashes"])]))).to_pandas()
    assert len(rows) == 50 * 16 and set(rows["first"]) == {0}
    assert rows.groupby(["band", "key", "spread"]).size().max() == 1


def test_late_windows_after_a_failure(spark, sf):
    events = late.arriving(spark.read.parquet(f"{sf}/events.parquet"))
    path, at = replay.arrivals(events), scratch(spark, "late")
    with pytest.raises(Exception, match="Stop"):
        replay.run(spark, path, events.schema, lambda e: late.windows(e, "1 day"), at=at, each=failing(None, 12))
    got = replay.run(spark, path, events.schema, lambda e: late.windows(e, "1 day"), at=at)
    whole = replay.run(spark, path, events.schema, lambda e: late.windows(e, "1 day"))
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, whole.collect())) and got.count() > 100
    # late rows were dropped: three days late is beyond half a day
    assert 0.9 * events.count() < got.agg(F.sum("n")).first()[0] < events.count()


def test_alerts_call_back_once_a_batch(spark):
    day = lambda d, h: f"2024-01-{d:02} {h:02}:00:00"
    rows = [("a", day(1, 0), 10.0), ("a", day(1, 1), 8.0), ("a", day(1, 2), 7.9), ("a", day(1, 9), 9.0), ("b", day(1, 0), 1.0), ("a", day(2, 1), 0.0), ("a", day(2, 2), 5.0), (None, day(3, 5), 2.0), (None, day(3, 6), 1.0), ("a", None, 1.0), ("b", day(2, 0), None)]
    values = spark.createDataFrame(rows, "metric string, at string, value double").withColumn("at", F.col("at").cast("timestamp")).withColumn("slice", F.coalesce(F.unix_date(F.col("at").cast("date")), F.lit(0)))
    calls = []
    out = replay.run(spark, replay.arrivals(values), values.schema, alerts.watched, each=alerts.notified(lambda b, k: calls.append((k, b.count()))))
    got = Counter((r.metric, r.at.strftime("%d %H"), r.kind, r.change and round(r.change, 3)) for r in out.collect())
    assert got == Counter([("a", "01 01", "fall", 0.2), ("a", "01 05", "silent", None), ("a", "01 12", "silent", None), ("b", "01 03", "silent", None), ("a", "02 01", "fall", 1.0), ("a", "02 05", "silent", None), ("", "03 06", "fall", 0.5)])
    assert len({k for k, _ in calls}) == len(calls) and sum(n for _, n in calls) == 7


def test_a_table_without_rows(spark):
    docs = dedup.sliced(texts(spark).limit(0))
    assert replay.run(spark, replay.arrivals(docs), docs.schema, dedup.probed, each=dedup.least).count() == 0


@pytest.mark.parametrize("more, want", [([], {(3, "01 00", 2)}), ([(9, 2, "2024-01-06 01:00:00")], {(1, "02 00", 3), (2, "03 03", 1), (3, "01 00", 2), (3, "03 03", 1)})])
def test_a_late_event_reopens_its_session(spark, tmp_path, more, want):
    """An event three days late, not late by the watermark, follows a session that has been put out."""
    import duckdb
    from oracle import assert_same

    from textloom.plans import catalog

    rows = [(1, 1, "2024-01-02 00:00:00"), (2, 1, "2024-01-02 04:00:00"), (20, 1, "2024-01-02 09:30:00"), (4, 2, "2024-01-03 03:00:00"), (40, 3, "2024-01-01 05:00:00")]
    rows += [(5, 3, "2024-01-01 00:00:00"), (6, 3, "2024-01-01 05:30:00"), (8, 3, "2024-01-03 03:00:00"), *more]
    out = spark.createDataFrame(rows, "event_id long, user_id long, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    out.write.parquet(f"{tmp_path}/events.parquet")
    df = catalog.queries()["stream_late_sessions"](spark, str(tmp_path))
    assert {(r.user_id, r.start.strftime("%d %H"), r.n) for r in df.collect()} == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    assert_same(df, catalog.oracle_sql()["stream_late_sessions"], con)


def test_sessions_of_a_table_without_rows(spark, sf, tmp_path):
    from textloom.plans import catalog

    spark.read.parquet(f"{sf}/events.parquet").limit(0).write.parquet(f"{tmp_path}/events.parquet")
    assert catalog.queries()["stream_late_sessions"](spark, str(tmp_path)).count() == 0


def test_keys_of_texts_equal_those_of_columns(spark):
    import pyarrow as pa

    docs = texts(spark).where("doc_id IS NOT NULL").unionByName(spark.createDataFrame([(50, "ÀB c\x0bd\te f G"), (51, "x" * 3)], "doc_id long, text string"))
    want = {(r.doc, r.band, r.key) for r in minhash.band_keys(docs, "doc_id", "text").collect()}
    t = docs.select("doc_id", F.lower("text").alias("text")).toArrow()
    got = [b.to_pandas() for b in dedup.local_firsts(dedup.hashed(iter(t.combine_chunks().to_batches()), 5))]
    assert {(d, b, k) for x in got for d, b, k in zip(x["doc"], x["band"], x["key"], strict=True)} == want


def test_one_call_for_all_keys_of_a_part(spark):
    import numpy as np
    import pandas as pd

    class Value:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    class Handle:
        def getValueState(self, name, schema, ttl=None):  # noqa: N802
            return Value()

    part = dedup.FirstsOfPart()
    part.init(Handle())
    keys = [f"{k:032x}" for k in range(3000)]

    def ask(docs, keys, spread=0):
        rows = pd.DataFrame({"band": np.arange(len(keys), dtype=np.int32) % 2, "key": keys, "spread": spread, "doc": docs, "first": docs})
        return next(part.handleInputRows((0,), iter([rows[:7], rows[7:]]), None))

    assert ask(range(10, 3010), keys)["first"].tolist() == list(range(10, 3010))
    assert ask([5] * 3000, keys[::-1])["first"].tolist() == [5] * 3000  # the other band of each
    assert ask(range(9000, 12000), keys)["first"].tolist() == list(range(10, 3010))
    known = ask([7, 8], ["f" * 32, "e" * 32], spread=9)
    assert known["first"].tolist() == [7, 8] and not known["known"].any() and len(part.held.value[0]) == 6000 * 26
    assert dedup.parts_for(0) == dedup.PARTS < dedup.parts_for(10**8)
