"""Documents drawn to look like a target, by the importance of hashed n-grams.

Features of a text are its words (A-Z lower-cased, stretches of 0-9, a-z and all beyond ASCII) and
all runs of two, joined by one space; a feature's bucket is the CRC-32 of its bytes modulo
``BUCKETS``. A bucket's gain is the logarithm of how much likelier it is in the target texts than
in the documents; a document's weight is the mean gain of its features, and Gumbel noise by its id
makes the highest scores a weighted draw without replacement.

Each worker runs DuckDB over its own partition, a slice of text at a time: SQL cuts and unnests
words, a window joins neighbours, a registered CRC function gives buckets, and counts by text and
bucket go to Parquet in the shared folder, so texts are read once. Spark merges the counts (partial
sums by bucket), scores the texts from them, and numbers the drawn ones by ranges of the score, so
no task sorts them all. The only things sent to workers are the gains, one for each bucket.

A text beyond ``PART`` bytes goes to DuckDB in parts that end between words; the last word of a
part leads the next one, where it makes the pair across the border and is not counted again.

Cases: a null or empty text has no words, no features, weight 0 and no place in the draw. A null
id has no noise of its own: its score is null and it is not drawn. Ties of score go to the smaller
id, then to what was counted first; rows that repeat an id stay rows of their own. Without target
texts gains still are as the formula has them. An empty table gives an empty result. Further
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import buckets_for, slices, written

BUCKETS = 10_000
#: Bytes of text that DuckDB takes at a time, and of a text's part; its memory besides the text.
SLICE, PART, MEMORY = 2 << 20, 2 << 20, "300MB"
#: Bytes of scored rows that are numbered by one task (about 40 a row).
RANGE_BYTES = 64 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
#: Word bytes as w, others as blanks.
KINDS = bytes(0x77 if not NO_WORD.match(bytes([b])) else 0x20 for b in range(256))
COUNTS = "row long, id long, n_words long, n_features long, buckets array<int>, counts array<int>"

SQL = rf"""
WITH texts AS (
  SELECT row, led, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM slice),
words AS (
  SELECT row, unnest(words) AS word, led AND generate_subscripts(words, 1) = 1 AS before FROM texts),
pairs AS (
  SELECT row, word, before, CASE WHEN lead(row) OVER () = row THEN lead(word) OVER () END AS next FROM words),
features AS (
  SELECT row, unnest([CASE WHEN NOT before THEN word END, word || ' ' || next]) AS feature, unnest([NOT before, false]) AS single FROM pairs)
SELECT row, crc(feature) % {{buckets}} AS bucket, count(*) AS n, count_if(single) AS words
FROM features WHERE feature IS NOT NULL GROUP BY ALL
"""


def crc(features: pa.ChunkedArray | pa.Array) -> pa.Array:
    """CRC-32 of each string's UTF-8 bytes, from the array's own memory."""
    if isinstance(features, pa.ChunkedArray):
        features = features.combine_chunks()
    if not len(features):
        return pa.array([], pa.int64())
    features = features.cast(pa.large_string())
    _, places, data = features.buffers()
    at = np.frombuffer(places, np.int64, len(features) + 1, features.offset * 8).tolist()
    raw, of = memoryview(data or b""), zlib.crc32
    return pa.array(np.fromiter((of(raw[a:b]) for a, b in zip(at, at[1:], strict=False)), np.int64, len(features)))


def parts(text: str, most: int = PART) -> Iterator[tuple[str, bool]]:
    """A text in parts that end between words; True where the last word before leads a part."""
    if len(text) * 4 <= most or len(raw := text.encode()) <= most:
        yield text, False
        return
    at, lead = 0, b""
    while at < len(raw):
        cut = NO_WORD.search(raw, at + most)
        end = cut.end() if cut else len(raw)
        yield (lead + b" " + raw[at:end]).decode() if lead else raw[at:end].decode(), bool(lead)
        kinds = raw[at:end].translate(KINDS).rstrip(b" ")
        if kinds:
            lead = raw[at + kinds.rfind(b" ") + 1 : at + len(kinds)]
        at = end


def counted(batches: Iterator[pa.RecordBatch], buckets: int = BUCKETS, part: int = PART) -> Iterator[pa.RecordBatch]:
    """Counts of a partition's rows (id, text) by bucket; a row of the result for each row and part."""
    import duckdb

    con = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
    con.create_function("crc", crc, ["VARCHAR"], "BIGINT", type="arrow")
    first, seen = TaskContext.get().partitionId() << 40, 0
    held: list[tuple[int, int | None, str, bool]] = []

    def flush() -> pa.RecordBatch:
        rows = [r for r, *_ in held]
        # a row's parts never share a slice: rows of a slice are as many as its texts
        con.register("slice", pa.table({"row": pa.array(range(len(held)), pa.int32()), "text": pa.array([t for _, _, t, _ in held], pa.string()), "led": pa.array([x for *_, x in held], pa.bool_())}))
        found = con.execute(SQL.format(buckets=buckets)).fetchnumpy()
        con.unregister("slice")
        order = np.lexsort((found["bucket"], found["row"]))
        row, bucket, n, words = (np.asarray(found[c])[order].astype(np.int64) for c in ("row", "bucket", "n", "words"))
        ends = np.searchsorted(row, np.arange(len(rows) + 1)).astype(np.int32)
        total = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[ends])
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (bucket, n)]
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array([i for _, i, *_ in held], pa.int64()), pa.array(total(words)), pa.array(total(n)), *lists], names=["row", "id", "n_words", "n_features", "buckets", "counts"])

    for batch in batches:
        for b in slices(batch, 1, SLICE):
            for i, t in zip(b.column(0), b.column(1), strict=True):
                for text, led in parts(t.as_py() or "", part):
                    if led:
                        yield flush()
                        held = []
                    held.append((first + seen, i.as_py(), text, led))
                seen += 1
            yield flush()
            held = []


def bucket_counts(docs: DataFrame, id_col: str, text_col: str, buckets: int = BUCKETS, part: int = PART) -> DataFrame:
    """COUNTS of each text, as a table in the shared folder."""
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    return written(rows.mapInArrow(lambda batches: counted(batches, buckets, part), COUNTS), "bucket-counts")


def merged(counts: DataFrame) -> DataFrame:
    """bucket, n over all texts: partial sums in each task, a row a bucket after."""
    each = counts.select(F.explode(F.arrays_zip("buckets", "counts")).alias("x"))
    return each.groupBy(F.col("x.buckets").alias("bucket")).agg(F.sum(F.col("x.counts").cast("long")).alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row: the gain of every bucket in an array, in thousandths. Both: bucket, n."""
    every = source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").fillna(0, ["s", "t"])
    whole = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))  # one row
    d = lambda c, k: F.col(c).cast("double") + k
    gain = F.floor(1000.0 * F.log(d("t", 1) * d("all_s", buckets) / (d("s", 1) * d("all_t", buckets))))
    each = both.crossJoin(F.broadcast(whole)).select("bucket", gain.alias("gain"))
    return each.agg(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "gain"))), lambda x: x["gain"]).alias("gains"))


def noise(id_col: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the digest of seed and id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), id_col.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_id: str = "item_id", target_text: str = "text", percent: int = 25, least_words: int = 20, seed: int = 7, buckets: int = BUCKETS, part: int = PART) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document: of the N with ``least_words`` or
    more, floor(percent * N / 100) are drawn."""
    counts = bucket_counts(docs, id_col, text_col, buckets, part)
    gain = written(gains(merged(counts), merged(bucket_counts(target, target_id, target_text, buckets, part)), buckets), "gains")
    summed = F.aggregate(F.arrays_zip("buckets", "counts"), F.lit(0).cast("long"), lambda a, x: a + F.get("gains", x["buckets"]) * x["counts"])
    part = counts.crossJoin(F.broadcast(gain)).select("row", "id", "n_words", "n_features", summed.alias("total"))  # one row of gains
    whole = part.groupBy("row").agg(F.first("id").alias("doc_id"), *(F.sum(c).alias(c) for c in ("n_words", "n_features", "total")))
    n = "nullif(n_features, 0)"
    weight = F.coalesce(F.expr(f"(total - pmod(total, {n})) div {n}"), F.lit(0))  # rounded down
    scored = written(whole.withColumn("weight", weight).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored")
    eligible = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    order = [F.desc("score"), F.asc("doc_id"), F.asc("row")]
    drawn = scored.where(eligible)
    # ranges are cut by a sample, so they are written before they are counted
    ranged = written(drawn.repartitionByRange(buckets_for(drawn, RANGE_BYTES), *order).withColumn("part", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("part").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a range
    most = F.floor(F.sum("count").over(Window.partitionBy()) * percent / 100)
    starts = sizes.select("part", before.alias("before"), most.cast("long").alias("most"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) + F.col("before")
    placed = ranged.join(F.broadcast(starts), "part").withColumn("rank", place.cast("long"))
    ranks = placed.withColumn("rank", F.when(F.col("rank") <= F.col("most"), F.col("rank")))
    out = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranks.select(*out).unionByName(scored.where(~eligible).withColumn("rank", F.lit(None).cast("long")).select(*out))
