"""Near duplicates on a stream of documents: an index of band keys in keyed state.

Every text with words has a key in each band (``operators.minhash``). The state holds the first
document that came with each key: a document's keys probe the index and are put in, and the
result is, for each document, the least of the first documents of its keys (itself, if it is
new). With documents that come in the order of their ids this is what ``minhash.probe`` finds
over all of them at once. The index is the stream's checkpoint, so it outlives the run.

The index is dealt into ``parts`` by hash, each a sorted array that a batch reads once, for all
its keys there. With ``forget_ms`` each key is a state of its own instead, for it is let go by
itself so long after it was put in; that takes a call for every key.

A key that very many documents share (exact copies) is no hot group: within a task only the first
document of a key goes to the state, the others know it by then and are spread.

Cases: null and empty texts have no words and no result. Rows that repeat an id count once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import minhash

PROBES = "band int, key string, spread long, doc long, first long"
#: Parts of the index at least, and keys of a part for ``parts_for``; 26 bytes each.
PARTS, PART_KEYS = 64, 1 << 19
SPACES = re.compile(r"[ \t\n\x0b\f\r]+")
#: Texts whose shingles a task holds at a time.
TEXTS = 1024
HELD = np.dtype([("key", "S18"), ("doc", "<i8")])


def hashes_of(text: str, width: int) -> list[int]:
    """``minhash.shingle_hashes`` of a text in lower case."""
    w = [x for x in SPACES.split(text) if x]
    runs = {" ".join(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {" ".join(w)} if w else ()
    return [int.from_bytes(hashlib.md5(r.encode()).digest()[:4]) for r in runs]


def hashed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """doc and text to doc and hashes, without the texts that have no words."""
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS):
            part = batch.slice(at, TEXTS)
            rows = [(d, h) for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True) if t and (h := hashes_of(t, width))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), (pa.int64(), pa.list_(pa.int64())), strict=True)], names=["doc", "hashes"])


def keys_of(hashes: pa.Array, bands: int, rows: int) -> list[str]:
    """The keys that ``minhash.band_keys`` gives, by text and band, from the texts' shingle hashes."""
    flat, first = hashes.flatten().to_numpy().astype(np.uint64), np.cumsum([0, *pc.list_value_length(hashes).to_pylist()])[:-1]
    least = np.empty((len(hashes), bands * rows), np.int64)
    for k in range(bands * rows):
        a, b = 1 + (k * 829348951 + 40503) % minhash.FACTORS, k * 40503 + 12345
        least[:, k] = np.minimum.reduceat((np.uint64(a) * flat + np.uint64(b)) % np.uint64(minhash.PRIME), first)
    return [hashlib.md5("-".join(map(str, x)).encode()).hexdigest() for x in least.reshape(-1, rows).tolist()]


def local_firsts(batches: Iterator[pa.RecordBatch], bands: int = minhash.BANDS, rows_each: int = minhash.ROWS) -> Iterator[pa.RecordBatch]:
    """doc and hashes to a row a band: spread 0 for the first document of a key in these rows, and
    one of its own for each other, which knows that first one."""
    for batch in batches:
        docs = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), bands)
        keys = keys_of(batch.column(1), bands, rows_each)
        rows = pd.DataFrame({"doc": docs, "key": keys, "band": np.tile(np.arange(bands, dtype=np.int32), batch.num_rows)})
        rows["first"] = rows.groupby(["band", "key"])["doc"].transform("min")
        rows["spread"] = (rows["doc"] + 1).where(rows["doc"] != rows["first"], 0)
        yield pa.RecordBatch.from_pandas(rows[["band", "key", "spread", "doc", "first"]], preserve_index=False, schema=pa.schema([("band", pa.int32()), ("key", pa.string()), ("spread", pa.int64()), ("doc", pa.int64()), ("first", pa.int64())]))


class FirstHolder(StatefulProcessor):
    """Keeps the first document of a band's key."""

    def __init__(self, forget_ms: int | None) -> None:
        self.forget_ms = forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", "doc long", self.forget_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = key[2] != 0  # by its task
        held = None if known or not self.first.exists() else self.first.get()[0]
        parts = list(rows)  # the firsts of tasks, or the rows of one document
        if not known:
            least = min(int(p["doc"].min()) for p in parts)
            if held is None:
                held = least
                self.first.update((held,))
        for p in parts:
            yield pd.DataFrame({"band": p["band"], "key": p["key"], "doc": p["doc"], "first": p["first"] if known else held, "known": not known})

    def close(self) -> None:
        pass


def parts_for(documents: int) -> int:
    """Parts of an index that shall hold so many documents. One that is gone on with keeps its number."""
    return max(PARTS, -(-documents * minhash.BANDS // PART_KEYS))


def packed(bands: np.ndarray, keys: list[str]) -> np.ndarray:
    """A band and its key (32 hexadecimal digits) in 18 bytes."""
    digits = np.array(keys, "S32").view(np.uint8).reshape(-1, 32)
    values = np.where(digits < 58, digits - 48, digits - 87).astype(np.uint8)
    of = np.ascontiguousarray(bands, ">u2").view(np.uint8).reshape(-1, 2)
    return np.concatenate((of, values[:, ::2] << 4 | values[:, 1::2]), axis=1).view("S18").ravel()


class FirstsOfPart(StatefulProcessor):
    """Keeps the first document of every key of a part of the index, sorted by key."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("firsts", "firsts binary")

    def ask(self, keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """The first document of each key; those that are new are put in, with the least of theirs."""
        held = np.frombuffer(bytes(self.held.get()[0]), HELD) if self.held.exists() else np.zeros(0, HELD)
        distinct, of = np.unique(keys, return_inverse=True)
        firsts = np.full(len(distinct), np.iinfo(np.int64).max)
        np.minimum.at(firsts, of, docs)
        at = np.searchsorted(held["key"], distinct)
        there = at < len(held)
        there[there] = held["key"][at[there]] == distinct[there]
        firsts[there] = held["doc"][at[there]]
        if not there.all():
            new = np.zeros(int((~there).sum()), HELD)
            new["key"], new["doc"] = distinct[~there], firsts[~there]
            self.held.update((np.insert(held, at[~there], new).tobytes(),))
        return firsts[of]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        t = pd.concat(list(rows), ignore_index=True)
        asked = t["spread"].to_numpy() == 0
        first = t["first"].to_numpy(copy=True)  # known by its task
        if asked.any():
            first[asked] = self.ask(packed(t["band"].to_numpy()[asked], t["key"].to_numpy()[asked].tolist()), t["doc"].to_numpy()[asked])
        yield pd.DataFrame({"band": t["band"], "key": t["key"], "doc": t["doc"], "first": first, "known": asked})

    def close(self) -> None:
        pass


FOUND = "band int, key string, doc long, first long, known boolean"


def probed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, forget_ms: int | None = None, parts: int = PARTS) -> DataFrame:
    """band, key, doc, first of each streamed document, and whether the index has been asked (known): if
    not, ``first`` is the first of its task. The rows of a document come in one batch."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.lower(text_col).alias("text")).where("doc IS NOT NULL")
    # an arrival is one file, often one task's; its texts are dealt to all
    rows = texts.repartition("doc").mapInArrow(lambda batches: local_firsts(hashed(batches, width)), PROBES)
    if forget_ms is not None:
        return rows.groupBy("band", "key", "spread").transformWithStateInPandas(FirstHolder(forget_ms), FOUND, "Append", "ProcessingTime")
    place = F.when(F.col("spread") == 0, F.xxhash64("band", "key")).otherwise(F.xxhash64("spread"))
    return rows.withColumn("part", F.pmod(place, F.lit(parts)).cast("int")).groupBy("part").transformWithStateInPandas(FirstsOfPart(), FOUND, "Append", "None")


def least(batch: DataFrame, k: int = 0) -> DataFrame:
    """A batch's bands to its documents: what the index has told one document of a key holds for all of
    them. The join's hot keys are on one side alone, where Spark splits them."""
    batch = batch.persist()
    told = batch.where("known").groupBy("band", "key").agg(F.min("first").alias("held"))
    others = batch.where("NOT known").join(told, ["band", "key"]).select("doc", F.col("held").alias("first"))
    return batch.where("known").select("doc", "first").unionByName(others).groupBy("doc").agg(F.min("first").alias("first"))


def sliced(docs: DataFrame, id_col: str = "doc_id", slices: int = 6) -> DataFrame:
    """The documents with ``slice``: ranges of the id, which come one after the other."""
    ends = docs.agg(F.min(id_col).alias("low"), F.max(id_col).alias("high"))  # one row
    place = F.floor((F.col(id_col) - F.col("low")) * slices / (F.col("high") - F.col("low") + 1)).cast("int")
    return docs.crossJoin(F.broadcast(ends)).withColumn("slice", F.coalesce(place, F.lit(0))).drop("low", "high")
