"""Removal of lines that many documents share, by a sharded minimal perfect hash.

A line's key is the line without white space at its ends, A-Z lower-cased. Keys of at least
``min_chars`` code points that at least ``min_docs`` documents hold lose all their lines, except
in the document with the largest id. The keys that many documents hold are found by one
aggregation over 128-bit hashes (counted map-side first, so that a line that a third of all
documents hold is a row a task). They go into shards; each shard is a minimal perfect hash whose
slots hold a 64-bit fingerprint, the count and the largest id. Documents probe these arrays.
Up to ``broadcast_bytes`` all shards go to every worker; beyond that size each shard stays where
it is, and the documents' line hashes visit it in as many groups as their number asks for
(``VISITS`` each), whatever the line, so no task holds more.

Cases: a null or empty text is one empty line and stays as the empty text. Every row counts as a
document; rows that repeat an id count one by one and share its rank. A null id ranks below all
others. An empty table gives an empty result. Further columns pass through whatever their names;
columns that have the names of the two counts are replaced.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WS, written

LOWEST = -(2**63)
SHARD_KEYS = 1 << 20
#: Lines that visit a shard in one group, about.
VISITS = 1 << 20
U = np.uint64


def line_hash(line: str, min_chars: int) -> int | None:
    """The 128-bit hash of a line's key, None where the key is short."""
    if len(line) < min_chars:
        return None
    key = line.strip(WS)
    return xxhash.xxh3_128_intdigest(key.encode().lower()) if len(key) >= min_chars else None


def _halves(hashes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(h.to_bytes(16, "little") for h in hashes), dtype="<u8").reshape(-1, 2)
    return both[:, 0].astype(U), both[:, 1].astype(U)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _place(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    return _mix(h1 + h2 * U(2 * level + 1) + U(level)) % U(size)


class PerfectHash:
    """A minimal perfect hash over 128-bit keys: at each level keys that are alone at their
    place take it, the others go on to the next level; ranks of the taken places number them."""

    def __init__(self, h1: np.ndarray, h2: np.ndarray, counts: np.ndarray, largest: np.ndarray) -> None:
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        left, base, order = np.arange(len(h1)), 0, []
        while len(left):
            size = -(-2 * len(left) // 64) * 64
            at = _place(h1[left], h2[left], len(self.levels), size).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            ranks = base + np.concatenate(([0], np.cumsum(alone.reshape(-1, 64).sum(axis=1))))
            self.levels.append((size, np.packbits(alone, bitorder="little"), ranks))
            mine = alone[at]
            order.append(left[mine][np.argsort(at[mine], kind="stable")])
            base, left = base + int(mine.sum()), left[~mine]
        slots = np.concatenate(order) if order else np.zeros(0, np.int64)
        self.fingerprints, self.counts, self.largest = h2[slots], counts[slots], largest[slots]

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Each key's slot, -1 where it is none of the keys."""
        out, left = np.full(len(h1), -1, np.int64), np.arange(len(h1))
        for level, (size, bits, ranks) in enumerate(self.levels):
            if not len(left):
                break
            at = _place(h1[left], h2[left], level, size).astype(np.int64)
            here = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            if here.any():
                p = at[here]
                words = bits.view("<u8")[p >> 6] & ((U(1) << (p & 63).astype(U)) - U(1))
                out[left[here]] = ranks[p >> 6] + np.bitwise_count(words)
            left = left[~here]
        found = out >= 0
        out[found] = np.where(self.fingerprints[out[found]] == h2[found], out[found], -1)
        return out


def _line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """h1, h2, doc, text (a hash) of each document's distinct long lines."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, whole, hashes = [], [], []
            for i, text, h in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                mine = {line_hash(x, min_chars) for x in (text or "").split("\n")} - {None}
                hashes += mine
                ids += [LOWEST if i is None else i] * len(mine)
                whole += [h] * len(mine)
            h1, h2 = _halves(hashes)
            columns = [pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(ids, pa.int64()), pa.array(whole, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["h1", "h2", "doc", "text"])

    rows = docs.select(F.col(id_col).cast("long"), text_col, F.xxhash64(text_col))
    return rows.mapInArrow(keys, "h1 long, h2 long, doc long, text long")


def line_index(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int) -> tuple[DataFrame, int]:
    """shard, most, bytes: the shards of the index, written to the shared folder; how many there are."""
    common = _line_keys(docs, id_col, text_col, min_chars).groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc").alias("largest"))
    common = written(common.where(F.col("n") >= min_docs), "line-keys")
    shards = max(1, math.ceil(common.count() / SHARD_KEYS))

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        table = PerfectHash(rows.h1.to_numpy().view(U), rows.h2.to_numpy().view(U), rows.n.to_numpy(), rows.largest.to_numpy())
        return pd.DataFrame({"shard": [key[0]], "most": [int(rows.n.max())], "bytes": [pickle.dumps(table)]})

    built = common.withColumn("shard", F.pmod("h2", F.lit(shards))).groupBy("shard").applyInPandas(build, "shard long, most long, bytes binary")
    return written(built, "line-index"), shards


def _drops(tables: dict[int, PerfectHash], shards: int, h1: np.ndarray, h2: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which of the (line, document) pairs lose the line."""
    out, of = np.zeros(len(h1), bool), (h2.view(np.int64) % shards)
    for s, t in tables.items():
        mine = np.flatnonzero(of == s)
        at = t.find(h1[mine], h2[mine])
        hit = at >= 0
        out[mine[hit]] = doc[mine[hit]] != t.largest[at[hit]]
    return out


_loaded: dict[int, dict[int, PerfectHash]] = {}


def _tables(shared) -> dict[int, PerfectHash]:
    if id(shared) not in _loaded:
        _loaded.clear()
        _loaded[id(shared)] = {s: pickle.loads(x) for s, x in shared.value.items()}
    return _loaded[id(shared)]


def _result(batch: pa.RecordBatch, text_at: int, kept: list[str], lines: list[int], dropped: list[int], names: list[str], of: list[int]) -> pa.RecordBatch:
    columns = [pa.array(kept, pa.string()) if k == text_at else batch.column(k) for k in of]
    return pa.RecordBatch.from_arrays([*columns, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names=names)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5, counts: tuple[str, str] = ("n_lines", "n_dropped"), broadcast_bytes: int = 64 << 20
) -> DataFrame:
    """``docs`` with the kept lines as text, and how many lines there were and were dropped."""
    spark = docs.sparkSession
    docs = docs.select(*(f"`{c}`" for c in docs.columns if c not in counts))
    index, shards = line_index(docs, id_col, text_col, min_chars, min_docs)
    size = index.agg(F.coalesce(F.sum(F.length("bytes")), F.lit(0))).first()[0]
    schema = T.StructType([*(T.StructField(f.name, T.StringType()) if f.name == text_col else f for f in docs.schema), T.StructField(counts[0], T.LongType()), T.StructField(counts[1], T.LongType())])
    id_at, text_at, names, width = docs.columns.index(id_col), docs.columns.index(text_col), schema.names, len(docs.columns)
    if size <= broadcast_bytes:
        shared = spark.sparkContext.broadcast({r.shard: bytes(r.bytes) for r in index.select("shard", "bytes").collect()})

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = _tables(shared)
            for b in batches:
                split = [(t or "").split("\n") for t in b.column(text_at).to_pylist()]
                ids = pc.fill_null(b.column(id_at).cast(pa.int64()), LOWEST).to_numpy(zero_copy_only=False)
                hashes, rows, at = [], [], []
                for r, lines in enumerate(split):
                    for k, line in enumerate(lines):
                        if (h := line_hash(line, min_chars)) is not None:
                            hashes.append(h)
                            rows.append(r)
                            at.append(k)
                h1, h2 = _halves(hashes)
                gone: dict[int, set[int]] = {}
                for j in np.flatnonzero(_drops(tables, shards, h1, h2, ids[np.array(rows, np.int64)])).tolist():
                    gone.setdefault(rows[j], set()).add(at[j])
                kept = ["\n".join(x for k, x in enumerate(lines) if k not in gone[r]) if r in gone else "\n".join(lines) for r, lines in enumerate(split)]
                yield _result(b, text_at, kept, [len(x) for x in split], [len(gone.get(r, ())) for r in range(len(split))], names, list(range(width)))

        return docs.mapInArrow(probe, schema)
    return _visiting(docs, index, shards, id_col, text_col, min_chars, schema)


def _dealt(visits: DataFrame, index: DataFrame, most: int = VISITS) -> tuple[DataFrame, DataFrame]:
    """Visits and shards with a salt: a shard has a copy for every ``most`` visits of its own."""
    salts = written(visits.groupBy("shard").agg(F.ceil(F.count("*") / most).cast("int").alias("salts")), "shard-salts")
    busy = visits.join(salts.where("salts > 1"), "shard", "left")
    salt = F.pmod(F.xxhash64("h1", "doc", "text"), F.coalesce("salts", F.lit(1))).cast("int")
    copies = index.join(salts, "shard").select("shard", "bytes", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    return busy.select("shard", salt.alias("salt"), "h1", "h2", "doc", "text"), copies


def _visiting(docs: DataFrame, index: DataFrame, shards: int, id_col: str, text_col: str, min_chars: int, schema: T.StructType) -> DataFrame:
    """As above where the index is too large to send: line hashes visit the shards, and what is
    dropped comes back to its document by the id and the text."""
    visits = written(_line_keys(docs, id_col, text_col, min_chars).withColumn("shard", F.pmod("h2", F.lit(shards))), "line-visits")
    visits, copies = _dealt(visits, index)

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        h1, h2, doc, text = (left[c].to_numpy() for c in ("h1", "h2", "doc", "text"))
        gone = np.zeros(len(h1), bool)
        if left.num_rows and right.num_rows:
            table = pickle.loads(right["bytes"][0].as_py())
            at = table.find(h1.view(U), h2.view(U))
            gone = (at >= 0) & (table.largest[at] != doc)
        return pa.table([pa.array(x[gone]) for x in (h1, h2, doc, text)], names=["h1", "h2", "doc", "text"])

    gone = visits.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt")).applyInArrow(look, "h1 long, h2 long, doc long, text long")
    name = next(x for x in (f"gone_{k}" for k in range(len(docs.columns) + 1)) if x not in docs.columns)
    gone = gone.groupBy("doc", "text").agg(F.collect_set(F.struct("h1", "h2")).alias(name))  # of one text
    row = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("doc"), F.xxhash64(text_col).alias("text"))
    joined = row.join(gone, ["doc", "text"], "left").select(*(F.col("row")[c].alias(c) for c in docs.columns), name)
    text_at, width, names = docs.columns.index(text_col), len(docs.columns), schema.names

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, n_lines, n_dropped = [], [], []
            for text, gone in zip(b.column(text_at).to_pylist(), b.column(width).to_pylist(), strict=True):
                lines, mine = (text or "").split("\n"), {(x["h1"] & (2**64 - 1)) | (x["h2"] & (2**64 - 1)) << 64 for x in gone or ()}
                stay = [x for x in lines if line_hash(x, min_chars) not in mine] if mine else lines
                kept.append("\n".join(stay))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
            yield _result(b, text_at, kept, n_lines, n_dropped, names, list(range(width)))

    return joined.mapInArrow(apply, schema)
