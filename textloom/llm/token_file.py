"""Token ids in files of 64-bit words (Simple-8b), in ascending document order.

Layout of a file (all little-endian): the magic, four 64-bit counts (documents, ids, blocks,
words), then document ids, null marks (a byte each), lengths (ids of each document), block
offsets (first word of each block, and the end), words. A block holds ``BLOCK`` ids. A word's
top four bits select how many ids it holds and their width; selector 15 is an escape: the whole
next word is one id. Because no word crosses a block and offsets are kept, any block is decoded
by itself, all words of a selector at once.

A file's name has its task's place and a part of its own for each attempt; the table of files
holds the names of the attempts that Spark has committed, and only these are read. Files are
written and read by pyarrow's file systems (local, S3, GCS, HDFS where its client is installed).

Cases: a null text counts as empty and gives the end id alone. A null id comes first in order
and is marked. Rows that repeat an id follow each other in any order. An empty table gives no
file and an empty result. Further columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import buckets_for, scratch, written
from .word_tokens import vocabulary_path, word_ids

MAGIC, BLOCK = b"S8BTOK01", 1024
#: Selector: (ids in a word, bits of each). 15 is the escape.
KINDS = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
ESCAPE = 15
FILE_IDS = 4 << 20
#: Bytes of the input that a task encodes.
RANGE_BYTES = 128 << 20
U = np.uint64


def _windows(small: np.ndarray, count: int) -> np.ndarray:
    """Where ``count`` true values start."""
    out, have = small.copy(), 1
    while have < count and out.any():
        step = min(have, count - have)
        out[:-step] &= out[step:]
        out[len(out) - step :] = False
        have += step
    return out


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, and the first word of each block and the end."""
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    ids = ids.astype(U)
    starts, length = np.arange(blocks) * BLOCK, np.minimum(BLOCK, n - np.arange(blocks) * BLOCK)
    room = np.repeat(starts + length, length) - np.arange(n)  # ids left in the block from each place
    # the most ids that a word starting at each place can hold
    choice = np.full(n, ESCAPE, np.int8)
    for kind in range(len(KINDS) - 1, -1, -1):
        count, bits = KINDS[kind]
        small = ids < (U(1) << U(bits))
        if count > 1:
            if n < count or not (small := _windows(small, count)).any():
                continue
            small &= room >= count
        choice[small] = kind
    step = np.array([c for c, _ in KINDS] + [0, 1])[choice]
    at, ends, heads = starts.copy(), starts + length, []
    live = np.flatnonzero(at < ends)
    while len(live):  # one word of every block at a time
        heads.append(at[live])
        at[live] += step[at[live]]
        live = live[at[live] < ends[live]]
    head = np.sort(np.concatenate(heads)) if heads else np.zeros(0, np.int64)
    kinds = choice[head]
    sizes = 1 + (kinds == ESCAPE)
    place = np.concatenate(([0], np.cumsum(sizes)))
    words = np.zeros(place[-1], U)
    for kind, (count, bits) in enumerate(KINDS):
        mine = np.flatnonzero(kinds == kind)
        if len(mine):
            word = np.full(len(mine), kind, U) << U(60)
            for j in range(count):
                word |= ids[head[mine] + j] << U(j * bits)
            words[place[mine]] = word
    mine = np.flatnonzero(kinds == ESCAPE)
    words[place[mine]], words[place[mine] + 1] = U(ESCAPE) << U(60), ids[head[mine]]
    return words, place[np.searchsorted(head, np.concatenate((starts, [n])))].astype(np.int64)


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ids of all blocks, as unsigned 64-bit numbers. Ids of ``n`` in all."""
    words = words.astype(U)
    kinds = (words >> U(60)).astype(np.int64)
    if (kinds == ESCAPE).any():  # the words after escapes are values, not heads; escapes come in order
        head = np.ones(len(words), bool)
        for p in np.flatnonzero(kinds == ESCAPE).tolist():
            if head[p]:
                head[p + 1] = False
    else:
        head = np.ones(len(words), bool)
    at = np.flatnonzero(head)
    step = np.array([c for c, _ in KINDS] + [0, 1])[kinds[at]]
    first, out = np.cumsum(step) - step, np.zeros(n, U)
    for kind, (count, bits) in enumerate(KINDS):
        mine = np.flatnonzero(kinds[at] == kind)
        for j in range(count):
            out[first[mine] + j] = (words[at[mine]] >> U(j * bits)) & U((1 << bits) - 1)
    mine = np.flatnonzero(kinds[at] == ESCAPE)
    out[first[mine]] = words[at[mine] + 1]
    return out


def decode_block(words: np.ndarray, offsets: np.ndarray, n: int, block: int) -> np.ndarray:
    """One block by itself."""
    return decode(words[offsets[block] : offsets[block + 1]], offsets[:1], min(BLOCK, n - block * BLOCK))


def pack_file(doc_ids: list[int | None], texts: list[bytes]) -> bytes:
    """A file's bytes; texts: each document's ids as 32-bit bytes."""
    ids = np.frombuffer(b"".join(texts), "<u4")
    words, offsets = encode(ids)
    docs = np.array([0 if i is None else i for i in doc_ids], "<i8")
    nulls = np.array([i is None for i in doc_ids], np.uint8)
    lengths = np.array([len(t) // 4 for t in texts], "<i8")
    return b"".join((MAGIC, struct.pack("<4q", len(docs), len(ids), len(offsets) - 1, len(words)), docs.tobytes(), nulls.tobytes(), lengths.tobytes(), offsets.astype("<i8").tobytes(), words.astype("<u8").tobytes()))


def unpack_file(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, lengths, and all ids as 32-bit numbers."""
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    n_docs, n_ids, n_blocks, n_words = struct.unpack_from("<4q", data, 8)
    at, parts = 40, []
    for kind, count in (("<i8", n_docs), ("u1", n_docs), ("<i8", n_docs), ("<i8", n_blocks + 1), ("<u8", n_words)):
        parts.append(np.frombuffer(data, kind, count, at))
        at += parts[-1].nbytes
    docs, nulls, lengths, offsets, words = parts
    return [None if z else i for i, z in zip(docs.tolist(), nulls.tolist(), strict=True)], lengths, decode(words, offsets, n_ids).astype("<u4")


def _store(folder: str):
    """The folder's file system and its path there; Spark's names of S3 are pyarrow's s3."""
    from pyarrow import fs

    scheme, _, rest = folder.partition("://")
    if scheme in ("s3a", "s3n"):
        folder = f"s3://{rest}"
    elif not rest and not folder.startswith("file:"):
        folder = f"file://{folder}"
    return fs.FileSystem.from_uri(folder)


def write_token_files(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Writes all documents' ids below ``folder``; returns name, n_docs, n_ids and start of each file."""
    spark, path = docs.sparkSession, vocabulary or vocabulary_path()
    parts = buckets_for(docs, RANGE_BYTES)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, seq, attempt = word_ids(path), TaskContext.get().partitionId(), 0, uuid.uuid4().hex
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        ids: list[int | None] = []
        texts: list[bytes] = []
        done: list[tuple[str, int, int]] = []

        def flush() -> None:
            nonlocal seq, ids, texts
            if ids:
                name = f"part-{part:08d}-{seq:08d}-{attempt}.s8b"
                with store.open_output_stream(f"{root}/{name}") as out:
                    out.write(pack_file(ids, texts))
                done.append((name, len(ids), sum(map(len, texts)) // 4))
                seq, ids, texts = seq + 1, [], []

        held = 0
        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), tokens.texts(b.column(1)), strict=True):
                ids.append(i)
                texts.append(text)
                held += len(texts[-1]) // 4
                if held >= FILE_IDS:
                    flush()
                    held = 0
        flush()
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["name", "n_docs", "n_ids"])

    # rows without an id, or with one id, may fill several ranges
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    ordered = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    files = written(ordered.mapInArrow(write, "name string, n_docs long, n_ids long"), "token-files")
    before = Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids (binary, unsigned 32-bit little-endian) of each document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        for b in batches:
            for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with store.open_input_stream(f"{root}/{name}") as data:
                    docs, lengths, ids = unpack_file(data.read())
                ends = np.cumsum(lengths)
                body = pa.Array.from_buffers(pa.binary(), len(docs), [None, pa.py_buffer(np.concatenate(([0], ends * 4)).astype("<i4").tobytes()), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(start + ends - lengths), pa.array(lengths), body], names=["doc_id", "start", "n_tokens", "ids"])

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), files.count() // 4)
    # names are dealt, not files: each task opens its own
    return files.select("name", "start").repartition(parts, "name").mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def token_files(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, folder: str | None = None) -> DataFrame:
    """Writes the files and reads them back."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "tokens")
    files = written(write_token_files(docs, folder, id_col, text_col, vocabulary), "token-starts")
    if not files.head(1):
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids binary")
    return read_token_files(spark, folder, files)
