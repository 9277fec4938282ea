"""Digests of folders: SHA-256 over sorted ``name:checksum`` lines, as of a directory of files.

Files are digested where they lie; what goes on is a line of a name and 64 digits a file. A SHA-256
reads its input in order, so a folder's lines are fed to it by one task, as a sorted stream from
Spark's sort: that task holds a batch of lines and the digest's state, never a folder.

Cases: a null content has the checksum of the empty one. Files of one name are ordered by checksum. A
null folder or name is left out. A folder without files has no row; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def file_checksums(files: DataFrame, folder: str, name: str, content: str) -> DataFrame:
    """folder, name, checksum of every file."""
    rows = files.where(F.col(folder).isNotNull() & F.col(name).isNotNull())
    return rows.select(F.col(folder).alias("folder"), F.col(name).alias("name"), F.sha2(F.coalesce(F.col(content), F.lit("")), 256).alias("checksum"))


def folder_digests(files: DataFrame, folder: str, name: str, content: str) -> DataFrame:
    """SCO40: folder, files, checksum of every folder."""
    lines = file_checksums(files, folder, name, content)
    lines = lines.select("folder", F.concat("name", F.lit(":"), "checksum").alias("line"), "name", "checksum")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, count, done = None, hashlib.sha256(), 0, []
        for b in batches:
            for at, line in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if at != now:
                    if count:
                        done.append((now, count, state.hexdigest()))
                    now, state, count = at, hashlib.sha256(), 0
                state.update(("\n" if count else "").encode() + line.encode())
                count += 1
        if count:
            done.append((now, count, state.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string()))], names=["folder", "files", "checksum"])

    ordered = lines.repartition("folder").sortWithinPartitions("folder", "name", "checksum")
    return ordered.select("folder", "line").mapInArrow(digest, "folder string, files long, checksum string")
