"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch, shared_dir, written  # noqa: F401

#: The white space of the word and line rules: space, tab, LF, VT, FF, CR.
WS = " \t\n\x0b\x0c\r"


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files and rows that a plan starts from, by Spark's statistics; 0 where unknown."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(k).stats().sizeInBytes()) for k in range(leaves.size())]
    return sum(s for s in sizes if s < 1 << 60)


def buckets_for(df: DataFrame, each: int) -> int:
    """As many buckets as Spark has shuffle partitions, and more where they would take more than
    ``each`` bytes of the input."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(df) // each))


def written_by(df: DataFrame, what: str, key: str, buckets: int) -> DataFrame:
    """As ``written``, in files by bucket of ``key``: where rows meet by that key later, these need
    no shuffle. There are as many buckets as Spark lets a table have, at most. The name that the
    table needs while it is read in goes again; its files stay until ``clear_scratch``."""
    spark = df.sparkSession
    path, name = scratch(spark, what), f"textloom_{uuid.uuid4().hex}"
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    df.write.format("parquet").bucketBy(min(buckets, most), key).option("path", path).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out


def quoted(name: str) -> str:
    """A column's name as Spark reads it whole, whatever characters are in it."""
    return f"`{name.replace('`', '``')}`"


def whole_text(column: str = "text"):
    """The text, null as the empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def slices(batch: pa.RecordBatch, text_at: int, chars: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about so many bytes of text, so that arrays over words stay bounded
    however long the texts of a batch are together; a text is never cut."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False).astype("int64")
    first = held = 0
    for row, size in enumerate(sizes.tolist()):
        held += size
        if held >= chars:
            yield batch.slice(first, row + 1 - first)
            first, held = row + 1, 0
    if first < batch.num_rows:
        yield batch.slice(first)


def clear_scratch(spark: SparkSession) -> None:
    """Deletes what these operators have written to the shared folder, once results are read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/textloom")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
