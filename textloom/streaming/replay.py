"""Tables replayed as streams of several batches, in the order in which their rows arrive.

``arrivals`` writes a table as one file for each value of its ``slice`` column and dates the files
in that order, so a file source with ``maxFilesPerTrigger`` 1 reads a slice a batch. ``run`` takes
all of them through a function; each batch's output is a table of its own in the shared folder,
which a batch that is done again replaces, and offsets and state are kept there too, so a run that
fails goes on where it stopped. A slice is what arrives between two triggers, one task's work.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch

#: State that outgrows memory, and the one kind that keyed processors can use.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DATED = 1_700_000_000_000


def arrivals(df: DataFrame, slice_col: str = "slice") -> str:
    """The folder of the table's files, one a slice, dated a second apart in the slices' order."""
    spark, path = df.sparkSession, scratch(df.sparkSession, "arrivals")
    df.repartition(slice_col).write.partitionBy(slice_col).parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    files, found = store.listFiles(at, True), []
    while files.hasNext():
        if (name := files.next().getPath()).getName().endswith(".parquet"):
            found.append((int(re.search(rf"/{slice_col}=(-?\d+)/", name.toString())[1]), name))
    for k, (_, name) in enumerate(sorted(found, key=lambda x: x[0])):
        store.setTimes(name, DATED + 1000 * k, -1)
    return path


def run(spark: SparkSession, path: str, schema, function: Callable[[DataFrame], DataFrame], at: str | None = None, mode: str = "append", each: Callable[[DataFrame, int], DataFrame] | None = None) -> DataFrame:
    """What the stream over the files has put out once all are read. at: the folder of its state and
    output; the one of an earlier run goes on from there. each: applied to every batch's output."""
    at = at or scratch(spark, "stream")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        out = function(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path))
        kinds: list = [out.schema]

        def put(batch: DataFrame, k: int) -> None:
            out = each(batch, k) if each else batch
            kinds.append(out.schema)
            out.write.mode("overwrite").parquet(f"{at}/rows/batch={k}")
            batch.unpersist()

        query = out.writeStream.foreachBatch(put).option("checkpointLocation", f"{at}/state").outputMode(mode).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    try:
        return spark.read.parquet(f"{at}/rows").drop("batch")
    except AnalysisException:  # nothing has arrived
        return spark.createDataFrame([], kinds[-1])


def state(spark: SparkSession, at: str) -> DataFrame | None:
    """key, value of what the stream with the folder ``at`` holds after its last batch, if it has one state;
    None where nothing has arrived."""
    commits = spark._jvm.org.apache.hadoop.fs.Path(f"{at}/state/commits")
    store = commits.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(commits) or not store.listStatus(commits):
        return None
    return spark.read.format("statestore").load(f"{at}/state")
