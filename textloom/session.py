"""Session helpers shared by the library, tests, the bench and the entry module."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | None = None, app: str = "textloom") -> SparkSession:
    """A local session with the settings that the queries assume (UTC, AQE, Arrow)."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TEXTLOOM_DRIVER_MEMORY", "4g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; works for a file or a directory, on any Hadoop path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the setting is absent, a local session (tests) gets a temporary folder once; on a
    cluster that is an error, because executors would not see the driver's folder.
    """
    if at := spark.conf.get("spark.checkpoint.dir", None):
        return at.rstrip("/")
    if (at := spark.sparkContext._jsc.sc().getCheckpointDir()).isDefined():
        return at.get().rstrip("/")
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="textloom-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def parts_for(df: DataFrame, each: int = 128 << 20) -> int:
    """As many partitions as the session shuffles into, and more where the files that a plan starts from
    have more than ``each`` bytes for one, by Spark's statistics."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(k).stats().sizeInBytes()) for k in range(leaves.size())]
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-sum(s for s in sizes if s < 1 << 60) // each))


def scratch(spark: SparkSession, what: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/textloom/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
