"""Sources and sinks: datasets by suffix, phase folders, baselines, reports and catalogs.

Paths go through Spark's file systems, so they may be on any store that Spark reads.
"""

from __future__ import annotations

import json
import logging
import re
from dataclasses import dataclass, fields
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class CorpusConfig:
    """SRC6: the settings that are read from a nested configuration, with their defaults."""

    target_languages: tuple[str, ...] = ("javascript", "typescript", "xml", "html", "css", "mdx")
    deduplication_threshold: float = 0.8
    quality_threshold: float = 0.7
    syntax_threshold: float = 0.8
    coherence_threshold: float = 0.6

    @classmethod
    def of(cls, nested: dict) -> CorpusConfig:
        """Takes each setting from wherever it stands in the nested mapping; the first one counts."""
        found: dict = {}

        def walk(node: dict) -> None:
            for key, value in node.items():
                if isinstance(value, dict):
                    walk(value)
                elif key not in found:
                    found[key] = tuple(value) if isinstance(value, list) else value

        walk(nested)
        return cls(**{f.name: found[f.name] for f in fields(cls) if f.name in found})


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """SRC3-5: a JSON array (.json), JSON lines (.jsonl), CSV with a header, else Parquet."""
    name = path.rstrip("/").lower()
    if name.endswith(".json"):
        return spark.read.option("multiLine", True).json(path)
    if name.endswith(".jsonl"):
        return spark.read.json(path)
    if name.endswith(".csv"):
        return spark.read.option("header", True).csv(path)
    return spark.read.parquet(path)


def load(spark: SparkSession, root: str, name: str, subset: str | None = None, split: str = "train", key: str | None = None) -> DataFrame:
    """SRC1, SRC2: a split of a dataset below ``root`` (``root/name[/subset]/split``, with any suffix
    that ``read_dataset`` knows). split: its name, with a range of rows like ``train[:1000]`` or
    ``test[50:100]`` in the order of ``key``."""
    m = re.fullmatch(r"(\w+)(?:\[(\d*):(\d*)\])?", split)
    if not m:
        raise ValueError(f"not a split: {split}")
    folder = "/".join(p for p in (root.rstrip("/"), name, subset) if p)
    path = first_existing(spark, [f"{folder}/{m[1]}{suffix}" for suffix in ("", ".parquet", ".jsonl", ".json", ".csv")])
    if path is None:
        raise FileNotFoundError(f"{folder}/{m[1]}")
    rows = read_dataset(spark, path)
    if m[2] is None:
        return rows
    if key is None:
        raise ValueError("a range of rows needs a key that orders them")
    first, end = int(m[2] or 0), m[3]
    out = rows.orderBy(key)
    return out.limit(int(end)).offset(first) if end else out.offset(first)


def save_dataset(df: DataFrame, path: str) -> None:
    """SNK1."""
    df.write.mode("overwrite").parquet(path)


def scan_phase(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """SRC7: every dataset of a phase folder by name; entries that cannot be read are left out."""
    fs, at = _file_system(spark, folder)
    out: dict[str, DataFrame] = {}
    for status in fs.listStatus(at) if fs.exists(at) else []:
        name, path = status.getPath().getName(), status.getPath().toString()
        if name.startswith((".", "_")):
            continue
        try:
            out[name.rsplit(".", 1)[0]] = read_dataset(spark, path)
        except (PySparkException, Py4JJavaError) as e:  # the second: files that are no dataset
            log.warning("%s is left out: %s", path, str(e).splitlines()[0])
    return out


def first_existing(spark: SparkSession, paths: list[str]) -> str | None:
    """SRC8."""
    return next((p for p in paths if (x := _file_system(spark, p))[0].exists(x[1])), None)


def write_rows(parts: list[DataFrame], path: str) -> None:
    """SNK4: results of different columns as one CSV; what a part lacks is empty."""
    reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).write.mode("overwrite").option("header", True).csv(path)


def few(df: DataFrame, most: int) -> list[Row]:
    """The rows of a small table; an error where there are more than ``most``."""
    if len(rows := df.limit(most + 1).collect()) > most:
        raise ValueError(f"more than {most} rows: write them by Spark instead")
    return rows


def export_catalog(df: DataFrame, kind: str = "json", most: int = 100_000) -> str:
    """SNK6: a small catalog as text; JSON or YAML."""
    rows = [r.asDict(recursive=True) for r in few(df, most)]
    if kind == "json":
        return json.dumps(rows, indent=2, default=str)
    if kind == "yaml":
        import yaml

        return yaml.safe_dump(json.loads(json.dumps(rows, default=str)), sort_keys=False)
    raise ValueError(f"neither json nor yaml: {kind}")


def markdown_report(title: str, df: DataFrame, most: int = 100_000) -> str:
    """SNK5: a small result as a Markdown table."""
    head = [f"# {title}", "", f"| {' | '.join(df.columns)} |", f"|{'---|' * len(df.columns)}"]
    return "\n".join(head + [f"| {' | '.join('' if v is None else str(v) for v in r)} |" for r in few(df, most)]) + "\n"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text as one file on any store."""
    fs, at = _file_system(spark, path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_stats(stats: DataFrame, path: str) -> None:
    """SNK2: a row of figures as one JSON object; nothing for a table without rows."""
    row = stats.first()
    write_text(stats.sparkSession, path, json.dumps(row.asDict(recursive=True) if row else {}, indent=2, default=str))


def write_duplicates(pairs: DataFrame, path: str) -> None:
    """SNK3: representatives and their duplicates as JSON lines, a line for each duplicate, so that no
    group is gathered. pairs: rep_id, dup_id."""
    pairs.select("rep_id", "dup_id").write.mode("overwrite").json(path)


def phase_report(phases: dict[str, DataFrame], metrics: dict[str, float], config: CorpusConfig, seconds: float, at: str) -> dict:
    """RPT14: what the phases of a preparation have left, its metrics and its settings."""
    counts = {name: df.count() for name, df in phases.items()}
    return {
        "pipeline_summary": {"total_execution_time": f"{seconds:.2f} seconds", "phases_completed": len(counts), "success": bool(counts), "timestamp": at},
        "processing_statistics": {"rows": counts, "total_processed": sum(counts.values())},
        "quality_metrics": dict(metrics),
        "configuration": {f.name: getattr(config, f.name) for f in fields(config)},
    }
