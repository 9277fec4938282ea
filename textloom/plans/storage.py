"""Queries of sources and sinks: what is written to the shared folder and read back from there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import duplicate_pairs
from ..session import scratch, table
from ..sources import io
from .pipelines import _KEYED, _keyed

Query = Callable[[SparkSession, str], DataFrame]

NESTED = {"dataset": {"target_languages": ["en", "fr"], "deduplication_threshold": 0.9}, "quality": {"quality_threshold": 0.75}, "syntax_threshold": 0.85}


def _documents(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", "lang", "source", "n_chars")


def src1(s: SparkSession, d: str) -> DataFrame:
    root = scratch(s, "datasets")
    io.save_dataset(_documents(s, d), f"{root}/corpus/plain/train.parquet")
    return io.load(s, root, "corpus", "plain", "train")


def src2(s: SparkSession, d: str) -> DataFrame:
    root = scratch(s, "datasets")
    io.save_dataset(_documents(s, d), f"{root}/corpus/train")
    return io.load(s, root, "corpus", split="train[:1000]", key="doc_id").unionByName(io.load(s, root, "corpus", split="train[50:100]", key="doc_id"))


def src3(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s, "saved")
    io.save_dataset(_documents(s, d), path)
    return io.read_dataset(s, path)


def src4(s: SparkSession, d: str) -> DataFrame:
    path = f"{scratch(s, 'array')}.json"
    io.write_text(s, path, io.export_catalog(table(s, d, "nation")))  # 25 rows
    return io.read_dataset(s, path).select("n_nationkey", "n_name", "n_regionkey")


def src5(s: SparkSession, d: str) -> DataFrame:
    path = f"{scratch(s, 'lines')}.jsonl"
    table(s, d, "documents").select("doc_id", "text").write.json(path)
    return io.read_dataset(s, path).select("doc_id", F.sha2("text", 256).alias("text"))


def src6(s: SparkSession, d: str) -> DataFrame:
    """The nested configuration's languages and thresholds at the documents that it selects."""
    c = io.CorpusConfig.of(NESTED)
    limits = {"deduplication": c.deduplication_threshold, "quality": c.quality_threshold, "syntax": c.syntax_threshold, "coherence": c.coherence_threshold}
    return _documents(s, d).where(F.col("lang").isin(*c.target_languages)).select("doc_id", "lang", *(F.lit(v).alias(k) for k, v in limits.items()))


def src7(s: SparkSession, d: str) -> DataFrame:
    folder = scratch(s, "phase")
    io.save_dataset(_documents(s, d), f"{folder}/first")
    table(s, d, "labels").write.json(f"{folder}/second.jsonl")
    io.write_text(s, f"{folder}/broken/notes.txt", "no dataset")
    found = io.scan_phase(s, folder)
    return s.createDataFrame([(k, v.count()) for k, v in found.items()], "name string, n long")


def src8(s: SparkSession, d: str) -> DataFrame:
    """The first of three names that exists, read: baselines are the means of the events' types."""
    folder, means = scratch(s, "baselines"), table(s, d, "events").groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("mean"))
    for name, factor in (("baseline_metrics.json", 1), ("results.json", 0)):
        io.save_dataset(means.withColumn("mean", F.col("mean") * factor), f"{folder}/{name}")
    at = io.first_existing(s, [f"{folder}/{n}" for n in ("baseline_results.json", "baseline_metrics.json", "results.json")])
    return s.read.parquet(at)


def snk2(s: SparkSession, d: str) -> DataFrame:
    path = f"{scratch(s, 'stats')}.json"
    io.write_stats(_documents(s, d).agg(F.count("*").alias("total"), F.sum("n_chars").alias("chars")), path)
    return io.read_dataset(s, path).select("total", "chars")


def snk3(s: SparkSession, d: str) -> DataFrame:
    path = f"{scratch(s, 'duplicates')}.jsonl"
    io.write_duplicates(duplicate_pairs(_keyed(s, d)), path)
    return s.read.schema("rep_id string, dup_id string").json(path)


def snk4(s: SparkSession, d: str) -> DataFrame:
    path = f"{scratch(s, 'results')}.csv"
    io.write_rows([table(s, d, "nation").select("n_nationkey", "n_name"), table(s, d, "region").select("r_regionkey")], path)
    return s.read.option("header", True).schema("n_nationkey int, n_name string, r_regionkey int").csv(path)


def _regions(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "region").select("r_regionkey", "r_name").orderBy("r_regionkey")  # 5 rows


def rpt14(s: SparkSession, d: str) -> DataFrame:
    report = io.phase_report({t: table(s, d, t) for t in ("documents", "pages")}, {"quality": 0.9}, io.CorpusConfig(), 0.0, "-")
    stats = report["processing_statistics"]
    return s.createDataFrame([(report["pipeline_summary"]["phases_completed"], stats["rows"]["documents"], stats["rows"]["pages"], stats["total_processed"])], "phases long, documents long, pages long, total long")


def queries() -> dict[str, Query]:
    return {
        "src1_dataset_split": src1,
        "src2_range_slice": src2,
        "src3_saved_dataset": src3,
        "src4_json_array": src4,
        "src5_json_lines": src5,
        "src6_nested_config": src6,
        "src7_phase_scan": src7,
        "src8_first_existing": src8,
        "snk2_stats_json": snk2,
        "snk3_duplicates_json": snk3,
        "snk4_results_csv": snk4,
        "snk5_markdown": lambda s, d: s.createDataFrame([(io.markdown_report("Regions", _regions(s, d)),)], "report string"),
        "snk6_catalog_json": lambda s, d: s.createDataFrame([(io.export_catalog(_regions(s, d)),)], "catalog string"),
        "rpt14_phase_report": rpt14,
    }


def oracle_sql() -> dict[str, str]:
    documents = "SELECT doc_id, lang, source, n_chars FROM documents"
    lf = "chr(10)"
    row = "'  {' || chr(10) || '    \"r_regionkey\": ' || r_regionkey || ',' || chr(10) || '    \"r_name\": \"' || r_name || '\"' || chr(10) || '  }'"
    return {
        "src1_dataset_split": documents,
        "src2_range_slice": f"(SELECT * FROM ({documents}) ORDER BY doc_id LIMIT 1000) UNION ALL (SELECT * FROM ({documents}) ORDER BY doc_id LIMIT 50 OFFSET 50)",
        "src3_saved_dataset": documents,
        "src4_json_array": "SELECT n_nationkey::BIGINT AS n_nationkey, n_name, n_regionkey::BIGINT AS n_regionkey FROM nation",
        "src5_json_lines": "SELECT doc_id, sha256(text) AS text FROM documents",
        "src6_nested_config": "SELECT doc_id, lang, 0.9::DOUBLE AS deduplication, 0.75::DOUBLE AS quality, 0.85::DOUBLE AS syntax, 0.6::DOUBLE AS coherence FROM documents WHERE lang IN ('en', 'fr')",
        "src7_phase_scan": "SELECT 'first' AS name, count(*) AS n FROM documents UNION ALL SELECT 'second', count(*) FROM labels",
        "src8_first_existing": "SELECT event_type, round(avg(value), 6) AS mean FROM events GROUP BY event_type",
        "snk2_stats_json": "SELECT count(*) AS total, sum(n_chars)::BIGINT AS chars FROM documents",
        "snk3_duplicates_json": f"WITH {_KEYED}, m AS (SELECT key, min(id) AS rep_id FROM k GROUP BY key) SELECT rep_id, id AS dup_id FROM k JOIN m USING (key) WHERE id <> rep_id",
        "snk4_results_csv": "SELECT n_nationkey, n_name, NULL::INT AS r_regionkey FROM nation UNION ALL SELECT NULL, NULL, r_regionkey FROM region",
        "snk5_markdown": f"SELECT '# Regions' || {lf} || {lf} || '| r_regionkey | r_name |' || {lf} || '|---|---|' || {lf} || string_agg('| ' || r_regionkey || ' | ' || r_name || ' |' || {lf}, '' ORDER BY r_regionkey) AS report FROM region",
        "snk6_catalog_json": f"SELECT '[' || {lf} || string_agg({row}, ',' || {lf} ORDER BY r_regionkey) || {lf} || ']' AS catalog FROM region",
        "rpt14_phase_report": "SELECT 2::BIGINT AS phases, d AS documents, p AS pages, d + p AS total FROM (SELECT count(*) AS d FROM documents), (SELECT count(*) AS p FROM pages)",
    }
