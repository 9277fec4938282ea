"""The registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate as _leaks
from . import importance_resampling as _importance
from . import line_dedup as _lines
from . import lm_scoring as _lm
from . import ngram_jaccard as _jaccard
from . import packing as _packing
from . import periodic_runs as _runs
from . import piece_encoding as _pieces
from . import quality_rules as _rules
from . import site_quality as _site
from . import token_counts as _counts
from . import token_file as _file
from . import toxicity as _toxicity


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _jaccard.jaccard_components(_documents(spark, sf_dir))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packing.pack_documents(_documents(spark, sf_dir))


def op3_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _file.token_files(_documents(spark, sf_dir))
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts.token_counts(_documents(spark, sf_dir))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.crc32(F.col("doc_id").cast("string")) % 3
    out = _toxicity.toxicity(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), third != 1)
    return out.select("doc_id", (third == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "evidence")


def op6_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.crc32(F.col("doc_id").cast("string")) % 3
    out = _site.site_quality(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), third != 1)
    return out.select("doc_id", (third == 1).alias("held_out"), "evidence", "host_rate", "path_rate", "score", F.col("kept").cast("int").alias("predicted"), "kept")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _lines.dedup_lines(_documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(range(len(x))) AS i, unnest(x) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS largest FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
f AS (SELECT k.*, coalesce(k.doc_id <> c.largest, false) AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lm.score_texts(_documents(spark, sf_dir), F.crc32(F.col("doc_id").cast("string")) % 10 == 0)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks.matches(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _rules.quality_rules(_documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP10_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
g AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) v(k) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM w) w LEFT JOIN cov USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS f FROM f WHERE source IS NOT NULL GROUP BY source),
p AS (SELECT sum(f) / sum(n) AS m, coalesce(var_pop(f / n), 0) AS v, avg(1 / n) AS r FROM h),
k AS (SELECT m, least(1000.0, greatest(1.0, CASE WHEN v - m * (1 - m) * r > 0 THEN m * (1 - m) / (v - m * (1 - m) * r) - 1 ELSE 1000.0 END)) AS k FROM p),
q AS (SELECT source, f + m * k AS a, n - f + (1 - m) * k AS b FROM h, k),
bad AS (SELECT source FROM q WHERE a / (a + b) - 2.0 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(source IN (SELECT source FROM bad), false) AS kept
FROM f
"""


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _importance.resample(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TABLE = "list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END))"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP11_SQL = rf"""
WITH tab AS (SELECT {_TABLE} AS t),
d AS (
  SELECT doc_id AS id, false AS target, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL SELECT item_id, true, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
f AS (SELECT id, target, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM d),
u AS (SELECT f, list_transform(range(0, length(hex(f)), 2), lambda i: ('0x' || substr(hex(f), i + 1, 2))::BIGINT) AS bytes FROM (SELECT DISTINCT f FROM f)),
k AS (SELECT f, xor(4294967295, list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 10000 AS bucket FROM u, tab),
c AS (SELECT id, target, bucket, count(*) AS n FROM f JOIN k USING (f) GROUP BY ALL),
b AS (SELECT bucket, coalesce(sum(n) FILTER (NOT target), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (target), 0)::DOUBLE AS t FROM c GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM b),
m AS (SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS total FROM c JOIN g USING (bucket) WHERE NOT target GROUP BY id),
w AS (
  SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight,
    ('0x' || substr(sha256('7:' || id), 1, 8))::BIGINT AS h
  FROM d LEFT JOIN m USING (id) WHERE NOT target),
s AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM w),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 25 * count(*) OVER () // 100 AS most FROM s WHERE n_words >= 20)
SELECT s.doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score, place AS rank FROM s LEFT JOIN r ON s.doc_id = r.doc_id AND place <= most
"""


def op12_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pieces.round_trips(_documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def _folded(docs: DataFrame) -> DataFrame:
    """The contract's texts of op13: of a tenth of the documents the words from one on repeat a few of them."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g, w = F.floor(h / 10).cast("long"), F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    n = F.size("w").cast("long")
    rows = docs.select("doc_id", "text", F.when(h % 10 == 0, w).alias("w"), g.alias("g")).withColumn("a", F.when(n > 0, F.col("g") % n))
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)).cast("long"))
    tail, left = F.slice("w", (F.col("a") + 1).cast("int"), F.col("p").cast("int")), n - F.col("a")
    again = F.slice(F.flatten(F.array_repeat(tail, F.ceil(left / F.col("p")).cast("int"))), F.lit(1), left.cast("int"))
    words = F.concat(F.slice("w", F.lit(1), F.col("a").cast("int")), again)
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _runs.find_runs(_folded(_documents(spark, sf_dir)))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    out = found.select(F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    b = {"start": -F.col("best.start"), "length": F.col("best.length"), "period": -F.col("best.period")}
    return out.select("doc_id", "n_runs", *(v.alias(k) for k, v in b.items()), F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_jaccard": op1_ngram_jaccard,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_token_file": op3_token_file,
        "op4_token_counts": op4_token_counts,
        "op5_toxicity": op5_toxicity,
        "op6_site_quality": op6_site_quality,
        "op7_line_dedup": op7_line_dedup,
        "op8_lm_scoring": op8_lm_scoring,
        "op9_decontamination": op9_decontamination,
        "op10_quality_rules": op10_quality_rules,
        "op11_importance_resampling": op11_importance_resampling,
        "op12_piece_round_trip": op12_piece_round_trip,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {"op7_line_dedup": OP7_SQL, "op10_quality_rules": OP10_SQL, "op11_importance_resampling": OP11_SQL}
