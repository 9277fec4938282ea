"""Aggregates, joins, windows, samples, set operations and reports as SQL that Spark and DuckDB
both read. Tables stand in braces: ``spark.sql`` gets them as DataFrames, so Catalyst plans the
scans (pruned columns, pushed filters) as for any DataFrame query."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import statistics as T
from ..session import table

Query = Callable[[SparkSession, str], DataFrame]

_DAILY = "daily AS (SELECT event_type, CAST(ts AS DATE) AS d, avg(value) AS v, count(*) AS n FROM {events} GROUP BY event_type, CAST(ts AS DATE))"
_STEPS = _DAILY + ", s AS (SELECT event_type, d, v, row_number() OVER (PARTITION BY event_type ORDER BY d) AS step FROM daily)"
_P = lambda x, *ps: ", ".join(f"round(percentile_cont({p}) WITHIN GROUP (ORDER BY {x}), 6) AS p{round(p * 100)}" for p in ps)
_QUALITY = "q AS (SELECT d.doc_id, d.lang, CAST(length(d.text) AS DOUBLE) AS n, CAST(l.quality AS DOUBLE) AS quality FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id)"
_LENGTHS = "x AS (SELECT doc_id, lang, CAST(length(coalesce(text, '')) AS DOUBLE) AS n FROM {documents})"

SQL: dict[str, str] = {
    # sources and filters
    "src9_warehouse_pull": "SELECT doc_id, lang, length(text) AS n FROM {documents} WHERE lang IN ('en', 'fr') AND text IS NOT NULL AND length(text) BETWEEN 100 AND 100000",
    "flt11_training_filter": "SELECT doc_id, length(text) AS n FROM {documents} WHERE length(text) BETWEEN 10 AND 32768 AND length(trim(text)) > 0",
    "flt12_distinct_text": "SELECT min(doc_id) AS doc_id, count(*) AS copies FROM {documents} GROUP BY sha256(text)",
    "flt14_catalog_filter": "SELECT p_partkey, p_brand, p_size FROM {part} WHERE p_size <= 10 AND p_brand LIKE 'Brand#1%'",
    "flt15_retention": "SELECT o_orderkey, o_orderstatus FROM {orders} WHERE o_orderdate >= (SELECT max(o_orderdate) FROM {orders}) - INTERVAL '30' DAY",
    # projections
    "prj10_framework": "SELECT page_id, CASE WHEN contains(html, 'useState') OR contains(html, 'react') THEN 'react' WHEN contains(html, 'v-if') OR contains(html, 'vue') THEN 'vue' WHEN contains(html, 'ngIf') OR contains(html, 'angular') THEN 'angular' WHEN contains(html, '<?xml') OR contains(html, 'xmlns') THEN 'xml' ELSE 'none' END AS framework FROM {pages}",
    "prj14_language_wrap": "SELECT doc_id, concat('<', lang, '>', text, '</', lang, '>') AS wrapped FROM {documents}",
    "prj18_preview": "SELECT doc_id, CASE WHEN length(text) > 100 THEN concat(substr(text, 1, 100), '...') ELSE text END AS preview FROM {documents}",
    "prj20_extension": "SELECT o_orderkey, concat('file_', CAST(o_orderkey AS STRING), CASE o_orderkey % 5 WHEN 0 THEN '.js' WHEN 1 THEN '.ts' WHEN 2 THEN '.xml' WHEN 3 THEN '.html' ELSE '.css' END) AS file_path FROM {orders}",
    "prj23_mcq_category": "SELECT item_id, CASE WHEN contains(t, 'function') OR contains(t, 'class') OR contains(t, 'method') OR contains(t, 'object') THEN 'oop' WHEN contains(t, 'algorithm') OR contains(t, 'complexity') OR contains(t, 'sorting') OR contains(t, 'search') THEN 'algorithms' "
    "WHEN contains(t, 'data structure') OR contains(t, 'array') OR contains(t, 'list') OR contains(t, 'tree') THEN 'data_structures' WHEN contains(t, 'python') OR contains(t, 'javascript') OR contains(t, 'java') OR contains(t, 'code') THEN 'programming_languages' ELSE 'general' END AS category "
    "FROM (SELECT item_id, lower(concat(text, CASE item_id % 4 WHEN 0 THEN ' class' WHEN 1 THEN ' sorting' WHEN 2 THEN ' tree' ELSE '' END)) AS t FROM {benchmark}) x",
    # aggregates
    "agg1_counts": "SELECT lang, source, count(*) AS n FROM {documents} GROUP BY lang, source",
    "agg2_share": "SELECT lang, n, round(100.0 * n / sum(n) OVER (), 6) AS share FROM (SELECT lang, count(*) AS n FROM {documents} GROUP BY lang) x",
    "agg3_size": "SELECT coalesce(min(n_chars), 0) AS least, coalesce(max(n_chars), 0) AS most, round(coalesce(avg(n_chars), 0), 6) AS mean, round(coalesce(median(n_chars), 0), 6) AS median FROM {documents}",
    "agg4_length_stats": f"WITH {_LENGTHS} SELECT round(avg(n), 6) AS mean, round(median(n), 6) AS median, round(stddev_pop(n), 6) AS std, min(n) AS least, max(n) AS most, {_P('n', 0.25, 0.75)} FROM x",
    "agg5_quality_stats": f"WITH {_QUALITY} SELECT round(avg(quality), 6) AS mean, round(stddev_pop(quality), 6) AS std, round(var_pop(quality), 6) AS variance, round(1 - stddev_pop(quality) / nullif(avg(quality), 0), 6) AS consistency FROM q",
    "agg6_by_language": f"WITH {_QUALITY} SELECT lang, count(*) AS n, round(avg(quality), 6) AS mean, round(stddev_pop(quality), 6) AS std, min(quality) AS least, max(quality) AS most FROM q GROUP BY lang",
    "agg8_iqr_outliers": f"WITH {_LENGTHS}, b AS (SELECT percentile_cont(0.25) WITHIN GROUP (ORDER BY n) AS q1, percentile_cont(0.75) WITHIN GROUP (ORDER BY n) AS q3 FROM x), "
    "c AS (SELECT q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high, q3 - q1 AS iqr FROM b) SELECT round(max(low), 6) AS lower_bound, round(max(high), 6) AS upper_bound, round(max(iqr), 6) AS iqr, "
    "count(CASE WHEN n < low OR n > high THEN 1 END) AS outliers, round(avg(CASE WHEN n < low OR n > high THEN 1.0 ELSE 0.0 END), 6) AS share FROM x CROSS JOIN c",
    "agg9_shape": f"WITH {_LENGTHS}, b AS (SELECT avg(n) AS m, median(n) AS md, stddev_pop(n) AS s FROM x), k AS (SELECT m, s, CASE WHEN s > 0 THEN (m - md) / s ELSE 0 END AS skew FROM b) "
    "SELECT round(skew, 6) AS skewness, CASE WHEN abs(skew) < 0.5 THEN 'approximately_normal' WHEN skew > 0.5 THEN 'right_skewed' ELSE 'left_skewed' END AS shape, round(CASE WHEN m > 0 THEN s / m ELSE 0 END, 6) AS variation FROM k",
    "agg10_histogram": f"WITH {_LENGTHS}, b AS (SELECT CASE WHEN max(n) > min(n) THEN min(n) ELSE min(n) - 0.5 END AS lo, CASE WHEN max(n) > min(n) THEN (max(n) - min(n)) / 10 ELSE 0.1 END AS w FROM x), "
    "h AS (SELECT CAST(least(floor((n - lo) / w), 9) AS INT) AS bin, count(*) AS n FROM x CROSS JOIN b GROUP BY CAST(least(floor((n - lo) / w), 9) AS INT)), "
    "k AS (SELECT * FROM (VALUES (0), (1), (2), (3), (4), (5), (6), (7), (8), (9)) AS v(bin)) SELECT k.bin, coalesce(h.n, 0) AS n, round(lo + k.bin * w, 6) AS low FROM k CROSS JOIN b LEFT JOIN h ON k.bin = h.bin",
    "agg11_cosine": "WITH a AS (SELECT lang, CAST(count(*) AS DOUBLE) AS n FROM {documents} GROUP BY lang), b AS (SELECT lang, n / sum(n) OVER () AS share FROM a), t AS (SELECT * FROM (VALUES ('en', 0.4), ('fr', 0.3), ('it', 0.3)) AS v(lang, share)) "
    "SELECT round(sum(coalesce(b.share, 0) * coalesce(t.share, 0)) / (sqrt(sum(coalesce(b.share, 0) * coalesce(b.share, 0))) * sqrt(sum(coalesce(t.share, 0) * coalesce(t.share, 0)))), 6) AS cosine FROM b FULL OUTER JOIN t ON b.lang = t.lang",
    "agg13_bands": "WITH s AS (SELECT lang, CAST(count(*) AS DOUBLE) AS n FROM {documents} GROUP BY lang), x AS (SELECT lang, n / sum(n) OVER () AS share FROM s) SELECT b.lang, round(coalesce(x.share, 0), 6) AS share, coalesce(x.share, 0) BETWEEN low AND high AS within "
    "FROM (VALUES ('en', 0.3, 0.7), ('fr', 0.2, 0.3), ('de', 0.1, 0.2), ('it', 0.1, 0.2)) AS b(lang, low, high) LEFT JOIN x ON b.lang = x.lang",
    "agg14_completion_sets": "WITH t AS (SELECT role, CASE WHEN turn < 2 THEN 'early' ELSE 'late' END AS difficulty, CASE WHEN length(coalesce(text, '')) >= 100 THEN 1.0 ELSE 0.0 END AS done FROM {conversations}) "
    "SELECT coalesce(role, 'all') AS role, coalesce(difficulty, 'all') AS difficulty, count(*) AS n, round(avg(done), 6) AS rate FROM t GROUP BY GROUPING SETS ((), (role), (difficulty))",
    "agg16_concepts": "SELECT round((avg(CASE WHEN contains(t, 'variable') OR contains(t, 'let ') OR contains(t, 'const ') THEN 1.0 ELSE 0.0 END) + avg(CASE WHEN contains(t, 'function') THEN 1.0 ELSE 0.0 END) + avg(CASE WHEN contains(t, 'class') THEN 1.0 ELSE 0.0 END) "
    "+ avg(CASE WHEN contains(t, 'if') OR contains(t, 'for') OR contains(t, 'while') THEN 1.0 ELSE 0.0 END) + avg(CASE WHEN contains(t, 'array') OR contains(t, 'object') OR contains(t, 'list') THEN 1.0 ELSE 0.0 END)) / 5, 6) AS coverage FROM (SELECT lower(html) AS t FROM {pages}) x",
    "agg25_category_means": "SELECT round(avg(m), 6) AS overall FROM (SELECT event_type, avg(value) AS m FROM {events} GROUP BY event_type) x",
    "agg26_latency": f"SELECT event_type, round(avg(value), 6) AS mean, {_P('value', 0.95)}, round(1000.0 / nullif(avg(value), 0), 6) AS throughput FROM {{events}} GROUP BY event_type",
    "agg27_distribution": f"SELECT event_type, round(avg(value), 6) AS mean, round(median(value), 6) AS median, {_P('value', 0.95, 0.99)}, round(min(value), 6) AS least, round(max(value), 6) AS most, round(stddev_samp(value), 6) AS std FROM {{events}} GROUP BY event_type",
    "agg28_metric_stats": f"SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, {_P('value', 0.5, 0.9, 0.95, 0.99)} FROM {{events}} GROUP BY event_type",
    "agg32_modal_share": "SELECT user_id, round(max(n) * 1.0 / sum(n), 6) AS share FROM (SELECT user_id, event_type, count(*) AS n FROM {events} GROUP BY user_id, event_type) x GROUP BY user_id",
    "agg33_summary": f"WITH {_LENGTHS} SELECT count(*) AS n, count(DISTINCT lang) AS languages, round(avg(n), 6) AS mean, round(stddev_pop(n), 6) AS std FROM x",
    "agg34_validity_breakdown": "SELECT lang, count(*) AS valid, count(CASE WHEN length(replace(text, '(', '')) <> length(replace(text, ')', '')) THEN 1 END) AS invalid FROM {documents} GROUP BY lang",
    # joins
    "jon7_config_lookup": "SELECT d.doc_id, c.least, length(d.text) BETWEEN c.least AND c.most AS fits FROM {documents} d JOIN (VALUES ('en', 50, 5000), ('fr', 100, 2000), ('de', 30, 9000)) AS c(lang, least, most) ON d.lang = c.lang",
    "jon4_missing_languages": "SELECT t.lang FROM (VALUES ('en'), ('it'), ('pt'), ('fr')) AS t(lang) LEFT ANTI JOIN {documents} d ON t.lang = d.lang",
    "jon9_target_gap": "WITH a AS (SELECT event_type, avg(value) AS v FROM {events} GROUP BY event_type) SELECT t.metric, round(a.v, 6) AS actual, t.target, round(a.v - t.target, 6) AS gap, coalesce(a.v >= t.target, false) AS achieved FROM (VALUES ('click', 50.0), ('view', 10.0), ('nothing', 1.0)) AS t(metric, target) LEFT JOIN a ON t.metric = a.event_type",
    # windows
    "win1_first_in_group": "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS k FROM {documents}) x WHERE k = 1",
    "win3_last_n": "SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM {events}) x WHERE k <= 3",
    "win4_patience": f"WITH {_STEPS}, b AS (SELECT event_type, step, v, min(v) OVER (PARTITION BY event_type ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM s), i AS (SELECT event_type, step, count(CASE WHEN best IS NULL OR v < best THEN 1 END) OVER (PARTITION BY event_type ORDER BY step) AS island FROM b) "
    "SELECT event_type, step, row_number() OVER (PARTITION BY event_type, island ORDER BY step) - 1 AS bad_steps FROM i",
    "win5_degradation": f"WITH {_STEPS}, b AS (SELECT event_type, step, CASE WHEN v < lag(v) OVER (PARTITION BY event_type ORDER BY step) THEN 1 ELSE 0 END AS worse FROM s), i AS (SELECT event_type, step, worse, sum(1 - worse) OVER (PARTITION BY event_type ORDER BY step) AS island FROM b) "
    "SELECT event_type, step, CAST(sum(worse) OVER (PARTITION BY event_type, island ORDER BY step) AS BIGINT) AS in_a_row FROM i",
    "win6_moving": f"WITH {_STEPS} SELECT event_type, step, round(avg(v) OVER w, 6) AS moving_mean, round(var_pop(v) OVER w, 5) AS moving_variance FROM s WINDOW w AS (PARTITION BY event_type ORDER BY step ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)",
    "win8_scaling": f"WITH {_STEPS} SELECT event_type, step, round(v / nullif(first_value(v) OVER (PARTITION BY event_type ORDER BY step), 0), 6) AS scaling, round(v - lag(v) OVER (PARTITION BY event_type ORDER BY step), 6) AS marginal, coalesce(v < 0.8 * lag(v) OVER (PARTITION BY event_type ORDER BY step), false) AS diminishing FROM s",
    "win9_best": f"WITH {_STEPS} SELECT event_type, min_by(step, v) AS least_step, max_by(step, v) AS most_step, round(min(v), 6) AS least, round(max(v), 6) AS most FROM s GROUP BY event_type",
    # sorts, samples, splits
    "srt1_by_time": "SELECT event_id, user_id, event_type, ts FROM {events} ORDER BY ts, event_id",
    "srt3_keep_newest": "SELECT o_custkey, o_orderkey, k <= 3 AS kept FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM {orders}) x",
    "srt5_head": "SELECT o_orderkey FROM {orders} ORDER BY o_orderkey LIMIT 1000",
    "srt6_hash_sample": "SELECT doc_id FROM {documents} ORDER BY md5(concat(CAST(doc_id AS STRING), ':42')), doc_id LIMIT 100",
    "srt7_hash_split": "SELECT doc_id, CASE WHEN substr(h, 1, 2) < 'e6' THEN 'train' WHEN substr(h, 1, 2) < 'f3' THEN 'validation' ELSE 'test' END AS split FROM (SELECT doc_id, md5(concat(CAST(doc_id AS STRING), ':split')) AS h FROM {documents}) x",
    "srt9_optimal": "SELECT max_by(user_id, m) AS user_id, round(max(m), 6) AS best FROM (SELECT user_id, avg(value) AS m FROM {events} GROUP BY user_id) x",
    # sets
    "set1_union": "SELECT doc_id AS id, lang, text AS content FROM {documents} WHERE lang = 'en' UNION ALL SELECT doc_id, lang, text FROM {documents} WHERE lang = 'fr' UNION ALL SELECT page_id, NULL, html FROM {pages}",
    "set4_except": "SELECT source FROM {documents} WHERE lang = 'en' EXCEPT SELECT source FROM {documents} WHERE lang = 'es'",
    "set4_except_lengths": "SELECT n_chars FROM {documents} WHERE lang = 'en' EXCEPT SELECT n_chars FROM {documents} WHERE lang <> 'en'",
    "set6_intersect_lengths": "SELECT n_chars FROM {documents} WHERE lang = 'en' INTERSECT SELECT n_chars FROM {documents} WHERE lang <> 'en'",
    "set6_intersect": "SELECT sha256(text) AS text FROM {documents} WHERE lang = 'en' INTERSECT SELECT sha256(text) FROM {documents} WHERE lang <> 'en'",
    "set5_distinct": "SELECT DISTINCT lang, source FROM {documents}",
    # scalars and reports
    "sco39_perplexity": f"WITH {_STEPS} SELECT event_type, step, round(exp(least(v / 100, 20)), 6) AS perplexity FROM s",
    "sco40_checksum": "SELECT doc_id, sha256(text) AS checksum FROM {documents}",
    "rpt6_summary_scores": "SELECT event_type, round(greatest(0, 100 - avg(value) / 10) / 100, 6) AS performance_score FROM {events} GROUP BY event_type",
    "rpt11_source_report": "WITH c AS (SELECT lang, CAST(count(*) AS DOUBLE) AS n FROM {documents} GROUP BY lang), s AS (SELECT lang, n / sum(n) OVER () AS share FROM c) SELECT t.lang, round(coalesce(s.share, 0), 6) AS share, CASE WHEN s.share IS NULL THEN 'missing' WHEN s.share < 0.01 THEN 'low' ELSE 'ok' END AS verdict FROM (VALUES ('en'), ('fr'), ('de'), ('es'), ('it')) AS t(lang) LEFT JOIN s ON t.lang = s.lang",
    "rpt15_scaling_efficiency": f"WITH {_STEPS} SELECT event_type, round(max(CASE WHEN step = 1 THEN v END) / nullif(max_by(v, step), 0), 6) AS ratio FROM s GROUP BY event_type",
}

#: Where the engines spell a function or a join in different ways: Spark's to DuckDB's.
TO_DUCK = {"LEFT ANTI JOIN": "ANTI JOIN", "AS STRING": "AS VARCHAR"}


def _spark_text(sql: str) -> str:
    # numbers with a point are doubles here, as they are after DuckDB's arithmetic
    parts = [x if k % 2 else re.sub(r"(?<![\w.])(\d+\.\d+)(?![\w.])", r"\1D", x) for k, x in enumerate(sql.split("'"))]
    sql = "'".join(parts)
    return re.sub(r"sha256\((\w+)\)", r"sha2(\1, 256)", sql)


def _duck_text(sql: str) -> str:
    parts = [x if k % 2 else re.sub(r"(?<![\w.])(\d+\.\d+)(?![\w.])", r"\1::DOUBLE", x) for k, x in enumerate(sql.split("'"))]
    sql = "'".join(parts)
    for a, b in TO_DUCK.items():
        sql = sql.replace(a, b)
    return re.sub(r"(?<!\{)\{(\w+)\}(?!\})", r"\1", sql).replace("{{", "{").replace("}}", "}")


#: Counts and places that Spark gives as INT and DuckDB as BIGINT; all are BIGINT here.
WIDE = {"n", "difference", "bad_steps", "step", "least_step", "most_step", "position"}


def _widened(df: DataFrame) -> DataFrame:
    return df.select(*(df[c].cast("long").alias(c) if kind == "int" and c in WIDE else df[c] for c, kind in df.dtypes))


def _query(sql: str) -> Query:
    names = sorted(set(re.findall(r"(?<!\{)\{(\w+)\}(?!\})", sql)))
    return lambda spark, sf_dir: _widened(spark.sql(_spark_text(sql), **{n: table(spark, sf_dir, n) for n in names}))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.length(F.coalesce("text", F.lit(""))).cast("double").alias("n"))


def _latency(ps: list[float], *columns: str) -> Query:
    return lambda s, d: T.rounded(T.described(table(s, d, "events"), ["event_type"], "value", ps).selectExpr("event_type", *columns))


def agg3(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = T.described(table(spark, sf_dir, "documents"), [], "n_chars")
    whole = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return d.select(whole("least").cast("long").alias("least"), whole("most").cast("long").alias("most"), F.round(whole("mean"), 6).alias("mean"), F.round(whole("p50"), 6).alias("median"))


def agg4(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = T.described(_texts(spark, sf_dir), [], "n", [0.5, 0.25, 0.75])
    return T.rounded(d.select("mean", F.col("p50").alias("median"), "std", "least", "most", "p25", "p75"))


#: Statistics with quantiles: operators on the main path, the SQL above is their oracle.
OPERATORS: dict[str, Query] = {
    "agg3_size": agg3,
    "agg4_length_stats": agg4,
    "agg8_iqr_outliers": lambda s, d: T.rounded(T.outliers(_texts(s, d), "n")),
    "agg9_shape": lambda s, d: T.rounded(T.shape(_texts(s, d), "n")),
    "agg26_latency": _latency([0.95], "mean", "p95", "try_divide(1000D, mean) AS throughput"),
    "agg27_distribution": _latency([0.5, 0.95, 0.99], "mean", "p50 AS median", "p95", "p99", "least", "most", "std_samp AS std"),
    "agg28_metric_stats": _latency([0.5, 0.9, 0.95, 0.99], "n", "mean", "std", "p50", "p90", "p95", "p99"),
}


def queries() -> dict[str, Query]:
    return {k: _query(v) for k, v in SQL.items()} | OPERATORS


def oracle_sql() -> dict[str, str]:
    return {k: _duck_text(v) for k, v in SQL.items()}
