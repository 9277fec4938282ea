"""Queries of deduplication, the funnel, parsers, generators and streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup, digests, folds, funnel, generate, vectors
from ..functions import tables
from ..session import table
from ..streaming import metrics
from . import content as K
from . import duck as D
from .inputs import CONTENTS, PAIRS, contents, pairs

Query = Callable[[SparkSession, str], DataFrame]


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.keyed(contents(spark, sf_dir), dedup.aggressive_key(F.col("content"))).withColumn("id", F.concat_ws("-", "src", F.lpad(F.col("id").cast("string"), 12, "0")))


_ID = "concat_ws('-', src, lpad(id::VARCHAR, 12, '0'))"


def _key(x: str) -> str:
    x = f"regexp_replace({x}, '(?m)//.*$', '', 'g')"
    x = f"regexp_replace({x}, {D.q(r'(?s)/\*.*?\*/')}, '', 'g')"
    x = f"regexp_replace({x}, {D.q(D.SPACE + '+')}, ' ', 'g')"
    x = f"regexp_replace({x}, {D.q(chr(91) + chr(34) + chr(39) + '`][^' + chr(34) + chr(39) + ']*[' + chr(34) + chr(39) + '`]')}, {D.q(chr(34) + 'string' + chr(34))}, 'g')"
    x = f"regexp_replace({x}, {D.q(r'([\p{L}\p{N}_]+)')}, chr(1) || '\\1' || chr(2), 'g')"  # RE2 has no look-around: tokens get marks
    x = f"regexp_replace({x}, {D.q(r'\x01([0-9]+|[a-zA-Z_][a-zA-Z0-9_]*)\x02')}, 'identifier', 'g')"
    return D.strip(f"lower(replace(replace({x}, chr(1), ''), chr(2), ''))")


_KEYED = f"{CONTENTS}, k AS (SELECT {_ID} AS id, content, sha256({_key('content')}) AS key FROM c)"


def prj8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contents(spark, sf_dir).select("src", "id", F.sha2(generate.cat_clean(F.col("content")), 256).alias("cleaned"))


def _cat() -> str:
    x = "content"
    for p in generate.REMOVED:
        x = f"regexp_replace({x}, {D.q(p)}, '', 'g')"
    for p, r in generate.REWRITTEN:
        x = f"regexp_replace({x}, {D.q(p)}, {D.q(r.replace('$1', chr(92) + '1'))}, 'g')"
    return D.strip(x)


def prj15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", *(x.alias(n) for n, x in generate.truncated(F.coalesce("text", F.lit("")), 64).items()))


PRJ15 = """WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda x: x <> '')[1:64] AS w FROM documents)
SELECT doc_id, array_to_string(list_concat(w, list_transform(range(64 - len(w)), lambda i: '<pad>')), ' ') AS tokens, array_to_string(list_concat(list_transform(w, lambda x: '1'), list_transform(range(64 - len(w)), lambda i: '0')), '') AS mask FROM w"""


def prj16(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("question"), F.transform(F.split("text", " "), lambda w: w).alias("w"))
    rows = rows.withColumn("choices", F.slice("w", 1, 4))
    return rows.select("item_id", generate.mcq_prompt(F.col("question"), F.col("choices")).alias("prompt"), generate.answer_letter(F.col("question")).alias("letter"))


PRJ16 = """WITH b AS (SELECT item_id, text AS question, string_split(text, ' ')[1:4] AS c FROM benchmark)
SELECT item_id, question || chr(10) || array_to_string(list_transform(c, lambda x, i: '(' || chr((64 + i)::INT) || ') ' || x), chr(10)) || chr(10) || 'Answer:' AS prompt, nullif(upper(regexp_extract(question, '[A-Da-d]', 0)), '') AS letter FROM b"""


def prj9_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each pair of turns as comment and code, whole, in the reference's tasks."""
    q = pairs(spark, sf_dir).select("conv_id", "turn", F.col("instruction").alias("comment"), F.col("output").alias("code"))
    task = lambda name, x, y: F.struct(F.lit(name).alias("task_type"), F.col(x).alias("input"), F.col(y).alias("target"))
    explained = F.when(F.length("comment") > 100, task("code_explanation", "code", "comment"))
    tasks = F.array_compact(F.array(task("comment_to_code", "comment", "code"), task("code_to_comment", "code", "comment"), explained))
    return q.select("conv_id", "turn", F.explode(tasks).alias("t")).select("conv_id", "turn", "t.*")


def sco28(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).select("conv_id", "turn", generate.repetitive(F.col("instruction")).alias("repetitive"))


SCO28 = f"""WITH {PAIRS}, w AS (SELECT conv_id, turn, instruction AS t, {D.words('instruction')} AS w FROM q),
r AS (SELECT conv_id, turn, t, unnest(list_transform(range(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM w WHERE len(w) >= 10),
f AS (SELECT DISTINCT conv_id, turn FROM r WHERE (length(t) - length(replace(t, s, ''))) // length(s) > 2)
SELECT w.conv_id, w.turn, f.conv_id IS NOT NULL AS repetitive FROM w LEFT JOIN f ON w.conv_id = f.conv_id AND w.turn = f.turn"""


def win7(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = table(spark, sf_dir, "events").groupBy("event_type", F.col("ts").cast("date").alias("d")).agg(F.avg("value").alias("v"))
    return generate.plateau_rate(daily, "event_type", "d", "v")


DUP5 = """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
n AS (SELECT a.vec_id AS query_id, b.vec_id, round(list_cosine_similarity(a.e, b.e), 6) AS cosine FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0)
SELECT query_id, cosine, vec_id FROM n QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, vec_id) = 1"""

#: Queries that are sent to the workers at a time.
QUERIES = 4096


def dup5_all(spark: SparkSession, sf_dir: str, at_a_time: int = QUERIES) -> DataFrame:
    """The nearest of all vectors to each query (ids divisible by 100), under any label."""
    v = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vectors.nearest(v, v.where("vec_id % 100 = 0"), at_a_time=at_a_time)


#: All pairs that share a run of five words, exactly verified, and what can be reached over them.
VERIFIED = """WITH RECURSIVE w AS (SELECT doc_id AS doc, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\\s+'), lambda x: x <> '') AS w FROM documents),
r AS (SELECT doc, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS g FROM w),
z AS (SELECT doc, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS same FROM r GROUP BY doc),
c AS (SELECT same, min(doc) AS node, count(*) AS copies, any_value(n) AS n FROM z GROUP BY same),
h AS (SELECT doc, hash(g) AS g FROM r WHERE doc IN (SELECT node FROM c)),
p AS (SELECT a.doc AS u, b.doc AS v, count(*) AS shared FROM h a JOIN h b ON a.g = b.g AND a.doc <> b.doc GROUP BY a.doc, b.doc),
l AS (SELECT u, v FROM p JOIN c x ON x.node = u JOIN c y ON y.node = v WHERE shared >= 0.8 * (x.n + y.n - shared)),
t AS (SELECT node AS a, node AS b FROM c UNION SELECT t.a, l.v FROM t JOIN l ON l.u = t.b),
f AS (SELECT a AS node, min(b) AS first FROM t GROUP BY a)
SELECT d.doc_id AS doc, coalesce(f.first, d.doc_id) AS first, coalesce(c.copies, 1) AS copies FROM documents d LEFT JOIN z ON z.doc = d.doc_id LEFT JOIN c USING (same) LEFT JOIN f ON f.node = c.node"""


def dup1_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All links of a similarity of 0.8; this query alone of these needs the language-model operators."""
    from ..llm import ngram_jaccard

    return ngram_jaccard.jaccard_groups(table(spark, sf_dir, "documents"))


def dup5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors, and of each fourth a near copy (a fifth of its mirror image added)."""
    v = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
    near = F.zip_with("embedding", F.reverse("embedding"), lambda x, y: x + 0.2 * y)
    return vectors.groups(v.unionByName(v.where("vec_id % 4 = 0").select((F.col("vec_id") + 1_000_000_000).alias("vec_id"), near.alias("embedding"))))


DUP5_GROUPS = """WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
v AS (SELECT * FROM e UNION ALL SELECT vec_id + 1000000000, list_transform(e, lambda x, i: x + 0.2 * e[len(e) + 1 - i]) FROM e WHERE vec_id % 4 = 0),
l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
t AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT t.a, l.v FROM t JOIN l ON l.u = t.b),
f AS (SELECT a AS doc, min(b) AS first FROM t GROUP BY a), c AS (SELECT e, count(*) AS copies FROM v GROUP BY e)
SELECT doc, first, copies FROM f JOIN v ON vec_id = doc JOIN c USING (e)"""

def win4_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = folds.patience(table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value"), "event_type", ["ts", "event_id"], "value", delta=0.05)
    return out.select("own.event_id", "own.event_type", F.round("best", 6).alias("best"), "bad")


WIN4 = """WITH RECURSIVE s AS (SELECT event_id, event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS k FROM events),
f AS (SELECT event_id, event_type, k, value AS best, 0::BIGINT AS bad FROM s WHERE k = 1
  UNION ALL SELECT s.event_id, s.event_type, s.k, CASE WHEN s.value < f.best - 0.05::DOUBLE THEN s.value ELSE f.best END, CASE WHEN s.value < f.best - 0.05::DOUBLE THEN 0 ELSE f.bad + 1 END FROM f JOIN s ON s.event_type = f.event_type AND s.k = f.k + 1)
SELECT event_id, event_type, round(best, 6) AS best, bad FROM f"""


def win5_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = folds.in_a_row(table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value"), "event_type", ["ts", "event_id"], "value", share=0.15)
    return out.select("own.event_id", "own.event_type", "bad")


WIN5 = """WITH l AS (SELECT event_id, event_type, ts, value, lag(value) OVER w AS before FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),
x AS (SELECT *, coalesce(before <> 0 AND (before - value) / before > 0.15::DOUBLE, false)::INT AS worse FROM l),
i AS (SELECT *, sum(1 - worse) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM x)
SELECT event_id, event_type, (sum(worse) OVER (PARTITION BY event_type, island ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS bad FROM i"""


def sco40_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("file", F.concat(F.lit("doc_"), F.lpad(F.col("doc_id").cast("string"), 12, "0"), F.lit(".txt")))
    return digests.folder_digests(docs, "source", "file", "text")


def prj9_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ9 by a table function, joined laterally in SQL."""
    tables.register(spark)
    return spark.sql("SELECT q.conv_id, q.turn, t.* FROM {q} q, LATERAL cat_tasks(q.instruction, q.output) t", q=pairs(spark, sf_dir))


def flt_user_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's predicate over Arrow batches: documents of more than a hundred words, most of them short."""
    import pyarrow.compute as pc

    def plain(text, lang):
        n = pc.list_value_length(pc.utf8_split_whitespace(pc.fill_null(text, "")))
        return pc.and_(pc.greater(n, 100), pc.not_equal(lang, "de"))

    return tables.keep(table(spark, sf_dir, "documents"), plain, "text", "lang").select("doc_id", "lang")


_FUNNEL = f"""WITH {CONTENTS}, {K._FOUND},
g AS (SELECT content, {{bank}} AS l, round({K._quality()}, 9) >= 0.7 AS q, round({K._syntax(True)}, 9) >= 0.8 AS s, round({K._coherence()}, 9) >= 0.6 AS c FROM f),
k AS (SELECT *, CASE WHEN l AND q AND s AND c THEN sha256({_key('content')}) END AS key FROM g)
SELECT count(*) AS total, count_if(NOT l)::BIGINT AS language_filtered, count_if(l AND NOT q)::BIGINT AS quality_filtered, count_if(l AND q AND NOT s)::BIGINT AS syntax_filtered,
  count_if(l AND q AND s AND NOT c)::BIGINT AS coherence_filtered, count(key) - count(DISTINCT key) AS duplicates, count(DISTINCT key) AS kept, round(count(DISTINCT key)::DOUBLE / count(*), 6) AS efficiency FROM k"""


def _stream(function: Callable[[DataFrame], DataFrame], mode: str = "complete") -> Query:
    return lambda spark, sf_dir: metrics.replay(spark, f"{sf_dir}/events.parquet", function, mode)


def stream_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n")).select("event_type", F.lit(60.0).alias("target"))
    return metrics.replay(spark, f"{sf_dir}/events.parquet", lambda e: metrics.with_static(e, targets), "append")


def queries() -> dict[str, Query]:
    return {
        "prj5_dedup_key": lambda s, d: _keyed(s, d).select("id", "key"),
        "prj6_light_key": lambda s, d: contents(s, d).select("src", "id", F.sha2(dedup.light_key(F.col("content"), F.col("language")), 256).alias("key")),
        "prj8_cat_clean": prj8,
        "prj9_cat_transform": prj9_whole,
        "prj15_truncate_pad": prj15,
        "prj16_mcq_prompt": prj16,
        "dup1_keep_first": lambda s, d: dedup.keep_first(_keyed(s, d)).select("id", "copies"),
        "dup1_verified_groups": dup1_verified,
        "dup3_groups": lambda s, d: dedup.duplicate_pairs(_keyed(s, d)),
        "dup5_embedding_neighbors": dup5_all,
        "dup5_semantic_groups": dup5_groups,
        "win4_patience_threshold": win4_threshold,
        "win5_degradation_threshold": win5_threshold,
        "sco40_folder_digest": sco40_folder,
        "prj9_table_function": prj9_table_function,
        "flt_user_predicate": flt_user_predicate,
        "agg7_funnel": lambda s, d: funnel.funnel(contents(s, d)),
        "agg7_funnel_corrected": lambda s, d: funnel.funnel(contents(s, d), corrected=True),
        "sco28_repetition": sco28,
        "win7_plateau_lr": win7,
        "gen1_templates": lambda s, d: generate.templated(table(s, d, "documents").select(F.col("doc_id").alias("id"))),
        "gen7_stats": lambda s, d: generate.templated(table(s, d, "documents").select(F.col("doc_id").alias("id"))).groupBy("difficulty", "language").agg(F.count("*").alias("n")),
        "flt9_hash_bernoulli": lambda s, d: table(s, d, "documents").select("doc_id", (generate.draw(F.col("doc_id"), "unit") < 0.75).alias("passed")),
        "srt8_weighted_choice": lambda s, d: table(s, d, "documents").select("doc_id", generate.weighted(generate.draw(F.col("doc_id"), "pick"), {"easy": 0.3, "medium": 0.5, "hard": 0.2}).alias("choice")),
        "stream_tumbling": _stream(metrics.tumbling),
        "stream_sliding": _stream(metrics.sliding),
        "stream_session": _stream(metrics.sessions),
        "stream_dedup_watermark": _stream(metrics.deduplicated, "append"),
        "stream_static_join": stream_static,
    }


_DIFFICULTY = D.case((f"{D.draw('i::VARCHAR', D.q(':difficulty'))} < 0.3", "'beginner'"), (f"{D.draw('i::VARCHAR', D.q(':difficulty'))} < 0.8", "'intermediate'"), other="'advanced'")
_LANG = D.case((f"{D.draw('i::VARCHAR', D.q(':language'))} < 0.6", "'javascript'"), (f"{D.draw('i::VARCHAR', D.q(':language'))} < 0.9", "'typescript'"), other="'css'")
_GEN = f"g AS (SELECT i AS id, {_DIFFICULTY} AS difficulty, {_LANG} AS language FROM (SELECT doc_id AS i FROM documents) r)"


def oracle_sql() -> dict[str, str]:
    return {
        "prj5_dedup_key": f"WITH {_KEYED} SELECT id, key FROM k",
        "prj6_light_key": f"WITH {CONTENTS}, n AS (SELECT *, regexp_replace(content, {D.q(D.SPACE + '+')}, ' ', 'g') AS x FROM c) SELECT src, id, sha256({D.strip('lower(CASE WHEN contains(lower(language), ' + D.q('javascript') + ') OR contains(lower(language), ' + D.q('typescript') + ') THEN regexp_replace(regexp_replace(x, ' + D.q('//.*$') + ', ' + D.q('') + ', ' + D.q('g') + '), ' + D.q(r'(?s)/\*.*?\*/') + ', ' + D.q('') + ', ' + D.q('g') + ') ELSE x END)')}) AS key FROM n",
        "prj8_cat_clean": f"WITH {CONTENTS} SELECT src, id, sha256({_cat()}) AS cleaned FROM c",
        "prj9_cat_transform": f"""WITH {PAIRS} SELECT conv_id, turn, 'comment_to_code' AS task_type, instruction AS input, output AS target FROM q
UNION ALL SELECT conv_id, turn, 'code_to_comment', output, instruction FROM q UNION ALL SELECT conv_id, turn, 'code_explanation', output, instruction FROM q WHERE length(instruction) > 100""",
        "prj15_truncate_pad": PRJ15,
        "prj16_mcq_prompt": PRJ16,
        "dup1_keep_first": f"WITH {_KEYED} SELECT min(id) AS id, count(*) AS copies FROM k GROUP BY key",
        "dup1_verified_groups": VERIFIED,
        "dup3_groups": f"WITH {_KEYED}, m AS (SELECT key, min(id) AS rep_id FROM k GROUP BY key) SELECT rep_id, id AS dup_id FROM k JOIN m USING (key) WHERE id <> rep_id",
        "dup5_embedding_neighbors": DUP5,
        "dup5_semantic_groups": DUP5_GROUPS,
        "win4_patience_threshold": WIN4,
        "win5_degradation_threshold": WIN5,
        "sco40_folder_digest": "SELECT source AS folder, count(*) AS files, sha256(string_agg('doc_' || lpad(doc_id::VARCHAR, 12, '0') || '.txt:' || sha256(coalesce(text, '')), chr(10) ORDER BY doc_id)) AS checksum FROM documents WHERE source IS NOT NULL GROUP BY source",
        "prj9_table_function": f"""WITH {PAIRS} SELECT conv_id, turn, 'comment_to_code' AS task_type, instruction AS input, output AS target FROM q
UNION ALL SELECT conv_id, turn, 'code_to_comment', output, instruction FROM q UNION ALL SELECT conv_id, turn, 'code_explanation', output, instruction FROM q WHERE length(instruction) > 100""",
        "flt_user_predicate": "SELECT doc_id, lang FROM documents WHERE len(list_filter(regexp_split_to_array(trim(text), '\\s+'), lambda x: x <> '')) > 100 AND lang <> 'de'",
        "agg7_funnel": _FUNNEL.replace("{bank}", K._bank(False)),
        "agg7_funnel_corrected": _FUNNEL.replace("{bank}", K._bank(True)),
        "sco28_repetition": SCO28,
        "gen1_templates": f"WITH {_GEN} SELECT id, difficulty, language, 'Write a ' || difficulty || ' ' || language || ' sample number ' || id AS instruction FROM g",
        "gen7_stats": f"WITH {_GEN} SELECT difficulty, language, count(*) AS n FROM g GROUP BY difficulty, language",
        "win7_plateau_lr": """WITH d AS (SELECT event_type, ts::DATE AS d, avg(value) AS v FROM events GROUP BY 1, 2),
s AS (SELECT *, row_number() OVER w AS step, coalesce(v < min(v) OVER (PARTITION BY event_type ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS new FROM d WINDOW w AS (PARTITION BY event_type ORDER BY d)),
r AS (SELECT *, max(CASE WHEN new THEN step END) OVER (PARTITION BY event_type ORDER BY step) AS since FROM s)
SELECT event_type, step, 0.1 * power(0.5, sum((step > since AND (step - since) % 4 = 0)::INT) OVER (PARTITION BY event_type ORDER BY step)) AS rate FROM r""",
        "flt9_hash_bernoulli": f"SELECT doc_id, {D.draw('doc_id::VARCHAR', D.q(':unit'))} < 0.75 AS passed FROM documents",
        "srt8_weighted_choice": f"SELECT doc_id, {D.case((D.draw('doc_id::VARCHAR', D.q(':pick')) + ' < 0.3', D.q('easy')), (D.draw('doc_id::VARCHAR', D.q(':pick')) + ' < 0.8', D.q('medium')), other=D.q('hard'))} AS choice FROM documents",
        "stream_tumbling": "SELECT date_trunc('day', ts)::TIMESTAMP AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
        "stream_sliding": "SELECT s AS start, event_type, count(*) AS n FROM (SELECT event_type, time_bucket(INTERVAL '12 hours', ts, TIMESTAMP '1970-01-01') - k * INTERVAL '12 hours' AS s FROM events, (VALUES (0), (1)) v(k)) x GROUP BY 1, 2",
        "stream_session": "WITH l AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL '6 hours' THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM l) SELECT min(ts) AS start, user_id, count(*) AS n FROM s GROUP BY user_id, k",
        "stream_dedup_watermark": "SELECT DISTINCT event_id, event_type FROM events",
        "stream_static_join": "SELECT event_id, event_type, value FROM events WHERE value > 60",
    }
