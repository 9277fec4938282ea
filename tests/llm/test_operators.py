"""Operators and registered queries in a session: oracles, brute force, odd rows."""

import inspect
import math
import random
import re
import zlib
from collections import Counter

import pytest
from oracle import assert_same, duck
from pyspark.sql import functions as F

from textloom.llm import decontaminate, line_dedup, lm_scoring, ngram_jaccard, packing, quality_rules, queries, site_quality, token_counts, token_file, toxicity
from textloom.llm.common import slices
from textloom.operators import components

ODD = [(1, "", "a", "h", 9), (2, None, None, None, None), (None, "x y z", "b", "h", 1), (3, "x y z", "b", "h", 1), (3, "x y z", "b", "h", 1), (4, "w " * 30_000, "a", "h", 2), (5, " \n\n\t", "a", "", 0)]
SCHEMA = "doc_id long, text string, lang string, source string, n_lines int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(name, spark, sf):
    assert_same(queries.queries()[name](spark, sf), queries.oracle_sql()[name], duck(sf))


def test_rules_on_odd_rows(odd, nothing):
    out = quality_rules.quality_rules(odd).collect()
    assert len(out) == len(ODD) and not any(r.kept for r in out)
    assert {r.n_repeat_words for r in out if r.doc_id == 4} == {30_000}
    assert quality_rules.quality_rules(nothing).count() == 0
    assert quality_rules.kept_documents(odd).columns == odd.columns


@pytest.mark.parametrize("most", [100_000, 0])
def test_kept_documents_are_decided_row_by_row(spark, most):
    good, bad = " ".join(f"w{k}" for k in range(60)), "a b"
    rows = [(None, good, "fine"), (None, bad, "fine"), (7, good, "fine"), (7, bad, "fine"), (8, good, None), (9, good, "spam")] + [(100 + k, good, "fine") for k in range(100)] + [(1000 + k, bad, "spam") for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = Counter((r.doc_id, r.text, r.source) for r in quality_rules.kept_documents(docs, broadcast_hosts=most).collect())
    assert got == Counter(r for r in rows if r[1] == good and r[2] != "spam")


@pytest.mark.parametrize("most", [100_000, 0])
def test_hosts_are_condemned_and_shrunk(spark, most):
    good, bad = " ".join(f"w{k}" for k in range(60)), "a b"
    rows = [(k, good, "fine") for k in range(200)] + [(1000 + k, bad if k < 95 else good, "spam") for k in range(100)] + [(2000, bad, "tiny")]
    out = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string"), broadcast_hosts=most).collect()}
    assert out[0].kept and not out[1099].kept and out[1099].host_failed and not out[1099].base_failed
    assert not out[2000].host_failed


@pytest.mark.parametrize("most", [64 << 20, -1])
def test_line_dedup_both_ways(spark, odd, nothing, most):
    line = "This line is long enough to count as one that repeats."
    docs = [(k, f"own {k}\n  {line.upper() if k % 2 else line} \n{line}") for k in range(6)] + [(9, "short\nshort"), (None, line)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = {r.doc_id: r for r in line_dedup.dedup_lines(df, broadcast_bytes=most).collect()}
    assert out[5].text == docs[5][1] and out[5].n_dropped == 0
    assert all(out[k].text == f"own {k}" and out[k].n_dropped == 2 for k in range(5))
    assert out[9].text == "short\nshort" and out[None].text == ""
    got = line_dedup.dedup_lines(odd, broadcast_bytes=most)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_lines", "n_dropped"] and got.count() == len(ODD)
    assert line_dedup.dedup_lines(nothing, broadcast_bytes=most).count() == 0


def _brute(rows, width, percent):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append((i, frozenset([tuple(w)] if 0 < len(w) < width else (tuple(w[k : k + width]) for k in range(len(w) - width + 1)))))
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a][1] & sets[b][1])
            if both and 100 * both >= percent * (len(sets[a][1]) + len(sets[b][1]) - both):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(least.get(find(k), i), i)
    return {i: (len(s), least[find(k)]) for k, (i, s) in enumerate(sets)}


@pytest.mark.parametrize(("width", "percent", "cluster"), [(4, 85, 8 << 20), (5, 80, 2000)])
def test_jaccard_components(spark, monkeypatch, width, percent, cluster):
    monkeypatch.setattr(ngram_jaccard, "CLUSTER_GRAMS", cluster)
    monkeypatch.setattr(ngram_jaccard, "COMMON_LEAST", 10)
    r = random.Random(5)
    words = [f"w{k}" for k in range(1500)]
    base, rows = [r.choices(words, k=r.randint(2, 200)) for _ in range(30)], []
    for i in range(300):
        x = list(r.choice(base))
        for _ in range(int(len(x) * r.choice([0, 0.005, 0.01, 0.02, 0.05]) + r.random())):
            x[r.randrange(len(x))] = r.choice(words)
        rows.append((i, " ".join(x + base[0][:40] if r.random() < 0.3 else x)))
    rows += [(9000, ""), (9001, None), (9002, "a"), (9003, "A"), (9004, "a b")]
    got = ngram_jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), width=width, percent=percent)
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got.collect()} == _brute(rows, width, percent)


@pytest.mark.parametrize(("split", "cluster"), [((2, 3, 4), 8 << 20), ((1024, 64, 65_536), 150), ((3, 100, 3), 300)])
def test_jaccard_of_large_groups(spark, monkeypatch, split, cluster):
    """Blocks cut into chunks, clusters verified in chunks: no link is lost, sizes differ."""
    monkeypatch.setattr(ngram_jaccard, "SPLIT", split)
    monkeypatch.setattr(ngram_jaccard, "CLUSTER_GRAMS", cluster)
    r = random.Random(9)
    words = [f"w{k}" for k in range(4000)]
    base, rows = r.choices(words, k=60), []
    for i in range(90):  # a chain of texts that grow apart, and copies with changes
        base = [*base[1:], r.choice(words)] if i % 3 else base + r.choices(words, k=2)
        if i % 31 == 30:  # and a new start
            base = r.choices(words, k=50)
        rows.append((i, " ".join(base if i % 4 else [*base[:20], r.choice(words), *base[21:]])))
    got = ngram_jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), width=3, percent=85)
    want = _brute(rows, 3, 85)
    assert len({c for _, c in want.values()}) > 1
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got.collect()} == want


def test_near_duplicates_on_odd_rows(odd, nothing):
    kept = ngram_jaccard.without_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 3, 4, 5])
    assert ngram_jaccard.without_near_duplicates(nothing).count() == 0


def test_near_duplicates_are_told_apart_by_id_and_text(spark):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcd")
    near = lambda t: t + " more"
    rows = [
        (3, a, 1), (3, b, 2),  # one id, unlike texts: both stay
        (5, near(a), 3), (3, near(b), 4),  # near copies, one of them under the id of a kept row: both go
        (None, c, 5), (None, near(c), 6), (None, d, 7), (None, d, 8), (9, near(d), 9),  # nulls: one of the c group, 9 of the d group
        (None, "", 10), (None, "", 11), (None, None, 12),  # no words: all stay
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id long").withColumnsRenamed({"component_id": "at"}).withColumn("h", F.lit(1)).withColumn("row", F.lit("x"))
    got = ngram_jaccard.without_near_duplicates(docs).collect()
    kept = sorted(r["at"] for r in got)
    assert kept[:2] == [1, 2] or (3, near(b)) in {(r.doc_id, r.text) for r in got}
    by_text = Counter((r.doc_id, r.text) for r in got)
    assert by_text[3, a] == 1 and by_text[3, b] + by_text[3, near(b)] == 1 and by_text[5, near(a)] == 0
    assert by_text[None, c] + by_text[None, near(c)] == 1 and by_text[9, near(d)] == 1 and by_text[None, d] == 0
    assert by_text[None, ""] == 2 and by_text[None, None] == 1 and len(got) == 7 and got[0].__fields__ == docs.columns
    again = spark.createDataFrame([(1, a, 0), (1, a, 0), (1, a, 2), (2, a, 0)], "doc_id long, text string, n long")
    assert [tuple(r) for r in ngram_jaccard.without_near_duplicates(again).collect()] == [(1, a, 0)]


def test_components_do_not_mix_texts_of_one_id(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(40)) for x in "ab")
    docs = spark.createDataFrame([(7, a), (7, b), (8, a), (4, b + " more"), (None, "q r s t u")], "doc_id long, text string").withColumn("component_id", F.lit("own")).withColumn("set", F.lit(0))
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in ngram_jaccard.jaccard_components(docs).collect())
    assert got == [(0, 0), (4, 4), (7, 4), (7, 7), (8, 7)]


def test_components(spark):
    edges = [(k, k + 1) for k in range(20)] + [(100, k) for k in range(90, 100)] + [(7, 7)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(21)} | {k: 90 for k in range(90, 101)}


def test_token_operators(spark, sf, odd, nothing):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    files = {r.doc_id: r for r in token_file.token_files(docs).collect()}
    at = 0
    for i in sorted(files):
        assert files[i].start == at and len(files[i].ids) == 4 * files[i].n_tokens
        at += files[i].n_tokens
    pieces = {}
    for r in packing.pack_documents(docs).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    for i, rows in pieces.items():
        rows.sort(key=lambda r: r.piece)
        assert [r.piece for r in rows] == list(range(len(rows))) and all(r.length == 4096 for r in rows[:-1])
        assert [zlib.crc32(files[i].ids[4 * r.start : 4 * (r.start + r.length)]) for r in rows] == [r.ids_crc32 for r in rows]
    bins = {}
    for r in (r for rows in pieces.values() for r in rows):
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for mine in bins.values():
        assert [o for o, _ in sorted(mine)] == [sum(n for _, n in sorted(mine)[:k]) for k in range(len(mine))] and sum(n for _, n in mine) <= 4096
    assert len(bins) <= -(-at // 4096) + 1
    assert token_file.token_files(odd).count() == packing.pack_documents(odd).where("piece = 0").count() == token_counts.token_counts(odd).count() == len(ODD)
    for f in (token_file.token_files, packing.pack_documents, token_counts.token_counts):
        assert f(nothing).count() == 0


@pytest.mark.parametrize("head", [1 << 20, 3000, 0])
def test_lm_base_is_exact(spark, sf, head):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows, counts = docs.select("doc_id", "text").collect(), Counter()
    tokens = {r.doc_id: [*r.text.encode().lower().split(), b" end"] for r in rows}
    for i, t in tokens.items():
        if zlib.crc32(str(i).encode()) % 10:
            counts.update(t)
    n, v = sum(counts.values()), len(counts)
    for r in lm_scoring.score_texts(docs, F.crc32(F.col("doc_id").cast("string")) % 10 == 0, head_words=head).collect():
        t = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(w in counts for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), abs=1e-6)
        assert r.score < 0


@pytest.fixture(scope="module")
def lm_pairs(spark):
    """Texts whose pairs occur once, 2-3 and 4-7 times, and their scores by exact counts."""
    rng = random.Random(8)
    texts = [" ".join(f"w{min(int(rng.expovariate(0.05)), 90)}" for _ in range(rng.randint(5, 60))) for _ in range(60)]
    split = [["", *t.split(), ""] for t in texts]
    words, pairs = Counter(w for t in split for w in t[1:]), Counter(p for t in split for p in zip(t, t[1:]))
    quantised = {p: 1 << c.bit_length() - 1 for p, c in pairs.items()}
    left = Counter()
    for (v, _), q in quantised.items():
        left[v] += q
    total = sum(words.values()) + 0.1 * (len(words) + 1)

    def after(v, w, share=0.9, strength=2.0):
        per, alone = share / (words[v] + strength), (words[w] + 0.1) / total
        return per * quantised.get((v, w), 0) + (1 - per * left[v]) * alone if words[v] else alone

    for v in words:
        assert sum(after(v, w) for w in [*words, "unseen"]) == pytest.approx(1)
    exact = [sum(math.log10(after(v, w)) for v, w in zip(t, t[1:])) for t in split]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), exact


def test_lm_probabilities_sum_to_one(spark, lm_pairs):
    import numpy as np

    docs, _ = lm_pairs
    trained = lm_scoring.Trained(docs.select("text"), 1 << 20, 64 << 20, event_bits=64)
    keys, c, s = trained.head
    model = lm_scoring.Smoothing(trained.n, trained.v, 0.9, 2.0)
    assert len(keys) == trained.v and model.alone(c).sum() + model.alone(np.zeros(1)) == pytest.approx(1)
    for k in range(len(keys)):
        first = np.full(len(keys), k)
        level = trained.bloom.levels(*lm_scoring.pair_place(keys[first], keys, trained.buckets))
        rest = model.after(c[[k]], s[[k]], np.zeros(1), np.zeros(1))
        assert model.after(c[first], s[first], c, level).sum() + rest[0] == pytest.approx(1, abs=1e-9)


@pytest.mark.parametrize("size", [64 << 20, 2000, 0])
def test_lm_scores_do_not_depend_on_the_filters_size(lm_pairs, size):
    docs, exact = lm_pairs
    got = {r.doc_id: r.score for r in lm_scoring.score_texts(docs, F.lit(False), filter_bytes=size, event_bits=64).collect()}
    assert got == {k: pytest.approx(x, abs=1e-6) for k, x in enumerate(exact)}
    assert got == {r.doc_id: r.score for r in lm_scoring.score_texts(docs, F.lit(False), event_bits=64).collect()}


@pytest.mark.parametrize("head", [0, 1, 20, 1 << 20])
def test_lm_scores_do_not_depend_on_the_head(lm_pairs, head):
    docs, exact = lm_pairs
    got = {r.doc_id: r.score for r in lm_scoring.score_texts(docs, F.lit(False), head_words=head, event_bits=64).collect()}
    assert got == {k: pytest.approx(x, abs=1e-6) for k, x in enumerate(exact)}


def test_lm_on_few_and_many_buckets(spark, lm_pairs, monkeypatch):
    docs, exact = lm_pairs
    for buckets, pending in ((1, 1 << 20), (3, 10), (50, 10)):
        monkeypatch.setattr(lm_scoring, "buckets_for", lambda df, each, n=buckets: n)
        monkeypatch.setattr(lm_scoring, "PENDING", pending)
        got = {r.doc_id: r.score for r in lm_scoring.score_texts(docs, F.lit(False), event_bits=64).collect()}
        assert got == {k: pytest.approx(x, abs=1e-6) for k, x in enumerate(exact)}


def test_only_a_hot_shard_is_copied(spark):
    """A line of all rows asks for copies of its own shard, not of all."""
    visits = spark.range(10_000).select(F.when(F.col("id") < 9_000, 3).otherwise(F.col("id") % 40).alias("shard"), F.col("id").alias("h1"), F.col("id").alias("h2"), F.col("id").alias("doc"), F.lit(0).cast("long").alias("text"))
    index = spark.range(40).select(F.col("id").alias("shard"), F.lit(b"x").alias("bytes"))
    dealt, copies = line_dedup._dealt(visits, index, most=500)
    assert {r.shard: r["count"] for r in copies.groupBy("shard").count().collect()} == {k: 19 if k == 3 else 1 for k in range(40)}
    met = dealt.join(copies, ["shard", "salt"]).groupBy("shard", "salt").count().collect()
    assert sum(r["count"] for r in met) == 10_000 and max(r["count"] for r in met) < 700


def test_token_files_split_rows_of_one_id(spark, tmp_path):
    docs = spark.createDataFrame([(None if k % 3 == 0 else 7 if k % 3 == 1 else k, f"text {k} " * 20) for k in range(3000)], "doc_id long, text string")
    rows = docs.select("doc_id", "text").collect()
    files = token_file.write_token_files(docs, str(tmp_path)).collect()
    assert max(f.n_docs for f in files) < 1200 and sum(f.n_docs for f in files) == 3000
    out = token_file.read_token_files(spark, str(tmp_path), spark.createDataFrame(files)).orderBy("start").collect()
    assert [r.doc_id for r in out] == sorted((r.doc_id for r in rows), key=lambda i: (i is not None, i or 0))


def test_lm_beyond_the_buckets_that_a_table_may_have(spark, lm_pairs, monkeypatch):
    """A file holds the slices of several buckets; nothing stays in the catalogue."""
    docs, exact = lm_pairs
    monkeypatch.setattr(lm_scoring, "buckets_for", lambda df, each: 40)
    before = spark.conf.get("spark.sql.sources.bucketing.maxBuckets")
    spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "3")
    try:
        got = {r.doc_id: r.score for r in lm_scoring.score_texts(docs, F.lit(False), head_words=1, filter_bytes=0, event_bits=64).collect()}
    finally:
        spark.conf.set("spark.sql.sources.bucketing.maxBuckets", before)
    assert got == {k: pytest.approx(x, abs=1e-6) for k, x in enumerate(exact)}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("textloom")]
    assert lm_scoring.Trained(docs.select("text"), 1, 0, event_bits=64).bloom is None


def test_lm_on_odd_rows(odd, nothing):
    assert lm_scoring.score_texts(odd, F.col("doc_id") == 4).count() == len(ODD)
    assert {r.score for r in lm_scoring.score_texts(odd, F.lit(True)).collect()} == {0.0}
    assert lm_scoring.score_texts(nothing, F.lit(False)).count() == 0


def _auc(scores, labels):
    ranked = sorted(zip(scores, labels, strict=True))
    ones, total, below = sum(labels), 0.0, 0
    k = 0
    while k < len(ranked):
        same = [y for s, y in ranked[k:] if s == ranked[k][0]]
        total += sum(same) * (below + (len(same) - sum(same)) / 2)
        below += len(same) - sum(same)
        k += len(same)
    return total / (ones * (len(labels) - ones))


@pytest.mark.parametrize(("name", "label", "least"), [("op5_toxicity", "toxic", 0.7), ("op6_site_quality", "quality", 0.95)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.01"
    rows = queries.queries()[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert _auc([r.score for r in rows], [r[label] for r in rows]) > least


def test_classifiers_on_odd_rows(spark, odd, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(1, 0, 1), (2, None, None), (3, 1, 0), (77, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, some):
        for docs, n in ((odd, len(ODD)), (nothing, 0)):
            assert toxicity.toxicity(docs, labels, F.lit(True)).count() == n
            assert site_quality.site_quality(docs, labels, F.lit(True)).count() == n


def test_sites_are_shrunk(spark):
    rows = site_quality.written(spark.createDataFrame([("a", 1000, 900.0), ("b", 1000, 300.0), ("c", 1, 0.0)], "h string, n long, good double"), "t").withColumn("raw", F.col("good") / F.col("n")).withColumn("all", F.lit(0.6))
    k = site_quality._strength(rows, "n", "raw", "all")
    assert 1 <= k < 50 and (0 + k * 0.6) / (1 + k) > 0.25


def test_decontamination(spark, odd, nothing):
    item = "The quick brown fox jumps over the lazy dog while nine more foxes look on from the hill."
    items = spark.createDataFrame([(1, item), (2, None), (3, "short"), (4, item)], "item_id long, text string")
    docs = odd.unionByName(spark.createDataFrame([(50, f"x\n{item.upper()}  y", "a", "b", 1), (51, item.replace("lazy", "lzy"), "a", "b", 1), (52, item[:40], "a", "b", 1)], SCHEMA))
    got = sorted((r.doc_id, r.item_id, r.distance) for r in decontaminate.matches(docs, items).collect())
    assert got == [(50, 1, 0), (50, 4, 0), (51, 1, 1), (51, 4, 1)]
    assert decontaminate.clean(docs, items).count() == len(ODD) + 1
    assert decontaminate.clean(docs, items.limit(0)).count() == len(ODD) + 3 and decontaminate.clean(nothing, items).count() == 0


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 100)
    texts = [f"item number {k} " + " ".join(f"word{k}x{j}" for j in range(12)) for k in range(6)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = spark.createDataFrame([(k, f"before {t} after") for k, t in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id: r.item_id for r in decontaminate.matches(docs, items).collect()} == {k: k for k in range(6)}
    assert decontaminate.clean(docs, items).count() == 0


def test_slices_cut_no_text():
    import pyarrow as pa

    b = pa.RecordBatch.from_arrays([pa.array(["a" * 9, None, "b" * 20, ""])], names=["t"])
    assert [s.num_rows for s in slices(b, 0, 10)] == [3, 1]


def test_pipeline_stages(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = line_dedup.written(stage(spark, docs, sf), name)
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    parts = ngram_jaccard.jaccard_components(docs, width=5, percent=80)
    assert parts.where("n_shingles > 0 AND component_id <> doc_id").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).select("doc_id").distinct().count() == before


def test_scratch_goes(spark):
    from textloom.llm.common import clear_scratch, shared_dir, written

    at = written(spark.range(3), "probe")
    assert at.count() == 3
    clear_scratch(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/textloom")
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def restated_sites(rows, base):
    """Rates and scores from evidence, in plain Python. rows: (id, host, path, evidence); base: the
    share of good labels."""
    sure = lambda e: 1 / (1 + math.exp(-(e + math.log(base / (1 - base)))))
    hosts, paths = {}, {}
    for _, h, p, e in rows:
        for of, key in ((hosts, h), (paths, (h, p))):
            n, good = of.get(key, (0, 0.0))
            of[key] = n + 1, good + sure(e)
    every = sum(g for _, g in hosts.values()) / len(rows)

    def strength(groups):  # (n, rate, parent's rate)
        v, b, s = (sum(x) / len(groups) for x in zip(*(((r - p) ** 2, p * (1 - p), p * (1 - p) / n) for n, r, p in groups)))
        return 10_000.0 if v <= s else min(10_000.0, max(1.0, b / (v - s) - 1))

    k = strength([(n, g / n, every) for n, g in hosts.values()])
    rate = {h: (g + k * every) / (n + k) for h, (n, g) in hosts.items()}
    j = strength([(n, g / n, rate[h]) for (h, _), (n, g) in paths.items()])
    out = {}
    for i, h, p, e in rows:
        host = (hosts[h][1] - sure(e) + k * every) / (hosts[h][0] - 1 + k)
        path = (paths[h, p][1] - sure(e) + j * host) / (paths[h, p][0] - 1 + j)
        safe = min(1 - 1e-6, max(1e-6, path))
        out[i] = host, path, 1 / (1 + math.exp(-(e + math.log(safe / (1 - safe)))))
    return out, k, j


def test_site_quality_equals_its_restatement(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    known = [r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.doc_id in docs and zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    got = queries.op6_site_quality(spark, sf).collect()
    want, _, _ = restated_sites([(r.doc_id, docs[r.doc_id].source, docs[r.doc_id].lang, r.evidence) for r in got], sum(known) / len(known))
    assert len(got) == len(docs)
    for r in got:
        assert (r.host_rate, r.path_rate, r.score) == pytest.approx(want[r.doc_id], rel=1e-9) and r.kept == (r.score >= 0.5)


def test_paths_of_one_site_differ(spark):
    """Addresses of pages: a site of good and bad folders; folders keep their own rates."""
    rng, rows = random.Random(3), []
    good = lambda: " ".join(rng.choice(["the", "of", "and", "house", "river", "stone", "light"]) + rng.choice(["", "s", ","]) for _ in range(80))
    bad = lambda: " ".join(rng.choice(["$$$", "###", "|x|", "9", "!!"]) for _ in range(80))
    for k in range(400):
        site = f"site{k % 4}"
        folder, text = (("blog", good()) if k % 8 < 4 else ("spam", bad())) if site != "site0" else ("blog", good())
        rows.append((k, f"https://{site}.org/{folder}/{k}.html", text, int(folder == "blog")))
    rows.append((400, "https://site1.org/spam/x", good(), 1))
    pages = spark.createDataFrame(rows, "doc_id long, url string, text string, quality int")
    host, path = site_quality.host_and_path(F.col("url"))
    out = {r.doc_id: r for r in site_quality.site_quality(pages.withColumn("source", host).withColumn("lang", path), pages, F.col("doc_id") % 2 == 0).collect()}
    base = sum(r[3] for r in rows if r[0] % 2 == 0) / sum(1 for r in rows if r[0] % 2 == 0)
    want, k, j = restated_sites([(r[0], r[1].split("/")[2], r[1].split("/")[3], out[r[0]].evidence) for r in rows], base)
    assert j < 10_000 and all((out[i].host_rate, out[i].path_rate, out[i].score) == pytest.approx(x, rel=1e-9) for i, x in want.items())
    assert out[400].path_rate < 0.3 < out[400].host_rate  # a good page in a bad folder


CLASH = "doc_id long, text string, lang string, source string, score string, evidence string, piece string, start string, component_id string, n string, h string, row string, at string, lines string, bad_host string, base_failed string, kept string, set string, root string, doc string"


@pytest.fixture(scope="module")
def clash(spark):
    words = " ".join(f"w{k}" for k in range(60))
    return spark.createDataFrame([(k, f"{words} x{k // 2}", "en", "s", *("own",) * 16) for k in range(6)], CLASH)


def test_clashing_columns(spark, clash):
    """Columns that have the names of results, or of what operators use inside, pass through or are ignored."""
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(6)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "an item of more than fifty characters that no text holds at all")], "item_id long, text string")
    for out in (quality_rules.kept_documents(clash), quality_rules.kept_documents(clash, broadcast_hosts=-1), ngram_jaccard.without_near_duplicates(clash), decontaminate.clean(clash, items)):
        rows = out.collect()
        assert out.columns == clash.columns and rows and all(r.score == r.row == r.kept == r.at == "own" for r in rows)
    for most in (64 << 20, -1):
        rows = line_dedup.dedup_lines(clash, broadcast_bytes=most).collect()
        assert len(rows) == 6 and all(r.lines == r.doc == "own" and r.n_dropped == 0 for r in rows)
    assert {r.component_id for r in ngram_jaccard.jaccard_components(clash).collect()} == {0}
    assert {r.n_words for r in quality_rules.quality_rules(clash).collect()} == {61}
    for out in (toxicity.toxicity(clash, labels, F.lit(True)), site_quality.site_quality(clash, labels, F.lit(True)), lm_scoring.score_texts(clash, F.lit(False)), token_file.token_files(clash), token_counts.token_counts(clash), packing.pack_documents(clash)):
        assert sorted(r.doc_id for r in out.collect()) == list(range(6))


@pytest.mark.parametrize("hosts", [100_000, -1])
def test_no_name_inside_the_stages_can_clash(spark, sf, hosts):
    """Extra columns with every name that the stages' modules spell out pass through unchanged."""
    import corpus_pipeline

    modules = (quality_rules, line_dedup, ngram_jaccard, components, decontaminate, corpus_pipeline)
    own = {n.lower() for m in modules for n in re.findall(r"""["'](\w+)["']""", inspect.getsource(m))} - {"doc_id", "text", "source", "n_chars"}
    names = sorted(n for n in own if not n.isdigit()) + ["a.b", "c`d"]
    assert "bad_host" in names and "bad_salt" in names
    words = " ".join(f"w{k}" for k in range(60))
    rows = [(k, f"{words} x{k // 2}", "s", *(f"{n}-{k}" for n in names)) for k in range(6)]
    kind = "struct<doc_id: bigint, text: string, source: string, " + ", ".join(f"`{n.replace('`', '``')}`: string" for n in names) + ">"
    docs = spark.createDataFrame(rows, kind)
    stages = [lambda d: quality_rules.kept_documents(d, broadcast_hosts=hosts), *(lambda d, f=f: f(spark, d, sf) for _, f in corpus_pipeline.STAGES[1:-1])]
    for stage in stages:
        out = stage(docs)
        assert out.columns == docs.columns
        got = out.collect()
        assert got and all(tuple(r)[3:] == tuple(f"{n}-{r[0]}" for n in names) for r in got)


def test_odd_rows_by_value(spark, odd):
    by = lambda rows, *names: sorted((tuple(r[n] for n in names) for r in rows), key=str)
    counts = by(token_counts.token_counts(odd).collect(), "doc_id", "n_bytes", "over_limit")
    assert counts[:3] == [(1, 0, False), (2, 0, False), (3, 5, False)] and (4, 60_000, True) in counts and (None, 5, False) in counts
    files = by(token_file.token_files(odd).collect(), "doc_id", "start", "n_tokens")
    assert files[0] == (1, 4, 1) and [x for x in files if x[0] is None] == [(None, 0, 4)] and [x[2] for x in files if x[0] == 4] == [30_001]
    pieces = packing.pack_documents(odd).collect()
    assert sorted(p.length for p in pieces if p.doc_id == 4) == [30_001 % 4096, *[4096] * 7] and sum(p.length for p in pieces) == sum(x[2] for x in files)
    scores = {(r.doc_id, r.n_tokens): r for r in lm_scoring.score_texts(odd, F.lit(False)).collect()}
    assert set(scores) == {(1, 1), (2, 1), (3, 4), (None, 4), (4, 30_001), (5, 1)} and len({round(scores[k, 1].score, 9) for k in (1, 2, 5)}) == 1
    lines = {(r.doc_id, r.text): (r.n_lines, r.n_dropped) for r in line_dedup.dedup_lines(odd.drop("n_lines")).collect()}
    assert lines[1, ""] == lines[2, ""] == (1, 0) and lines[5, " \n\n\t"] == (3, 0)
    labels = spark.createDataFrame([(1, 0, 1), (3, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    tox = {r.doc_id: r for r in toxicity.toxicity(odd, labels, F.lit(True)).collect()}
    assert tox[1].score == tox[2].score == tox[5].score and tox[1].evidence == [] and 0 <= tox[4].score <= 1
    sites = site_quality.site_quality(odd, labels, F.lit(True)).collect()
    assert len({r.evidence for r in sites if r.doc_id in (1, 2, 5)}) == 1 and all(0 < r.score < 1 for r in sites)


def test_toxicity_query_equals_brute_force(spark):
    """The query's scores on a small table: neighbours by all cosines, votes, curve."""
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op5_toxicity(spark, sf).collect()}
    third = F.crc32(F.col("doc_id").cast("string")) % 3
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    examples = toxicity.labelled_examples(docs, labels, third != 1)
    index = toxicity.trained(examples, 25, 1.0, 0.5)
    mine = [x for n, x in enumerate(examples) if n % 3]
    vectors = [dict(zip(*(v.tolist() for v in index.vector(Counter(toxicity.words(t)))), strict=True)) for _, t, _ in mine]
    for r in docs.select("doc_id", "text").collect():
        q = dict(zip(*(v.tolist() for v in index.vector(Counter(toxicity.words(r.text)))), strict=True))
        cosines = sorted(((-round(sum(w * q.get(t, 0.0) for t, w in v.items()), 9), k) for k, v in enumerate(vectors)))[:25]
        near = [(-c, k) for c, k in cosines if c < 0]
        vote = (sum(c * c * mine[k][2] for c, k in near) + index.base) / (sum(c * c for c, _ in near) + 1)
        a, b = index.curve
        want = 1 / (1 + math.exp(-a - b * index.log_odds(vote))) if index.curve != (0.0, 1.0) else vote
        assert got[r.doc_id].score == pytest.approx(want, abs=1e-6)


def test_toxicity_is_calibrated(spark):
    """Held-out texts are toxic about as often as their scores say: the expected calibration error."""
    sf = "/root/testdata/sf0.1"
    rows = queries.op5_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out AND toxic IS NOT NULL").select("score", "toxic", F.size("evidence").alias("k")).collect()
    error = 0.0
    for low in range(10):
        some = [r for r in rows if low <= min(9, int(r.score * 10)) < low + 1]
        error += abs(sum(r.score - r.toxic for r in some)) / len(rows)
    assert error < 0.05 and sum(r.k > 0 for r in rows) > 0.95 * len(rows)
    hit = [r.toxic for r in rows if r.score >= 0.7]
    assert sum(hit) > 0.9 * len(hit) and sum(hit) > 0.55 * sum(r.toxic for r in rows)


def test_short_items_are_found(spark):
    items = spark.createDataFrame([(1, "tiny item"), (2, ""), (3, None), (4, "seventeen letters")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a Tiny  ITEM here"), (2, "nothing"), (3, "seventeen leters"), (4, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id, r.distance) for r in decontaminate.matches(docs, items).collect()) == [(1, 1, 0), (3, 4, 1)]
    assert decontaminate.clean(docs, items).count() == 4 and decontaminate.clean(docs, items, min_chars=0).count() == 2


def test_own_evidence_counts_once(spark):
    """A site of one document has its parents' rate, whatever the document."""
    rows = [(k, " ".join(f"w{j * (k % 7 + 1)}" for j in range(40 + k)), "en", "big") for k in range(40)] + [(100, "!!! $$$ ???", "en", "lone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(40)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in site_quality.site_quality(docs, labels, F.lit(True)).collect()}
    assert out[100].path_rate == pytest.approx(out[100].host_rate)
    hosts = {r.host_rate for r in out.values() if r.doc_id < 40}
    assert len(hosts) > 1 and max(hosts) - min(hosts) < 0.1
