"""Verified near duplicates against all pairs of whole texts."""

import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import near_duplicates
from textloom.session import table


def sets_of(rows, width=5):
    out = {}
    for i, t in rows:
        w = (t or "").lower().split()
        out[i] = frozenset(" ".join(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([" ".join(w)] if w else [])
    return out


def brute(sets, threshold=0.8):
    """Linked pairs of different sets, and the groups' least ids."""
    ids, pairs, root = sorted(sets), set(), {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                if sets[a] != sets[b]:
                    pairs.add((a, b))
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return pairs, {i: top(i) for i in ids}


def near_copies():
    rng, rows = random.Random(3), []
    for g in range(12):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(120)]
        for _ in range(6):
            w = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, 3, 12))):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            rows.append(" ".join(w))
    rng.shuffle(rows)
    return [*enumerate(rows), (500, None), (501, ""), (502, " \n"), (503, "a b"), (504, "A  b"), (505, "a b c")]


def test_groups_against_all_pairs(spark):
    rows = near_copies()
    pairs, want = brute(sets_of(rows))
    got = {r.doc: r for r in near_duplicates.groups(spark.createDataFrame([*rows, (None, "a b")], "doc_id long, text string")).collect()}
    assert set(got) == {i for i, _ in rows}
    assert all(want[r.doc] == want[r.first] and r.first <= r.doc for r in got.values())  # nothing joined wrongly
    linked = [i for i in want if want[i] != i]
    assert sum(got[i].first == want[i] for i in linked) >= 0.9 * len(linked) and len(linked) > 40
    assert got[504].first == 503 and got[504].copies == 2 and got[505].first == 505
    assert {got[i].first for i in (500, 501, 502)} == {500, 501, 502}


def test_recall_on_all_documents(spark, sf):
    docs = table(spark, sf, "documents")
    pairs, want = brute(sets_of([(r.doc_id, r.text) for r in docs.collect()]))
    got = {r.doc: r.first for r in near_duplicates.groups(docs).collect()}
    later = [i for i in want if want[i] != i]
    assert all(want[i] == want[f] for i, f in got.items())
    assert later and sum(got[i] == want[i] for i in later) >= 0.9 * len(later)


def test_a_hot_bucket_is_taken_apart_by_hubs(spark):
    """One key of all nodes: every pair that is linked to a hub is found, and no other is made."""
    rows = [(k, [k // 10 * 100 + j for j in range(10)]) for k in range(60)]
    nodes = spark.createDataFrame(rows, "doc long, set array<long>")
    buckets = nodes.select("doc", F.lit(0).alias("band"), F.lit("same").alias("key"))
    got = near_duplicates.links(nodes, buckets, 0.8).collect()
    assert len(got) == 6 * 9 and all(r.u // 10 == r.v // 10 and r.u < r.v for r in got)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "one text of some words")]])
def test_few_rows(spark, rows):
    out = near_duplicates.groups(spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, first string"))
    assert [(r.doc, r.first, r.copies, r.links) for r in out.collect()] == [(1, 1, 1, 0)] * len(rows)
    assert near_duplicates.first_of_groups(spark.createDataFrame(rows, "doc_id long, text string")).count() == len(rows)


def test_no_link_at_the_threshold_is_missed(spark, tmp_path):
    """Three hundred pairs of a similarity of just 0.8, of which an index of bands misses some."""
    from textloom.plans import catalog

    rows = [(2 * k + j, " ".join([f"É{k}w{i}" for i in range(12)] + [f"end{j}"])) for k in range(300) for j in range(2)]
    rows += [(9000 + j, " ".join([f"u{i}" for i in range(11)] + [f"end{j}"])) for j in range(2)]  # 7 of 9
    rows += [(9100, None), (9101, " "), (9102, rows[0][1].lower()), (9102, rows[0][1].lower())]
    spark.createDataFrame([*rows, (None, "a b")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc: (r.first, r.copies) for r in catalog.queries()["dup1_verified_groups"](spark, str(tmp_path)).collect()}
    want = {i: (i - i % 2, 2 if i == 0 else 1) for i in range(600)} | {i: (i, 1) for i in (9000, 9001, 9100, 9101)} | {9102: (0, 2)}
    assert got == want
