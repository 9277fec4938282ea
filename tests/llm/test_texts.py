"""Importance resampling, piece encoding and runs: against plain restatements and the library."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from textloom.llm import importance_resampling, periodic_runs, piece_encoding, queries

CLASH = "doc_id long, text string, id long, row long, words string, runs int, `a.b` int"


def odd_rows(spark):
    rows = [(1, ""), (2, None), (None, "x y z " * 9), (3, "a b " * 40), (3, "a b " * 40), (4, " \n\t"), (5, "Ж ж ж ж ж ж ж"), (6, "z" * 50_000)]
    return spark.createDataFrame([(*r, 1, 1, "w", 2, 3) for r in rows], CLASH)


# --- runs


def plain_runs(w, least=6, times=4):
    """Every period, every maximal stretch of words that equal those a period on."""
    found = {}
    for p in range(1, len(w) // times + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, times * p):
                found.setdefault((i, j + p - i), p)
            i = max(j, i + 1)
    return sorted(((a, n, p) for (a, n), p in found.items()), key=lambda r: (r[0], r[2]))


def some_words(rng):
    w = [rng.randrange(rng.choice((1, 2, 3, 4))) for _ in range(rng.randint(0, 60))]
    while w and rng.random() < 0.7:
        s = rng.randrange(len(w))
        w[s:s] = w[s : s + rng.randint(1, 8)] * rng.randint(1, 7)
        if rng.random() < 0.4:
            w += w[rng.randrange(len(w)) :]
        w = w[:150]
    return w


def test_runs_equal_all_periods():
    rng, seen = random.Random(3), 0
    for _ in range(5000):
        w = some_words(rng)
        expected = plain_runs(w)
        assert periodic_runs.text_runs([b"%d" % x for x in w]) == expected
        got = periodic_runs.stretch_runs(w)  # without the rare threes taken out first
        assert sorted(((a, b - a + 1, p) for (a, b), p in got.items()), key=lambda r: (r[0], r[2])) == expected
        seen += len(expected)
    assert seen > 5000


def test_factors_repeat_what_came_before():
    rng = random.Random(4)
    for _ in range(300):
        w, at = some_words(rng), 0
        for start, length, source in periodic_runs.factors(w):
            assert start == at
            at += length
            if source < 0:
                assert length == 1 and w[start] not in w[:start]
            else:
                assert source < start and w[source : source + length] == w[start : start + length]
                longer = w[start : start + length + 1]  # no longer one has begun before
                assert len(longer) == length or all(w[k : k + length + 1] != longer for k in range(start))
        assert at == len(w)


def test_nested_and_long_runs():
    word, other = [b"a", b"b"], [b"c"]
    inner = word * 4 + other
    runs = periodic_runs.text_runs(inner * 5)
    assert (0, 45, 9) in runs and [(k * 9, 8, 2) in runs for k in range(5)] == [True] * 5
    fibonacci, before = [b"a"], [b"b"]
    while len(fibonacci) < 2000:
        before, fibonacci = fibonacci, fibonacci + before
    assert periodic_runs.text_runs(fibonacci) == plain_runs(fibonacci)
    assert periodic_runs.text_runs([b"%d" % (k % 997) for k in range(100_000)]) == [(0, 100_000, 997)]


def test_find_runs_on_odd_rows(spark):
    rows = [(r.id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.find_runs(odd_rows(spark)).collect()]
    assert sorted(rows, key=str) == sorted(
        [(1, 0, [], ""), (2, 0, [], ""), (None, 27, [(0, 27, 3)], "x y z"), (3, 80, [(0, 80, 2)], "a b"), (3, 80, [(0, 80, 2)], "a b"), (4, 0, [], ""), (5, 7, [(1, 6, 1)], "Ж ж"), (6, 1, [], "z" * 50_000)], key=str
    )
    assert periodic_runs.find_runs(odd_rows(spark).limit(0)).count() == 0


def test_runs_query_equals_its_restatement(spark, sf):
    docs = {r.doc_id: r for r in queries.op13_periodic_runs(spark, sf).collect()}
    table = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert len(docs) == len(table)
    for row in table:
        w, h = (row["text"] or "").encode().split(), zlib.crc32(str(row["doc_id"]).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs, got = plain_runs(w), docs[row["doc_id"]]
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        gone = {k for s, n, p in runs for k in range(s + p, s + n)}
        assert (got.n_runs, got.start, got.length, got.period) == (len(runs), *best)
        assert got.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert got.runs_sha256 == hashlib.sha256("".join(f"{a},{n},{p}\n" for a, n, p in runs).encode()).hexdigest()
        assert got.collapsed_sha256 == hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()
    assert any(r.n_runs for r in docs.values())


# --- pieces

PARTS = ["a", "th", "ing", " ", "  ", "\n", "▁", "é", "日本", "🎉", "\x00", "<s>", "</s>", "<unk>", "<0x41>", "=", "----", "http://", "x" * 40, "\t", "​", "﻿", "İ", ".", ","]


@pytest.fixture(scope="module")
def coder():
    return piece_encoding.PieceCoder(piece_encoding.vocabulary_path())


@pytest.mark.parametrize(("most", "part"), [(400_000, 1 << 18), (50, 3)])
def test_pieces_equal_the_library(coder, monkeypatch, most, part, sf):
    monkeypatch.setattr(piece_encoding, "MOST_WORDS", most)
    monkeypatch.setattr(piece_encoding, "PART", part)
    coder.kept.clear()
    rng = random.Random(5)
    pieces = [p.replace("▁", " ") for p in coder.pieces]
    texts = pq.read_table(f"{sf}/documents.parquet", columns=["text"])["text"].to_pylist()
    texts += ["".join(rng.choice(PARTS if rng.random() < 0.5 else pieces) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += ["".join(rng.choice("abcd") for _ in range(5000)), "x" * 3000, " " * 3000, "漢q" * 500]
    for t in texts:
        ids = [i for p in coder.encode(t or "") for i in p]
        assert ids == coder.model.encode(t or "")
        assert "".join(coder.decode(coder.encode(t or ""))) == coder.model.decode(ids)


def test_backtracking_is_needed_and_right(coder):
    """Texts whose longest pieces from the left are not their encoding."""
    rng, other = random.Random(6), 0
    for _ in range(2000):
        text = "".join(rng.choice("etaoinshrdlu") for _ in range(12))
        greedy, at = [], 0
        while at < len(text):
            piece = next(coder.automaton.iter_long(text, at))[1]
            greedy.append(piece)
            at += len(piece)
        got = list(coder.cover(text))
        assert got == [coder.pieces[p] for p in coder.merged(text)]
        other += got != [coder.pieces[p] for p in greedy]
    assert other > 200


def test_round_trips_on_odd_rows(spark, coder):
    got = Counter((r.id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in piece_encoding.round_trips(odd_rows(spark)).collect())
    expected = Counter()
    for r in odd_rows(spark).collect():
        ids = coder.model.encode(r.text or "")
        expected[r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(coder.model.decode(ids).encode()).hexdigest()] += 1
    assert got == expected
    ids = {r.id: [int.from_bytes(r.ids[k : k + 4], "little") for k in range(0, len(r.ids), 4)] for r in piece_encoding.encode_texts(odd_rows(spark)).collect()}
    assert ids == {r.doc_id: coder.model.encode(r.text or "") for r in odd_rows(spark).collect()}
    assert piece_encoding.round_trips(odd_rows(spark).limit(0)).count() == 0


# --- importance resampling


def features(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = "".join(c if c in "0123456789" or "a" <= c <= "z" or c > "\x7f" else " " for c in low).split(" ")
    words = [w for w in words if w]
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def drawn(docs, target, percent=25, least=20):
    """The formula over dictionaries. docs: (id, text)."""
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = (Counter(bucket(f) for x in texts for f in features(x)[1]) for texts in ([x for _, x in docs], target))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000))))
    rows = []
    for i, text in docs:
        words, f = features(text)
        weight = sum(gain(bucket(x)) for x in f) // len(f) if f else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(f), weight, score, None, len(words)])
    able = sorted((r for r in rows if r[5] >= least and r[0] is not None), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return Counter(tuple(r[:5]) for r in rows)


@pytest.mark.parametrize("part", [4 << 20, 40])
def test_resampling_equals_the_formula(spark, part):
    rng = random.Random(8)
    some = ["The", "quick", "fox-", "é9", "Жж", "x_y", "don't", "a" * 60, "--", "\x00", "日本 語", "\n"]
    docs = [(k, " ".join(rng.choice(some) for _ in range(rng.randint(0, 60)))) for k in range(150)]
    docs += [(2, None), (None, "some words " * 30), (3, ""), (900, docs[7][1]), (900, docs[7][1])]
    target = [" ".join(rng.choice(some[:4]) for _ in range(30)) for _ in range(5)] + [None]
    frame = spark.createDataFrame([(*r, 5, "z") for r in docs], "doc_id long, text string, score int, `rank` string").repartition(3)
    goal = spark.createDataFrame(list(enumerate(target)), "item_id long, text string")
    got = importance_resampling.resample(frame, goal, part=part)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == drawn(docs, target)


def test_resampling_without_documents_or_target(spark):
    docs = spark.createDataFrame([(k, f"w{k} " * 25) for k in range(8)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert Counter(map(tuple, importance_resampling.resample(docs, none).collect())) == drawn([(r.doc_id, r.text) for r in docs.collect()], [])
    assert importance_resampling.resample(docs.limit(0), none).count() == 0


def test_parts_end_between_words():
    rng = random.Random(9)
    for _ in range(300):
        text = "".join(rng.choice("aé9B -\n日") for _ in range(rng.randint(0, 120)))
        seen = defaultdict(int)
        for part, led in importance_resampling.parts(text, 10):
            words, runs = features(part)
            for f in runs:
                seen[f] += 1
            if led:
                seen[words[0]] -= 1
        assert +Counter(seen) == Counter(features(text)[1])


def test_crc_reads_slices_of_arrays():
    words = pa.array(["a", "é x", "", "日本"])
    for a in (words, words[1:], words[2:3], pa.chunked_array([words[:1], words[1:]]), words.cast(pa.large_string())[1:]):
        assert importance_resampling.crc(a).to_pylist() == [zlib.crc32(x.encode()) for x in a.to_pylist()]
    assert importance_resampling.crc(pa.array([], pa.string())).to_pylist() == []
