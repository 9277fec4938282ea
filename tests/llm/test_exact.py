"""The parts that need no session: exact against libraries and brute force."""

import math
import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from textloom.llm import decontaminate, line_dedup, lm_scoring, ngram_jaccard, packing, site_quality, token_counts, token_file, toxicity, word_hashes, word_tokens

ODD = [
    "", "  ", "a  b\n\n c", "<|endoftext|> x<|startoftext|>y", "Ａ①ﬁ é é ǅ İI ß", "\x1c\x1da b\xa0c\x85d", "don't I'VE a'b 12½ x²", "it's we're 'street ,'s x'll'd 'r 're", "'", "a'", "'s", "''s", "5's ½'t ²'ve",
    "▁a ▁▁b", "日本語テキスト", "\x00a\x00", "a" * 300 + " " + "é" * 200, "﻿x ​ y", "\t\tx\r\n y <s> </s> <unk> <0x0A>", "🎉🎉 x", "a\n▁\n  \n x  ", "x" * 100_000,
]


@pytest.fixture(scope="module")
def texts(sf):
    return pq.read_table(f"{sf}/documents.parquet", columns=["text"])["text"].to_pylist() + ODD


def test_word_ids_equal_the_library(texts):
    ours = word_tokens.WordIds(word_tokens.vocabulary_path())
    theirs = [x.ids for x in ours.library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in ours.texts(pa.array(texts))] == [x + [1] for x in theirs]
    assert [np.frombuffer(ours.text(t), "<u4").tolist() for t in texts] == [x + [1] for x in theirs]
    assert list(ours.texts(pa.array([None, ""], pa.string()))) == [word_tokens.END_BYTES] * 2


def test_merge_counts_equal_the_library(texts):
    import sentencepiece

    ours, theirs = token_counts.MergeCounts(token_counts.vocabulary_path()), sentencepiece.SentencePieceProcessor(model_file=token_counts.vocabulary_path())
    assert [ours.text(t) for t in texts] == [len(x) for x in theirs.encode(texts, num_threads=1)]


@pytest.mark.parametrize("n", [0, 1, 5, 1023, 1024, 1025, 4000])
@pytest.mark.parametrize("top", [1, 40, 65_000, 2**31, 2**64 - 1])
def test_simple8b_round_trip(n, top):
    r = random.Random(n)
    ids = np.array([r.randint(0, top) if r.random() < 0.5 else r.randint(0, 1) for _ in range(n)], np.uint64)
    words, offsets = token_file.encode(ids)
    assert (token_file.decode(words, offsets, n) == ids).all()
    for k in range(len(offsets) - 1):
        assert (token_file.decode_block(words, offsets, n, k) == ids[k * token_file.BLOCK : (k + 1) * token_file.BLOCK]).all()


def test_file_bytes_round_trip():
    parts = [np.array(x, "<u4").tobytes() for x in ([5, 1], [1], [49_000] * 3000 + [1])]
    ids, lengths, tokens = token_file.unpack_file(token_file.pack_file([None, 7, 7], parts))
    assert ids == [None, 7, 7] and lengths.tolist() == [2, 1, 3001] and tokens.tobytes() == b"".join(parts)


@pytest.mark.parametrize(("n", "low", "high"), [(0, 1, 2), (1, 4096, 4096), (800, 1, 4096), (3000, 1, 900), (600, 900, 2500)])
def test_packing(n, low, high):
    r = random.Random(n)
    lengths = [r.randint(low, high) for _ in range(n)]
    of, offset = packing.pack(lengths, 4096)
    bins = {}
    for k, b in enumerate(of):
        bins.setdefault(b, []).append((offset[k], lengths[k]))
    for mine in bins.values():
        at = 0
        for o, size in sorted(mine):
            assert o == at
            at += size
        assert at <= 4096
    assert len(bins) <= -(-sum(lengths) // 4096) * (1.01 if high < 2000 else 1.06) + 1


@pytest.mark.parametrize(("n", "low", "high"), [(900, 600, 2500), (700, 1000, 1600), (1500, 1, 4096)])
def test_the_querys_patience_costs_few_bins(n, low, high):
    """What the query uses, against a search without that end and against best fit alone."""
    import inspect

    r = random.Random(n)
    lengths, used = [r.randint(low, high) for _ in range(n)], inspect.signature(packing.pack_documents).parameters["patience"].default
    alone, default, whole = (len(set(packing.pack(lengths, 4096, p)[0])) for p in (0, used, None))
    assert used == 256 and whole <= default <= alone and default <= 1.005 * whole + 1
    if high < 3000:
        assert default < alone


def test_a_search_goes_on_after_its_arrays_are_made_anew(monkeypatch):
    r = random.Random(5)
    lengths = [r.randint(900, 1700) for _ in range(300)]
    found = {}
    for recent in (0, 2, 64):
        monkeypatch.setattr(packing, "RECENT", recent)
        of, _ = packing.pack(lengths, 4096)
        fills = np.bincount(of, lengths)
        assert fills.max() <= 4096 and fills.sum() == sum(lengths)
        found[recent] = len(fills)
    assert max(found.values()) - min(found.values()) <= 2


def test_block_maxima_skip_most_blocks():
    """Neighbours are those of all cosines, and at least half of the blocks are never read."""
    rng = random.Random(12)
    topics = [[f"t{k}w{j}" for j in range(40)] for k in range(40)]
    common = [f"c{j}" for j in range(60)]

    def text(k):
        return " ".join(rng.choice(topics[k]) if rng.random() < 0.5 else rng.choice(common) for _ in range(60))

    examples = [(i, text(i % 40), int(i % 40 < 8)) for i in range(1600)]
    index = toxicity.BlockMaxIndex(examples, 25, 1.0, 0.5)
    vectors = [dict(zip(*(x.tolist() for x in index.vector(Counter(toxicity.words(t)))))) for _, t, _ in examples]
    for k in range(40):
        terms, weights = index.vector(Counter(toxicity.words(text(k))))
        near = index.nearest(terms, weights)
        cosines = [round(sum(w * v.get(t, 0.0) for t, w in zip(terms.tolist(), weights.tolist())), 9) for v in vectors]
        best = sorted(cosines, reverse=True)[:25]
        assert [round(c, 9) for c, _ in near] == pytest.approx(best) and all(cosines[d] == pytest.approx(c) for c, d in near)
    assert 0 < index.blocks_read <= index.blocks_asked / 2


def test_local_search_empties_a_bin():
    bins = packing.Bins([6, 5, 5, 4, 4, 4, 2], 10)
    bins.items, bins.fill = [[0], [1, 3], [2, 4], [5, 6]], [6, 9, 9, 6]
    for b in range(4):
        bins._list(b)
    bins.improve()
    assert sum(map(bool, bins.items)) == 3 and sorted(i for x in bins.items for i in x) == list(range(7))


def _distance(p, t):
    prev = [0] * (len(t) + 1)
    for i in range(1, len(p) + 1):
        cur = [i]
        for j in range(1, len(t) + 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (p[i - 1] != t[j - 1])))
        prev = cur
    return min(prev), prev.index(min(prev))


def test_myers_equals_dynamic_programming():
    r = random.Random(2)
    for _ in range(1500):
        p, t = "".join(r.choices("ab", k=r.randint(1, 9))), "".join(r.choices("abc", k=r.randint(0, 14)))
        if _distance(p, t)[0] < len(p):
            assert decontaminate.myers(p, t, 99) == _distance(p, t)


def test_planted_passages(sf, texts):
    r, items = random.Random(3), [(x["item_id"], x["text"]) for x in pq.read_table(f"{sf}/benchmark.parquet").to_pylist()]
    search, docs = decontaminate.Searcher(items, 0.1, 50), []
    for d in texts[:120]:
        item = r.choice(items)
        x = list(item[1])
        for _ in range(int(len(x) * r.choice([0, 0.03, 0.06, 0.09, 0.13]))):
            p = r.randrange(len(x))
            x[p : p + 1] = r.choice([[], ["é"], [x[p], "z"]])
        docs.append((f"{d} {''.join(x).upper() if r.random() < 0.2 else ''.join(x)} {d}", item))
    for (text, (i, item)), found in zip(docs, search.find(pa.array([t for t, _ in docs])), strict=True):
        pattern = decontaminate.plain(item)
        want = decontaminate.myers(pattern, decontaminate.plain(text), math.floor(0.1 * len(pattern)))
        got = {m[0]: m for m in found}.get(i)
        assert (want is None) == (got is None)
        if want:
            assert got[1] == want[0]
            assert abs(len(decontaminate.plain(text[got[2] : got[3]])) - len(pattern)) <= want[0]


def test_perfect_hash():
    r = random.Random(4)
    keys = np.array([[r.getrandbits(64), r.getrandbits(64)] for _ in range(3000)], np.uint64)
    table = line_dedup.PerfectHash(keys[:2000, 0], keys[:2000, 1], np.arange(2000), np.arange(2000))
    found = table.find(keys[:, 0], keys[:, 1])
    assert sorted(found[:2000].tolist()) == list(range(2000)) and (table.counts[found[:2000]] == np.arange(2000)).all() and (found[2000:] == -1).all()


def test_word_hashes(texts):
    seen = {}
    for t, h in zip(texts, word_hashes.word_hashes(pa.array(texts)), strict=True):
        words = t.encode().lower().split()
        assert len(words) == len(h)
        assert all(seen.setdefault(w, x) == x for w, x in zip(words, h.tolist(), strict=True))
    assert len(set(seen.values())) == len(seen)


def test_tree_finds_every_link():
    r = random.Random(6)
    sets = []
    for _ in range(300):
        base = [r.getrandbits(64) for _ in range(r.randint(1, 90))] if not sets or r.random() < 0.3 else list(r.choice(sets))
        for _ in range(r.randint(0, 6)):
            base[r.randrange(len(base))] = r.getrandbits(64)
        sets.append(np.unique(np.array(base, np.uint64)))
    tree = ngram_jaccard.RTree(np.stack([ngram_jaccard.point(s) for s in sets]), np.array([len(s) for s in sets]), 80)
    for i, a in enumerate(sets):
        found = set(tree.search(i).tolist())
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                assert j in found


def test_log_bloom_levels():
    r = np.random.default_rng(1)
    keys, counts = r.integers(0, 2**40, 5000).astype(np.uint64), r.integers(1, 2000, 5000)
    bloom = lm_scoring.LogBloom(1, {0: lm_scoring.LogBloom.segment(keys, lm_scoring.levels_of(counts), 16)})
    of = np.zeros(5000, np.int64)
    got, want = bloom.levels(of, keys), np.floor(np.log2(counts)) + 1
    assert (got >= want).all() and (got == want).mean() > 0.99
    assert (bloom.levels(of, r.integers(0, 2**40, 5000).astype(np.uint64)) == 0).mean() > 0.99


def test_short_keys():
    keys = np.array([0, 1, 2**40 - 1, 12345678901], np.uint64)
    raw = lm_scoring._short(keys)
    assert len(raw) == 20 and (lm_scoring._long(pa.py_buffer(raw)) == keys).all()


@pytest.mark.parametrize("contrast", [0.0, 0.5, 1.0])
def test_block_max_index_is_exact(contrast):
    r = random.Random(7)
    vocabulary = [f"w{k}" for k in range(40)]
    examples = [(k, " ".join(r.choices(vocabulary, k=12)) + (" vile" if k % 7 == 0 and r.random() < 0.8 else ""), int(k % 7 == 0)) for k in range(500)]
    index = toxicity.BlockMaxIndex(examples, k=5, prior=1.0, contrast=contrast)
    vectors = [dict(zip(*(x.tolist() for x in index.vector(Counter(toxicity.words(x)))), strict=True)) for _, x, _ in examples]
    for text in (examples[3][1], "vile", "w1 w2 vile vile", "w5 w9 w11", " ".join(vocabulary), "w1 unknown"):
        q = index.vector(Counter(toxicity.words(text)))
        mine = dict(zip(*(x.tolist() for x in q), strict=True))
        every = sorted((-round(sum(w * mine.get(t, 0) for t, w in v.items()), 12), d) for d, v in enumerate(vectors))
        want = [(-c, d) for c, d in every if c < 0][:5]
        assert [(pytest.approx(c, abs=1e-9), d) for c, d in want] == index.nearest(*q)
    if contrast:
        assert index.score("vile")[0] > 0.6 > index.score("w1 w2")[0]
    assert index.score("nothing") == index.score(None) == (pytest.approx(index.base), [])


def test_logistic_without_both_labels():
    model = site_quality.Logistic(np.zeros((0, 14)), np.zeros(0))
    assert model.evidence(np.array([site_quality.features(t) for t in ("", None, "a b")])).tolist() == [0.0] * 3
