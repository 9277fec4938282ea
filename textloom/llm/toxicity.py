"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Examples are a bounded sample of labelled rows (``max_examples``, those of the lowest hash of
their id); every third one is kept back for calibration. All words of the others are terms. A
term's weight in a text is (1 + log tf) idf G^contrast: G is the likelihood ratio of the term and
the label over the indexed examples (at least ``floor``), so no term is left out, and those that
say something about the label count more; a ``contrast`` of 0 is plain TF-IDF, under which
thousands of neutral words drown the few that matter. Vectors are over whole texts, of length 1.

Examples lie in an inverted index cut into blocks of ``BLOCK``, alike ones together; each term
knows its largest weight in every block. A query takes blocks in order of the bound that these
give, in growing groups, and ends when no block left can better its k-th neighbour; of a group only
blocks that can are read, so the neighbours are exact. Votes are weighted by closeness (squared cosine) and shrunk towards the examples' base
rate by ``prior`` votes; a logistic curve fitted to the votes of the examples kept back makes the
score a probability. The neighbours' ids are the evidence.

Cases: a null or empty text, or one without any known term, has no neighbours: its vote is the
base rate. Labels other than 0 and 1 and nulls are left out. Without examples every score is 0.
Where the examples kept back have but one label, the vote is the score. Ties in cosine go to the
lower place in the sample. Repeated rows are scored alike. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 8
#: Blocks that a search reads first, for a least score; each further group has four times as many.
FIRST = 12
#: ASCII characters that are no letter or digit part words.
PARTS = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))
#: Texts whose scores a worker remembers.
REMEMBERED = 20_000


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(PARTS).split()


def likelihood_ratios(held: np.ndarray, toxic: np.ndarray, n: int, n1: int) -> np.ndarray:
    """G of each term: ``held`` of ``n`` examples have it, ``toxic`` of the ``n1`` toxic ones."""
    cells = [(toxic, held * (n1 / n)), (held - toxic, held * ((n - n1) / n)), (n1 - toxic, (n - held) * (n1 / n)), (n - n1 - held + toxic, (n - held) * ((n - n1) / n))]
    with np.errstate(divide="ignore", invalid="ignore"):
        return 2 * sum(np.where(o > 0, o * np.log(o / e), 0.0) for o, e in cells)


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the stretches that begin at ``starts``, one stretch after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class BlockMaxIndex:
    """Examples' unit vectors by term, with each term's largest weight in each block."""

    def __init__(self, examples: list[tuple[int, str, int]], k: int, prior: float, contrast: float, floor: float = 1.0) -> None:
        bags = [Counter(words(text)) for _, text, _ in examples]
        self.k, self.prior = k, prior
        self.ids = np.array([i for i, _, _ in examples], np.int64)
        self.labels = np.array([y for _, _, y in examples], float)
        self.base = float(self.labels.mean()) if examples else 0.0
        self.curve = (0.0, 1.0)
        self.terms: dict[bytes, int] = {}
        for bag in bags:
            for t in bag:
                self.terms.setdefault(t, len(self.terms))
        of = [np.array([self.terms[t] for t in bag], np.int64) for bag in bags]
        held = np.bincount(np.concatenate([*of, np.zeros(0, np.int64)]), minlength=len(self.terms)).astype(float)
        toxic = np.bincount(np.concatenate([*(x for x, y in zip(of, self.labels, strict=True) if y), np.zeros(0, np.int64)]), minlength=len(self.terms))
        n, n1 = len(bags), int(self.labels.sum())
        ratios = np.maximum(floor, likelihood_ratios(held, toxic, n, n1)) if 0 < n1 < n else np.ones(len(held))
        self.weights = np.log1p(n / np.maximum(held, 1)) * ratios**contrast
        vectors = [self.vector(bag) for bag in bags]
        heaviest = [int(t[np.argmax(w)]) if len(t) else -1 for t, w in vectors]
        self.place = np.lexsort((np.arange(n), heaviest, self.labels)) if n else np.zeros(0, np.int64)  # alike examples share blocks
        self.blocks = -(-n // BLOCK)
        term = np.concatenate([*(vectors[p][0] for p in self.place), np.zeros(0, np.int64)])
        weight = np.concatenate([*(vectors[p][1] for p in self.place), np.zeros(0)])
        doc = np.repeat(np.arange(n), [len(vectors[p][0]) for p in self.place])
        order = np.lexsort((doc, term))
        term, self.doc, self.weight = term[order], doc[order], weight[order]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(term)), bool), (term[1:] != term[:-1]) | (self.doc[1:] // BLOCK != self.doc[:-1] // BLOCK))))
        self.start, self.size = first, np.diff(np.concatenate((first, [len(term)])))
        self.block = self.doc[first] // BLOCK
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self.of_term = np.searchsorted(term[first], np.arange(len(self.terms) + 1))
        self.blocks_asked = self.blocks_read = 0
        self.seen: dict[bytes, tuple[float, list[int]]] = {}

    def vector(self, bag: Counter) -> tuple[np.ndarray, np.ndarray]:
        """The text's known terms, in order, and their weights."""
        size = len(bag)
        t = np.fromiter(map(self.terms.get, bag, repeat(-1)), np.int64, size)
        raw = (1 + np.log(np.fromiter(bag.values(), float, size))) * self.weights[t] if len(self.weights) else np.zeros(size)
        known = np.flatnonzero(t >= 0)
        known = known[np.argsort(t[known])]
        t, raw = t[known], raw[known]
        return t, raw / math.sqrt(float((raw * raw).sum()) or 1.0)

    def nearest(self, terms: np.ndarray, weights: np.ndarray) -> list[tuple[float, int]]:
        """The k examples of the largest cosine, exactly: (cosine, place in the sample)."""
        if not len(terms) or not self.blocks:
            return []
        sizes = self.of_term[terms + 1] - self.of_term[terms]
        entries, w = spans(self.of_term[terms], sizes), np.repeat(weights, sizes)
        blocks = self.block[entries]
        bound = np.bincount(blocks, w * self.most[entries], self.blocks)
        order = np.argsort(-bound, kind="stable")
        order, best, at, step = order[bound[order] > 0], [], 0, FIRST
        self.blocks_asked += len(order)
        while at < len(order) and (len(best) < self.k or bound[order[at]] >= best[-1][0] - 1e-9):
            some = order[at : at + step]
            if len(best) == self.k:  # the others of the group cannot better it either
                some = some[bound[some] >= best[-1][0] - 1e-9]
            best = sorted([*best, *self._scored(entries, w, blocks, some)], key=lambda x: (-x[0], x[1]))[: self.k]
            self.blocks_read += len(some)
            at, step = at + step, 4 * step
        return best

    def _scored(self, entries: np.ndarray, w: np.ndarray, blocks: np.ndarray, chosen: np.ndarray) -> list[tuple[float, int]]:
        """The best examples of the chosen blocks."""
        inside = np.zeros(self.blocks, bool)
        inside[chosen] = True
        mine = inside[blocks]
        e = entries[mine]
        posts = spans(self.start[e], self.size[e])
        return self._best(np.bincount(self.doc[posts], self.weight[posts] * np.repeat(w[mine], self.size[e]), len(self.place)))

    def _best(self, scores: np.ndarray) -> list[tuple[float, int]]:
        found = np.flatnonzero(scores > 0)
        scores = np.round(scores[found], 12)
        if len(found) > self.k:  # those of at least the k-th score, ties included
            some = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            found, scores = found[some], scores[some]
        return sorted(zip(scores.tolist(), self.place[found].tolist(), strict=True), key=lambda x: (-x[0], x[1]))[: self.k]

    def vote(self, bag: Counter) -> tuple[float, list[int]]:
        """The share of toxic votes, and the ids of the neighbours that they come from."""
        near = self.nearest(*self.vector(bag))
        votes = sum(c * c for c, _ in near)
        toxic = sum(c * c * self.labels[d] for c, d in near)
        return (float((toxic + self.prior * self.base) / (votes + self.prior)) if votes + self.prior else 0.0), [int(self.ids[d]) for _, d in near]

    def calibrate(self, kept_back: list[tuple[int, str, int]]) -> BlockMaxIndex:
        """Fits the logistic curve from votes to labels (Newton's method, a light pull to the identity)."""
        y = np.array([label for _, _, label in kept_back], float)
        if not len(y) or not 0 < y.mean() < 1:
            return self
        x = np.array([self.log_odds(self.vote(Counter(words(t)))[0]) for _, t, _ in kept_back])
        z, b = np.stack((np.ones(len(x)), x), axis=1), np.array([0.0, 1.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
            ridge = np.diag([1e-1, 1e-1])
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ (b - np.array([0.0, 1.0])))
            b = b + step
            if np.abs(step).max() < 1e-9:
                break
        if b[1] > 0:  # else the votes say nothing, and stay as they are
            self.curve = float(b[0]), float(b[1])
        return self

    @staticmethod
    def log_odds(vote: float) -> float:
        vote = min(max(vote, 1e-6), 1 - 1e-6)
        return math.log(vote / (1 - vote))

    def score(self, text: str | None) -> tuple[float, list[int]]:
        if not len(self.ids):
            return 0.0, []
        bag = Counter(words(text))
        key = hash(frozenset(bag.items())).to_bytes(8, "little", signed=True) + len(bag).to_bytes(4, "little")
        if key not in self.seen:
            vote, near = self.vote(bag)
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            self.seen[key] = vote if self.curve == (0.0, 1.0) else 1 / (1 + math.exp(-max(-30.0, min(30.0, self.curve[0] + self.curve[1] * self.log_odds(vote))))), near
        return self.seen[key]


def labelled_examples(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_examples: int = 3072, max_example_bytes: int = 48 << 20
) -> list[tuple[int, str, int]]:
    """At most ``max_examples`` rows (id, text, label) of ``max_example_bytes`` of text in all: of
    those that ``learn`` allows, the ones of the lowest hash."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & learn).distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_examples)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    by = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("text"), F.col("label")]
    rows = texts.join(F.broadcast(known), "doc_id").orderBy(*by).limit(max_examples)  # at most max_examples ids
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).over(Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, 0))  # max_examples rows
    return [(r.doc_id, r.text, r.label) for r in rows.withColumn("size", size).where(F.col("size") <= max_example_bytes).select("doc_id", "text", "label").collect()]


def trained(examples: list[tuple[int, str, int]], k: int, prior: float, contrast: float) -> BlockMaxIndex:
    """An index of two thirds of the examples, calibrated on the others."""
    return BlockMaxIndex([x for n, x in enumerate(examples) if n % 3], k, prior, contrast).calibrate(examples[::3])


def toxicity(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", k: int = 25, prior: float = 1.0, contrast: float = 0.5, max_examples: int = 3072, max_example_bytes: int = 48 << 20
) -> DataFrame:
    """doc_id, score, evidence (ids of the neighbours) of every text.

    learn: a condition on ``doc_id`` that the examples meet. prior: votes of the base rate.
    """
    examples = labelled_examples(docs, labels, learn, id_col, text_col, label_col, max_examples, max_example_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(trained(examples, k, prior, contrast))  # bounded by max_example_bytes

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for b in batches:
            got = [index.score(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s for s, _ in got], pa.float64()), pa.array([e for _, e in got], pa.list_(pa.int64()))], names=["doc_id", "score", "evidence"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(score, "doc_id long, score double, evidence array<long>")
