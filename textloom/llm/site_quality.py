"""Document quality from a document classifier and hierarchical empirical Bayes over sites.

A logistic regression over shape features of the text (no vocabulary) is fitted on a bounded
sample of labelled rows (``max_examples``, those of the lowest hash of their id) and gives each
document evidence. Expected good documents are then summed by (host, path) and by host: a host's
rate is shrunk towards the global one, a path's towards its host's, each with a strength that
the spread of the groups' rates itself gives (method of moments), so sparse sites stay near
their parents. A document's posterior is its own evidence with its path's rate as prior; both
rates are those of the other documents, so its evidence counts once.

Cases: a null or empty text has features of zeros, so its evidence is the model's constant. A
null host or path is a group of its own. Labels other than 0 and 1 and nulls are left out;
without labels of both kinds every document's evidence is 0 and its score its site's rate, 0.5.
Repeated rows are scored alike and count as often as they occur. An empty table gives an empty
result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SYMBOLS = b"#*$%&|<>{}[]\\^~_=+@"
STRENGTHS = (1.0, 10_000.0)


def features(text: str | None) -> list[float]:
    """Shape of a text: sizes, shares of kinds of characters, repetition of words and lines."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * 14
    size, lines = len(raw), [x for x in raw.split(b"\n") if x.strip()]
    upper = sum(map(raw.count, (bytes([c]) for c in range(65, 91)))) if size < 64 else size - len(raw.translate(None, bytes(range(65, 91))))
    letters = size - len(raw.translate(None, bytes([*range(65, 91), *range(97, 123), *range(128, 256)])))
    symbols = size - len(raw.translate(None, SYMBOLS))
    marks = size - len(raw.translate(None, b"!?"))
    stops = size - len(raw.translate(None, b".,;:"))
    digits = size - len(raw.translate(None, b"0123456789"))
    twice = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        float(np.log(n)),
        (size - n + 1) / n / 10,
        upper / max(letters, 1),
        symbols / size * 10,
        marks / n,
        stops / n,
        digits / size * 10,
        twice / n,
        len(set(words)) / n,
        float(np.log(n)) * len(set(words)) / n,
        1 - len(set(lines)) / max(len(lines), 1),
        raw.count(b"|") / n,
        len(lines) / n * 10,
        float(letters / size < 0.6),
    ]


class Logistic:
    """A ridge logistic regression by Newton's method over standardised features and squares."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> None:
        self.mean, self.scale = np.zeros(x.shape[1]), np.ones(x.shape[1])
        self.weights = np.zeros(2 * x.shape[1] + 1)
        self.base = 0.5
        if len(y) and 0 < y.mean() < 1:
            self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
            self.base = float(y.mean())
            z, keep = self._wide(x), np.full(len(self.weights), ridge)
            keep[0] = 1e-9
            for _ in range(30):
                p = 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))
                step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(keep), z.T @ (y - p) - keep * self.weights)
                self.weights += step
                if np.abs(step).max() < 1e-8:
                    break

    def _wide(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.concatenate((np.ones((len(z), 1)), z, z * z), axis=1)

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """The log odds of a good text less those of any text."""
        return np.clip(self._wide(x) @ self.weights, -30, 30) - np.log(self.base / (1 - self.base))


def _sampled(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str, text_col: str, label_col: str, max_examples: int) -> tuple[np.ndarray, np.ndarray]:
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & learn).distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_examples)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(known), "doc_id")  # at most max_examples ids

    def shape(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([features(t.as_py()) for t in b.column(2)], pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    got = rows.select("doc_id", "label", "text").mapInArrow(shape, "doc_id long, label int, x array<double>").orderBy(F.xxhash64("doc_id"), "doc_id", "label", "x").limit(max_examples).collect()
    return np.array([r.x for r in got]).reshape(-1, 14), np.array([r.label for r in got], float)


def _strength(groups: DataFrame, n: str, rate: str, parent: str) -> float:
    """How many documents a parent's rate is worth, from the spread of its groups' rates."""
    r = groups.agg(F.avg(F.pow(F.col(rate) - F.col(parent), 2)).alias("v"), F.avg(F.col(parent) * (1 - F.col(parent))).alias("b"), F.avg(F.col(parent) * (1 - F.col(parent)) / F.col(n)).alias("s")).first()
    if r.v is None or r.v <= r.s:
        return STRENGTHS[1]
    return float(min(STRENGTHS[1], max(STRENGTHS[0], r.b / (r.v - r.s) - 1)))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and first folder of a URL (of ``pages``, say), as ``host_col`` and ``path_col`` take them."""
    return F.lower(F.try_parse_url(url, F.lit("HOST"))), F.element_at(F.split(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("/")), "/"), 2)


def site_quality(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", label_col: str = "quality", threshold: float = 0.5, max_examples: int = 20_000
) -> DataFrame:
    """doc_id, evidence, host_rate, path_rate, score, kept of every row. learn: a condition on ``doc_id``."""
    model = Logistic(*_sampled(docs, labels, learn, id_col, text_col, label_col, max_examples))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t.as_py()) for t in b.column(3)]).reshape(-1, 14)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(3)), pa.array(model.evidence(x))], names=["doc_id", "host", "path", "evidence"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path"), F.col(text_col))
    rows = written(rows.mapInArrow(weigh, "doc_id long, host string, path string, evidence double"), "evidence")
    prior = F.lit(float(np.log(model.base / (1 - model.base))))
    sure = 1 / (1 + F.exp(-(F.col("evidence") + prior)))
    paths = written(rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(sure).alias("good")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    every = hosts.agg(F.sum("host_good") / F.sum("host_n")).first()[0]
    every = model.base if every is None else float(every)
    hosts = hosts.withColumn("raw", F.col("host_good") / F.col("host_n")).withColumn("all", F.lit(every))
    k = _strength(hosts, "host_n", "raw", "all")
    shrunk = lambda good, n, k, parent: (good + k * parent) / (n + k)
    hosts = hosts.withColumn("rate", shrunk(F.col("host_good"), F.col("host_n"), k, F.lit(every))).select(F.col("host").alias("of_host"), "host_n", "host_good", "rate")
    paths = paths.join(hosts, F.col("host").eqNullSafe(F.col("of_host"))).withColumn("raw", F.col("good") / F.col("n"))
    j = _strength(paths, "n", "raw", "rate")
    paths = paths.select(F.col("host").alias("of_host"), F.col("path").alias("of_path"), "host_n", "host_good", "n", "good")
    out = rows.join(paths, F.col("host").eqNullSafe(F.col("of_host")) & F.col("path").eqNullSafe(F.col("of_path")))
    out = out.withColumn("host_rate", shrunk(F.col("host_good") - sure, F.col("host_n") - 1, k, F.lit(every)))
    out = out.withColumn("path_rate", shrunk(F.col("good") - sure, F.col("n") - 1, j, F.col("host_rate")))
    safe = F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), F.col("path_rate")))
    score = 1 / (1 + F.exp(-(F.col("evidence") + F.log(safe / (1 - safe)))))
    return out.select("doc_id", "evidence", "host_rate", "path_rate", score.alias("score"), (score >= threshold).alias("kept"))
