"""Semantic duplicates against all pairs of vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import vectors


def test_groups_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    rows, base = [], rng.standard_normal((150, 32))
    for v in base:
        for _ in range(rng.integers(1, 6)):
            rows.append(v + rng.choice([0.0, 0.05, 0.15, 0.25]) * rng.standard_normal(32))
    e = np.array(rows) * rng.uniform(0.1, 9, (len(rows), 1))
    order = rng.permutation(len(e))
    e = e[order]
    data = [(k, v.tolist(), "x") for k, v in enumerate(e)] + [(9000, e[3].tolist(), "x"), (9001, None, "x"), (9002, [], "x"), (9003, [0.0] * 32, "x"), (9004, [None, 1.0], "x"), (None, e[0].tolist(), "x")]
    got = {r.doc: r for r in vectors.groups(spark.createDataFrame(data, "vec_id long, embedding array<double>, same string"), threshold=0.95).collect()}
    unit = e / np.linalg.norm(e, axis=1, keepdims=True)
    near, root = unit @ unit.T >= 0.95, list(range(len(e)))
    for k in range(len(e)):  # least id that can be reached
        seen, todo = {k}, [k]
        while todo:
            for j in np.flatnonzero(near[todo.pop()]).tolist():
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        root[k] = min(seen)
    later = [k for k in range(len(e)) if root[k] != k]
    assert all(root[got[k].first] == root[k] and got[k].first <= k for k in range(len(e)))  # none joined wrongly
    assert len(later) > 100 and sum(got[k].first == root[k] for k in later) >= 0.9 * len(later)
    assert got[9000].first == got[3].first and got[9000].copies >= 2
    assert [got[k].first for k in (9001, 9002, 9003, 9004)] == [9001, 9002, 9003, 9004] and None not in got


def test_bands_grow_with_the_table():
    small, large = vectors.bands_for(1000, 0.95, 0.9), vectors.bands_for(10**9, 0.95, 0.9)
    assert small[0] < large[0] == 28 and small[1] < large[1] < 60
    side = 1 - np.arccos(0.95) / np.pi
    for bits, bands in (small, large):
        assert 1 - (1 - side**bits) ** bands >= 0.9


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_vectors(spark, n):
    df = spark.range(n).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    assert [(r.first, r.copies) for r in vectors.groups(df).collect()] == [(0, n)] * n


def test_all_links_at_the_threshold_are_found(spark):
    """A chain in which each vector is just within the threshold of the next alone, through small tiles."""
    step = np.arccos(0.95) - 1e-7
    rows = [(k, [float(np.cos(k * step)), float(np.sin(k * step))] + [0.0] * 14) for k in range(9)]
    rows += [(100 * c + k, [0.0] * (2 + c) + [float(np.cos(k * step)), float(np.sin(k * step))]) for c in range(1, 13) for k in range(4)]
    apart = np.arccos(0.95) + 1e-7
    rows += [(5000 + k, [0.0] * 14 + [-float(np.cos(k * apart)), -float(np.sin(k * apart))]) for k in range(4)]
    got = {r.doc: r.first for r in vectors.groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert [got[k] for k in range(9)] == [0] * 9 and [got[5000 + k] for k in range(4)] == [5000 + k for k in range(4)]
    nodes = vectors.units(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    found = vectors.connected_components(vectors.linked_pairs(nodes, len(rows), 16, 0.95, tile=64)).collect()
    assert {r.node: r.root for r in found} == {d: f for d, f in got.items() if d < 5000}


def test_a_cluster_gives_a_forest(spark):
    rng = np.random.default_rng(5)
    rows = [(k, (np.ones(8) + 0.01 * rng.standard_normal(8)).tolist()) for k in range(3000)]
    nodes = vectors.units(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    edges = vectors.linked_pairs(nodes, 3000, 8, 0.95)
    assert edges.count() <= 3000 * (vectors.LEAST_GROUPS + 1) and set(r.root for r in vectors.connected_components(edges).collect()) == {0}


def test_nearest_with_and_without_a_direction(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [2.0, 0.2]), (3, None), (100, [-1.0, 0.0]), (200, None)]

    def near(more):
        df = spark.createDataFrame(rows + more, "vec_id long, embedding array<double>")
        return {r.query_id: (r.cosine, r.vec_id) for r in vectors.nearest(df, df.where("vec_id % 100 = 0"), at_a_time=2).collect()}

    assert near([]) == {0: (0.995037, 1), 100: (-0.995037, 1), 200: (None, 0)}
    zero = near([(4, [0.0, 0.0])])
    assert {q: v for q, (_, v) in zero.items()} == {0: 4, 100: 4, 200: 0} and np.isnan(zero[0][0]) and zero[200][0] is None
