"""Folds in chunks against plain loops."""

import random

import pytest

from textloom.operators import folds


def patience_loop(values, delta):
    best, bad, out = float("inf"), -1, []
    for v in values:
        best, bad = (v, 0) if v < best - delta else (best, bad + 1)
        out.append((best, bad))
    return out


def row_loop(values, share, falling):
    out, bad = [], 0
    for k, v in enumerate(values):
        before = values[k - 1] if k else 0
        change = (before - v if falling else v - before) / before if before else 0
        bad = bad + 1 if change > share else 0
        out.append(bad)
    return out


def test_functions_compose():
    rng = random.Random(4)
    for _ in range(3000):
        delta, n = rng.choice((0.0, 0.5, 2.0)), rng.randint(1, 40)
        values = [rng.choice((rng.randint(0, 8), rng.uniform(0, 8), 20 - k)) for k in range(n)]
        cuts = sorted({0, n, *(rng.randrange(n) for _ in range(rng.randint(0, 5)))})
        state = (float("inf"), -1)
        for a, b in zip(cuts, cuts[1:]):
            state = folds.patience_after(folds.patience_function(values[a:b], delta), b - a, delta, *state)
            assert state == patience_loop(values[:b], delta)[-1]


def series(rng):
    return {"hot": [round(rng.uniform(0, 100), 2) for _ in range(700)], "down": [100.0 - k / 4 for k in range(90)], None: [3.0, 3.0, 1.0], "one": [0.0]}


@pytest.mark.parametrize(("delta", "chunk"), [(0.0, 1 << 18), (5.0, 50), (0.7, 7)])
def test_patience_of_a_split_series(spark, delta, chunk):
    data = series(random.Random(6))
    rows = [(g, k, v, "x") for g, vs in data.items() for k, v in enumerate(vs)] + [("hot", 10**6, None, "x")]
    df = spark.createDataFrame(rows, "name string, step int, value double, best string").repartition(3)
    got = {}
    for r in folds.patience(df, "name", ["step"], "value", delta, chunk=chunk).collect():
        assert r.own.best == "x"
        got.setdefault(r.own.name, {})[r.own.step] = (r.best, r.bad)
    assert {g: [x[k] for k in sorted(x)] for g, x in got.items()} == {g: patience_loop(vs, delta) for g, vs in data.items()}


@pytest.mark.parametrize(("share", "falling", "chunk"), [(0.0, True, 1 << 18), (0.1, True, 11), (0.2, False, 5)])
def test_falls_in_a_row_of_a_split_series(spark, share, falling, chunk):
    data = series(random.Random(7))
    df = spark.createDataFrame([(g, k, v) for g, vs in data.items() for k, v in enumerate(vs)], "name string, step int, value double").repartition(3)
    got = {}
    for r in folds.in_a_row(df, "name", ["step"], "value", share, falling, chunk).collect():
        got.setdefault(r.own.name, {})[r.own.step] = r.bad
    assert {g: [x[k] for k in sorted(x)] for g, x in got.items()} == {g: row_loop(vs, share, falling) for g, vs in data.items()}


def test_no_rows(spark):
    assert folds.patience(spark.createDataFrame([], "name string, step int, value double"), "name", ["step"], "value").count() == 0
