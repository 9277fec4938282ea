"""Exact quantiles against numpy, with intervals that have to be narrowed."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import quantiles

PS = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]


def rows(kind):
    rng = np.random.default_rng(5)
    return {
        "even": rng.uniform(-1, 1, 6000),
        "tail": np.exp(rng.normal(0, 8, 5000)),
        "ties": np.concatenate((np.full(4000, 5.0), rng.uniform(4.9, 5.1, 2000), np.full(1500, 5.05))),
        "one": np.full(3000, -2.5),
        "powers": np.repeat(2.0 ** np.arange(-300, 300), 5),
        "few": np.array([3.0, 1.0]),
        "single": np.array([7.0]),
    }[kind]


@pytest.mark.parametrize("most", [1 << 20, 50])
def test_quantiles_equal_numpy(spark, most):
    kinds = ["even", "tail", "ties", "one", "powers", "few", "single"]
    data = [(None if k == "even" else k, float(v), "x") for k in kinds for v in rows(k)] + [("none", None, "x")] * 3 + [("few", None, "x")]
    df = spark.createDataFrame(data, "g string, v double, n string").repartition(5)
    got = {r["g"]: r for r in quantiles.quantiles(df, ["g"], "v", PS, most).collect()}
    assert len(got) == len(kinds) + 1 and got["none"]["n"] == 0 and got["none"]["p50"] is None
    for k in kinds:
        r, v = got[None if k == "even" else k], rows(k)
        assert r["n"] == len(v)
        assert [r[f"p{round(p * 100)}"] for p in PS] == pytest.approx(np.quantile(v, PS).tolist(), rel=1e-12)


def test_quantiles_of_all_rows_and_of_none(spark):
    df = spark.range(1001).select((F.col("id") * 3 % 1001).alias("v"))
    assert quantiles.quantiles(df, [], "v", [0.1, 0.5], 20).collect() == [(1001, 100.0, 500.0)]
    assert quantiles.quantiles(df.limit(0), [], "v", [0.5]).collect() == [(0, None)]
    assert quantiles.quantiles(df.limit(0).withColumn("g", F.lit(1)), ["g"], "v", [0.5]).count() == 0


def test_a_window_never_sees_more_than_its_bound(spark, monkeypatch):
    """What is ranked by one task is counted."""
    seen, ranked = [], quantiles._ranked

    def counted(values, ranks, keys):
        spans = ranks.select(*keys, "low", "high").distinct()
        seen.extend(r["count"] for r in quantiles._within(values, spans, keys).groupBy(*keys, "low", "high").count().collect())
        return ranked(values, ranks, keys)

    monkeypatch.setattr(quantiles, "_ranked", counted)
    df = spark.range(200_000).select((F.xxhash64("id") % 1_000_003).alias("v"))
    got = quantiles.quantiles(df, [], "v", [0.5, 0.95], 1000).collect()[0]
    v = np.sort(df.toPandas()["v"].to_numpy())
    assert (got.p50, got.p95) == (np.quantile(v, 0.5), pytest.approx(np.quantile(v, 0.95))) and 0 < max(seen) <= 1000
