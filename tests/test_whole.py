"""Queries over all rows, against plain Python on the tables."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from textloom.plans import catalog, pipelines


@pytest.mark.parametrize("at_a_time", [4096, 2])
def test_nearest_vectors_of_any_label(spark, sf, at_a_time):
    t = pq.read_table(f"{sf}/embeddings.parquet")
    ids, e, labels = t["vec_id"].to_numpy(), np.array(t["embedding"].to_pylist(), float), t["label"].to_numpy()
    e /= np.linalg.norm(e, axis=1, keepdims=True)
    got, other = {r.query_id: r for r in pipelines.dup5_all(spark, sf, at_a_time).collect()}, 0
    assert set(got) == set(ids[ids % 100 == 0].tolist())
    for q, r in got.items():
        cosine = e @ e[ids == q][0]
        cosine[ids == q] = -2
        assert r.cosine == pytest.approx(cosine.max(), abs=2e-6) and cosine[ids == r.vec_id][0] == pytest.approx(cosine.max(), abs=2e-6)
        other += labels[ids == r.vec_id][0] != labels[ids == q][0]
    assert other and "dup5_embedding_neighbors" in catalog.queries()


def test_whole_pairs_are_transformed(spark, sf):
    rows = sorted(pq.read_table(f"{sf}/conversations.parquet").to_pylist(), key=lambda r: (r["conv_id"], r["turn"]))
    want = []
    for a, b in zip(rows, rows[1:]):
        if a["conv_id"] == b["conv_id"] and (a["role"], b["role"]) == ("user", "assistant"):
            x, y = a["text"] or "", b["text"] or ""
            tasks = [("comment_to_code", x, y), ("code_to_comment", y, x)] + [("code_explanation", y, x)] * (len(x) > 100)
            want += [(a["conv_id"], a["turn"], *t) for t in tasks]
    got = [tuple(r) for r in catalog.queries()["prj9_cat_transform"](spark, sf).collect()]
    assert want and sorted(got) == sorted(want)


def test_all_events_are_sorted(spark, sf):
    rows = pq.read_table(f"{sf}/events.parquet").to_pylist()
    got = [r.event_id for r in catalog.queries()["srt1_by_time"](spark, sf).collect()]
    assert got == [r["event_id"] for r in sorted(rows, key=lambda r: (r["ts"], r["event_id"]))] and len(got) > 50


def test_sources_of_all_ids_are_subtracted(spark, tmp_path):
    docs = [(1, "en", "a"), (2, "en", "b"), (3, "en", "b"), (4, "es", "c"), (900, "es", "a")]
    spark.createDataFrame(docs, "doc_id long, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert [r.source for r in catalog.queries()["set4_except"](spark, str(tmp_path)).collect()] == ["b"]
