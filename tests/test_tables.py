"""Folder digests, table functions and user callables."""

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
import pytest

from textloom.functions import tables
from textloom.operators import digests


def test_folder_digests(spark):
    files = [("a", f"f{k:03}", f"text {k}" if k % 7 else None) for k in range(200)] + [("b", "x", ""), ("b", "x", "y"), (None, "n", "t"), ("c", None, "t")]
    got = {r.folder: (r.files, r.checksum) for r in digests.folder_digests(spark.createDataFrame(files, "at string, name string, content string").repartition(5), "at", "name", "content").collect()}
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    lines = {at: sorted((n, sha(t)) for a, n, t in files if a == at and n) for at in ("a", "b")}
    assert got == {at: (len(x), sha("\n".join(f"{n}:{c}" for n, c in x))) for at, x in lines.items()}
    assert digests.folder_digests(spark.createDataFrame([], "at string, name string, content string"), "at", "name", "content").count() == 0


def test_table_function(spark):
    tables.register(spark)
    rows = spark.createDataFrame([(1, "c" * 101, "x"), (2, "c", None), (3, None, None)], "id int, comment string, code string")
    got = spark.sql("SELECT id, t.* FROM {r} r, LATERAL cat_tasks(r.comment, r.code) t", r=rows).collect()
    assert sorted(tuple(r) for r in got) == sorted(
        [(1, "comment_to_code", "c" * 101, "x"), (1, "code_to_comment", "x", "c" * 101), (1, "code_explanation", "x", "c" * 101), (2, "comment_to_code", "c", ""), (2, "code_to_comment", "", "c"), (3, "comment_to_code", "", ""), (3, "code_to_comment", "", "")]
    )


def test_user_callables(spark):
    df = spark.createDataFrame([(1, "a", "s"), (2, None, "t"), (3, "bbb", "u")], "id int, `te.xt` string, own string")
    kept = tables.keep(df, lambda t: pc.less(pc.utf8_length(t), 3), "te.xt")
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == [(1, "a", "s")]
    made = tables.apply(df, lambda i, t: pc.add(i, pc.fill_null(pc.utf8_length(t), 0)), "int", "own", "id", "te.xt")
    assert sorted(tuple(r) for r in made.collect()) == [(1, "a", 2), (2, None, 2), (3, "bbb", 6)] and made.columns == df.columns
    assert tables.keep(df.limit(0), lambda t: pc.is_valid(t), "own").count() == 0


def test_a_callable_of_the_wrong_length(spark):
    df = spark.range(9).coalesce(1)
    for wrong in (lambda: tables.keep(df, lambda i: pa.array([True]), "id"), lambda: tables.apply(df, lambda i: i[:1], "long", "x", "id")):
        with pytest.raises(Exception, match="for"):
            wrong().collect()
