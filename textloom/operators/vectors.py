"""Vectors by their cosine: groups of those that reach a threshold, and the nearest to each of some queries.

For groups vectors are made units once, and equal ones are one node from the start, however many
there are. All pairs are compared: vectors are dealt into groups by hash, and each pair of groups
is a tile, which a task goes through in blocks of products in 32 bits. What is linked for certain is
joined in the tile, so it gives a forest of its links, not all pairs of a cluster; pairs as near to
the threshold as the products' error are verified by their exact cosine. Time grows with the square
of the number of vectors, a task's memory does not grow.

With ``recall`` an index of random projections is taken instead: a band's key is on which side of its
``bits`` hyperplanes a vector lies. Bits grow with the logarithm of the number of vectors, so a
key's bucket keeps about as many strangers at every size, and there are as many bands as find a
pair at the threshold with probability ``recall``. Candidates are verified by their exact cosine
against a bucket's hub (``near_duplicates.links``), never all pairs of a bucket.

Cases: a null vector, one without length and one of zeros have no direction; each is its own group. A
null component counts as 0; shorter vectors are filled with zeros. Rows that repeat an id are one
(its least vector); a null id is left out. An empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .components import connected_components
from .near_duplicates import links

#: Numbers of the vectors in a group of a tile, and tiles' groups at least; vectors in a block of products.
TILE, LEAST_GROUPS, BLOCK = 1 << 22, 8, 1024
#: Strangers that a bucket holds on average, for an even spread.
STRANGERS = 4


def bands_for(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits of a band, and how many bands, for n vectors."""
    side = 1 - math.acos(min(1.0, threshold)) / math.pi  # that a hyperplane does not part the two
    bits = max(1, math.ceil(math.log2(max(2, n) / STRANGERS)))
    chance = side**bits
    return bits, 1 if chance >= recall else math.ceil(math.log(1 - recall) / math.log(1 - chance))


def units(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """doc, set (the unit vector; null without a direction)."""
    rows = df.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc")).agg(F.min(F.transform(vector_col, lambda x: F.coalesce(x.cast("double"), F.lit(0.0)))).alias("e"))
    size = F.sqrt(F.aggregate("e", F.lit(0.0), lambda a, x: a + x * x))
    return rows.withColumn("size", size).select("doc", F.when(F.col("size") > 0, F.transform("e", lambda x: x / F.col("size"))).alias("set"))


def cosine(a: Column, b: Column) -> Column:
    """Of unit vectors."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.coalesce(x * y, F.lit(0.0))), F.lit(0.0), lambda s, x: s + x)


def matrix(column: pa.Array, width: int, dtype=np.float64) -> np.ndarray:
    """The vectors as rows, filled with zeros; null is zeros."""
    sizes = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(-1, width)
    out = np.zeros((len(column), width), dtype)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def join_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the trees of a[i] and b[i]; ``root`` has every item's root before and after."""
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := root[root], root):
            root[:] = up


def linked_pairs(nodes: DataFrame, n: int, width: int, threshold: float, tile: int = TILE) -> DataFrame:
    """u, v: forests of the links over all pairs of units. nodes: doc, set; n of them, at most width long."""
    groups = max(LEAST_GROUPS, -(-n * width // tile))
    error = (width + 8) * 2.0**-23

    def link(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, units_of, of = [], [], []
        for b in parts:
            ids.append(b.column("doc").to_numpy(zero_copy_only=False))
            units_of.append(matrix(b.column("set"), width, np.float32))
            of.append(b.column("own").to_numpy(zero_copy_only=False))
        of = np.concatenate(of)
        order = np.argsort(of, kind="stable")
        doc, m = np.concatenate(ids)[order], np.concatenate(units_of)[order]
        one = key[0].as_py() == key[1].as_py()
        cut = len(of) if one else int((of == of.min()).sum())
        first, second = (0, cut), ((0, cut) if one else (cut, len(of)))
        root, unsure = np.arange(len(doc)), []
        for i in range(*first, BLOCK):
            for j in range(i if one else second[0], second[1], BLOCK):
                products = m[i : min(i + BLOCK, first[1])] @ m[j : min(j + BLOCK, second[1])].T
                near = products >= threshold - error
                if near.any():
                    a, b = np.nonzero(near)
                    sure = products[a, b] >= threshold + error
                    join_roots(root, a[sure] + i, b[sure] + j)
                    unsure.append((a[~sure] + i, b[~sure] + j))
        below = np.flatnonzero(root != np.arange(len(root)))
        a, b = (np.concatenate(x) for x in zip(*unsure, strict=True)) if unsure else (below[:0], below[:0])
        apart = root[a] != root[b]
        u, v = np.concatenate((below, a[apart])), np.concatenate((root[below], b[apart]))
        yield pa.RecordBatch.from_arrays([pa.array(doc[u], pa.int64()), pa.array(doc[v], pa.int64()), pa.array(np.arange(len(u)) < len(below))], names=["u", "v", "sure"])

    own = F.pmod(F.xxhash64("doc"), F.lit(groups)).cast("int")
    dealt = nodes.select("doc", F.col("set").cast("array<float>").alias("set"), own.alias("own")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    tiles = dealt.groupBy(F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
    found = written(tiles.applyInArrow(link, "u long, v long, sure boolean"), "tiles")
    ends = [nodes.select(F.col("doc").alias(c), F.col("set").alias(f"{c}_set")) for c in ("u", "v")]
    judged = found.where("NOT sure").join(ends[0], "u").join(ends[1], "v").where(cosine(F.col("u_set"), F.col("v_set")) >= threshold)
    return found.where("sure").select("u", "v").unionByName(judged.select("u", "v"))


def band_keys(nodes: DataFrame, width: int, bits: int, bands: int, seed: int = 11) -> DataFrame:
    """doc, band, key. The planes are drawn again wherever they are needed, a band at a time."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = np.zeros((b.num_rows, width))
            for k, v in enumerate(b.column(1)):
                vectors[k, : len(v)] = v.values.to_numpy()
            for band in range(bands):
                planes = np.random.default_rng((seed, band)).standard_normal((width, bits))
                sides = np.packbits(vectors @ planes > 0, axis=1)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.full(b.num_rows, band, np.int32)), pa.array([x.tobytes().hex() for x in sides])], names=["doc", "band", "key"])

    return nodes.select("doc", "set").mapInArrow(keys, "doc long, band int, key string")


def groups(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95, recall: float | None = None) -> DataFrame:
    """doc, first (the least id of its group), copies (ids of the same vector, itself included). recall: that
    a link is found, by random projections; without it all are."""
    rows = written(units(df, id_col, vector_col).withColumn("same", F.xxhash64("set")), "units")
    found = rows.where("set IS NOT NULL")
    same = written(found.groupBy("same", "set").agg(F.min("doc").alias("node"), F.count("*").alias("copies")), "vectors")
    n, width = same.agg(F.count("*"), F.coalesce(F.max(F.size("set")), F.lit(1))).first()
    nodes = same.select(F.col("node").alias("doc"), "set")
    if recall is None:
        edges = linked_pairs(nodes, n, width, threshold)
    else:
        edges = links(nodes, band_keys(nodes, width, *bands_for(n, threshold, recall)), threshold, cosine)
    roots = connected_components(written(edges, "links"))
    told = same.join(roots, "node", "left").select("same", F.col("set").alias("of"), F.coalesce("root", "node").alias("first"), "copies")
    out = rows.join(told, (rows["same"] == told["same"]) & (F.col("set") == F.col("of")), "left")
    return out.select("doc", F.coalesce("first", "doc").alias("first"), F.coalesce("copies", F.lit(1)).alias("copies"))


#: What a query's best is before any vector, for itself, for null, and in place of NaN, which comes before all cosines.
NONE, UNKNOWN, NAN = -4.0, -3.0, 3.0


def nearest(df: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", at_a_time: int = 4096) -> DataFrame:
    """query_id, cosine (to six digits), vec_id: of all vectors but the query's id the nearest; ties go to
    the least id. NaN (of zeros) comes before, null (without a vector) after all cosines, as in SQL.

    Queries are sent to the workers ``at_a_time``, and each task keeps a best for each of them."""
    spark = df.sparkSession
    columns = lambda d: d.select(F.col(id_col).cast("long").alias("doc"), F.col(vector_col).cast("array<double>").alias("e"))
    asked, every = written(columns(queries).where("doc IS NOT NULL"), "queries"), columns(df).where("doc IS NOT NULL")
    n, width = asked.agg(F.count("*"), F.coalesce(F.max(F.size("e")), F.lit(1))).first()
    width, blocks = max(1, width), 1 + n // at_a_time

    def found(k: int) -> DataFrame:
        t = asked.where(F.pmod(F.xxhash64("doc"), F.lit(blocks)) == k).toArrow().combine_chunks()  # about at_a_time rows
        e = t["e"].combine_chunks()
        held = spark.sparkContext.broadcast((t["doc"].to_numpy(), matrix(e, width), e.is_null().to_numpy(zero_copy_only=False)))

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, q, unknown = held.value
            top, who = np.full(len(ids), NONE), np.full(len(ids), np.iinfo(np.int64).max)
            size = np.sqrt((q * q).sum(axis=1))[:, None]
            for batch in batches:
                for at in range(0, batch.num_rows if len(ids) else 0, BLOCK // 2):
                    part = batch.slice(at, BLOCK // 2)
                    doc, m = part.column(0).to_numpy(zero_copy_only=False), matrix(part.column(1), width)
                    with np.errstate(invalid="ignore", divide="ignore"):
                        c = np.round(q @ m.T / (size * np.sqrt((m * m).sum(axis=1))), 6)
                    c[np.isnan(c)] = NAN
                    c[:, part.column(1).is_null().to_numpy(zero_copy_only=False)] = UNKNOWN
                    c[unknown] = UNKNOWN
                    c[ids[:, None] == doc] = NONE
                    here = c.max(axis=1)
                    least = np.where(c == here[:, None], doc, np.iinfo(np.int64).max).min(axis=1)
                    better = (here > top) | ((here == top) & (least < who) & (here > NONE))
                    top[better], who[better] = here[better], least[better]
            some = top > NONE
            yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (ids, top, who)], names=["query_id", "c", "doc"])

        return every.mapInArrow(best, "query_id long, c double, doc long")

    out = found(0)
    for k in range(1, blocks):
        out = out.unionByName(found(k))
    out = out.groupBy("query_id").agg(F.max("c").alias("c"), F.min_by("doc", F.struct(-F.col("c"), F.col("doc"))).alias("vec_id"))
    return out.select("query_id", F.when(F.col("c") == NAN, F.lit(float("nan"))).when(F.col("c") != UNKNOWN, F.col("c")).alias("cosine"), "vec_id")
