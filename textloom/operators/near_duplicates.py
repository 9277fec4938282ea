"""Verified near duplicates: MinHash candidates, exact Jaccard similarity, groups.

Texts are sets of runs of ``width`` words, lower-cased (a shorter text is one run). Texts with one
set are one node from the start. Nodes that share a band's key (``minhash.band_keys``) are
candidates, and only pairs whose exact similarity reaches ``threshold`` are linked, so no text is
taken for a duplicate by a shared key alone.

Within a bucket no all-pairs are made. In a round each bucket has a hub (drawn by band, so bands
differ), and every other member is verified against it; those that the hub does not link go on as
a smaller bucket. A bucket of near copies is done after one round, and takes as many rounds as it
has groups. Groups are the connected components of the links, by rounds in the shared folder.

Cases: null and empty texts, and those of white space, have no words; each is its own group. Rows
that repeat an id are one document (its least text by hash counts); a null id is left out. Ties go
to the least id. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import minhash
from .components import connected_components


def _sets(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """doc, set (sorted 64-bit hashes of the runs; empty without words), same (a digest of the set)."""
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    rows = rows.groupBy("doc").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    runs = F.array_sort(F.transform(minhash.shingles(F.col("text"), width), lambda s: F.xxhash64(s)))
    return rows.select("doc", "text", runs.alias("set")).withColumn("same", F.when(F.size("set") > 0, F.md5(F.array_join("set", ","))))


def similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays without repetitions; 0 where both are empty."""
    shared = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(shared, F.size(a) + F.size(b) - shared), F.lit(0.0))


def links(nodes: DataFrame, buckets: DataFrame, threshold: float, alike: Callable[[Column, Column], Column] = similarity) -> DataFrame:
    """u, v of verified pairs. nodes: doc, set; buckets: doc, band, key."""
    sizes = buckets.groupBy("band", "key").agg(F.count("*").alias("n"))
    live = written(buckets.join(sizes.where("n > 1").select("band", "key"), ["band", "key"]), "buckets")
    found = None
    while live.head(1):
        draw = F.xxhash64("doc", "band")
        hubs = written(live.groupBy("band", "key").agg(F.min_by("doc", draw).alias("hub"), F.count("*").alias("n")).where("n > 1").select("band", "key", "hub"), "hubs")
        met = written(live.join(hubs, ["band", "key"]).where("doc != hub"), "met")
        pairs = met.select("doc", "hub").distinct()
        ends = [nodes.select(F.col("doc").alias(c), F.col("set").alias(f"{c}_set")) for c in ("doc", "hub")]
        judged = written(pairs.join(ends[0], "doc").join(ends[1], "hub").select("doc", "hub", (alike(F.col("doc_set"), F.col("hub_set")) >= threshold).alias("linked")), "judged")
        good = judged.where("linked").select(F.col("doc").alias("u"), F.col("hub").alias("v"))
        found = good if found is None else found.unionByName(good)
        live = written(met.join(judged.where("NOT linked").select("doc", "hub"), ["doc", "hub"]).select("band", "key", "doc"), "live")
    return nodes.sparkSession.createDataFrame([], "u long, v long") if found is None else found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: float = 0.8, bands: int = minhash.BANDS, rows: int = minhash.ROWS) -> DataFrame:
    """doc, first (the least id of its group), copies (documents of the same set, itself included) and
    links (verified links of its set to different sets; copies share them)."""
    sets = written(_sets(docs, id_col, text_col, width), "sets")
    same = written(sets.where("same IS NOT NULL").groupBy("same").agg(F.min("doc").alias("node"), F.count("*").alias("copies")), "nodes")
    nodes = sets.join(same.select(F.col("node").alias("doc")), "doc").select("doc", "set", "text")
    edges = written(links(nodes, minhash.band_keys(nodes, "doc", "text", width, bands, rows), threshold), "links")
    roots = written(connected_components(edges), "roots")
    degree = edges.select(F.explode(F.array("u", "v")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    told = same.join(roots, "node", "left").join(degree, "node", "left").select("same", F.coalesce("root", "node").alias("first"), "copies", F.coalesce("links", F.lit(0)).alias("links"))
    out = sets.select("doc", "same").join(told, "same", "left")
    return out.select("doc", F.coalesce("first", "doc").alias("first"), F.coalesce("copies", F.lit(1)).alias("copies"), F.coalesce("links", F.lit(0)).alias("links"))


def first_of_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: float = 0.8) -> DataFrame:
    """DUP1, DUP2: the ids that stay, the first of each group."""
    return groups(docs, id_col, text_col, width, threshold).where("doc = first").select("doc")
