"""Exact Jaccard links between word n-gram sets, and their components, by count-vector R-trees.

A text's set is that of its distinct word n-grams (64-bit hashes). Equal sets are one entry
("set") from here on. Hashing n-grams into groups and counting them by group makes a set a point;
the overlap of two sets is at most the summed minima of their coordinates. The steps:

1. Measure: size, set id and point of every text. Where one n-gram is common (a passage that
   many texts share), its batch-wise counts are noted.
2. Block: linked sets share one of their first n - ceil(p n) + 1 n-grams in any common order
   (common n-grams last, then by hash). Those go to buckets as packed arrays; n-grams that one
   set alone has, and sets whose size fits no other of the block, drop out; blocks of the same
   members are one. A block of more than ``SPLIT`` sets is cut by size into chunks, and each pair
   of chunks whose sizes may fit is a block of its own.
3. Bound: each block's points are an R-tree. From a set, all others that it may overlap enough
   are found and taken out of the tree, and searched from in turn: a spanning forest of the
   possible links, without the pairs within it.
4. Verify: the components of these forests are small clusters; their sets are read again and
   searched in the same way with the sets themselves compared. A cluster beyond
   ``CLUSTER_GRAMS`` n-grams is dealt into chunks, so no task holds an unbounded one: each chunk
   is searched by itself, then one set of each component found so far, and last the sets outside
   the cluster's largest component meet all chunks. A large group of copies thus costs three
   readings, not all pairs of chunks.
5. The components of the verified links, with the least document id.

Cases: a text of fewer words than n is one n-gram, its whole sequence; a text without words (null
or empty too) has an empty set and no link. Repeated rows link like copies; texts that share an
id but not their n-grams are rows of their own. A null id takes part but is never a component's
id unless all its ids are null. An empty table gives an empty result. Further columns are ignored
whatever their names. Sets are told apart by 64-bit hashes and their sizes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import buckets_for, written
from .word_hashes import U, joined, mix, word_hashes

#: Groups are so many that two sets of some ten thousand n-grams still differ clearly in counts.
GROUPS, LEAF = 512, 64
#: Bytes of input for each bucket of n-grams.
BUCKET_BYTES = 10 << 20
#: Sets of a block's chunk, at least, and chunks of a block, at most while chunks hold SPLIT[2] sets or fewer.
SPLIT = (1024, 64, 65_536)
#: A cluster of more n-grams than this is verified in chunks.
CLUSTER_GRAMS = 8 << 20
#: An n-gram is common when one text in so many starts with it, and in COMMON_LEAST at least.
COMMON_SHARE, COMMON_LEAST = 2048, 64
#: The most common n-grams that workers get; any choice is a right order.
COMMON_MOST = 4 << 20


def gram_set(w: np.ndarray, width: int) -> np.ndarray:
    """The sorted hashes of the distinct n-grams of a text's words (as hashes)."""
    if not len(w):
        return w
    if len(w) < width:
        return joined(*w.reshape(-1, 1))
    return np.unique(joined(*(w[k : len(w) - width + 1 + k] for k in range(width))))


def set_id(grams: np.ndarray) -> int:
    """A signed 64-bit id of a set."""
    return int(mix(np.array([mix(grams ^ U(0x5851F42D4C957F2D)).sum(dtype=U) + U(len(grams))], U)).view(np.int64)[0])


def point(grams: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Counts by group, at most 255."""
    shift = U(64 - groups.bit_length() + 1)
    return np.minimum(np.bincount((grams >> shift).astype(np.int64), minlength=groups), 255).astype(np.uint8)


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


class RTree:
    """Points (counts by group, size) in leaves of ``LEAF``, bulk-loaded by size; a node keeps
    its points' largest coordinates and their least and largest size. Points can be taken out."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, percent: int) -> None:
        self.percent = percent
        self.order = np.lexsort((points.argmax(axis=1), sizes))
        self.points, self.sizes = points[self.order].astype(np.int16), sizes[self.order]
        self.place = np.empty(len(sizes), np.int64)
        self.place[self.order] = np.arange(len(sizes))
        self.alive = np.ones(len(sizes), bool)
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        top, low, high = self.points, self.sizes, self.sizes
        while len(top) > LEAF:
            cuts = np.arange(0, len(top), LEAF)
            top, low, high = np.maximum.reduceat(top, cuts), np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            self.levels.append((top, low, high))

    def take_out(self, items: np.ndarray) -> None:
        self.alive[self.place[items]] = False

    def _may(self, q: np.ndarray, n: int, tops: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        p = self.percent
        out = np.flatnonzero((100 * high >= p * n) & (p * low <= 100 * n))
        short = np.maximum(q - tops[out], 0).sum(axis=1)
        return out[(100 + p) * (n - short) >= p * (n + low[out])]

    def search(self, item: int) -> np.ndarray:
        """The items still in the tree that may overlap ``item`` enough."""
        at = self.place[item]
        q, n = self.points[at], int(self.sizes[at])
        nodes = np.arange(len(self.levels[-1][0]) if self.levels else len(self.sizes))
        for k in range(len(self.levels) - 1, -1, -1):
            top, low, high = self.levels[k]
            nodes = nodes[self._may(q, n, top[nodes], low[nodes], high[nodes])]
            nodes = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
            nodes = nodes[nodes < (len(self.levels[k - 1][0]) if k else len(self.sizes))]
        nodes = nodes[self.alive[nodes]]
        nodes = nodes[self._may(q, n, self.points[nodes], self.sizes[nodes], self.sizes[nodes])]
        return self.order[nodes]


def forest(points: np.ndarray, sizes: np.ndarray, percent: int, linked=None) -> Iterator[tuple[int, int]]:
    """Edges (root, item) of the components of the links; items are taken in order. linked:
    of an item and candidates, those that are linked; all candidates where it is None."""
    tree, seen = RTree(points, sizes, percent), np.zeros(len(sizes), bool)
    for root in range(len(sizes)):
        if seen[root]:
            continue
        seen[root], queue = True, [root]
        tree.take_out(np.array([root]))
        while queue:
            item = queue.pop()
            found = tree.search(item)
            if linked is not None and len(found):
                found = linked(item, found)
            if len(found):
                tree.take_out(found)
                seen[found] = True
                queue += found.tolist()
                yield from ((root, i) for i in found.tolist())


def _measured(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, h, n, set, point of every row; further rows (gram, times) of n-grams that a batch has often.

    docs: doc_id, h (a hash of the text), text."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, ids, points, firsts = [], [], [], []
            for w in word_hashes(b.column(2)):
                g = gram_set(w, width)
                n.append(len(g))
                ids.append(set_id(g) if len(g) else None)
                points.append(point(g).tobytes() if len(g) else None)
                if len(g):
                    firsts.append(g[: prefix_size(len(g), percent)])
            grams, times = np.unique(np.concatenate(firsts), return_counts=True) if firsts else (np.zeros(0, U), np.zeros(0, np.int64))
            often = times >= max(8, len(n) // COMMON_SHARE)
            more = int(often.sum())
            none = [None] * more
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array([*b.column(k).to_pylist(), *none], pa.int64()) for k in (0, 1)),
                    pa.array([*n, *none], pa.int64()),
                    pa.array([*ids, *none], pa.int64()),
                    pa.array([*points, *none], pa.binary()),
                    pa.array([None] * len(n) + grams[often].view(np.int64).tolist(), pa.int64()),
                    pa.array([None] * len(n) + times[often].tolist(), pa.int64()),
                ],
                names=["doc_id", "h", "n", "set", "point", "gram", "times"],
            )

    return written(docs.mapInArrow(measure, "doc_id long, h long, n long, set long, point binary, gram long, times long"), "measured")


def _block_ids(sets: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """An id of the members of each block."""
    return mix(np.add.reduceat(mix(sets.view(U) + sizes.astype(U)), first))


def _chunk_pairs(sets: np.ndarray, sizes: np.ndarray, percent: int, split: tuple[int, int, int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """block, set, n of the pairs of chunks of a block of more than split[0] sets, which come by size."""
    each = max(split[0], min(-(-len(sets) // split[1]), split[2]))
    cuts = [*range(0, len(sets), each), len(sets)]
    for i, j in zip(cuts[:-2], cuts[1:-1], strict=True):
        for k, m in zip(cuts[:-1], cuts[1:], strict=True):
            if k >= j and 100 * sizes[j - 1] >= percent * sizes[k]:  # always so of the next chunk
                mine = np.concatenate((np.arange(i, j), np.arange(k, m)))
                yield np.repeat(_block_ids(sets[mine], sizes[mine], np.zeros(1, np.int64)), len(mine)), sets[mine], sizes[mine]


def _blocks(docs: DataFrame, common, width: int, percent: int, buckets: int) -> DataFrame:
    """block, set, n: the sets that share a first n-gram and may fit by size, a block once."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = common.value
        for b in batches:
            seen: set[int] = set()
            firsts, sets, sizes = [], [], []
            for w in word_hashes(b.column(0)):
                g = gram_set(w, width)
                if not len(g) or (s := set_id(g)) in seen:
                    continue
                seen.add(s)
                k = prefix_size(len(g), percent)
                if len(last):
                    late = last[np.minimum(np.searchsorted(last, g), len(last) - 1)] == g
                    g = np.concatenate((g[~late], g[late]))
                firsts.append(g[:k])
                sets.append(s)
                sizes.append((k, len(g)))
            if not sets:
                continue
            grams, times = np.concatenate(firsts), np.array(sizes, np.int64)
            of, n = np.repeat(np.array(sets, np.int64), times[:, 0]), np.repeat(times[:, 1].astype("<u4"), times[:, 0])
            bucket = (mix(grams) % U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            grams, of, n = grams[order], of[order], n[order]
            rows = [(k, grams[i:j].tobytes(), of[i:j].tobytes(), n[i:j].tobytes()) for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if j > i]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "grams", "sets", "sizes"])

    def meet(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: tuple[list, list, list] = ([], [], [])
        for b in parts:
            for k, (name, kind) in enumerate((("grams", U), ("sets", np.int64), ("sizes", "<u4"))):
                lists[k].extend(np.frombuffer(x.as_buffer(), kind) for x in b.column(name))
        grams, sets, sizes = (np.concatenate(x) for x in lists)
        order = np.lexsort((sets, sizes, grams))
        grams, sets, sizes = grams[order], sets[order], sizes[order].astype(np.int64)
        new = np.concatenate(([True], (grams[1:] != grams[:-1]) | (sets[1:] != sets[:-1]) | (sizes[1:] != sizes[:-1])))
        grams, sets, sizes = grams[new], sets[new], sizes[new]
        near = (grams[1:] == grams[:-1]) & (100 * sizes[:-1] >= percent * sizes[1:])  # to the next larger
        keep = np.concatenate((near, [False])) | np.concatenate(([False], near))
        # runs of sizes that follow each other closely are blocks of their own
        run = np.cumsum(np.concatenate(([True], ~near)))
        sets, sizes, run = sets[keep], sizes[keep], run[keep]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(run)), bool), run[1:] != run[:-1])))
        count = np.diff(np.concatenate((first, [len(run)])))
        small = count <= SPLIT[0]
        block = np.repeat(_block_ids(sets, sizes, first), count) if len(run) else np.zeros(0, U)
        whole = np.repeat(small, count)
        parts_of = [(block[whole], sets[whole], sizes[whole])]
        for i, c in zip(first[~small].tolist(), count[~small].tolist(), strict=True):
            parts_of += _chunk_pairs(sets[i : i + c], sizes[i : i + c], percent, SPLIT)
        block, sets, sizes = (np.concatenate(x) for x in zip(*parts_of, strict=True))
        block = block.view(np.int64)
        order = np.lexsort((sizes, sets, block))
        block, sets, sizes = block[order], sets[order], sizes[order]
        new = np.concatenate((np.ones(min(1, len(block)), bool), (block[1:] != block[:-1]) | (sets[1:] != sets[:-1]) | (sizes[1:] != sizes[:-1])))
        block, sets, sizes = block[new], sets[new], sizes[new]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (block, sets, sizes)], names=["block", "set", "n"])

    dealt = docs.select("text").mapInArrow(deal, "bucket int, grams binary, sets binary, sizes binary")
    return dealt.groupBy("bucket").applyInArrow(meet, "block long, set long, n long").dropDuplicates(["block", "set", "n"])


def _possible(blocks: DataFrame, percent: int, buckets: int) -> DataFrame:
    """u, v: forests of the possible links of every block. blocks: block, set, n, point."""

    def link(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(parts))
        block, sets, sizes = (t[c].to_numpy() for c in ("block", "set", "n"))
        points = np.frombuffer(b"".join(t["point"].to_pylist()), np.uint8).reshape(-1, GROUPS)
        order = np.lexsort((sets, block))
        block, sets, sizes, points = block[order], sets[order], sizes[order], points[order]
        first = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        count = np.diff(np.concatenate((first, [len(block)])))
        a = first[count == 2]  # blocks of two are one comparison each, all at once
        n, m = sizes[a], sizes[a + 1]
        short = np.maximum(points[a].astype(np.int16) - points[a + 1], 0).sum(axis=1)
        a = a[(100 + percent) * (n - short) >= percent * (n + m)]
        u, v = [sets[a]], [sets[a + 1]]
        for i, c in zip(first[count > 2].tolist(), count[count > 2].tolist(), strict=True):
            edges = np.array(list(forest(points[i : i + c], sizes[i : i + c], percent)), np.int64).reshape(-1, 2) + i
            u.append(sets[edges[:, 0]])
            v.append(sets[edges[:, 1]])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], names=["u", "v"])

    return blocks.withColumn("bucket", F.pmod("block", F.lit(buckets))).groupBy("bucket").applyInArrow(link, "u long, v long")


def _linked(docs: DataFrame, placed: DataFrame, width: int, percent: int) -> DataFrame:
    """u, v: forests of the links within every (task, cluster). docs: at, h, text; placed: at, h, set, task, cluster."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grams = [gram_set(w, width) for w in word_hashes(b.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array([g.tobytes() for g in grams], pa.binary()), b.column(1), b.column(2)], names=["grams", "set", "places"])

    def link(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clusters: dict[int, dict[int, np.ndarray]] = {}
        for b in parts:
            for c, s, g in zip(b.column("cluster").to_pylist(), b.column("set").to_pylist(), b.column("grams"), strict=True):
                clusters.setdefault(c, {})[s] = np.frombuffer(g.as_buffer().to_pybytes(), U)
        u, v = [], []
        for of in clusters.values():
            ids = sorted(of)
            grams = [of[i] for i in ids]
            sizes = np.array([len(g) for g in grams], np.int64)

            def linked(item: int, found: np.ndarray, grams=grams, sizes=sizes) -> np.ndarray:
                q, out = grams[item], []
                for part in np.array_split(found, -(-int(sizes[found].sum()) // (1 << 20)) or 1):
                    if len(part):
                        every = np.concatenate([grams[i] for i in part])
                        same = q[np.minimum(np.searchsorted(q, every), len(q) - 1)] == every
                        both = np.add.reduceat(same, np.concatenate(([0], np.cumsum(sizes[part])[:-1])), dtype=np.int64)
                        out.append(part[(100 + percent) * both >= percent * (len(q) + sizes[part])])
                return np.concatenate(out)

            for a, b in forest(np.stack([point(g) for g in grams]), sizes, percent, linked):
                u.append(ids[a])
                v.append(ids[b])
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    where = placed.groupBy("at", "h", "set").agg(F.collect_list(F.struct("task", "cluster")).alias("places"))
    # merged at every size: neither side has a bound. Rows that repeat an id and a text are one here
    texts = docs.join(where.hint("merge"), ["at", "h"]).dropDuplicates(["at", "h"]).select("text", "set", "places")
    rows = texts.mapInArrow(sets, "grams binary, set long, places array<struct<task: long, cluster: long>>").withColumn("p", F.explode("places"))
    return rows.select("grams", "set", "p.task", "p.cluster").groupBy("task").applyInArrow(link, "u long, v long")


def _verified(docs: DataFrame, members: DataFrame, width: int, percent: int, buckets: int) -> DataFrame:
    """u, v: forests of the links of every cluster. docs: at, h, text; members: at, h, set, n, cluster."""
    place = ["at", "h", "set", "task", "cluster"]
    sums = written(members.groupBy("cluster").agg(F.sum("n").alias("all")), "cluster-sizes")
    own = F.when(F.col("all") <= CLUSTER_GRAMS, F.pmod("cluster", F.lit(buckets)))

    def dealt(rows: DataFrame, salt: int) -> DataFrame:
        """Every member to a chunk of its cluster, by hash."""
        chunk = F.pmod(F.xxhash64("set", F.lit(salt)), F.ceil(F.col("all") / CLUSTER_GRAMS))
        return rows.withColumn("task", F.coalesce(own, F.xxhash64("cluster", chunk, F.lit(salt)))).select(place)

    links = _linked(docs, dealt(members.join(sums, "cluster"), 0), width, percent)
    if not sums.where(F.col("all") > CLUSTER_GRAMS).head(1):
        return links
    links = written(links, "links")
    large = written(members.join(sums.where(F.col("all") > CLUSTER_GRAMS), "cluster"), "large-clusters")

    def parts(links: DataFrame) -> DataFrame:
        return large.join(connected_components(links.join(large.select(F.col("set").alias("u")), "u", "left_semi")), F.col("set") == F.col("node"), "left").withColumn("part", F.coalesce("root", "set")).drop("node", "root")

    firsts = parts(links).where(F.col("set") == F.col("part")).drop("all")
    sized = firsts.join(firsts.groupBy("cluster").agg(F.sum("n").alias("all")), "cluster")
    links = written(links.unionByName(_linked(docs, dealt(sized, 1), width, percent)), "links")
    now = written(parts(links), "parts")
    main = now.groupBy("cluster", "part").agg(F.sum("n").alias("held")).groupBy("cluster").agg(F.max_by("part", "held").alias("main"))
    outside = written(now.join(main, "cluster").where(F.col("part") != F.col("main")).drop("main"), "outside")
    left = outside.groupBy("cluster").agg(F.ceil(F.sum("n") / CLUSTER_GRAMS).alias("chunks"))  # of the sets outside, by cluster
    chunk = lambda salt, n: F.pmod(F.xxhash64("set", F.lit(salt)), n).cast("int")
    count = lambda n: F.explode(F.sequence(F.lit(0), n.cast("int") - 1))
    n_all, n_out = F.ceil(F.col("all") / CLUSTER_GRAMS), F.col("chunks")
    some = outside.join(left, "cluster").withColumn("i", chunk(2, n_out)).withColumn("j", count(n_all))
    every = now.join(left, "cluster").withColumn("j", chunk(3, n_all)).withColumn("i", count(n_out))
    met = some.unionByName(every).withColumn("task", F.xxhash64("cluster", "i", "j", F.lit(4))).select(place).distinct()
    return links.unionByName(_linked(docs, met, width, percent))


LAST = 2**63 - 1


def _components(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, n, set; set is null where n is 0), and the linked sets (set, root)."""
    spark = docs.sparkSession
    buckets = buckets_for(docs, BUCKET_BYTES)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    every = _measured(docs, width, percent)
    rows = every.where(F.col("gram").isNull()).select("doc_id", "h", "n", "set")
    least = max(COMMON_LEAST, rows.count() // COMMON_SHARE)
    often = every.where(F.col("gram").isNotNull()).groupBy("gram").agg(F.sum("times").alias("times")).where(F.col("times") >= least)
    often = often.orderBy(F.desc("times"), "gram").limit(COMMON_MOST).select("gram").toArrow()  # 8 bytes each
    common = spark.sparkContext.broadcast(np.sort(often["gram"].to_numpy().astype(np.int64).view(U)))
    place = F.coalesce("doc_id", F.lit(LAST)).alias("at")
    first = F.min(F.struct(place, "h"))
    sets = every.where(F.col("set").isNotNull()).groupBy("set", "n").agg(first.alias("first"), F.first("point").alias("point")).select("set", "n", "first.at", "first.h", "point")
    blocks = written(_blocks(docs, common, width, percent, buckets), "blocks")
    possible = _possible(blocks.join(sets.select("set", "n", "point"), ["set", "n"]), percent, buckets)
    clusters = written(connected_components(possible).select(F.col("node").alias("set"), F.col("root").alias("cluster")), "clusters")
    members = written(clusters.join(sets.select("set", "n", "at", "h"), "set"), "members")
    links = _verified(docs.select(place, "h", "text"), members, width, percent, buckets)
    return rows, written(connected_components(links).select(F.col("node").alias("set"), "root"), "roots")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; texts link at a Jaccard of ``percent`` hundredths."""
    rows, roots = _components(docs, id_col, text_col, width, percent)
    # a table of its own, so that a join with many sets of one root or rows of one set can be split by Spark
    sets = written(rows.where(F.col("set").isNotNull()).groupBy("set").agg(F.min("doc_id").alias("least")).join(roots, "set", "left").withColumn("root", F.coalesce("root", "set")), "sets")
    first = written(sets.groupBy("root").agg(F.min("least").alias("component_id")), "first-ids")
    of_set = sets.join(first, "root").select("set", "component_id")
    return rows.join(of_set, "set", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """doc, first (the least id of its component), copies (ids of the same set, itself included).

    Letters of any alphabet are lower-cased. Rows that repeat an id are one (the least text by hash);
    a null id is left out; a text without words is a group of its own."""
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    again = written(texts.groupBy("doc").agg(F.count("*").alias("times")).where("times > 1").select("doc"), "repeated")
    if again.head(1):
        once = texts.join(again, "doc").groupBy("doc").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
        texts = texts.join(again, "doc", "left_anti").unionByName(once)
    rows, roots = _components(texts.select("doc", F.lower("text").alias("text")), "doc", "text", width, percent)
    sets = rows.where(F.col("set").isNotNull()).groupBy("set", "n").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    sets = written(sets.join(roots, "set", "left").withColumn("root", F.coalesce("root", "set")), "sets")
    first = written(sets.groupBy("root").agg(F.min("least").alias("first")), "first-ids")
    out = rows.join(sets.join(first, "root").select("set", "n", "first", "copies"), ["set", "n"], "left")
    return out.select(F.col("doc_id").alias("doc"), F.coalesce("first", "doc_id").alias("first"), F.coalesce("copies", F.lit(1)).alias("copies"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are the first of their component, with their own columns.

    Rows are told apart by id and text: of each component the row of the least id stays (null ids
    come last, then the least hash of the text), once where whole rows of that id and text repeat
    (the one whose other columns come first). Rows without words stay.
    """
    rows, roots = _components(docs, id_col, text_col, width, percent)
    linked = rows.where(F.col("set").isNotNull()).join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("at"), "h"))
    firsts = linked.groupBy("root").agg(first.alias("f")).select("f.at", "f.h")
    kept = written(firsts.unionByName(rows.where(F.col("set").isNull()).select(F.coalesce("doc_id", F.lit(LAST)).alias("at"), "h").distinct()), "kept")
    row = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("at"), F.xxhash64(text_col).alias("h"))
    stay = row.join(kept.hint("merge"), ["at", "h"], "left_semi")
    again = rows.where(F.col("set").isNotNull()).groupBy(F.coalesce("doc_id", F.lit(LAST)).alias("at"), "h").agg(F.count("*").alias("times")).where("times > 1").select("at", "h")
    again = written(again, "repeated")
    if again.head(1):
        once = stay.join(again.hint("merge"), ["at", "h"], "left_semi").groupBy("at", "h").agg(F.min("row").alias("row"))
        stay = stay.join(again.hint("merge"), ["at", "h"], "left_anti").select("row").unionByName(once.select("row"))
    return stay.select(*(F.col("row")[c].alias(c) for c in docs.columns))
