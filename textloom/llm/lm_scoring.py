"""Language-model scores of texts from a log-frequency Bloom filter of word pairs.

One pass counts words and word pairs of the training texts: every slice of a batch is counted by
itself and its counts go to buckets as packed arrays. A pair (v, w) goes to one of ``FAN`` buckets
of v, so the pairs of a frequent v are no single group; buckets follow the size of the input.
A pair of count c is entered into its bucket's log-frequency Bloom filter at levels 1 to
floor(log2 c) + 1, so probing level after level gives its quantised count 2^(level - 1). All pairs
are entered, so the filter grows with the corpus. Of each word the store has the count c(v) and
the sum s(v) of the quantised counts of the pairs that it begins.

A filter of at most ``filter_bytes`` and the ``head_words`` most frequent words are broadcast to the
workers. A larger filter stays in its segments: slices of texts are written as tokens, ask the
buckets of their pairs and of the other words, each once a slice, and are scored when the answers
are back; so scores do not depend on these two limits.

A token w after v has the probability

    share(v) q(v, w) / c(v) + (1 - share(v) s(v) / c(v)) p(w),  share(v) = pair_share c(v) / (c(v) + strength)

if v was seen, and p(w) otherwise. p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)), one unseen word having
the rest; q is the quantised count, at most c(v) and c(w). What the quantised pairs leave goes to
p(w), so the probabilities after every v sum to 1, but for pairs that the filter holds by mistake
(one in a thousand at ``event_bits`` = 16). A text's first token follows the end token.

Cases: a null text counts as empty: the end token alone. A null id is training. Without training
texts every probability is 1. Repeated rows are scored one by one. An empty table gives an empty
result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, slices, written, written_by
from .word_hashes import U, joined, mix, word_hashes

#: The end token, a number beside the words' hashes.
END = U(0x6C6F6F6D2D656E64)
#: Bytes of text that are counted, and scored, at a time.
COUNTED_CHUNK, CHUNK = 8 << 20, 4 << 20
#: Bytes of input for each bucket.
BUCKET_BYTES = 10 << 20
PROBES = 6
#: Buckets that hold the pairs of one word, a power of two.
FAN = 4
#: Bits of the key of a pair, or of a pair's first word, within its bucket, and their bytes.
KEY = U((1 << 40) - 1)
KEY_BYTES = 5
#: Pairs that a bucket gathers before they are summed, at least.
PENDING = 1 << 20
#: Bytes of asked pairs that one task answers, at most (about).
ASKED = 64 << 20


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of a batch of texts one after the other, each text's end token last, and each
    text's number of tokens."""
    parts, sizes, end = [], [], np.array([END], U)
    for w in word_hashes(texts):
        parts += w, end
        sizes.append(len(w) + 1)
    return np.concatenate(parts) if parts else np.zeros(0, U), np.array(sizes, np.int64)


def word_bucket(words: np.ndarray, buckets: int) -> np.ndarray:
    """Known from a word's key, the lowest 40 bits of its hash."""
    return (mix(words & KEY) % U(buckets)).astype(np.int64)


def pair_place(first: np.ndarray, second: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each pair of words, one of ``FAN`` of its first word, and its key there."""
    fan = (mix(second) >> U(64 - FAN.bit_length() + 1)).astype(np.int64)
    return (word_bucket(first, buckets) + fan * (buckets // FAN + 1)) % buckets, joined(first, second) & KEY


def _short(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]).tobytes()


def _long(raw: pa.Buffer) -> np.ndarray:
    out = np.zeros((raw.size // KEY_BYTES, 8), np.uint8)
    out[:, :KEY_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, KEY_BYTES)
    return out.view("<u8").reshape(-1).astype(U, copy=False)


def _planes(counts: np.ndarray) -> bytes:
    """Small counts byte by byte of their place, which a shuffle's compression makes short."""
    return np.ascontiguousarray(counts.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplaned(raw: pa.Buffer) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1).astype(np.int64)


def _squeezed(at: np.ndarray) -> bytes:
    """Small numbers, packed byte by byte of their place."""
    return pa.compress(_planes(at), codec="zstd", asbytes=True)


def _spread(raw: pa.Buffer, n: int) -> np.ndarray:
    return _unplaned(pa.decompress(raw, decompressed_size=4 * n, codec="zstd"))


def _distinct_pairs(found: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of tokens as places in the distinct words ``found``: the word before each token, each
    token's place among the distinct pairs, and these pairs' first and second words."""
    before = np.concatenate((np.searchsorted(found, [END]), at[:-1]))
    codes, pair_at = np.unique(before * len(found) + at, return_inverse=True)
    return before, pair_at, codes // len(found), codes % len(found)


def _cuts(bucket: np.ndarray) -> tuple[np.ndarray, list[int], np.ndarray]:
    """The order by bucket, the buckets that occur, and where each begins in that order, and the end."""
    order = np.argsort(bucket, kind="stable")
    some, first = np.unique(bucket[order], return_index=True)
    return order, some.tolist(), np.concatenate((first, [len(bucket)]))


COUNTED = "kind int, bucket int, a binary, b binary, c binary, d binary"


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    columns = list(zip(*rows, strict=True)) or [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["kind", "bucket", "a", "b", "c", "d"])


class _Sums:
    """Counts by key (and what else goes with a key), summed whenever as many have come as there are."""

    def __init__(self) -> None:
        self.columns = [np.zeros(0, U), np.zeros(0, np.int64)]
        self.more: list[list[np.ndarray]] = []
        self.waiting = 0

    def add(self, *columns: np.ndarray) -> None:
        self.more.append(list(columns))
        self.waiting += len(columns[0])
        if self.waiting > max(PENDING, len(self.columns[0])):
            self.close()

    def close(self) -> list[np.ndarray]:
        """keys, their summed counts, and the further columns' values at each key."""
        if self.more:
            parts = ([self.columns] if len(self.columns[0]) else []) + self.more
            keys = np.concatenate([p[0] for p in parts])
            order = np.argsort(keys)
            keys = keys[order]
            first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
            counts = np.add.reduceat(np.concatenate([p[1] for p in parts])[order], first) if len(keys) else np.zeros(0, np.int64)
            rest = [np.concatenate([p[k] for p in parts])[order[first]] for k in range(2, len(parts[0]))]
            self.columns, self.more, self.waiting = [keys[first], counts, *rest], [], 0
        return self.columns


def count_grams(texts: DataFrame, buckets: int, event_bits: int) -> tuple[DataFrame, DataFrame]:
    """Two tables in the shared folder. words: bucket, keys, c, s (packed), n (the sum of c);
    pairs: bucket, bits (a segment of the filter)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole, 0, COUNTED_CHUNK)):
            tokens, _ = _tokens(b.column(0))
            found, at, counts = np.unique(tokens, return_inverse=True, return_counts=True)
            order, some, cuts = _cuts(word_bucket(found, buckets))
            keys, counts = found[order], counts[order]
            yield _packed([(1, k, keys[i:j].tobytes(), _planes(counts[i:j]), None, None) for k, i, j in zip(some, cuts[:-1], cuts[1:], strict=True)])
            before = np.concatenate((np.searchsorted(found, [END]), at[:-1]))
            codes, counts = np.unique(before * len(found) + at, return_counts=True)
            del tokens, at, before
            first = codes // len(found)
            bucket, keys = pair_place(found[first], found[codes % len(found)], buckets)
            order, some, cuts = _cuts(bucket)  # within a bucket by first word
            bucket, first, keys, counts = bucket[order], first[order], keys[order], counts[order]
            runs = np.flatnonzero(np.concatenate(([True], (first[1:] != first[:-1]) | (bucket[1:] != bucket[:-1]))))
            sizes, heads, ends = np.diff(np.concatenate((runs, [len(first)]))), found[first[runs]] & KEY, np.searchsorted(runs, cuts)
            yield _packed([(2, k, _short(heads[x:y]), _planes(sizes[x:y]), _short(keys[i:j]), _planes(counts[i:j])) for k, i, j, x, y in zip(some, cuts[:-1], cuts[1:], ends[:-1], ends[1:], strict=True)])

    def add(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, bucket, sums = key[0].as_py(), key[1].as_py(), _Sums()
        for batch in parts:
            for a, b, c, d in zip(*(batch.column(x) for x in "abcd"), strict=True):
                if kind == 1:
                    sums.add(np.frombuffer(a.as_buffer(), U), _unplaned(b.as_buffer()))
                else:
                    sums.add(_long(c.as_buffer()), _unplaned(d.as_buffer()), np.repeat(_long(a.as_buffer()), _unplaned(b.as_buffer())))
        keys, counts, *heads = sums.close()
        if kind == 1:
            yield _packed([(1, bucket, keys.tobytes(), counts.tobytes(), None, None)])
            return
        level = levels_of(counts)
        yield _packed([(2, bucket, LogBloom.segment(keys, level, event_bits), None, None, None)])
        first, of = np.unique(heads[0], return_inverse=True)
        left = np.bincount(of, 1 << (level - 1)).astype(np.int64)
        order, some, cuts = _cuts(word_bucket(first, buckets))  # of FAN buckets at most
        first, left = first[order], left[order]
        yield _packed([(3, k, first[i:j].tobytes(), left[i:j].tobytes(), None, None) for k, i, j in zip(some, cuts[:-1], cuts[1:], strict=True)])

    def meet(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {1: _Sums(), 3: _Sums()}
        for batch in parts:
            for kind, a, b in zip(batch.column("kind").to_pylist(), batch.column("a"), batch.column("b"), strict=True):
                sums[kind].add(np.frombuffer(a.as_buffer(), U), np.frombuffer(b.as_buffer(), np.int64))
        (keys, c), (first, left) = sums[1].close(), sums[3].close()
        order = np.argsort(keys & KEY, kind="stable")
        s = np.zeros(len(keys), np.int64)
        s[order[np.searchsorted(keys[order] & KEY, first)]] = left  # every first word is a word
        s = np.minimum(s, c)  # so it is but where two words of a bucket had one key
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (keys, c, s)), pa.array([int(c.sum())], pa.int64())], names=["bucket", "keys", "c", "s", "n"])

    grams = written(texts.mapInArrow(count, COUNTED).groupBy("kind", "bucket").applyInArrow(add, COUNTED), "grams")
    words = grams.where(F.col("kind") != 2).select("kind", "bucket", "a", "b").groupBy("bucket").applyInArrow(meet, "bucket int, keys binary, c binary, s binary, n long")
    return written(words, "words"), grams.where(F.col("kind") == 2).select("bucket", F.col("a").alias("bits"))


def levels_of(counts: np.ndarray) -> np.ndarray:
    """The level of a count: floor(log2 c) + 1, 0 of 0."""
    return np.frexp(counts.astype(float))[1].astype(np.int64)


class LogBloom:
    """Segments of a log-frequency Bloom filter, by bucket of the pair."""

    def __init__(self, buckets: int, segments: dict[int, bytes]) -> None:
        raw = [np.frombuffer(segments.get(b, b"\0" * 8), np.uint8) for b in range(buckets)]
        self.sizes = np.array([8 * len(x) for x in raw], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bits = np.concatenate(raw)

    @staticmethod
    def segment(keys: np.ndarray, levels: np.ndarray, event_bits: int) -> bytes:
        """The bits of one bucket."""
        size = -(-max(64, int(levels.sum()) * event_bits) // 64) * 64
        bits = np.zeros(size, bool)
        for level in range(1, int(levels.max(initial=0)) + 1):
            mine = keys[levels >= level]
            for i in range(PROBES):
                bits[(LogBloom._probe(mine, level, i) % U(size)).astype(np.int64)] = True
        return np.packbits(bits, bitorder="little").tobytes()

    @staticmethod
    def _probe(keys: np.ndarray, level: int, i: int) -> np.ndarray:
        return mix(keys + U((level * 64 + i + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))

    def levels(self, bucket: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Each pair's level, 0 where it isn't entered."""
        out, left, level = np.zeros(len(keys), np.uint8), np.arange(len(keys)), 1
        starts, sizes = self.starts[bucket], self.sizes[bucket].astype(U)
        while len(left):
            for i in range(PROBES):
                at = starts[left] + (self._probe(keys[left], level, i) % sizes[left]).astype(np.int64)
                left = left[(self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
            out[left] = level
            level += 1
        return out


class Smoothing:
    """Probabilities from counts. n: training tokens; v: distinct ones."""

    def __init__(self, n: int, v: int, pair_share: float, strength: float) -> None:
        self.total, self.pair_share, self.strength = n + 0.1 * (v + 1), pair_share, strength

    def alone(self, c: np.ndarray) -> np.ndarray:
        return (c + 0.1) / self.total

    def after(self, c_before: np.ndarray, s_before: np.ndarray, c: np.ndarray, level: np.ndarray) -> np.ndarray:
        """Of tokens of count c after ones of count c_before whose pairs' quantised counts sum to s_before."""
        quantised = np.where(level > 0, np.exp2(level.astype(float) - 1), 0.0)
        quantised = np.minimum(quantised, np.minimum(c_before, c))
        per = self.pair_share / (np.maximum(c_before, 1) + self.strength)  # share(v) / c(v)
        return np.where(c_before > 0, per * quantised + (1 - per * s_before) * self.alone(c), self.alone(c))


def _word_rows(words: DataFrame) -> DataFrame:
    """word (hash), c, s of every training word."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for one in zip(*b.columns, strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x.as_buffer(), np.int64)) for x in one], names=["word", "c", "s"])

    return words.select("keys", "c", "s").mapInArrow(rows, "word long, c long, s long")


class Trained:
    """What training leaves: the tables of words and pairs, and the parts of them that workers hold."""

    def __init__(self, texts: DataFrame, head_words: int, filter_bytes: int, event_bits: int) -> None:
        self.buckets = buckets_for(texts, BUCKET_BYTES)
        self.words, self.pairs = count_grams(texts, self.buckets, event_bits)
        rows = _word_rows(self.words)
        # about a thousand rows at most
        sizes = rows.groupBy(F.floor(F.log2("c") * 16).alias("size")).agg(F.count("*").alias("v"), F.sum("c").alias("n"), F.min("c").alias("least")).orderBy(F.desc("size")).collect()
        self.v, self.n = sum(r.v for r in sizes), sum(r.n for r in sizes)
        held, least = 0, None
        for r in sizes:
            if held + r.v > head_words:
                break
            held, least = held + r.v, r.least
        head = rows.where(F.col("c") >= least).toArrow() if least is not None else None  # head_words at most
        columns = [head[x].to_numpy() for x in ("word", "c", "s")] if head is not None else [np.zeros(0, np.int64)] * 3
        order = np.argsort(columns[0].view(U))
        self.head = columns[0].view(U)[order], columns[1][order], columns[2][order]
        self.whole_head = held == self.v
        size = self.pairs.agg(F.sum(F.length("bits"))).first()[0] or 0
        # all of the filter or nothing: scores of a larger corpus then cost what they cost of a smaller one
        self.near = self.buckets if max(size, 8 * self.buckets) <= filter_bytes else 0
        # filter_bytes at most
        self.bloom = LogBloom(self.buckets, {r.bucket: bytes(r.bits) for r in self.pairs.collect()}) if self.near else None


def score_texts(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", pair_share: float = 0.9, strength: float = 2.0, head_words: int = 1 << 20, filter_bytes: int = 16 << 20, event_bits: int = 16
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every text.

    held_out: a condition on the input's columns; rows that do not meet it are the training.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    trained = Trained(rows.where(~F.col("held_out")).select("text"), head_words, filter_bytes, event_bits)
    buckets, near, model = trained.buckets, trained.near, Smoothing(trained.n, trained.v, pair_share, strength)
    frequent, shared = spark.sparkContext.broadcast(trained.head), spark.sparkContext.broadcast(trained.bloom)
    missing = 0 if trained.whole_head else -1
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]

    def counted(b: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        """The texts' sizes, their distinct words, these words' counts (``missing`` beyond the head)
        and sums, and each token's word."""
        keys, counts, left = frequent.value
        tokens, sizes = _tokens(b.column(1))
        found, at = np.unique(tokens, return_inverse=True)
        if not len(keys):
            return sizes, found, np.full(len(found), missing), np.zeros(len(found), np.int64), at
        k = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
        here = keys[k] == found
        return sizes, found, np.where(here, counts[k], missing), np.where(here, left[k], 0), at

    def sums(sizes: np.ndarray, c: np.ndarray, s: np.ndarray, at: np.ndarray, before: np.ndarray, level: np.ndarray) -> list[pa.Array]:
        """n_tokens to score of each text, from its tokens' words, those before them and their pairs' levels."""
        starts = np.cumsum(sizes) - sizes
        logs = np.log10(model.alone(c))[at], np.log10(model.after(c[before], s[before], c[at], level))
        return [pa.array(sizes), *(pa.array(np.add.reduceat(x, starts)) for x in ((c > 0).astype(np.int64)[at], *logs))]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole, 1, CHUNK)):
            sizes, found, c, s, at = counted(b)
            before, pair_at, v, w = _distinct_pairs(found, at)
            level = shared.value.levels(*pair_place(found[v], found[w], buckets))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *sums(sizes, c, s, at, before, level[pair_at])], names=names)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    out = ["doc_id", "held_out", "n_tokens", "n_known", F.lit(trained.n).cast("long").alias("train_tokens"), "base_score", "score"]
    if trained.whole_head and near == buckets:
        return rows.select("doc_id", "text", "held_out").mapInArrow(score, schema).select(*out)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole, 1, CHUNK)):
            sizes, found, c, s, at = counted(b)
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (b.column(0), b.column(2), pa.array(sizes))]
            packed = [pa.array([x], pa.binary()) for x in (found.tobytes(), _squeezed(at))]
            yield pa.RecordBatch.from_arrays([*lists, *packed, pa.array([len(at)])], names=["ids", "held", "sizes", "words", "places", "n"])

    parts = "ids array<long>, held array<boolean>, sizes array<long>, words binary, places binary, n long"
    held_slices = written_by(rows.select("doc_id", "text", "held_out").mapInArrow(index, parts).withColumn("slice", F.monotonically_increasing_id()), "lm-slices", "slice", buckets)
    salts = 1 + int(held_slices.agg(F.sum("n")).first()[0] or 0) * KEY_BYTES // (buckets * ASKED)

    def opened(words: pa.Scalar, places: pa.Scalar, size: int) -> tuple[np.ndarray, ...]:
        """A slice's distinct words, their counts and sums as far as workers know, its tokens, and its pairs."""
        keys, counts, left = frequent.value
        found, at = np.frombuffer(words.as_buffer(), U), _spread(places.as_buffer(), size)
        c, s = np.full(len(found), missing), np.zeros(len(found), np.int64)
        if len(keys):
            k = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
            here = keys[k] == found
            c, s = np.where(here, counts[k], missing), np.where(here, left[k], 0)
        before, pair_at, v, w = _distinct_pairs(found, at)
        return found, c, s, at, before, pair_at, *pair_place(found[v], found[w], buckets)

    def far(found: np.ndarray, c: np.ndarray, bucket: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, bytes]]:
        """kind, bucket, which of the slice's words or pairs are to be asked there, and their keys."""
        lacking = np.flatnonzero(c < 0)
        away = np.flatnonzero(bucket >= near)
        for kind, mine, at in ((1, lacking, word_bucket(found[lacking], buckets)), (2, away, bucket[away])):
            order, there, cuts = _cuts(at)
            for k, i, j in zip(there, cuts[:-1], cuts[1:], strict=True):
                some = mine[order[i:j]]
                yield kind, k, some, found[some].tobytes() if kind == 1 else _short(keys[some])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
        for b in batches:
            for one, words, places, size in zip(*b.columns, strict=True):
                found, c, _, _, _, _, bucket, keys = opened(words, places, size.as_py())
                asked = [(kind, k, one.as_py() % salts, one.as_py(), x) for kind, k, _, x in far(found, c, bucket, keys)]
                columns = list(zip(*asked, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names=["kind", "bucket", "salt", "slice", "keys"])

    def answer(asked: pa.Table, store: pa.Table) -> pa.Table:
        values: list[bytes] = []
        if asked.num_rows:
            kind, stored = asked["kind"][0].as_py(), store.num_rows > 0
            if kind == 2:
                segment = LogBloom(1, {0: store["a"][0].as_buffer()} if stored else {})
            else:
                keys, counts, left = (np.frombuffer(store[x][0].as_buffer() if stored else b"", t) for x, t in (("a", U), ("b", np.int64), ("c", np.int64)))
            for x in asked["keys"]:
                if kind == 2:
                    x = _long(x.as_buffer())
                    values.append(segment.levels(np.zeros(len(x), np.int64), x).tobytes())
                    continue
                x = np.frombuffer(x.as_buffer(), U)
                k = np.minimum(np.searchsorted(keys, x), max(len(keys) - 1, 0))
                here = keys[k] == x if len(keys) else np.zeros(len(x), bool)
                values.append(np.concatenate([np.where(here, y[k], 0) if len(keys) else np.zeros(len(x), np.int64) for y in (counts, left)]).tobytes())
        return pa.table({"slice": asked["slice"], "kind": asked["kind"], "bucket": asked["bucket"], "values": pa.array(values, pa.binary())})

    def finish(texts: pa.Table, answers: pa.Table) -> pa.Table:
        t = {k: texts[k][0] for k in texts.column_names}  # a slice is one row
        found, c, s, at, before, pair_at, bucket, keys = opened(t["words"], t["places"], t["n"].as_py())
        level = shared.value.levels(bucket, keys) if near else np.zeros(len(keys), np.uint8)
        told = {(k.as_py(), b.as_py()): x for k, b, x in zip(answers["kind"], answers["bucket"], answers["values"], strict=True)}
        for kind, k, place, _ in far(found, c.copy(), bucket, keys):
            if kind == 1:
                c[place], s[place] = np.frombuffer(told[kind, k].as_buffer(), np.int64).reshape(2, -1)
            else:
                level[place] = np.frombuffer(told[kind, k].as_buffer(), np.uint8)
        return pa.table([t["ids"].values, t["held"].values, *sums(t["sizes"].values.to_numpy(), c, s, at, before, level[pair_at])], names=names)

    store = trained.pairs.where(F.col("bucket") >= near).select(F.lit(2).alias("kind"), "bucket", F.col("bits").alias("a"), F.lit(None).cast("binary").alias("b"), F.lit(None).cast("binary").alias("c"))
    if missing:
        store = store.unionByName(trained.words.select(F.lit(1).alias("kind"), "bucket", F.col("keys").alias("a"), F.col("c").alias("b"), F.col("s").alias("c")))
    store = store.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    by = ["kind", "bucket", "salt"]
    asked = held_slices.select("slice", "words", "places", "n").mapInArrow(ask, "kind int, bucket int, salt int, slice long, keys binary")
    answers = asked.groupBy(*by).cogroup(store.groupBy(*by)).applyInArrow(answer, "slice long, kind int, bucket int, values binary")
    return held_slices.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(finish, schema).select(*out)
