"""Benchmark passages in documents, whole or with edits, by pigeonhole pieces.

Texts are lower-cased and their white space is one space. An item of m characters may have
k = floor(``error_rate`` x m) edits. It is split into k + 1 pieces, of which k edits leave at least
one as it is. Exact hits of pieces are found for many texts at once: the first bytes at every place
are looked up in a table of the pieces' first bytes, and whole pieces are compared where these are
known. Of k edits over k + 1 pieces on a ring, some piece without an edit is followed by one with at
most one; so of a hit whose next piece is known, one half of that piece must stand next to it.
Where the stretch around the hits left holds all but ``GRAM`` k of the item's ``GRAM``-character
substrings (an edit changes no more), it is verified by Myers' bit-parallel edit distance (the item
anywhere in the stretch). None of these filters loses a match. Items go to the workers in blocks of
at most ``BLOCK_CHARS`` characters; a larger benchmark takes one pass over the documents a block.

Cases: null or empty texts match nothing, nor do null or empty items. ``matches`` searches items
of every length (``min_chars`` is 0), those of under 1 / ``error_rate`` characters without edits;
for ``clean`` items of under ``min_chars`` characters, which occur in clean texts, condemn no
document. Items that repeat give a row each. Rows of documents that repeat give rows each. Empty
tables give empty results. Further columns are ignored by ``matches`` and pass through ``clean``.
"""

from __future__ import annotations

import math
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import quoted

BLOCK_CHARS = 16 << 20
#: Bytes of texts searched at a time, and the bits of the table of first bytes.
CHUNK, TABLE_BITS = 16 << 20, 22
GRAM = 4
U = np.uint64


def plain(text: str) -> str:
    return " ".join(text.lower().split())


def places(text: str) -> list[int]:
    """For each character of ``plain(text)``, its place in ``text``; the text's end is last."""
    out, gap = [], False
    for i, c in enumerate(text):
        if c.isspace():
            gap = bool(out)
            continue
        if gap:
            out.append(i - 1)
            gap = False
        out += [i] * len(c.lower())
    return [*out, len(text)]


def myers(item: str, text: str, most: int, anchored: bool = False) -> tuple[int, int] | None:
    """The least distance of ``item`` to a stretch of ``text``, and the first end of such a
    stretch; None where it is over ``most``. anchored: the stretch starts where the text does."""
    every, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    where: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        where[c] |= 1 << i
    more, less, score = every, 0, len(item)  # rows where the column goes up, down
    best = (most + 1, 0)
    for end, c in enumerate(text, 1):
        eq = where.get(c, 0)
        still = eq | less
        across = (((eq & more) + more) ^ more) | eq
        up, down = less | (every & ~(across | more)), more & across
        score += bool(up & top) - bool(down & top)
        up, down = ((up << 1) | anchored) & every, (down << 1) & every
        more, less = down | (every & ~(still | up)), up & still
        if score < best[0]:
            best = (score, end)
    return best if best[0] <= most else None


class Searcher:
    """The pieces of one block of items: (item id, text) pairs."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float, min_chars: int) -> None:
        self.items = [(i, p, math.floor(error_rate * len(p))) for i, t in items if t is not None and len(p := plain(t)) >= max(1, min_chars)]
        self.raw: list[bytes] = []
        of, number, starts = [], [], []
        for n, (_, text, k) in enumerate(self.items):
            raw, cuts = text.encode(), [len(text) * j // (k + 1) for j in range(k + 2)]
            if len(raw) != len(text):  # places in bytes
                ends = np.cumsum([0, *(len(c.encode()) for c in text)])
                cuts = ends[cuts].tolist()
            self.raw.append(raw)
            of += [n] * (k + 1)
            number += range(k + 1)
            starts.append(cuts)
        first = np.cumsum([0, *(len(c) for c in starts)])[:-1]  # of an item's cuts
        cuts = np.array([c for cs in starts for c in cs], np.int64)
        of, number = np.array(of, np.int64), np.array(number, np.int64)
        at = first[of] + number if len(of) else np.zeros(0, np.int64)
        start, end = cuts[at], cuts[at + 1] if len(at) else at
        self.cuts, self.first = cuts, first
        #: By width of the first bytes looked up: keys in order, and of each piece its item and number.
        self.tables: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        sizes = np.minimum(end - start, 8)
        for width in sorted(set(sizes.tolist())):
            mine = np.flatnonzero(sizes == width)
            keys = np.array([int.from_bytes(self.raw[n][s : s + width], "little") for n, s in zip(of[mine].tolist(), start[mine].tolist(), strict=True)], U)
            order = np.argsort(keys, kind="stable")
            table = np.zeros(1 << TABLE_BITS, bool)
            table[self._slots(keys)] = True
            self.tables.append((width, keys[order], of[mine][order], number[mine][order], table))

    @staticmethod
    def _slots(keys: np.ndarray) -> np.ndarray:
        return ((keys * U(0x9E3779B97F4A7C15)) >> U(64 - TABLE_BITS)).astype(np.int64)

    def _hits(self, texts: list[bytes]) -> dict[int, dict[int, list[tuple[int, int]]]]:
        """By text and item: (place in the text in bytes, place of the piece in the item in bytes)."""
        body = b"\n".join(texts) + b"\n" * 8  # no text has a line feed, so no hit crosses two
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        out: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        eights = np.ndarray((len(body) - 7,), "<u8", body, strides=(1,))
        for width, known, of, number, table in self.tables:
            keys = eights & U((1 << 8 * width) - 1) if width < 8 else eights
            at = np.flatnonzero(table[self._slots(keys)])
            found = keys[at]
            low, high = np.searchsorted(known, found), np.searchsorted(known, found, "right")
            some = high > low
            at, low, high = at[some], low[some], high[some]
            rows = np.searchsorted(starts, at, "right") - 1
            for place, row, i, j in zip(at.tolist(), rows.tolist(), low.tolist(), high.tolist(), strict=True):
                for n, k in zip(of[i:j].tolist(), number[i:j].tolist(), strict=True):
                    if (where := self._stands(body, place, n, k)) >= 0:
                        out[row][n].append((place - int(starts[row]), where))
        return out

    def _stands(self, body: bytes, place: int, n: int, k: int) -> int:
        """The piece's place in its item if it is at ``place`` and half of the next piece next to it, else -1."""
        raw, at = self.raw[n], self.first[n] + k
        start, end = int(self.cuts[at]), int(self.cuts[at + 1])
        if not body.startswith(raw[start:end], place):
            return -1
        if end < len(raw):  # a piece follows; a character has at most 4 bytes
            last, after = int(self.cuts[at + 2]), place + end - start
            half = (end + last) // 2
            while half < last and raw[half] & 0xC0 == 0x80:  # between characters
                half += 1
            if not body.startswith(raw[end:half], after) and body.find(raw[half:last], max(after, after + half - end - 4), after + last - end + 4) < 0:
                return -1
        return start

    def find(self, texts: pa.Array, first: bool = False) -> Iterator[list[tuple[int, int, int, int]]]:
        """For each text: item id, distance, start and end in the text, of the best match of each
        item. first: one match is enough."""
        held: list[str] = []
        size = 0
        for t in texts:
            held.append(t.as_py() or "")
            size += len(held[-1])
            if size >= CHUNK:
                yield from self._found(held, first)
                held, size = [], 0
        yield from self._found(held, first)

    def _found(self, texts: list[str], first: bool) -> Iterator[list[tuple[int, int, int, int]]]:
        if not self.items:
            yield from ([] for _ in texts)
            return
        whole = [plain(t) for t in texts]
        raw = [w.encode() for w in whole]
        hits = self._hits(raw)
        for row, text in enumerate(texts):
            yield self._matched(text, whole[row], raw[row], hits[row], first) if row in hits else []

    def _matched(self, text: str, whole: str, raw: bytes, hits: dict[int, list[tuple[int, int]]], first: bool) -> list[tuple[int, int, int, int]]:
        out, origin = [], None
        for n, mine in hits.items():
            item, pattern, k = self.items[n]
            if len(raw) != len(whole) or len(self.raw[n]) != len(pattern):  # places in characters
                mine = [(len(raw[:place].decode()), len(self.raw[n][:where].decode())) for place, where in mine]
            if best := self._best(whole, pattern, k, sorted(place - where for place, where in mine)):
                if first:
                    return [(item, *best)]
                origin = origin or places(text)
                out.append((item, best[0], origin[best[1]], origin[best[2] - 1] + 1))
        return out

    @staticmethod
    def _best(whole: str, pattern: str, k: int, at: list[int]) -> tuple[int, int, int] | None:
        """Distance, start, end in ``whole``, from stretches around the places where hits put the item."""
        best = None
        grams = [pattern[x : x + GRAM] for x in range(len(pattern) - GRAM + 1)]
        cuts = [0, *(i for i in range(1, len(at)) if at[i] - at[i - 1] > k), len(at)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            low, high = max(0, at[i] - k), min(len(whole), at[j - 1] + len(pattern) + k)
            stretch = whole[low:high]
            there = {stretch[x : x + GRAM] for x in range(len(stretch) - GRAM + 1)}
            if sum(map(there.__contains__, grams)) < len(grams) - GRAM * k:
                continue
            if got := myers(pattern, stretch, k if best is None else best[0] - 1):
                end = low + got[1]
                back = myers(pattern[::-1], whole[max(0, end - len(pattern) - k) : end][::-1], got[0], anchored=True)
                best = (got[0], end - back[1], end)
                if not got[0]:
                    break
        return best


def _blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of a bounded size, dealt by hash; as many passes as there are blocks."""
    rows = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = -(-size // BLOCK_CHARS)
    for b in range(max(1, n)):
        block = rows if n <= 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        yield [(r.item_id, r.text) for r in block.collect()]


_kept: dict[tuple, Searcher] = {}


def _searcher(shared, key: str, error_rate: float, min_chars: int) -> Searcher:
    if key not in _kept:
        _kept.clear()
        _kept[key] = Searcher(shared.value, error_rate, min_chars)
    return _kept[key]


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", error_rate: float = 0.1, min_chars: int = 0) -> DataFrame:
    """doc_id, item_id, distance, start, end: the best match of each item in each document."""
    rows = docs.select(F.col(id_col).cast("long"), text_col)

    def of_block(block: list[tuple[int, str]]) -> DataFrame:
        shared, key = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            find = _searcher(shared, key, error_rate, min_chars).find
            for b in batches:
                got = [(i, *m) for i, found in zip(b.column(0).to_pylist(), find(b.column(1)), strict=True) for m in found]
                columns = list(zip(*got, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "distance", "start", "end"])

        return rows.mapInArrow(search, "doc_id long, item_id long, distance long, start long, end long")

    return reduce(DataFrame.unionByName, map(of_block, _blocks(items, item_col, item_text_col)))


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", error_rate: float = 0.1, min_chars: int = 50) -> DataFrame:
    """The rows of ``docs`` that hold no item of at least ``min_chars`` characters."""
    # the other columns are one, so any names go through
    others = F.struct(*(F.col(quoted(c)) for c in docs.columns if c != text_col)).alias("own")
    rows = docs.select(F.col(quoted(text_col)).alias("text"), others if len(docs.columns) > 1 else F.lit(None).cast("string").alias("own"))
    for block in _blocks(items, item_col, item_text_col):
        shared, key = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

        def keep(batches: Iterator[pa.RecordBatch], shared=shared, key=key) -> Iterator[pa.RecordBatch]:
            find = _searcher(shared, key, error_rate, min_chars).find
            for b in batches:
                yield b.filter(pa.array([not found for found in find(b.column(0), first=True)], pa.bool_()))

        rows = rows.mapInArrow(keep, rows.schema)
    return rows.select(*((F.col("text") if c == text_col else F.col("own").getField(c)).alias(c) for c in docs.columns))
