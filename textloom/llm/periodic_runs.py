"""Runs of repeated words in whole texts, by the method of Kolpakov and Kucherov.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that no
neighbouring word extends, and here of at least ``least`` words and ``times`` periods. Words are the
stretches [^\\x20\\x09-\\x0D]+ of a text. All runs of a text are found in time that grows with its
length:

* LZ factors (the longest stretch that has begun before, or one new word) come from a suffix
  automaton that knows where each of its states first ended;
* Main's step finds the runs that cross or touch the end of a factor, from the longest common
  extensions to both sides of that place for every period (four Z arrays);
* a run strictly inside a factor is copied from the earlier place that the factor repeats.

In a run of four periods or more every three neighbouring words occur three times at least, so
stretches of a text whose threes of words are rarer hold no run: the automaton is built over the
other stretches only, each by itself. Documents are independent of each other, so nothing is
shuffled; a text takes about 100 bytes a word while it is worked on.

Cases: a null or empty text, or one of white space, has no words and no runs, and its collapsed
text is empty. Ties in a text: runs are listed by start, then period. Repeated rows, null ids and
ids that repeat stay rows of their own. An empty table gives an empty result. Further columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Bytes of text between two results of a worker.
SLICE = 4 << 20
SCHEMA = "id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def factors(w: list[int]) -> list[tuple[int, int, int]]:
    """LZ factors as (start, length, an earlier start; -1 for a new word)."""
    # a state's first transition stands in two arrays, further ones in a dictionary of the state
    size, link, ends = array("i", [0]), array("i", [-1]), array("i", [-1])
    letter, target, more = array("i", [-1]), array("i", [-1]), {}

    def add(length: int, suffix: int, end: int) -> int:
        size.append(length)
        link.append(suffix)
        ends.append(end)
        letter.append(-1)
        target.append(-1)
        return len(size) - 1

    last = 0
    for i, c in enumerate(w):
        new = add(size[last] + 1, 0, i)
        p = last
        while p >= 0:
            if letter[p] == -1:
                letter[p], target[p] = c, new
            elif letter[p] == c:
                q = target[p]
                break
            elif p not in more:
                more[p] = {c: new}
            elif (q := more[p].get(c, -1)) >= 0:
                break
            else:
                more[p][c] = new
            p = link[p]
        if p >= 0:
            if size[p] + 1 < size[q]:
                copy = add(size[p] + 1, link[q], ends[q])
                letter[copy], target[copy] = letter[q], target[q]
                if q in more:
                    more[copy] = dict(more[q])
                while p >= 0:
                    if letter[p] == c and target[p] == q:
                        target[p] = copy
                    elif letter[p] != c and p in more and more[p].get(c) == q:
                        more[p][c] = copy
                    else:
                        break
                    p = link[p]
                link[q] = q = copy
            link[new] = q
        last = new

    out, i, n = [], 0, len(w)
    while i < n:
        state = length = 0
        while i + length < n:
            c = w[i + length]
            after = target[state] if letter[state] == c else more[state][c]
            if ends[after] - length >= i:
                break  # the first of these stretches begins here
            state, length = after, length + 1
        out.append((i, max(1, length), ends[state] - length + 1 if length else -1))
        i += max(1, length)
    return out


def z_array(s: list[int]) -> list[int]:
    """For each place the longest common beginning of ``s`` and of what starts there; 0 at the start."""
    n, out = len(s), [0] * len(s)
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right and (k := out[i - left]) >= right - i:
            k = right - i
        elif i < right:
            out[i] = k
            continue
        while i + k < n and s[k] == s[i + k]:
            k += 1
        out[i] = k
        if i + k > right:
            left, right = i, i + k
    return out


def stretch_runs(w: list[int], least: int = 6, times: int = 4) -> dict[tuple[int, int], int]:
    """Runs of the sequence as (first, last) to the smallest period."""
    n, found, starts = len(w), {}, {}
    cut = factors(w)

    def meet(first: int, last: int, period: int) -> None:
        long = last - first + 1
        if long < least or long < times * period:
            return
        if first and w[first - 1] == w[first - 1 + period] or last < n - 1 and w[last + 1] == w[last + 1 - period]:
            return  # it goes on beyond the window, and ends in a later factor
        if period < found.get((first, last), n):
            found[first, last] = period
            starts.setdefault(first, {})[last] = period

    for k in range(len(cut) + 1):
        at, length, source = cut[k] if k < len(cut) else (n, 0, -1)
        before = cut[k - 1][1] if k else 0
        # a run that ends here starts less than a period before the factor before, or that one
        # would have been longer; so its periods, and what has to be seen to the left, are bounded
        most = (before + length) // (times - 1) + 1
        if before + length >= least and at:
            low, high = max(0, at - before - most), at + length
            own, past = w[at:high], w[low:at]
            m, t = len(own), len(past)
            back = past[::-1]
            # common extensions of the places ``at`` and ``at`` + p, then of ``at`` - p and ``at``
            ahead_of = z_array(own)
            behind_of = z_array([*back, -1, *own[::-1], *back])
            ahead_to = z_array([*own, -1, *past, *own])
            behind_to = z_array(back)
            for p in range(1, min(m, most) + 1):
                ahead = ahead_of[p] if p < m else 0
                behind = min(behind_of[t + 1 + m - p], t)
                meet(at - behind, at + p - 1 + ahead, p)
            for p in range(1, min(t, most) + 1):
                ahead = min(ahead_to[m + 1 + t - p], m)
                behind = behind_to[p] if p < t else 0
                meet(at - p - behind, at - 1 + ahead, p)
        if source >= 0 and length >= least + 2:
            shift, end = at - source, at + length - 1
            for x in range(at + 1, end - least + 1):
                for last, period in list(starts.get(x - shift, {}).items()):
                    if last + shift < end:
                        found[x, last + shift] = period
                        starts.setdefault(x, {})[last + shift] = period
    return found


def repeated(ids: np.ndarray) -> Iterator[tuple[int, int]]:
    """The stretches (start, end) in which every three neighbouring words occur three times in all."""
    n = len(ids)
    if n < 3:
        return
    # pairs are numbered before threes, so products stay small
    pairs = np.unique(ids[:-1] * (int(ids.max()) + 1) + ids[1:], return_inverse=True)[1].astype(np.int64)
    _, place, count = np.unique(pairs[:-1] * (int(ids.max()) + 1) + ids[2:], return_inverse=True, return_counts=True)
    often = np.concatenate(([0], (count[place] >= 3).astype(np.int8), [0]))
    edge = np.diff(often)
    for start, end in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
        yield start, end + 2


def text_runs(words: list[bytes], least: int = 6, times: int = 4) -> list[tuple[int, int, int]]:
    """All runs of the words as (start, length, period), by start and period."""
    if least < 6 or times < 4:
        raise ValueError("runs of at least six words and four periods")
    if len(words) < least:
        return []
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(x, len(number)) for x in words), np.int64, len(words))
    out = []
    if len(number) <= len(words) - 4:  # a word of a run comes four times
        for start, end in repeated(ids):
            if end - start >= least:
                out += [(start + a, b - a + 1, p) for (a, b), p in stretch_runs(ids[start:end].tolist(), least, times).items()]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period, joined by one space."""
    if runs:
        drop = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            drop[start + period] += 1
            drop[start + length] -= 1
        words = [words[k] for k in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]
    return b" ".join(words)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """id, n_words, runs (start, length, period), collapsed of each row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
        for batch in batches:
            for b in slices(batch, 1, SLICE):
                counts, runs, texts = [], [], []
                for text in b.column(1):
                    words = (text.as_py() or "").encode().split()
                    mine = text_runs(words, least, times)
                    counts.append(len(words))
                    runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in mine])
                    texts.append(collapsed(words, mine).decode())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(runs, kind), pa.array(texts, pa.string())], names=["id", "n_words", "runs", "collapsed"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(work, SCHEMA)
