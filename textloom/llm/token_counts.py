"""Token counts of whole texts by byte-pair merging with a heap and a linked list.

The vocabulary file is a sentencepiece model (BPE with byte fallback). A text's count is its
initial symbols less the merges; no ids are made. Symbols are the characters after the model's
own escaping (a space before the text, spaces as U+2581); a character that the vocabulary lacks
counts as its UTF-8 bytes and merges with nothing. The lowest-ranked adjacent pair is popped
from a heap until none is left; entries of pairs that no longer stand are skipped. No piece has
U+2581 after another character, and none has a line feed, so stretches between these are counted
by themselves and remembered (at most ``MOST_WORDS`` by each worker).

Cases: a null text counts as empty: 0 bytes, 0 tokens. Texts of any length are counted whole.
Repeated rows stay rows. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
MOST_WORDS = 400_000
STRETCH = re.compile(r"\n| *[^ \n]+| +").findall


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class MergeCounts(dict):
    """Stretch of text to the number of its tokens."""

    def __init__(self, path: str) -> None:
        super().__init__()
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usual = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
        pieces = {model.id_to_piece(i): model.get_score(i) for i in usual}
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces):
            raise ValueError("this vocabulary has pieces that cross words")
        order = sorted(set(pieces.values()), reverse=True)
        place = {s: k for k, s in enumerate(order)}
        self.rank = {p: place[s] for p, s in pieces.items()}

    def __missing__(self, stretch: str) -> int:
        n = self.merged(stretch.replace(" ", MARK))
        if len(stretch) <= 64:
            if len(self) >= MOST_WORDS:
                self.clear()
            self[stretch] = n
        return n

    def merged(self, symbols: str) -> int:
        """Initial symbols less merges."""
        rank, n = self.rank.get, len(symbols)
        count = sum(1 if c in self.rank else len(c.encode()) for c in symbols)
        part: list[str] = list(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, c) for i in range(n - 1) if (r := rank(c := part[i] + part[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, whole = heapq.heappop(heap)
            j = right[i]
            if not part[i] or j >= n or part[i] + part[j] != whole:
                continue  # one of the two has merged meanwhile
            part[i], part[j] = whole, ""
            right[i] = k = right[j]
            count -= 1
            if k < n:
                left[k] = i
                if (r := rank(c := whole + part[k])) is not None:
                    heapq.heappush(heap, (r, i, c))
            if (h := left[i]) >= 0 and (r := rank(c := part[h] + whole)) is not None:
                heapq.heappush(heap, (r, h, c))
        return count

    def text(self, text: str) -> int:
        return sum(map(self.__getitem__, STRETCH(f" {text.replace(MARK, ' ')}"))) if text else 0


_kept: dict[str, MergeCounts] = {}


def merge_counts(path: str) -> MergeCounts:
    if path not in _kept:
        _kept.clear()
        _kept[path] = MergeCounts(path)
    return _kept[path]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""
    path = vocabulary or vocabulary_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = merge_counts(path)
        for b in batches:
            n = np.array([counts.text(t.as_py() or "") for t in b.column(1)], np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n)], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
