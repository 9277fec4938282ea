"""SentencePiece (BPE) encoding and decoding of whole texts, exact, by backtracking.

The model file is a sentencepiece model: BPE pieces with scores, bytes for characters that it
lacks. No merges are replayed over a text. A sequence of pieces is the encoding of its text
exactly if every two neighbours are: merges inside them go on as if they stood alone, and the
first merge across a border would show in the two alone. So the text is covered from the left by
the longest piece that starts at a place (Aho-Corasick finds these); a piece that does not suit
the one before gives way to its longest shorter beginning; where none is left the place is marked
in a bitfield as one from which nothing goes on, and the piece before gives way. Whether two
pieces suit is found by merging the two again, and remembered.

No piece has U+2581 after another character, and none has a line feed, so the text between these
is encoded by itself; encodings of short stretches are remembered (at most twice ``MOST_WORDS`` by each
worker). Decoding is sentencepiece's own, in parts of ``PART`` ids: each part
after the first starts with an id that is taken off again, for a decoded text loses one leading
space.

Cases: a null text counts as empty: no ids, and the empty text. Texts of any length are encoded
whole. Repeated rows, null ids and ids that repeat stay rows of their own. An empty table gives an
empty result. Further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .token_counts import vocabulary_path

MARK = "▁"
STRETCHES = re.compile(r"\n| *[^ \n]+| +").finditer
MOST_WORDS, MOST_PAIRS, PART, WINDOW = 400_000, 1_000_000, 1 << 18, 256
#: Bytes of text between two results of a worker.
SLICE = 8 << 20


class PieceCoder:
    """A model's encoder and decoder."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        usual = [i for i in range(self.model.get_piece_size()) if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i) or self.model.is_byte(i))]
        self.pieces = {self.model.id_to_piece(i): i for i in usual}
        self.score = {self.model.id_to_piece(i): self.model.get_score(i) for i in usual}
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in self.pieces) or not {c for p in self.pieces for c in p} <= set(self.pieces):
            raise ValueError("this vocabulary has pieces that cross words, or characters in pieces only")
        self.bytes = [self.model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.letters = {p for p in self.pieces if len(p) == 1}
        self.longest_piece = max(map(len, self.pieces))
        self.automaton = ahocorasick.Automaton()
        for p in self.pieces:
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.suits: dict[tuple[str, str], bool] = {}
        self.beginning: dict[str, str] = {}
        self.first = self.pieces["a"]

    def merged(self, text: str) -> list[str]:
        """The pieces of a few characters by merging the best pair, the leftmost of equal ones."""
        parts = list(text)
        while len(parts) > 1:
            scores = [self.score.get(a + b, float("-inf")) for a, b in zip(parts, parts[1:], strict=False)]
            if (best := max(scores)) == float("-inf"):
                break
            k = scores.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def suit(self, a: str, b: str) -> bool:
        """Whether ``a`` stays ``a`` before ``b``, and ``b`` after it; ``a`` may be empty."""
        if (out := self.suits.get((a, b))) is None:
            out = self.merged(a + b) == ([a, b] if a else [b])
            if len(self.suits) >= MOST_PAIRS:
                self.suits.clear()
            self.suits[a, b] = out
        return out

    def shorter(self, piece: str) -> str:
        """The longest piece that ``piece`` begins with, itself left out; empty for one character."""
        if (out := self.beginning.get(piece)) is None:
            out = next((piece[:k] for k in range(len(piece) - 1, 0, -1) if piece[:k] in self.pieces), "")
            self.beginning[piece] = out
        return out

    def cover(self, text: str) -> array:
        """The ids of a text of which every character is a piece, so that a piece starts everywhere."""
        n, pos, known = len(text), 0, 0
        suits, suit, beginning, shorter = self.suits.get, self.suit, self.beginning.get, self.shorter
        out, failed, piece, longest = [""], bytearray(n // 8 + 1), "", None
        while pos < n:
            if piece is not longest or pos >= known:  # the search so far has other matches, or has come to its window's end
                matches = self.automaton.iter_long(text[pos : pos + WINDOW])
                known = n if pos + WINDOW >= n else pos + WINDOW - self.longest_piece
            piece = longest = next(matches)[1]
            while True:
                last = out[-1]
                while piece:
                    end = pos + len(piece)
                    if not failed[end >> 3] >> (end & 7) & 1:
                        if (fits := suits((last, piece))) is None:
                            fits = suit(last, piece)
                        if fits:
                            break
                    if (less := beginning(piece)) is None:
                        less = shorter(piece)
                    piece = less
                if piece:
                    break
                failed[pos >> 3] |= 1 << (pos & 7)  # nothing goes on from here: the piece before gives way
                piece, longest = out.pop(), None
                pos -= len(piece)
            out.append(piece)
            pos = end
        return array("i", map(self.pieces.__getitem__, out[1:]))

    def stretch(self, text: str) -> array:
        """The ids of a text between borders, spaces as U+2581."""
        if self.letters.issuperset(text):
            return self.cover(text)
        out, held = array("i"), []
        for c in text:
            if c in self.letters:
                held.append(c)
            else:
                if held:
                    out += self.cover("".join(held))
                    held = []
                out.extend(self.bytes[b] for b in c.encode())
        return out + self.cover("".join(held)) if held else out

    def encode(self, text: str) -> Iterator[array]:
        """The ids of a whole text, in parts."""
        part, kept = bytearray(), self.kept
        for found in STRETCHES(f" {text.replace(MARK, ' ')}") if text else ():
            word = found.group()
            if (ids := kept.get(word)) is None:
                kept = self.keep(word)
                ids = kept[word] if word in kept else self.stretch(word.replace(" ", MARK)).tobytes()
            part += ids
            if len(part) >= 4 * PART:
                yield array("i", bytes(part))
                part = bytearray()
        if part:
            yield array("i", bytes(part))

    def keep(self, word: str) -> dict[str, bytes]:
        """The remembered stretches, with this one if it is short. Once they are ``MOST_WORDS`` they
        become the older ones; those of these that come again are taken over."""
        if len(word) <= 48:
            if len(self.kept) >= MOST_WORDS:
                self.kept, self.older = {}, self.kept
            self.kept[word] = self.older.get(word) or self.stretch(word.replace(" ", MARK)).tobytes()
        return self.kept

    def decode(self, parts: Iterator[array]) -> Iterator[str]:
        """The text of ids that come in parts; no part ends within a character's bytes."""
        for k, ids in enumerate(parts):
            yield self.model.decode([self.first, *ids])[1:] if k else self.model.decode(ids.tolist())


_kept: dict[str, PieceCoder] = {}


def piece_coder(path: str) -> PieceCoder:
    if path not in _kept:
        _kept.clear()
        _kept[path] = PieceCoder(path)
    return _kept[path]


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """id, ids (binary, unsigned 32-bit little-endian) of each row."""
    path = vocabulary or vocabulary_path()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(path)
        for batch in batches:
            for b in slices(batch, 1, SLICE):
                ids = [b"".join(p.tobytes() for p in coder.encode(t.as_py() or "")) for t in b.column(1)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], names=["id", "ids"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(work, "id long, ids binary")


def round_trips(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """id, n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256 of each row: ids
    and decoded texts are digested part by part as they come."""
    path = vocabulary or vocabulary_path()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(path)
        for batch in batches:
            for b in slices(batch, 1, SLICE):
                rows: list[list] = [[], [], []]
                for t in b.column(1):
                    ids, text, n = hashlib.sha256(), hashlib.sha256(), 0

                    def seen(parts: Iterator[array]) -> Iterator[array]:
                        nonlocal n
                        for p in parts:
                            ids.update((b"," if n else b"") + ",".join(map(str, p)).encode())  # noqa: B023
                            n += len(p)
                            yield p

                    for part in coder.decode(seen(coder.encode(t.as_py() or ""))):
                        text.update(part.encode())
                    for column, value in zip(rows, (n, ids.hexdigest(), text.hexdigest()), strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(work, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
