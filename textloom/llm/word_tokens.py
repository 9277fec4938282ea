"""Token ids of whole texts by a word-piece vocabulary file of the tokenizers library.

White space is dropped by this tokenizer and no token crosses it, nor the bounds of the pieces
into which its pattern splits a text. So a text's ids are those of its pieces one after the
other, as the library's model gives them. Texts of characters that are in normal form already
(one byte each in Latin-1) are split many at a time by numpy; pieces are made distinct by Arrow's
dictionary encoding, and only distinct ones are looked up. Other texts go word by word, and words
with other characters through the whole library. Each worker keeps what it has met (at most
``MOST_WORDS``, then it starts anew). Ids are kept as little-endian unsigned 32-bit bytes.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex

END_ID = 1
MOST_WORDS = 400_000
#: Words of such characters alone are in normal form already; the rest goes through the library.
PLAIN = regex.compile("[\x21-\x7e\xa1-\xff]{1,64}")
#: A character that a whole text may not have to be split as one.
ODD = re.compile("[^\t-\r\x20-\x7e\xa1-\xff]")
#: The pattern that ``pieces_of`` splits by.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters split at a time.
CHUNK = 24 << 20

SPACE, LETTER, NUMBER, OTHER, END = range(5)


def _kinds() -> np.ndarray:
    kinds = np.full(256, OTHER, np.uint8)
    for b in range(256):
        c = chr(b)
        kinds[b] = END if b == 0 else SPACE if c in " \t\n\x0b\x0c\r" else LETTER if c.isalpha() else NUMBER if c.isnumeric() else OTHER
    return kinds


KINDS = _kinds()
LOWER = np.array([ord(chr(b).lower()) for b in range(256)], np.uint8)


def pieces_of(texts: bytes) -> pa.Array:
    """The pieces of Latin-1 texts, lower-cased, each text's NUL at its end a piece of its own."""
    raw = LOWER[np.frombuffer(texts, np.uint8)]
    kind = KINDS[raw]
    before = np.concatenate((np.zeros(1, np.uint8), kind[:-1]))
    start = (kind != before) | (kind == NUMBER) | (kind == END)
    quotes = np.flatnonzero((raw == 39) & (before != OTHER))  # a quote that no other mark precedes
    if len(quotes):
        pad = np.concatenate((raw, np.zeros(2, np.uint8)))
        one, two = pad[quotes + 1], pad[quotes + 2]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = np.zeros(len(quotes), bool)
        for a, b in (b"re", b"ve", b"ll"):
            long |= (one == a) & (two == b)
        size = np.where(short, 2, np.where(long, 3, 0))
        at, size = quotes[size > 0], size[size > 0]
        start[at + 1] = False
        start[at[size == 3] + 2] = False
        start[(at + size)[at + size < len(start)]] = True
    start &= kind != SPACE
    solid = kind != SPACE
    offsets = np.concatenate((np.flatnonzero(start[solid]), [int(solid.sum())])).astype("<i4")
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw[solid])])


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds(dict):
    """Word (UTF-8 bytes without ASCII white space) to ids."""

    def __init__(self, path: str) -> None:
        super().__init__()
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        spec = json.loads(self.library.to_str())
        self.pieces = Pieces(self.library.model.tokenize, "utf-8")
        self.latin = Pieces(self.library.model.tokenize, "latin-1")
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(split).findall
        self.by_chunk = split == PATTERN
        self.special = [x["content"] for x in spec["added_tokens"]]

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        if PLAIN.fullmatch(text) and not any(x in text for x in self.special):
            ids = b"".join(map(self.pieces.__getitem__, (p.encode() for p in self.split(text.lower()))))
        else:
            got = self.library.encode(text, add_special_tokens=False).ids
            ids = struct.pack(f"<{len(got)}I", *got)
        if len(word) <= 64:
            if len(self) >= MOST_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def text(self, text: str | None) -> bytes:
        """The ids of a text word by word, the end id last."""
        return b"".join(map(self.__getitem__, (text or "").encode().split())) + END_BYTES

    def texts(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, the end id last."""
        held: list[bytes | None] = []  # a chunk's texts in Latin-1, None in place of others
        other: list[bytes] = []
        size = 0
        for t in texts:
            text = t.as_py() or ""
            if self.by_chunk and not ODD.search(text) and not any(x in text for x in self.special):
                held.append(text.encode("latin-1"))
                size += len(text)
            else:
                held.append(None)
                other.append(self.text(text))
            if size >= CHUNK or len(other) >= 1024:
                yield from self._chunk(held, other)
                held, other, size = [], [], 0
        yield from self._chunk(held, other)

    def _chunk(self, held: list[bytes | None], other: list[bytes]) -> Iterator[bytes]:
        plain = [x for x in held if x is not None]
        if plain:
            pieces = pieces_of(b"\0".join((*plain, b""))).dictionary_encode()
            known = [END_BYTES if p == b"\0" else self.latin[p] for p in pieces.dictionary.to_pylist()]
            index = pieces.indices.to_numpy()
            sizes = np.array([len(k) // 4 for k in known], np.int32)
            every = np.frombuffer(b"".join(known), "<u4")
            of = sizes[index]
            ends = np.cumsum(of)
            at = np.repeat(((np.cumsum(sizes) - sizes)[index] - ends + of).astype(np.int32), of)  # a chunk has far less than 2^31 ids
            at += np.arange(len(at), dtype=np.int32)
            ids = every[at].tobytes()
            cuts = iter((4 * ends[np.flatnonzero(index == known.index(END_BYTES))]).tolist())
        rest, at = iter(other), 0
        for x in held:
            if x is None:
                yield next(rest)
            else:
                end = next(cuts)
                yield ids[at:end]
                at = end


class Pieces(dict):
    """Piece of the splitting pattern, in an encoding, to ids."""

    def __init__(self, model, encoding: str) -> None:
        super().__init__()
        self.model, self.encoding = model, encoding
        # the byte-level alphabet: printable bytes stand for themselves, others follow from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.alphabet = {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}

    def __missing__(self, piece: bytes) -> bytes:
        got = [t.id for t in self.model(piece.decode(self.encoding).encode().decode("latin-1").translate(self.alphabet))]
        ids = struct.pack(f"<{len(got)}I", *got)
        if len(piece) <= 64:
            if len(self) >= MOST_WORDS:
                self.clear()
            self[piece] = ids
        return ids


END_BYTES = struct.pack("<I", END_ID)
_kept: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """This worker's tokenizer; workers are reused, and so are the words it has met."""
    if path not in _kept:
        _kept.clear()
        _kept[path] = WordIds(path)
    return _kept[path]
