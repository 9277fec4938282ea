"""Words of texts as 64-bit hashes, in numpy arrays, for the operators that count or compare them.

Words are the stretches [^\\x20\\x09-\\x0D]+ of a text in UTF-8, A-Z lower-cased. A word's hash is
the sum of its bytes' random values times powers of an odd number by place, mixed with its
length, so the words of many texts are hashed by a few array operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes hashed at a time; a text is never cut.
CHUNK = 1 << 20
#: Places in a word that have a power of their own; further ones take these again, times a factor.
PLACES = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def joined(*parts: np.ndarray) -> np.ndarray:
    """A hash of the sequences (parts[0][i], parts[1][i], ...)."""
    out = np.zeros(len(parts[0]), U)
    for p in parts:
        out = mix(out * U(0x9E3779B97F4A7C15) + p)
    return out


LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
VALUES = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))[LOWER]
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
POWERS = np.cumprod(np.concatenate((np.ones(1, U), np.full(PLACES - 1, 0xD6E8FEB86659FD93, U))))


def _hashed(texts: list[bytes]) -> Iterator[np.ndarray]:
    raw = np.frombuffer(b"\n".join((*texts, b"")), np.uint8)
    solid = ~SPACE[raw]
    first = np.flatnonzero(solid & np.concatenate(([True], ~solid[:-1])))
    after = np.cumsum([len(t) + 1 for t in texts])
    cuts = np.searchsorted(first, after).tolist()
    if not len(first):
        yield from (np.zeros(0, U) for _ in texts)
        return
    inside = np.flatnonzero(solid)
    starts = np.searchsorted(inside, first)
    sizes = np.diff(np.concatenate((starts, [len(inside)])))
    place = inside - np.repeat(first, sizes)
    value = VALUES[raw[inside]]
    if int(sizes.max()) > PLACES:
        value = value * (mix((place // PLACES).astype(U)) | U(1))
        place = place % PLACES
    words = mix(np.add.reduceat(value * POWERS[place], starts) + sizes.astype(U) * U(0x632BE59BD9B4E019))
    at = 0
    for end in cuts:
        yield words[at:end]
        at = end


def word_hashes(texts: pa.Array) -> Iterator[np.ndarray]:
    """The hashes of each text's words, in order; null has none."""
    held: list[bytes] = []
    size = 0
    for t in texts:
        held.append(b"" if (text := t.as_py()) is None else text.encode())
        size += len(held[-1])
        if size >= CHUNK:
            yield from _hashed(held)
            held, size = [], 0
    if held:
        yield from _hashed(held)
