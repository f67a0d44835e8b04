"""Words of an Arrow column of texts as numpy arrays of 64-bit hashes.

Words are runs of bytes other than ASCII white space; UTF-8 uses no such byte inside a character. A whole
batch is cut and hashed by array operations, so the time per word does not depend on the text length.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# ASCII without letters and digits, for words without the punctuation around them.
PUNCTUATED = np.array([byte < 128 and not chr(byte).isalnum() for byte in range(256)])
# A to Z in lower case, all other bytes as they are.
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32

BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 2**64)
SLICE_BYTES = 1 << 18
STEM_BYTES = 4


class Words(NamedTuple):
    """Words of some texts in order: index of the text in the batch, hash, hash of the beginning."""

    text: np.ndarray
    hash: np.ndarray
    stem: np.ndarray  # hash of the first bytes of the word
    first: int  # the first text of the slice
    texts: int  # and how many it has


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of an ordered pair of hashes."""
    return mix(left * np.uint64(0xD6E8FEB86659FD93) + mix(right ^ np.uint64(0xA0761D6478BD642F)))


def powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_tables = {"size": 0}


def power_tables(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; grown to the longest text seen."""
    if _tables["size"] < count:
        _tables.update(size=count, up=powers(BASE, count), down=powers(BASE_INVERSE, count))
    return _tables["up"][:count], _tables["down"]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where its texts begin and end; null reads as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", dtype=np.uint8), starts


def slices(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``SLICE_BYTES`` each; a longer text is a range of its own."""
    low = 0
    while low < len(starts) - 1:
        high = int(np.searchsorted(starts, starts[low] + SLICE_BYTES, side="right")) - 1
        high = min(max(high, low + 1), len(starts) - 1)
        yield low, high
        low = high


def words(column: pa.Array, separators: np.ndarray = SPACES) -> Iterator[Words]:
    """The words of a column, some texts at a time. Texts without words do not occur in ``text``.

    A to Z are read as lower case; ``separators`` marks the bytes between words.
    """
    data, starts = utf8(column)
    for low, high in slices(starts):
        begin = starts[low : high + 1] - starts[low]
        raw = data[starts[low] : starts[high]]
        if not len(raw):
            none = np.zeros(0, dtype=np.uint64)
            yield Words(np.zeros(0, dtype=np.int64), none, none, low, high - low)
            continue
        solid = ~separators[raw]
        inner = begin[1:-1]
        inner = inner[inner < len(raw)]
        after_gap = np.empty(len(raw), dtype=bool)
        after_gap[0] = True
        np.logical_not(solid[:-1], out=after_gap[1:])
        after_gap[inner] = True
        before_gap = np.empty(len(raw), dtype=bool)
        before_gap[-1] = True
        np.logical_not(solid[1:], out=before_gap[:-1])
        before_gap[inner[inner > 0] - 1] = True
        word_from = np.flatnonzero(solid & after_gap)
        word_to = np.flatnonzero(solid & before_gap)
        up, down = power_tables(len(raw) + 1)
        value = LOWERED[raw].astype(np.uint64) + np.uint64(1)
        value *= up[: len(raw)]
        total = np.cumsum(value, dtype=np.uint64)
        before = np.where(word_from > 0, total[word_from - 1], np.uint64(0))
        chunk = total[word_to] - before
        length = (word_to - word_from + 1).astype(np.uint64)
        hashed = mix(chunk * down[word_from] + length * np.uint64(0xC2B2AE3D27D4EB4F))
        text = np.searchsorted(begin, word_from, side="right") - 1
        stem = mix((total[np.minimum(word_to, word_from + STEM_BYTES - 1)] - before) * down[word_from])
        yield Words(text + low, hashed, stem, low, high - low)


def bounds(found: Words) -> np.ndarray:
    """Where the words of each text of the slice begin and end in ``hash``."""
    return np.searchsorted(found.text, np.arange(found.first, found.first + found.texts + 1))
