"""Words and shingles of many texts at once, as numpy arrays.

Texts come as Arrow columns. They are handled as one array of UTF-8 bytes with the offset of
each text, in pieces of about ``PIECE_BYTES`` so that memory stays bounded (a longer text is a
piece of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20

# White space that separates words.
BLANKS = b" \t\n\x0b\x0c\r"

_BASE = 0x9E3779B97F4A7C15 | 1
_WRAP = 1 << 64


def _byte_codes(fold_case: bool, blanks: bytes) -> np.ndarray:
    """Code of each byte: 0 for a blank, otherwise the (folded) byte plus one."""
    codes = np.arange(1, 257, dtype=np.uint64)
    if fold_case:
        codes[65:91] += np.uint64(32)
    codes[list(blanks)] = 0
    return codes


#: Words between white space, A-Z lower-cased.
PLAIN_WORDS = _byte_codes(True, BLANKS)
#: Words of letters and digits, A-Z lower-cased; bytes beyond ASCII count as letters.
LETTER_WORDS = _byte_codes(True, bytes(b for b in range(128) if not chr(b).isalnum()))


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Scramble 64-bit values (a bijection for each seed)."""
    x = values + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) % _WRAP)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, as far as asked for."""

    def __init__(self, base: int = _BASE):
        self.base = base
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), PIECE_BYTES)
            for name, factor in (("up", self.base), ("down", pow(self.base, -1, _WRAP))):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))


_POWERS = Powers()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offset of each text; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    if not len(column):
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(
    data: np.ndarray, offsets: np.ndarray, size: int = PIECE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``size`` bytes: first text, last text + 1, bytes, offsets."""
    first, n = 0, len(offsets) - 1
    while first < n:
        stop = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        stop = min(max(stop, first + 1), n)
        low, high = offsets[first], offsets[stop]
        yield first, stop, data[low:high], offsets[first : stop + 1] - low
        first = stop


def words(data: np.ndarray, offsets: np.ndarray, codes: np.ndarray = PLAIN_WORDS):
    """64-bit hash of every word, each word's first byte, and the first word of each text.

    No word reaches into another text. The hash of a word does not depend on where it stands.
    """
    if not len(data):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    _POWERS.reach(len(data) + 1)
    coded = codes[data]
    inside = coded != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.empty(0, np.uint64), starts, np.zeros(len(offsets), np.int64)
    coded *= _POWERS.up[: len(data)]
    sums = np.add.reduceat(coded, starts) * _POWERS.down[starts]
    return mix(sums), starts, np.searchsorted(starts, offsets)


def ngrams(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each word on, across text borders."""
    factor, rolled = 1, np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for k in range(width):
        rolled += hashes[k : k + len(rolled)] * np.uint64(factor)
        factor = factor * 0xD6E8FEB86659FD93 % _WRAP
    return mix(rolled, 1)


def shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of each text; a text of fewer words has one, without words none."""
    rolled = ngrams(hashes, width)
    for low, high in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        count = high - low
        if count >= width:
            found = np.sort(rolled[low : high - width + 1])
            fresh = np.ones(len(found), bool)
            np.not_equal(found[1:], found[:-1], out=fresh[1:])
            yield found[fresh]
        elif count:
            steps = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)
            yield mix(np.array([np.sum(mix(hashes[low:high], 3) * (steps | np.uint64(1)))]), 2 + count)
        else:
            yield np.empty(0, np.uint64)
