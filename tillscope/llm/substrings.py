"""Where long strings repeat: anchors that find candidates, and suffix sorting in two stages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tillscope.llm.textarrays import Powers, mix

#: Length of a string that counts as repeated.
LENGTH = 200
# An anchor is the least 32-byte gram (by hash) among those inside a string of LENGTH bytes.
GRAM = 32
SPAN = LENGTH - GRAM + 1

# Texts are looked at in stretches of this size, which fits a processor's cache.
PIECE_BYTES = 1 << 17
_PLACE_BITS = 24
SEGMENT = 1 << 22

_POWERS = Powers(0xD1342543DE82EF95)


def segments(offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Stretches to look at together: first text, last text + 1, first byte, byte after the last.

    Texts go together up to ``PIECE_BYTES``; a long one is cut, with LENGTH - 1 bytes over, so
    that every string of LENGTH bytes lies whole in exactly one stretch.
    """
    first, n = 0, len(offsets) - 1
    while first < n:
        stop = int(np.searchsorted(offsets, offsets[first] + PIECE_BYTES, side="right")) - 1
        stop = min(max(stop, first + 1), n)
        low, high = int(offsets[first]), int(offsets[stop])
        if stop == first + 1 and high - low > SEGMENT:
            for at in range(low, high - LENGTH + 1, SEGMENT):
                yield first, stop, at, min(at + SEGMENT + LENGTH - 1, high)
        else:
            yield first, stop, low, high
        first = stop


def sliding_least(values: np.ndarray, span: int) -> np.ndarray:
    """Least of each ``span`` neighbours: running minima from both ends of blocks."""
    n = len(values) - span + 1
    blocks = -(-len(values) // span)
    padded = np.full(blocks * span, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    padded = padded.reshape(blocks, span)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[span - 1 : span - 1 + n])


class Rolling:
    """Hash of any stretch of ``data``, from running sums."""

    def __init__(self, data: np.ndarray):
        _POWERS.reach(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POWERS.up[: len(data)], out=self.sums[1:])

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return mix((self.sums[high] - self.sums[low]) * _POWERS.down[low], 31)


def anchored_runs(data: np.ndarray, ends: np.ndarray):
    """Strings of LENGTH bytes grouped by the place of their anchor.

    ``ends`` are the bytes where texts end. Neighbouring strings with one anchor are a run.
    Returns, per run, the first string's byte, the number of strings, the anchor's hash and a
    hash of all bytes the strings touch. Equal strings have equal anchors at equal distances,
    as their choice depends on the string alone.
    """
    empty = np.empty(0, np.int64)
    n = len(data) - LENGTH + 1
    if n <= 0:
        return empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    rolling = Rolling(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = rolling.of(at, at + GRAM)
    low_bits = np.uint64((1 << _PLACE_BITS) - 1)
    place = sliding_least((grams & ~low_bits) | at.view(np.uint64), SPAN) & low_bits
    crossing = np.zeros(n + 1, np.int32)
    np.add.at(crossing, np.clip(ends - LENGTH + 1, 0, n), 1)
    np.add.at(crossing, np.clip(ends, 0, n), -1)
    valid = np.cumsum(crossing[:n]) == 0
    changed = np.ones(n, bool)
    changed[1:] = (place[1:] != place[:-1]) | ~valid[:-1]
    first = np.flatnonzero(changed & valid)
    last = np.ones(n, bool)
    last[:-1] = (place[1:] != place[:-1]) | ~valid[1:]
    stop = np.flatnonzero(last & valid) + 1
    return first, stop - first, grams[place[first].astype(np.int64)], rolling.of(first, stop + LENGTH - 1)


def suffix_array(text: np.ndarray, rolling: Rolling, depth: int = LENGTH) -> np.ndarray:
    """All suffixes of ``text`` in the order of (at least) their first ``depth`` bytes, in two stages.

    A suffix smaller than the one a byte later is of the small kind; only these are sorted
    directly. Behind them the order of the others follows: scanning the buckets of first bytes
    upwards, the suffix that begins a byte earlier than the one met, if it is of the large
    kind, is the next in its own bucket.
    """
    n = len(text)
    order = np.empty(n, np.int64)
    if not n:
        return order
    # The kind of a suffix is that of the next place where the byte changes.
    changes = np.full(n, n - 1)
    differ = np.flatnonzero(text[:-1] != text[1:])
    changes[differ] = differ
    changes = np.minimum.accumulate(changes[::-1])[::-1]
    rises = np.append(text[:-1] < text[1:], False)
    small = rises[changes]
    counts = np.bincount(text, minlength=256)
    ends = np.cumsum(counts)
    head = ends - counts
    begin = head.copy()
    direct = _sort_directly(text, np.flatnonzero(small), rolling, depth)
    first = text[direct]
    small_counts = np.bincount(first, minlength=256)
    shift = ends - np.cumsum(small_counts)
    order[np.arange(len(direct)) + shift[first]] = direct

    order[head[text[n - 1]]] = n - 1
    head[text[n - 1]] += 1
    for c in np.flatnonzero(counts).tolist():
        done = int(begin[c])
        while done < head[c]:
            before = order[done : head[c]] - 1
            done = int(head[c])
            before = before[before >= 0]
            before = before[text[before] == c]
            order[done : done + len(before)] = before
            head[c] += len(before)
        before = order[begin[c] : ends[c]] - 1
        before = before[before >= 0]
        before = before[text[before] > c]
        bucket = text[before]
        by_bucket = np.argsort(bucket, kind="stable")
        before, bucket = before[by_bucket], bucket[by_bucket]
        sizes = np.bincount(bucket, minlength=256)
        place = head[bucket] + np.arange(len(bucket)) - (np.cumsum(sizes) - sizes)[bucket]
        order[place] = before
        head += sizes
    return order


def _sort_directly(text: np.ndarray, suffixes: np.ndarray, rolling: Rolling, depth: int) -> np.ndarray:
    """``suffixes`` in the order of their first ``depth`` bytes, eight bytes at a time.

    Suffixes whose whole ``depth`` bytes are equal stand together once and are not compared.
    """
    ends = np.minimum(suffixes + depth, len(text))
    _, one, same = np.unique(rolling.of(suffixes, ends), return_index=True, return_inverse=True)
    rows = suffixes[one]
    padded = np.zeros(len(text) + depth + 8, np.uint64)
    # What lies beyond the end of the text counts as zero bytes.
    padded[: len(text)] = text
    eight = np.zeros(len(text) + depth, np.uint64)
    for k in range(8):
        eight |= padded[k : k + len(eight)] << np.uint64(56 - 8 * k)
    rank = np.argsort(eight[rows], kind="stable")
    group = np.zeros(len(rows), np.int64)
    sorted_keys = eight[rows[rank]]
    group[1:] = np.cumsum(sorted_keys[1:] != sorted_keys[:-1])
    for offset in range(8, depth, 8):
        tied = np.zeros(len(rows), bool)
        tied[1:] = group[1:] == group[:-1]
        tied[:-1] |= tied[1:]
        open_places = np.flatnonzero(tied)
        if not len(open_places):
            break
        members = rank[open_places]
        keys = eight[np.minimum(rows[members] + offset, len(eight) - 1)]
        again = np.lexsort((keys, group[open_places]))
        rank[open_places] = members[again]
        keys, before = keys[again], group[open_places]
        split = np.zeros(len(rows), np.int64)
        inner = np.zeros(len(open_places), bool)
        inner[1:] = (before[1:] == before[:-1]) & (keys[1:] != keys[:-1])
        split[open_places] = inner
        group = group + np.cumsum(split)
    place = np.empty(len(rows), np.int64)
    place[rank] = np.arange(len(rows))
    return suffixes[np.argsort(place[same.ravel()], kind="stable")]


def repeated_strings(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which of the strings of LENGTH bytes at ``starts`` another of them equals.

    In the order of suffixes equal strings are neighbours, with a common prefix of LENGTH.
    """
    rolling = Rolling(text)
    wanted = np.zeros(len(text), bool)
    wanted[starts] = True
    order = suffix_array(text, rolling)
    order = order[wanted[order]]
    prefix = rolling.of(order, order + LENGTH)
    same = prefix[1:] == prefix[:-1]
    again = np.zeros(len(order), bool)
    again[1:] |= same
    again[:-1] |= same
    found = np.zeros(len(text), bool)
    found[order[again]] = True
    return found[starts]
