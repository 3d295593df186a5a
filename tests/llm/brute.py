"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FOLD = str.maketrans(UPPER, UPPER.lower())


def fold(text):
    return (text or "").translate(FOLD)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, width=5):
    w = words(fold(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def components(docs, percent=75):
    """doc_id to (size, component), for ids that are unique."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in ids}


def without_repeats(texts, length=200):
    """Bytes, removed bytes, removed runs and hash of the rest, for each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    results = []
    for b in data:
        cover = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                cover[i : i + length] = [True] * length
        runs = sum(1 for i, c in enumerate(cover) if c and (i == 0 or not cover[i - 1]))
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        results.append((len(b), sum(cover), runs, hashlib.sha256(kept).hexdigest()))
    return results


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def base_scores(docs):
    """doc_id to (tokens, known, training tokens, base score)."""
    tokens = {i: [*words(fold(t)), None] for i, t in docs}
    counts = Counter()
    for i, own in tokens.items():
        if i is not None and remainder(i, 7) != 2:
            counts.update(own)
    total, distinct = sum(counts.values()), len(counts)
    return {
        i: (
            len(own), sum(counts[t] > 0 for t in own), total,
            sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own),
        )
        for i, own in tokens.items()
    }
