"""Importance resampling against a plain version in whole numbers, word by word."""

import math
import re
import struct
from collections import Counter

import pytest
import xxhash

from tests.llm.conftest import SCHEMA
from tillscope.llm.importance import BUCKETS, EFFECTIVE, LIKELY, SMOOTHING, resampled

WRAP = 1 << 64
BASE = 0x9E3779B97F4A7C15


def mixed(x, seed=0):
    x = (x + seed * BASE + BASE) % WRAP
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % WRAP
    x = (x ^ x >> 27) * 0x94D049BB133111EB % WRAP
    return x ^ x >> 31


def word_hash(codes):
    return mixed(sum(code * pow(BASE, k, WRAP) for k, code in enumerate(codes)) % WRAP)


def shape(byte):
    if 65 <= byte <= 90:
        return 2
    if 48 <= byte <= 57:
        return 3
    return byte if 33 <= byte < 127 and not 97 <= byte <= 122 else 1


def buckets(text):
    """Three buckets for each word: itself, it and the next one, its shape."""
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode())
    plain = [word_hash([b + 1 for b in re.sub(rb"[A-Z]", lambda m: m[0].lower(), w)]) for w in words]
    found = []
    for i, (own, word) in enumerate(zip(plain, words, strict=True)):
        following = mixed((own + plain[i + 1] * 0xD6E8FEB86659FD93) % WRAP, 1) if i + 1 < len(plain) else mixed(own, 71)
        marks = word_hash([shape(b) for b in word])
        found += [h % BUCKETS for h in (mixed(own, 72), mixed(following, 73), mixed(marks, 74))]
    return found


def noise(doc_id, text, seed=0):
    state = xxhash.xxh64_intdigest(struct.pack("<i", seed), 42)
    if doc_id is not None:
        state = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), state)
    draw = xxhash.xxh64_intdigest(text.encode(), state)
    return -math.log(-math.log(((mixed(draw, 81) >> 11) + 0.5) * 2.0**-53))


def expected(rows, good, keep=None):
    rows = [(i, text or "") for i, text in rows]
    raw, target = Counter(), Counter()
    for i, text in rows:
        raw.update(buckets(text))
        if i in good:
            target.update(buckets(text))
    scale = sum(target.values()) / max(sum(raw.values()), 1)

    def ratio(bucket):
        return math.log(target[bucket] + SMOOTHING) - math.log(raw[bucket] * scale + SMOOTHING)

    worst = min(map(ratio, range(BUCKETS)))
    out = []
    for i, text in rows:
        own = buckets(text)
        weight = EFFECTIVE * (math.fsum(map(ratio, own)) / len(own) if own else worst)
        out.append((i, weight, weight + noise(i, text)))
    wanted = sum(w >= LIKELY for _, w, _ in out) if keep is None else math.ceil(keep * len(out))
    keys = sorted((key for *_, key in out), reverse=True)
    limit = -math.inf if wanted >= len(keys) else math.inf if not wanted else keys[wanted - 1]
    return [(i, w, key, key >= limit) for i, w, key in out]


def same(got, want):
    def order(row):
        return (row[0] is None, row[0] or 0, row[2])

    got, want = sorted(map(tuple, got), key=order), sorted(want, key=order)
    assert len(got) == len(want)
    for one, other in zip(got, want, strict=True):
        assert one[0] == other[0] and one[3] == other[3]
        assert one[1:3] == pytest.approx(other[1:3], rel=1e-9, abs=1e-9)


def labels_of(spark, good):
    rows = [(i, 1, 0) for i in good] + [(1, 0, 0), (None, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


GOOD = {0, 3, 6, 9, 12, 16, 18}


@pytest.mark.parametrize("keep", [None, 0.0, 0.3, 1.0])
def test_equals_plain_version(spark, docs, rows, keep):
    got = resampled(docs, labels_of(spark, GOOD), keep).select("doc_id", "log_weight", "draw_key", "kept").collect()
    same(got, expected([(r[0], r[1]) for r in rows], GOOD, keep))
    assert keep != 0.3 or sum(r.kept for r in got) == math.ceil(0.3 * len(rows))


def test_repeated_rows(spark, repeated):
    got = resampled(repeated, labels_of(spark, GOOD)).collect()
    same(got, expected([(r.doc_id, r.text) for r in repeated.collect()], GOOD))


def test_without_labels_and_without_documents(spark, docs, rows, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    same(resampled(docs, none).collect(), expected([(r[0], r[1]) for r in rows], set()))
    assert resampled(nothing, labels_of(spark, GOOD)).count() == 0


def test_good_words_weigh_more(spark):
    texts = [(i, "calm clear prose about rivers " * 6 if i % 4 else "BUY!!! cheap $$$ click now " * 6, None, None, None, None, None, None) for i in range(80)]
    frame = spark.createDataFrame(texts, SCHEMA)
    got = resampled(frame, labels_of(spark, {i for i in range(0, 40) if i % 4})).collect()
    assert min(r.log_weight for r in got if r.doc_id % 4) > max(r.log_weight for r in got if r.doc_id % 4 == 0)
