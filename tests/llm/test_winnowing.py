"""Winnowing against a plain version: every run hashed and every window looked at on its own."""

import hashlib
import re
import struct
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import SCHEMA, prose
from tillscope.llm import winnowing
from tillscope.llm.winnowing import GRAM, WINDOW, fingerprinted


def hashed(*values):
    """Spark's 64-bit hash of texts and numbers; nulls are skipped."""
    seed = 42
    for value in values:
        if value is not None:
            raw = value.encode() if isinstance(value, str) else struct.pack("<Q", value)
            seed = xxhash.xxh64_intdigest(raw, seed)
    return seed


def gram(words, at, width):
    if at >= len(words):
        return None
    if width == 1:
        return hashed(words[at])
    return hashed(gram(words, at, width // 2), gram(words, at + width // 2, width // 2))


def selected(text):
    """``hash``, ``place`` of each window's smallest hash, the rightmost of equal ones."""
    words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", text.lower()) if w]
    hashes = [gram(words, i, GRAM) for i in range(max(len(words) - GRAM + 1, min(len(words), 1)))]
    places = set()
    for low in range(max(len(hashes) - WINDOW + 1, min(len(hashes), 1))):
        window = range(low, min(low + WINDOW, len(hashes)))
        places.add(min(window, key=lambda i: (hashes[i] >> 32, -i)))
    return [(hashes[i], i) for i in sorted(places)]


def jaccard(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    """Result rows for (doc_id, text): repeated rows count once in the order."""
    rows = [(i, t or "") for i, t in rows]

    def tie(row):
        value = xxhash.xxh64_intdigest(row[1].encode(), xxhash.xxh64_intdigest(struct.pack("<i", row[0] is None), 42))
        return value - (1 << 64) if value >> 63 else value

    nodes = sorted(set(rows), key=lambda r: (r[0] is None, -(r[0] or 0), tie(r)))
    out = []
    for (i, text), (_, other) in zip(nodes, nodes[1:] + nodes[:1], strict=True):
        third = len(text) // 3
        edited = text[: len(text) - third] + other[:third]
        own, new = selected(text), selected(edited)
        line = (
            i, len(text), hashlib.sha256(edited.encode()).hexdigest(),
            *[",".join(f"{h:x}@{p}" for h, p in found) for found in (own, new)],
            round(jaccard(own, new), 12), round(jaccard(own, selected(other)), 12),
        )
        out += [line] * rows.count((i, text))
    return Counter(out)


COLUMNS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint")


def found(frame):
    rows = fingerprinted(frame).select(*COLUMNS, F.round("near_edited", 12), F.round("near_next", 12)).collect()
    return Counter(tuple(r) for r in rows)


def test_equals_plain_version(docs, rows):
    assert found(docs) == expected([(r[0], r[1]) for r in rows])


def test_repeated_rows_and_missing_ids(repeated):
    assert found(repeated) == expected([(r.doc_id, r.text) for r in repeated.collect()])


def test_empty_table_and_lone_document(spark, nothing):
    assert found(nothing) == Counter()
    lone = spark.createDataFrame([(5, prose(1, 40), None, None, None, None, None, None)], SCHEMA)
    (row,) = fingerprinted(lone).collect()
    assert (row.near_next, row.next_doc_id) == (1.0, 5)


def test_parts_do_not_change_the_result(spark, docs):
    """The order is one ring however many parts it is cut into."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    one = found(docs.coalesce(1))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        assert found(docs.repartition(7)) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_shared_passage_is_always_found(spark):
    """GRAM + WINDOW - 1 words in common leave a common hash, whatever stands around them."""
    passage = prose(7, GRAM + WINDOW - 1, 10_000)
    texts = [(i, f"{prose(i, 30 + i)} {passage} {prose(100 + i, 50)}") for i in range(12)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    prints = [{h.hash for h in r[0]} for r in frame.select(winnowing.fingerprint(F.col("text"))).collect()]
    assert set.intersection(*prints)


def test_unspaced_scripts_are_cut_into_characters(spark):
    frame = spark.createDataFrame([("漢字かな交じり文のテキスト",)], "text string")
    assert frame.select(F.size(winnowing.words(F.col("text")))).first()[0] == 13


def test_only_native_operators(docs):
    plan = fingerprinted(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)
