"""Prefix trie against a plain version that lists every member of every node."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tillscope.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn int, role string, text string, depth string, P long, number int"
COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def expected(rows):
    """Result rows for (conv_id, turn, role, text) without two different turns of one number."""
    turns = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if c is not None:
            turns[c].append((role or "", text or ""))
    members = defaultdict(list)
    ends = defaultdict(list)
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole = tuple(turns.get(c - c % 20, [])[:h] + own[h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    children = Counter(path[:-1] for path in members if path)
    leaves, saved = Counter(), Counter()
    for path, inside in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(inside) - 1) * words
    return Counter(
        (
            min(inside), len(path), min(members[path[:-1]]) if path else None, len(inside), children[path],
            leaves[path], saved[path],
            hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest(),
        )
        for path, inside in members.items()
    )


def found(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    return Counter(tuple(r) for r in trie.prefix_trie(frame).select(*COLUMNS).collect())


def forest(seed, ids, most, kinds):
    """Conversations that often say the same: few different turns, some null, some blank."""
    chance = random.Random(seed)
    said = [None, "", " \t ", *[f"say {'so ' * k}{k}" for k in range(kinds)]]
    return [
        (c, None if t == 0 and c % 3 == 0 else t, chance.choice(["user", "bot", None]) if c % 2 else "user", chance.choice(said))
        for c in ids for t in range(chance.randint(1, most))
    ]


@pytest.mark.parametrize("seed, ids, most, kinds", [
    (1, range(60), 6, 1), (2, range(0, 200, 3), 9, 2), (3, range(-45, 30), 4, 1), (4, [7, 19, 20, 2**53 + 21], 5, 2),
])
def test_equals_plain_version(spark, seed, ids, most, kinds):
    rows = forest(seed, ids, most, kinds)
    random.Random(seed).shuffle(rows)
    assert found(spark, rows) == expected(rows)


def test_long_chains_cross_bands_and_blocks(spark, monkeypatch):
    """Deep tries take several levels of bands; blocks of running hashes are small here."""
    monkeypatch.setattr(trie, "BLOCK", 16)
    monkeypatch.setattr(trie, "BAND", 3)
    rows = [(c, t, "user", f"turn {t}" if t < 25 + 3 * c else f"own {c} {t}") for c in range(8) for t in range(30 + 7 * c)]
    assert found(spark, rows) == expected(rows)


def test_one_conversation_holds_most_turns(spark):
    rows = [(40, t, "user", f"t{t % 5}") for t in range(700)] + [(c, t, "user", "t0") for c in range(41, 60) for t in range(3)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "9")
        assert found(spark, rows) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_many_equal_conversations(spark, monkeypatch):
    """Members of one node come in several pieces, in the order of numbers, not of digits."""
    monkeypatch.setattr(trie, "ENDS", 3)
    rows = [(c, t, "user", "same again") for c in range(95, 130) for t in range(3)]
    assert found(spark, rows) == expected(rows)


def test_missing_ids_empty_table_and_repeated_rows(spark):
    assert found(spark, [(None, 1, "user", "a"), (None, None, None, None)]) == Counter()
    assert found(spark, []) == Counter()
    rows = [(5, 1, "user", "a")] * 3 + [(6, None, None, None)] * 2
    assert found(spark, rows) == expected(rows)


def test_turns_of_one_number_have_a_fixed_order(spark):
    rows = [(c, 1, "user", text) for c in (3, 63) for text in "abcdef"]
    one, other = found(spark, rows), found(spark, rows[::-1])
    assert one == other and sum(one.values()) > 0


def test_explosion_is_bounded(spark):
    chain = spark.range(1, 60).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("depth"), F.col("id").alias("p"), F.col("id").alias("q"),
        F.lit(True).alias("top"),
    )
    for step in (1, 8):
        ways = trie.band_ancestors(chain, step).select(F.size("up").alias("up"), F.size("over").alias("over")).collect()
        assert max(w["up"] for w in ways) <= trie.BAND and max(w["over"] or 0 for w in ways) <= trie.BAND
