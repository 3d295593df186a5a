"""Exact, near and substring de-duplication against plain versions."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from tests.llm import brute
from tillscope.llm import setsketch, substrings
from tillscope.llm.exact_dedup import DigestIndex, deduplicate_once, without_copies
from tillscope.llm.grouping import connected_components, with_group_totals
from tillscope.llm.near_dedup import _candidates, near_duplicates, one_of_each
from tillscope.llm.substring_dedup import remove_repeats
from pyspark.sql import functions as F


def test_exact(docs, rows):
    got = {r.doc_id: r for r in deduplicate_once(docs).collect()}
    texts = {r[0]: brute.fold(r[1]) for r in rows}
    sizes = Counter(texts.values())
    for i, text in texts.items():
        keep = max(j for j, other in texts.items() if other == text)
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (keep, sizes[text], i == keep)
        assert got[i].text_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_exact_repeated_rows(repeated, nothing):
    result = deduplicate_once(repeated)
    assert result.count() == repeated.count()
    kept = result.where("kept").groupBy("text_sha256").count()
    assert kept.where("count <> 1").count() == 0
    assert kept.count() == result.select("text_sha256").distinct().count()
    assert without_copies(repeated).columns == repeated.columns
    assert without_copies(repeated).count() == kept.count()
    assert deduplicate_once(nothing).count() == 0
    assert without_copies(nothing).count() == 0


def test_index_grows(spark, docs):
    index = DigestIndex(spark, "digest_index_test", buckets=3)
    try:
        index.deduplicate(docs.where("doc_id < 15"))
        first = spark.table(index.table).count()
        again = index.deduplicate(docs)
        assert again.where("kept and doc_id < 15").count() == 0
        # Copies of documents already there name the one recorded.
        assert {r.keep_id for r in again.where("doc_id in (20, 21)").collect()} == {0}
        whole = docs.select(F.lower("text")).distinct().count()
        assert first < spark.table(index.table).count()
        assert spark.table(index.table).count() == spark.table(index.table).select("digest").distinct().count()
        assert whole > 0
        added = spark.table(index.table).count()
        index.deduplicate(docs)
        assert spark.table(index.table).count() == added
    finally:
        index.drop()


def test_index_is_not_shuffled(spark, docs):
    index = DigestIndex(spark, "digest_index_plan", buckets=3)
    try:
        index.deduplicate(docs)
        groups = docs.select(F.unhex(F.sha2("text", 256)).alias("digest"))
        plan = index.entries(groups)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Bucketed: true" in plan
        assert plan.count("Exchange") == 1, plan
    finally:
        index.drop()


def test_named_batch_runs_again(spark, docs):
    """A batch whose result was lost gives the same rows again, and another batch none of its texts."""
    index = DigestIndex(spark, "digest_index_again", buckets=3)
    try:
        first = sorted(map(str, index.deduplicate(docs, "a").collect()))
        assert sorted(map(str, index.deduplicate(docs, "a").collect())) == first
        # Another object for the same table keeps to the table's buckets.
        other = DigestIndex(spark, index.table, buckets=5).deduplicate(docs, "b")
        assert other.where("kept").count() == 0
        assert other.select("keep_id").distinct().count() == docs.select(F.lower(F.coalesce("text", F.lit("")))).distinct().count()
    finally:
        index.drop()


def test_one_large_group(spark):
    """A third of all rows is one text."""
    frame = spark.range(9_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text")
    )
    got = deduplicate_once(frame)
    assert got.where("kept").count() == 6_001
    assert got.where("group_size = 3000 and keep_id = 8997").count() == 3_000


def test_near(docs, rows):
    got = {r.doc_id: r for r in near_duplicates(docs).collect()}
    for i, (size, component) in brute.components([(r[0], r[1]) for r in rows]).items():
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (size, component, i == component)


def test_near_odd_rows(repeated, nothing):
    result = near_duplicates(repeated)
    assert result.count() == repeated.count()
    assert result.where("doc_id is null and (component_id is not null or not kept)").count() == 0
    # An id with two texts links what either text links.
    assert result.where("doc_id in (1, 2, 22, 23)").select("component_id").distinct().count() == 1
    kept = one_of_each(repeated)
    assert kept.columns == repeated.columns
    assert near_duplicates(nothing).count() == 0


def test_near_family_of_edits(spark):
    """Edited copies around the limit: many pairs just miss it, no link may be lost."""
    chance = np.random.default_rng(5)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(70):
        own = list(base)
        for at in chance.choice(150, int(chance.integers(0, 9)), replace=False):
            own[at] = f"edit{i}x{at}"
        texts.append((i, " ".join(own)))
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {i: c for i, (_, c) in brute.components(texts).items()}
    assert len(set(got.values())) > 1


def test_near_large_family(spark):
    """Many hundred edits of one passage, most pairs of which just miss the limit or are far below."""
    chance = np.random.default_rng(11)
    base = [f"w{i}" for i in range(100)]
    texts = []
    for i in range(800):
        own = list(base)
        for at in chance.choice(100, int(chance.integers(2, 7)), replace=False):
            # A few edits are shared by many texts, so common shingles are of all frequencies.
            own[at] = f"edit{i % 40 if i % 3 else i}x{at}"
        texts.append((i, " ".join(own)))
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.component_id for r in near_duplicates(frame).collect()}
    assert got == {i: c for i, (_, c) in brute.components(texts).items()}
    assert len(set(got.values())) > 10


def test_candidates_come_once(spark):
    """Every similar pair of different components is a candidate, whatever shingles they share first."""
    chance = np.random.default_rng(3)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(60):
        own = list(base)
        for at in chance.choice(300, int(chance.integers(0, 16)), replace=False):
            own[at] = f"edit{i % 7}x{at}"
        texts.append((i, " ".join(own)))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    # Documents lie in twenty components of their own; one of them is the most frequent.
    homes = spark.createDataFrame([(i, i % 20 if i < 50 else 0) for i in range(60)], "doc_id long, component long")
    found = [tuple(r) for r in _candidates(homes, frame).collect()]
    assert len(found) == len(set(found))
    home = {r.doc_id: r.component for r in homes.collect()}
    sets = {i: brute.shingles(t) for i, t in texts}
    for i in range(60):
        for j in range(i + 1, 60):
            both = len(sets[i] & sets[j])
            if home[i] != home[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
                assert (i, j) in found


def test_likelihood_estimate():
    chance = np.random.default_rng(1)
    for share in (0.3, 0.75, 0.95):
        pool = chance.integers(0, 2**63, 3000).astype(np.uint64)
        cut = int(1000 * (1 - share) / (1 + share))
        a, b = pool[: 1000], pool[cut : 1000 + cut]
        both = setsketch.registers([a, b])
        estimate = setsketch.joint_similarity(both[:1], both[1:], np.array([1000.0]), np.array([1000.0]))[0]
        assert abs(estimate - (1000 - cut) / (1000 + cut)) < 0.15
        union = setsketch.registers([np.union1d(a, b)])[0]
        assert (setsketch.merged(both[0], both[1]) == union).all()


def test_substrings(docs, rows):
    got = {r.doc_id: tuple(r)[1:] for r in remove_repeats(docs).collect()}
    wanted = brute.without_repeats([r[1] for r in rows])
    assert [got[r[0]] for r in rows] == wanted
    assert sum(w[1] for w in wanted) > 0


@pytest.mark.parametrize(("limit", "heavy"), [(20_000, 10_000), (2, 10_000), (20_000, 3)])
def test_substrings_passages(spark, monkeypatch, limit, heavy):
    """A passage many documents share, in surroundings of their own; also string by string, and as a heavy key."""
    monkeypatch.setattr("tillscope.llm.substring_dedup.MAX_RUNS", limit)
    monkeypatch.setattr("tillscope.llm.substring_dedup.HEAVY_ROWS", heavy)
    chance = np.random.default_rng(3)

    def noise(n):
        return "".join(chr(97 + c) for c in chance.integers(0, 26, n))

    passage = noise(450)
    texts = [noise(int(chance.integers(0, 300))) + passage[: int(chance.integers(150, 450))] + noise(90) for _ in range(12)]
    texts += [passage[i : i + 230] for i in (0, 5, 100)] + ["é" * 150, "ab" * 250, "z" * 199, None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in remove_repeats(frame).collect()}
    assert [got[i] for i in range(len(texts))] == brute.without_repeats(texts)


def test_substrings_odd_rows(repeated, nothing):
    result = remove_repeats(repeated)
    assert result.count() == repeated.count()
    assert result.where("doc_id = 0 and n_removed < n_bytes").count() == 0
    assert remove_repeats(nothing).count() == 0


def test_suffix_array():
    chance = np.random.default_rng(0)
    for turn in range(40):
        text = chance.integers(97, 97 + int(chance.integers(1, 4)), int(chance.integers(1, 300))).astype(np.uint8)
        if turn % 3 == 0:
            text = np.concatenate([text] * 3)
        order = substrings.suffix_array(text, substrings.Rolling(text), len(text) + 1)
        data = text.tobytes()
        assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])


def test_components_of_chains_and_stars(spark):
    chain = [(i + 1, i) for i in range(40)]
    star = [(100, i) for i in range(101, 140)]
    edges = spark.createDataFrame(chain + star + [(7, 7)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}


def test_group_totals_spread_a_group(spark):
    rows = spark.range(5000).select(F.lit(1).alias("k"), "id")
    result = with_group_totals(rows, ["k"], F.col("id"), {"most": (F.col("id"), "max"), "n": (F.lit(1), "sum")})
    assert result.select("k", "most", "n").distinct().collect() == [(1, 4999, 5000)]
    assert result.count() == 5000
