"""A family that holds together in the end does not compare all that lies apart in between."""

import numpy as np

from tests.llm import brute
from tillscope.llm import near_dedup


def test_family_joins_by_few_pairs(spark, monkeypatch):
    chance = np.random.default_rng(2)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(400):
        own = list(base)
        for at in chance.choice(120, int(chance.integers(0, 8)), replace=False):
            own[at] = f"edit{i}x{at}"
        texts.append((i, " ".join(own)))
    met, similar = [], near_dedup._similar

    def counted(pairs, sketches, bodies):
        met.append(pairs.count())
        return similar(pairs, sketches, bodies)

    monkeypatch.setattr(near_dedup, "_similar", counted)
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame).collect()}
    assert got == {i: c for i, (_, c) in brute.components(texts).items()}
    # After the pairs of the buckets, 278 in turns; all at once are 1,208.
    assert sum(met[1:]) < 500


def test_all_turns_together_meet_all(spark, monkeypatch):
    """Each pair of different components has one turn, so nothing is lost where nothing joins."""
    texts = [(i, " ".join(f"w{j}" if j != 5 * i else f"edit{i}" for j in range(200))) for i in range(40)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    apart = spark.createDataFrame([(i, i) for i in range(40)], "doc_id long, component long")
    asked = []

    def never(pairs, sketches, bodies):
        asked.extend(tuple(r) for r in pairs.collect())
        return pairs.limit(0)

    monkeypatch.setattr(near_dedup, "_similar", never)
    monkeypatch.setattr(near_dedup, "FIRST_MET", 1)
    monkeypatch.setattr(near_dedup, "MORE", 2)
    near_dedup._links_between(apart, None, frame)
    assert len(asked) == len(set(asked)) > 100
    assert set(asked) == {tuple(r) for r in near_dedup._candidates(apart, frame).collect()}
