"""Which matches decontamination finds, against plain alignment of every document and item."""

import random

from tests.llm.conftest import prose
from tillscope.llm.decontamination import clean, contaminated


def plain_score(item, words):
    """Best local alignment: 1 for a word, -0.5 for another word or a gap."""
    best, before = 0.0, [0.0] * (len(words) + 1)
    for own in item:
        row = [0.0]
        for k, word in enumerate(words):
            row.append(max(0.0, before[k] + (1.0 if own == word else -0.5), before[k + 1] - 0.5, row[k] - 0.5))
        best, before = max(best, *row), row
    return best


def plain_matches(docs, items):
    found = set()
    for d, text in docs:
        words = (text or "").split()
        grams = {tuple(words[k : k + 3]) for k in range(len(words) - 2)}
        for i, item in items:
            own = (item or "").split()
            seeds = {tuple(own[k : k + 3]) for k in range(len(own) - 2)}
            least = min(max(0.4 * len(own), min(0.9 * len(own), 6)), 13)
            if seeds & grams and plain_score(own, words) >= least - 1e-9:
                found.add((d, i))
    return found


def test_all_matches_and_no_others(spark):
    chance = random.Random(4)
    items = [(i, prose(100 + i, chance.choice([4, 7, 12, 30, 60]), 300)) for i in range(12)] + [(50, None), (51, "two words")]
    docs = [(0, None), (1, "")]
    for d in range(2, 150):
        words = prose(d, chance.randint(5, 80), 300).split()
        own = items[chance.randrange(12)][1].split()
        low = chance.randrange(len(own) // 2)
        # A stretch of an item, from a word to the whole, some words of it changed, left out or put in.
        piece = [w for w in own[low : low + chance.randint(1, len(own))] if chance.random() > 0.08]
        piece = [w if chance.random() > 0.1 else "edited" for w in piece]
        at = chance.randint(0, len(words))
        docs.append((d, " ".join(words[:at] + piece + words[at:])))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    tests = spark.createDataFrame(items, "item_id long, text string")
    wanted = plain_matches(docs, items)
    assert 20 < len(wanted) < 120
    assert {(r.doc_id, r.item_id) for r in contaminated(frame, tests).collect()} == wanted
    kept = {r.doc_id for r in clean(frame, tests).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in wanted}
