"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Test items are a query set held against all documents, a block of bounded size at a time.
All word n-grams of an item that occur in the corpus are seeds; how rare they are only decides
which place of a document is aligned first. Where a document has a seed, the words around it
are aligned with the item, unless too few are the item's; the score is that of the best local
alignment as a share of a perfect one, so edited, shortened or partly rewritten copies score
by what is left of the item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.storage import free_name
from tillscope.llm.textarrays import LETTER_WORDS, mix, ngrams, pieces, utf8, words

SEED_WORDS = 3
# Items of at most about this many words are held against the documents at once.
BLOCK_WORDS = 500_000

MATCH, MISMATCH, GAP = 1.0, -0.5, -0.5
# A match has this share of the item's own score, or the score of so many words in a row,
# whatever the item's length; of short items it has so many words, or nearly all.
LEAST_SCORE = 0.4
LONG_WORDS = 13
SHORT_WORDS, SHORT_SHARE = 6, 0.9
CELLS = 2_000_000
# Sums of halves are exact; shares of them are not.
TINY = 1e-9

_SIEVE_BITS = 22


class Items:
    """A block of test items, as word hashes, with the n-grams to look for."""

    def __init__(self, ids: list[int], texts: list[str]):
        data, offsets = utf8(pa.array(texts, pa.large_string()))
        hashes, _, first = words(data, offsets, LETTER_WORDS)
        known: dict[bytes, int] = {}
        self.ids, self.words = [], []
        for item_id, low, high in sorted(zip(ids, first[:-1].tolist(), first[1:].tolist(), strict=True)):
            own = hashes[low:high]
            # Items of the same words are one, under the smallest id.
            if high - low >= SEED_WORDS and known.setdefault(own.tobytes(), item_id) == item_id:
                self.ids.append(item_id)
                self.words.append(own)
        lengths = np.array([len(w) for w in self.words], np.int64)
        grams = [ngrams(w, SEED_WORDS) for w in self.words]
        self.item = np.repeat(np.arange(len(self.ids)), lengths - SEED_WORDS + 1)
        self.place = np.concatenate([np.arange(len(g)) for g in grams] or [np.empty(0, np.int64)])
        self.gram = np.concatenate([*grams, np.empty(0, np.uint64)])
        self._look_for(np.unique(self.gram))

    def _look_for(self, grams: np.ndarray) -> None:
        self.grams = grams
        self.sieve = np.zeros(1 << _SIEVE_BITS, bool)
        self.sieve[grams & np.uint64((1 << _SIEVE_BITS) - 1)] = True

    def order_seeds(self, counts: dict[int, int]) -> None:
        """Use as seeds all n-grams that occur in the corpus, however often, and know how often."""
        often = np.array([counts.get(g, 0) for g in self.grams.view(np.int64).tolist()], np.int64)
        own = often[np.searchsorted(self.grams, self.gram)]
        seeds = np.flatnonzero(own > 0)
        seeds = seeds[np.argsort(self.gram[seeds], kind="stable")]
        self.item, self.place, self.gram = self.item[seeds], self.place[seeds], self.gram[seeds]
        self._look_for(np.unique(self.gram))
        self.often = often[often > 0]
        self.start = np.searchsorted(self.gram, self.grams)
        self.stop = np.searchsorted(self.gram, self.grams, side="right")
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        pairs = [_pair(np.full(len(w), i), w) for i, w in enumerate(self.words)]
        self.pairs = np.unique(np.concatenate([*pairs, np.empty(0, np.uint64)]))

    def hits(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, word position and number of each n-gram found."""
        rolled = ngrams(hashes, SEED_WORDS)
        at = np.flatnonzero(self.sieve[rolled & np.uint64((1 << _SIEVE_BITS) - 1)])
        found = rolled[at]
        number = np.minimum(np.searchsorted(self.grams, found), max(len(self.grams) - 1, 0))
        right = self.grams[number] == found if len(self.grams) else np.zeros(len(at), bool)
        at, number = at[right], number[right]
        text = np.searchsorted(first, at, side="right") - 1
        whole = at + SEED_WORDS <= first[text + 1]
        return text[whole], at[whole], number[whole]

    def matches(self, texts: pa.Array) -> Iterator[tuple[int, int, float, int, int]]:
        """Row, item id, score and window (first word, word after the last) of every match.

        Of several matches of an item in one text the best counts, then the first.
        """
        for start, _, part, at in pieces(*utf8(texts)):
            hashes, _, first = words(part, at, LETTER_WORDS)
            text, position, number = self.hits(hashes, first)
            many = (self.stop - self.start)[number]
            text, position, number = (np.repeat(x, many) for x in (text, position, number))
            nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
            entry = self.start[number] + nth
            item, begin = self.item[entry], position - self.place[entry]
            if not len(item):
                continue
            windows, often = self._windows(text, item, begin, first, self.often[number])
            bounds = self._most(windows, hashes)
            near = bounds >= self._least(windows[:, 1])
            windows, often, bounds = windows[near], often[near], bounds[near]
            # The place of the rarest seed comes first; others only if they can be as good.
            order = np.lexsort((often, windows[:, 1], windows[:, 0]))
            ahead = np.zeros(len(order), bool)
            pairs = windows[order, :2]
            ahead[order[np.flatnonzero(np.append(True, (pairs[1:] != pairs[:-1]).any(axis=1))[: len(order)])]] = True
            scores = np.zeros(len(windows))
            scores[ahead] = self._align(windows[ahead], hashes)
            tops = scores[ahead]
            nth = np.cumsum(np.append(True, (windows[1:, :2] != windows[:-1, :2]).any(axis=1))[: len(windows)]) - 1
            again = ~ahead & (bounds >= tops[nth] * MATCH * self.lengths[windows[:, 1]] - TINY)
            scores[again] = self._align(windows[again], hashes)
            matched = scores * MATCH * self.lengths[windows[:, 1]] >= self._least(windows[:, 1]) - TINY
            best: dict[tuple[int, int], tuple[float, int, int]] = {}
            for (t, i, low, high), score in zip(windows[matched].tolist(), scores[matched].tolist(), strict=True):
                if score > best.get((t, i), (0.0,))[0]:
                    best[t, i] = score, low - int(first[t]), high - int(first[t])
            for (t, i), (score, low, high) in sorted(best.items()):
                yield start + t, self.ids[i], score, low, high

    def _least(self, item: np.ndarray) -> np.ndarray:
        """Score from which on an alignment with each item is a match."""
        length = self.lengths[item]
        short = np.minimum(SHORT_SHARE * length, SHORT_WORDS)
        return MATCH * np.minimum(np.maximum(LEAST_SCORE * length, short), LONG_WORDS)

    def _most(self, windows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """A score no alignment can exceed: of each stretch, the words that are in its item."""
        spans = windows[:, 3] - windows[:, 2]
        result = np.zeros(len(windows))
        low = 0
        for high in [*np.flatnonzero(np.diff(np.cumsum(spans) // CELLS)) + 1, len(windows)]:
            size = spans[low:high]
            owner = np.repeat(np.arange(low, high), size)
            at = np.arange(len(owner)) + np.repeat(windows[low:high, 2] - (np.cumsum(size) - size), size)
            key = _pair(windows[owner, 1], hashes[at])
            place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            result += np.bincount(owner[self.pairs[place] == key], minlength=len(windows)) * MATCH
            low = high
        return result

    def _windows(self, text, item, begin, first, often) -> tuple[np.ndarray, np.ndarray]:
        """Stretches to align, and how often the rarest seed of each occurs in the corpus.

        Seeds of an item that lie alike belong to one stretch.
        """
        order = np.lexsort((begin, item, text))
        text, item, begin, often = text[order], item[order], begin[order], often[order]
        length = self.lengths[item]
        slack = length // 3 + 2
        fresh = np.ones(len(text), bool)
        fresh[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (begin[1:] - begin[:-1] > slack[1:])
        head = np.flatnonzero(fresh)
        last = np.append(head[1:], len(text)) - 1
        text, item = text[head], item[head]
        low = np.maximum(begin[head] - slack[head], first[text])
        high = np.minimum(begin[last] + length[head] + slack[head], first[text + 1])
        return np.stack([text, item, low, high], axis=1), np.minimum.reduceat(often, head)

    def _align(self, windows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Best local alignment of item and stretch, as a share of the item's own score.

        A row per word of the item is filled for many pairs at once; gaps along the stretch
        are a running maximum. Padding never matches, so it cannot raise a score.
        """
        scores = np.zeros(len(windows))
        lengths = np.array([len(self.words[i]) for i in windows[:, 1]], np.int64)
        spans = windows[:, 3] - windows[:, 2]
        order = np.lexsort((spans, lengths))
        done = 0
        while done < len(order):
            widest = np.maximum.accumulate(spans[order[done:]])
            fits = max(1, int(np.searchsorted(widest * np.arange(1, len(widest) + 1), CELLS)))
            group = order[done : done + fits]
            done += fits
            rows, columns = int(lengths[group].max()), int(spans[group].max())
            item = np.zeros((len(group), rows), np.uint64)
            stretch = np.ones((len(group), columns), np.uint64)
            for k, g in enumerate(group.tolist()):
                _, i, low, high = windows[g].tolist()
                item[k, : lengths[g]] = self.words[i]
                stretch[k, : high - low] = hashes[low:high]
            ramp = np.arange(columns + 1) * -GAP
            before = np.zeros((len(group), columns + 1))
            top = np.zeros(len(group))
            for r in range(rows):
                step = np.where(stretch == item[:, r, None], MATCH, MISMATCH)
                row = np.maximum(before + GAP, 0.0)
                np.maximum(row[:, 1:], before[:, :-1] + step, out=row[:, 1:])
                row = np.maximum.accumulate(row + ramp, axis=1) - ramp
                np.maximum(top, row.max(axis=1), out=top)
                before = row
            scores[group] = top / (MATCH * lengths[group])
        return scores


def _pair(item: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One number for an item's number and a word."""
    return mix(word + mix(item.astype(np.uint64), 61))


def _blocks(items: DataFrame) -> Iterator[Items]:
    """The test items in blocks of bounded size, dealt by a hash of the id."""
    rows = items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), F.lower("text").alias("text"),
        F.size(F.split("text", r"\s+")).alias("n"),
    )
    total = rows.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-2 * total // BLOCK_WORDS)) if total > BLOCK_WORDS else 1
    for k in range(blocks):
        # Items of one text fall in one block, so that they are known as one.
        own = rows.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).select("item_id", "text").collect()
        block = Items([r["item_id"] for r in own], [r["text"] for r in own])
        if block.ids:
            yield block


def _seeded(docs: DataFrame, block: Items):
    """The block, broadcast, after its seeds were counted over all documents."""
    context = docs.sparkSession.sparkContext
    raw = context.broadcast(block)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = raw.value
        totals = np.zeros(len(items.grams), np.int64)
        for batch in batches:
            for _, _, part, at in pieces(*utf8(batch.column("text"))):
                hashes, _, first = words(part, at, LETTER_WORDS)
                totals += np.bincount(items.hits(hashes, first)[2], minlength=len(totals))
        seen = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(items.grams[seen].view(np.int64)), pa.array(totals[seen])], names=["gram", "n"]
        )

    counts = docs.select(F.lower("text").alias("text")).mapInArrow(count, "gram long, n long")
    rows = counts.groupBy("gram").agg(F.sum("n").alias("n")).collect()
    block.order_seeds({r["gram"]: r["n"] for r in rows})
    return context.broadcast(block)


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Matches of test items in documents: ``doc_id``, ``item_id``, ``score``, ``first_word``, ``end_word``.

    One row per document row and item that match; documents without a match have no row. The score
    is a share of the item, and a match has ``LEAST_SCORE`` of it. A passage worth ``LONG_WORDS``
    words is one in any item, and a short item needs ``SHORT_WORDS`` words or nearly all. Words are runs of letters and digits, lower-cased. Items of equal words
    are reported under their smallest id; items of fewer than ``SEED_WORDS`` words, or with
    null id or text, match nothing. Null and empty texts match nothing; a document with a null
    doc_id is reported with it. Rows repeated are reported each. Empty tables give an empty result.
    """
    result = None
    for block in _blocks(items):
        seeded = _seeded(docs, block)

        def find(batches: Iterator[pa.RecordBatch], seeded=seeded) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = list(seeded.value.matches(batch.column("text")))
                row, item, score, low, high = zip(*found, strict=True) if found else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(row, pa.int64())),
                        pa.array(item, pa.int64()), pa.array(score, pa.float64()),
                        pa.array(low, pa.int64()), pa.array(high, pa.int64()),
                    ],
                    names=["doc_id", "item_id", "score", "first_word", "end_word"],
                )

        part = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text")
        ).mapInArrow(find, "doc_id long, item_id long, score double, first_word long, end_word long")
        result = part if result is None else result.unionByName(part)
    if result is None:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, item_id long, score double, first_word long, end_word long"
        )
    return result


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without a match, with their columns as they were."""
    kept, columns, lowered = docs, docs.columns, free_name(docs, "lowered")
    for block in _blocks(items):
        seeded = _seeded(docs, block)

        def sift(batches: Iterator[pa.RecordBatch], seeded=seeded) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = np.ones(batch.num_rows, bool)
                good[[row for row, *_ in seeded.value.matches(batch.column(lowered))]] = False
                yield batch.filter(pa.array(good)).select(columns)

        kept = kept.withColumn(lowered, F.lower("text")).mapInArrow(sift, docs.schema)
    return kept
