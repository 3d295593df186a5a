"""Quality by importance resampling: how much likelier a text is under the target than under all text.

Two generative models over hashed n-grams, one of the texts labelled good and one of all texts,
give each document the log ratio of its likelihoods. Adding Gumbel noise and keeping the largest
keys draws documents without replacement in proportion to their importance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.storage import checkpointed
from tillscope.llm.textarrays import BLANKS, PLAIN_WORDS, mix, ngrams, pieces, utf8, words

BUCKETS = 1 << 16
# Bound of the labelled documents that the target model is made of.
TARGET_DOCUMENTS = 200_000
# How much of the ratio of the two models counts for a text, whatever its length: the mean
# log ratio of its n-grams times this many n-grams.
EFFECTIVE = 50.0
# Added to a bucket's count in good texts, and to what its count in all texts lets expect there:
# a bucket hardly ever seen says little either way.
SMOOTHING = 1.0
# Unless told otherwise, as many documents are drawn as have at least this log weight.
LIKELY = -8.0


def _shape_codes() -> np.ndarray:
    """Byte codes under which words of one shape are equal: letters of a case and digits are alike
    each, marks keep apart."""
    codes = np.arange(256, dtype=np.uint64)
    codes[:33] = codes[97:123] = codes[127:] = 1
    codes[65:91] = 2
    codes[48:58] = 3
    codes[list(BLANKS)] = 0
    return codes


_SHAPE_WORDS = _shape_codes()


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram, and the first of each text.

    Counted are words, pairs of words, and the shape of words (case, digits, marks), so that
    mark-up, shouting and litter show even in words never seen.
    """
    hashes, _, first = words(data, offsets, PLAIN_WORDS)
    shapes, _, _ = words(data, offsets, _SHAPE_WORDS)
    n = len(hashes)
    if not n:
        return np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    pairs = np.append(ngrams(hashes, 2), np.uint64(0))
    # The last word of a text pairs with the end of the text.
    filled = first[1:][np.diff(first) > 0] - 1
    pairs[filled] = mix(hashes[filled], 71)
    grams = np.stack([mix(hashes, 72), mix(pairs, 73), mix(shapes, 74)], axis=1).ravel()
    return (grams & np.uint64(BUCKETS - 1)).astype(np.int64), first * 3


def _good_ids(labels: DataFrame) -> np.ndarray:
    """Sorted ids labelled good; of more than ``TARGET_DOCUMENTS`` about so many, by hash."""
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("id")).distinct()
    share = min(1.0, TARGET_DOCUMENTS / max(good.count(), 1))
    chosen = good.where(F.xxhash64("id") / F.lit(2.0**63) <= 2 * share - 1)
    return np.sort(chosen.toArrow().column("id").to_numpy())


def log_ratios(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Log ratio of each bucket's chance in good texts and in all texts.

    All documents count for the one model, those labelled good (a bounded number) for the other. The
    outcome is one number for each of ``BUCKETS`` buckets, however large the corpus.
    """
    good = docs.sparkSession.sparkContext.broadcast(_good_ids(labels))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            ids = batch.column("doc_id")
            marked = np.isin(pc.fill_null(ids, 0).to_numpy(), good.value)
            marked &= ids.is_valid().to_numpy(zero_copy_only=False)
            for start, stop, part, at in pieces(*utf8(batch.column("text"))):
                grams, first = features(part, at)
                totals[0] += np.bincount(grams, minlength=BUCKETS)
                chosen = np.repeat(marked[start:stop], np.diff(first))
                totals[1] += np.bincount(grams[chosen], minlength=BUCKETS)
        seen = np.flatnonzero(totals[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(totals[0][seen]), pa.array(totals[1][seen])],
            names=["bucket", "raw", "target"],
        )

    rows = docs.select("doc_id", "text").mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")
    ).collect()
    counts = np.zeros((2, BUCKETS))
    for row in rows:
        counts[:, row["bucket"]] = row["raw"], row["target"]
    expected = counts[0] * (counts[1].sum() / max(counts[0].sum(), 1.0))
    return np.log(counts[1] + SMOOTHING) - np.log(expected + SMOOTHING)


def resampled(docs: DataFrame, labels: DataFrame, keep: float | None = None, seed: int = 0) -> DataFrame:
    """Importance of every document, and the draw: ``doc_id``, ``log_weight``, ``draw_key``, ``kept``.

    ``log_weight`` is the mean log ratio of a text's n-grams times ``EFFECTIVE``; a text without
    words weighs like one that never occurs in good texts. ``draw_key`` adds Gumbel noise from id,
    text and seed, so reruns agree. The rows with the largest keys are kept (of equal keys, all at
    the limit): the share ``keep`` of all, or else as many as weigh ``LIKELY`` or more. Null text counts as empty. Rows repeated have one key
    and one fate. Without good labels all documents weigh alike. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ratios = spark.sparkContext.broadcast(log_ratios(own, labels))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ratios.value
        worst = float(table.min())
        for batch in batches:
            weights = np.full(batch.num_rows, worst)
            for start, stop, part, at in pieces(*utf8(batch.column("text"))):
                grams, first = features(part, at)
                sizes = np.diff(first)
                filled = np.flatnonzero(sizes)
                if len(filled):
                    sums = np.add.reduceat(table[grams], first[filled])
                    weights[start + filled] = sums / sizes[filled]
            # A uniform number from the hash, kept off both ends.
            draw = batch.column("draw").to_numpy().view(np.uint64)
            uniform = ((mix(draw, 81) >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53
            weights *= EFFECTIVE
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(weights), pa.array(weights - np.log(-np.log(uniform)))],
                names=["doc_id", "log_weight", "draw_key"],
            )

    weighed = checkpointed(own.select(
        "doc_id", "text", F.xxhash64(F.lit(seed), "doc_id", "text").alias("draw")
    ).mapInArrow(weigh, "doc_id long, log_weight double, draw_key double"))
    total, likely = weighed.agg(F.count("*"), F.count_if(F.col("log_weight") >= LIKELY)).first()
    limit = _key_at(weighed, likely if keep is None else int(np.ceil(keep * total)))
    return weighed.withColumn("kept", F.col("draw_key") >= F.lit(limit))


def _key_at(weighed: DataFrame, wanted: int) -> float:
    """The key of the last of ``wanted`` rows to keep: exact, by narrowing a range with counts.

    Each round splits the range in 1,000 parts and goes on in the one the wanted rank falls in; a
    round sends 1,000 numbers to the driver, whatever the number of rows.
    """
    total, low, high = weighed.agg(F.count("*"), F.min("draw_key"), F.max("draw_key")).first()
    if not total or wanted >= total:
        return float("-inf")
    if wanted <= 0:
        return float("inf")
    parts, above = 1_000, 0
    for _ in range(12):
        inside = weighed.where(F.col("draw_key").between(low, high))
        width = (high - low) / parts
        if width <= 0 or low + width <= low:
            return low
        part = F.least(F.floor((F.col("draw_key") - low) / width), F.lit(parts - 1))
        rows = inside.groupBy(part.alias("part")).agg(
            F.count("*").alias("n"), F.min("draw_key").alias("lo"), F.max("draw_key").alias("hi")
        ).orderBy(F.desc("part")).collect()
        for row in rows:
            if above + row["n"] >= wanted:
                low, high = row["lo"], row["hi"]
                break
            above += row["n"]
        if low == high:
            break
    return low
