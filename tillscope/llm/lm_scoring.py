"""Scoring documents by a unigram base and by a gated recurrent language model.

The counts of all training tokens are made by one distributed sum. The most frequent words
travel to the tasks; a token of any other word meets its count in a join by the word. The
recurrent model starts from a small sample and then learns from every training text where it
lies: each task passes over its texts from the same weights, and what the tasks learned is averaged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.gated_lm import RARE_CLASSES, Adam, GatedModel, learn, room, train
from tillscope.llm.language_id import remainder
from tillscope.llm.storage import checkpointed
from tillscope.llm.textarrays import mix, pieces, utf8, words

# Words whose counts are sent to all tasks, 16 bytes each; the others are joined.
HEAD_WORDS = 1 << 18
# Bounds of the sample that gives the recurrent model the weights all tasks start from.
TRAIN_DOCUMENTS = 800
TRAIN_TOKENS = 600
# Tokens counted together before their counts are handed on.
COUNT_TOKENS = 4_000_000
# Text scored side by side: more shares the cost of a step, less needs less memory.
SCORE_BYTES = 12 << 20
# Texts that learn in one task have this many tokens for each word with weights of its own, so that
# the weights a task sends stay small beside the texts it reads; and never fewer than the second figure.
TOKENS_A_WORD = 512
LEAST_TASK_TOKENS = 1 << 20
# Weights sent together when they are averaged; they are summed as whole numbers of this part of
# one, so that the sum does not depend on its order.
SLICE = 8_192
UNIT = 2.0**-16

#: Stands for the end of a text. Words are hashed, and 0 is mixed to something else.
END = np.uint64(0)
_END_CLASS = 0


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and rare class of every token, and the first token of each text; each text has an end."""
    hashes, starts, first = words(data, offsets)
    count = len(first) - 1
    at = np.arange(len(hashes)) + np.repeat(np.arange(count), np.diff(first))
    all_hashes = np.full(len(hashes) + count, END)
    all_hashes[at] = hashes
    kinds = np.full(len(all_hashes), _END_CLASS, np.int8)
    if len(hashes):
        # A word ends before the next blank or text; its last two bytes choose its class.
        blank = np.append((data == 32) | ((data >= 9) & (data <= 13)), True)
        edges = np.unique(np.concatenate([np.flatnonzero(blank), offsets]))
        last = edges[np.searchsorted(edges, starts, side="right")] - 1
        lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint64)
        two = lower[last] + np.where(last > starts, lower[last - 1], np.uint64(0)) * np.uint64(256)
        kinds[at] = (mix(two, 51) % np.uint64(RARE_CLASSES)).astype(np.int8)
    return all_hashes, kinds, first + np.arange(count + 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def merged() -> pa.RecordBatch:
        hashes, kinds, numbers = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        heads = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(hashes[heads].view(np.int64)), pa.array(kinds[order][heads]),
                pa.array(np.add.reduceat(numbers[order], heads)),
            ],
            names=["word", "kind", "n"],
        )

    for batch in batches:
        for _, _, part, at in pieces(*utf8(batch.column("text"))):
            hashes, kinds, _ = tokens(part, at)
            distinct, where, numbers = np.unique(hashes, return_index=True, return_counts=True)
            held.append((distinct, kinds[where], numbers))
            size += len(distinct)
        if size >= COUNT_TOKENS:
            yield merged()
            held, size = [], 0
    if held:
        yield merged()


class Vocabulary:
    """Counts of the most frequent words, and what the model needs of all others."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, rare_mass: np.ndarray, words: int):
        self.words = words
        order = np.argsort(hashes)
        self.hashes, self.counts, self.rank = hashes[order], counts[order], order
        self.log_counts = np.log10(self.counts + 1.0)
        self.rare_mass = rare_mass

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each token in the list, or -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def numbers(self, places: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Token numbers of the model: frequent words by rank, all others by class."""
        if not len(self.rank):
            return self.words + kinds.astype(np.int64)
        rank = np.where(places >= 0, self.rank[places], self.words)
        return np.where(rank < self.words, rank, self.words + kinds.astype(np.int64))


def _vocabulary(counts: DataFrame) -> tuple[Vocabulary, int, int, np.ndarray]:
    """Word list, tokens in all, distinct words, and the count of each token number of the model."""
    totals = {r["kind"]: (r["n"], r["words"]) for r in counts.groupBy("kind").agg(
        F.sum("n").alias("n"), F.count("*").alias("words")
    ).collect()}
    # The frequent words are those from a count on that few enough have; counts are compared by
    # steps of a twelfth of a power of two, so only some hundred numbers are looked at.
    step = F.floor(F.log2("n") * 12)
    number, least = 0, 0
    for row in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        number += row["count"]
        if number > HEAD_WORDS:
            least = row["step"] + 1
            break
    top = counts.where(step >= least).toArrow()
    hashes = top.column("word").to_numpy().view(np.uint64)
    numbers, kinds = top.column("n").to_numpy(), top.column("kind").to_numpy()
    order = np.lexsort((hashes, -numbers))
    hashes, numbers, kinds = hashes[order], numbers[order], kinds[order]
    tokens_in_all = int(sum(n for n, _ in totals.values()))
    distinct = int(sum(n for _, n in totals.values()))
    # About as many words as the root of all tokens have weights of their own.
    own = room(min(len(hashes), int(tokens_in_all**0.5)))
    rare = np.zeros(RARE_CLASSES)
    known = np.zeros(RARE_CLASSES)
    for kind, (n, kinds_words) in totals.items():
        rare[kind], known[kind] = n, kinds_words
    np.subtract.at(rare, kinds[:own], numbers[:own])
    np.subtract.at(known, kinds[:own], 1)
    per_number = np.zeros(own + RARE_CLASSES)
    per_number[: len(numbers[:own])] = numbers[:own]
    per_number[own:] = rare
    # Each class keeps one count for words never seen.
    return Vocabulary(hashes, numbers, rare + known + 1.0, own), tokens_in_all, distinct, per_number


def _fit(training: DataFrame, vocabulary: Vocabulary, per_number: np.ndarray) -> GatedModel:
    """Starting weights, from at most ``TRAIN_DOCUMENTS`` documents chosen by hash.

    Of a long document a stretch of ``TRAIN_TOKENS`` tokens is used, at a place the hash decides.
    """
    draw = F.xxhash64("doc_id", "text")
    total = training.count()
    share = min(1.0, 4.0 * TRAIN_DOCUMENTS / max(total, 1))
    length = TRAIN_TOKENS * 12
    spare = F.greatest(F.lit(1), F.length("text") - length + 1)
    rows = (
        training.select("text", draw.alias("draw")).where(F.col("draw") / F.lit(2.0**63) <= 2 * share - 1)
        .select("draw", F.substring("text", F.pmod("draw", spare).cast("int") + 1, F.lit(length)).alias("text"))
        .orderBy("draw", "text").limit(TRAIN_DOCUMENTS).collect()
    )
    texts = []
    for row in rows:
        hashes, kinds, _ = tokens(*utf8(pa.array([row["text"]], pa.string())))
        numbers = vocabulary.numbers(vocabulary.look_up(hashes), kinds)
        texts.append(numbers if len(numbers) <= TRAIN_TOKENS else numbers[-TRAIN_TOKENS:])
    return train(texts, per_number, min(vocabulary.words, len(vocabulary.hashes)))


def _spread(weights: dict[str, np.ndarray], seen: np.ndarray, words: int) -> np.ndarray:
    """How many tokens each weight, all in a row, was learned from."""
    classes, _, size = weights["words"].shape
    per_class = seen[:words].reshape(classes, size).sum(axis=1)
    rows = {"inputs": seen, "words": per_class, "word_bias": per_class}
    return np.concatenate([
        np.repeat(rows[k], v[0].size) if k in rows else np.full(v.size, seen.sum()) for k, v in weights.items()
    ])


def _learned(training: DataFrame, vocabulary: Vocabulary, start: GatedModel, total: int) -> GatedModel:
    """The model after a pass over all training texts, of ``total`` tokens.

    Every task learns from each token of its texts, from the same start. A weight's moves are
    averaged by the tokens that each task learned it from: a word's by its own, others by all.
    A hash deals the texts to tasks and orders them there, and the number of tasks follows from
    the tokens, so the model depends neither on the cluster nor on how the table is stored.
    """
    context = training.sparkSession.sparkContext
    shipped = context.broadcast((vocabulary, start.weights))

    def pass_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, begin = shipped.value
        model = GatedModel({k: v.copy() for k, v in begin.items()})
        adam = Adam(model)
        seen = np.zeros(known.words + RARE_CLASSES, np.int64)
        for batch in _small_batches(batches):
            hashes, kinds, first = _all_tokens(batch.column("text"))
            numbers = known.numbers(known.look_up(hashes), kinds)
            seen += np.bincount(numbers, minlength=len(seen))
            learn(model, adam, numbers, first)
        share = _spread(begin, seen, known.words)
        moves = np.concatenate([(model.weights[k].astype(float) - v).ravel() for k, v in begin.items()])
        sums = np.rint(moves * share / UNIT).astype(np.int64)
        for low in range(0, len(sums), SLICE):
            part = slice(low, low + SLICE)
            if share[part].any():
                yield _slice_row(low, sums[part], share[part])

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                own = [np.frombuffer(row[k], np.int64) for k in ("moves", "share")]
                held[row["slice"]] = [a + b for a, b in zip(held[row["slice"]], own)] if row["slice"] in held else own
        for low, (moves, share) in held.items():
            yield _slice_row(low, (moves * UNIT / np.maximum(share, 1)).astype(np.float32), share[:0])

    share_of_task = max(LEAST_TASK_TOKENS, TOKENS_A_WORD * vocabulary.words)
    tasks = (
        training.select(F.xxhash64("doc_id", "text").alias("draw"), "text")
        .repartition(max(1, -(-total // share_of_task)), "draw").sortWithinPartitions("draw").select("text")
    )
    kinds = "slice long, moves binary, share binary"
    rows = tasks.mapInArrow(pass_over, kinds).repartition("slice").mapInArrow(average, kinds).collect()
    flat = np.concatenate([v.ravel() for v in start.weights.values()])
    for row in rows:
        moves = np.frombuffer(row["moves"], np.float32)
        flat[row["slice"] : row["slice"] + len(moves)] += moves
    ends = np.cumsum([v.size for v in start.weights.values()])[:-1]
    return GatedModel({
        k: part.reshape(v.shape) for (k, v), part in zip(start.weights.items(), np.split(flat, ends), strict=True)
    })


def _slice_row(low: int, moves: np.ndarray, share: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([low]), pa.array([moves.tobytes()]), pa.array([share.tobytes()])], names=["slice", "moves", "share"]
    )


def score_documents(docs: DataFrame) -> DataFrame:
    """Base and model score of every whole text.

    Columns ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score``. Tokens are the words, A-Z lower-cased, and one end per text; null counts as empty
    and has the end alone. Training texts are those whose id's checksum does not leave 2 when
    divided by 7; a null doc_id is neither held out nor learned from. ``base_score`` sums
    log10((c + 1) / (N + V + 1)); ``score`` is the model's log10 probability. Rows repeated count
    and are scored each. Without training texts every token is unknown and the model untrained. An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    held_out = remainder(7) == 2
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    training = docs.where(~held_out).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counts = checkpointed(
        training.select("text").mapInArrow(_count, "word long, kind byte, n long")
        .groupBy("word").agg(F.sum("n").alias("n"), F.first("kind").alias("kind"))
    )
    vocabulary, total, distinct, per_number = _vocabulary(counts)
    model = _learned(training, vocabulary, _fit(training, vocabulary, per_number), total)
    shipped = spark.sparkContext.broadcast((vocabulary, model.weights))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per text; words whose count is not at hand are listed for the join."""
        known, weights = shipped.value
        lm = GatedModel(weights)
        log_mass = np.log10(known.rare_mass)
        for batch in _small_batches(batches):
            hashes, kinds, first = _all_tokens(batch.column("text"))
            places = known.look_up(hashes)
            at_hand = places >= 0
            numbers = known.numbers(places, kinds)
            logs = np.zeros(len(hashes))
            logs[at_hand] = known.log_counts[places[at_hand]]
            chances = np.where(numbers < known.words, 0.0, logs - log_mass[kinds])
            heads = first[:-1]
            model_logs = lm.text_scores(numbers, first) / np.log(10.0)
            tail = np.flatnonzero(~at_hand)
            bounds = np.searchsorted(tail, first)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("held_out"), pa.array(np.diff(first)),
                    pa.array(np.add.reduceat(at_hand.astype(np.int64), heads)),
                    pa.array(np.add.reduceat(logs, heads)),
                    pa.array(model_logs + np.add.reduceat(chances, heads)),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(hashes[tail].view(np.int64))),
                ],
                names=["doc_id", "held_out", "n_tokens", "known", "logs", "score", "tail"],
            )

    scored = rows.mapInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, known long, logs double, score double, tail array<long>"
    )
    # Scoring is dear, so it is done once; the number ties the rest of the words to their row.
    scored = checkpointed(scored.withColumn("row", F.monotonically_increasing_id()))
    rare = scored.select("row", F.explode("tail").alias("word")).join(counts, "word").groupBy("row").agg(
        F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 1.0)).alias("more_logs")
    )
    per_token = float(np.log10(total + distinct + 1.0))
    return scored.drop("tail").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("score") + F.coalesce("more_logs", F.lit(0.0))).alias("score"),
    )


def _small_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``SCORE_BYTES`` of text."""
    for batch in batches:
        for start, stop, _, _ in pieces(*utf8(batch.column("text")), SCORE_BYTES):
            yield batch.slice(start, stop - start)


def _all_tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of a batch, made piece by piece."""
    hashes, kinds, first, size = [np.empty(0, np.uint64)], [np.empty(0, np.int8)], [np.zeros(1, np.int64)], 0
    for _, _, part, at in pieces(*utf8(texts)):
        own, own_kinds, own_first = tokens(part, at)
        hashes.append(own)
        kinds.append(own_kinds)
        first.append(own_first[1:] + size)
        size += len(own)
    return np.concatenate(hashes), np.concatenate(kinds), np.concatenate(first)
