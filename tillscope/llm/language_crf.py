"""Linear-chain conditional random field over words, for naming languages in mixed text.

Every word scores each language by its character n-grams (with marks at both ends, so they
serve as affixes too) and by the word itself; learned transitions say how likely the next
word stays with the language. Forward-backward gives each word's probability per language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tillscope.llm.textarrays import mix

FEATURES = 1 << 17
NGRAMS = (2, 3, 4)
CHUNK = 32

TRAIN_LENGTH = 48
TRAIN_BATCH = 48
EPOCHS = 4
RATE = 0.3
DECAY = 1e-6


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Lower-cased runs of letters: distinct words, index of each word, first word of each text."""
    spaced = pc.utf8_trim_whitespace(pc.replace_substring_regex(
        pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")), r"[^\p{L}]+", " "
    ))
    lists = pc.split_pattern(spaced, " ")
    counts = np.where(
        pc.equal(spaced, "").to_numpy(zero_copy_only=False), 0, pc.list_value_length(lists).to_numpy()
    )
    flat = lists.flatten()
    flat = flat.filter(pc.not_equal(flat, ""))
    coded = flat.dictionary_encode()
    first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), first


def word_features(vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words in a row, and where each word's begin."""
    n = len(vocabulary)
    if not n:
        return np.empty(0, np.int64), np.zeros(1, np.int64)
    marked = pc.binary_join_element_wise(
        pa.scalar("^", pa.large_string()), vocabulary, pa.scalar("$", pa.large_string()),
        pa.scalar("", pa.large_string()),
    )
    ends = np.frombuffer(marked.buffers()[1], np.int64)[marked.offset : marked.offset + n + 1]
    data = np.frombuffer(marked.buffers()[2], np.uint8)[ends[0] : ends[-1]].astype(np.uint64)
    ends = ends - ends[0]
    lengths = np.diff(ends)
    room = np.repeat(ends[1:], lengths) - np.arange(len(data))
    owner = np.repeat(np.arange(n), lengths)
    owners, numbers = [], []
    for size in NGRAMS:
        rolled = np.zeros(len(data), np.uint64)
        for k in range(size):
            rolled[: len(data) - k] += data[k:] << np.uint64(8 * k)
        inside = room >= size
        numbers.append(mix(rolled[inside], 40 + size))
        owners.append(owner[inside])
    factors = np.power(np.uint64(1_000_003), np.arange(int(lengths.max()), dtype=np.uint64))
    whole = np.add.reduceat(data * factors[np.arange(len(data)) - np.repeat(ends[:-1], lengths)], ends[:-1])
    numbers.append(mix(whole, 40))
    owners.append(np.arange(n))
    owners, numbers = np.concatenate(owners), np.concatenate(numbers)
    order = np.argsort(owners, kind="stable")
    starts = np.searchsorted(owners[order], np.arange(n + 1))
    return (numbers[order] & np.uint64(FEATURES - 1)).astype(np.int64), starts


class LanguageCrf:
    """``labels``, feature weights (features by labels) and transition weights."""

    def __init__(self, labels: list[str], weights: np.ndarray | None = None, moves: np.ndarray | None = None):
        self.labels = labels
        n = len(labels)
        self.weights = np.zeros((FEATURES, n), np.float32) if weights is None else weights
        self.moves = np.zeros((n, n)) if moves is None else moves

    def emissions(self, vocabulary: pa.Array) -> np.ndarray:
        """Score of every distinct word for every language, the best one 0, as factors."""
        numbers, starts = word_features(vocabulary)
        if not len(vocabulary):
            return np.ones((0, len(self.labels)))
        scores = np.add.reduceat(self.weights[numbers], starts[:-1], axis=0).astype(float)
        return np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -60.0))

    def posteriors(self, factors: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability of each language for each word, by exact forward-backward.

        Texts are cut into chunks of ``CHUNK`` words. All chunks at once yield their product of
        transitions and words; passing these along a text gives what enters every chunk from
        either side, and a second pass fills the chunks in. A text of any length needs no more
        steps at a time than a chunk has words, plus one per chunk.
        """
        n_labels = len(self.labels)
        step = np.exp(self.moves - self.moves.max())
        counts = np.diff(first)
        chunks = -(-counts // CHUNK)
        total = int(chunks.sum())
        if not total:
            return np.zeros((0, n_labels))
        head = np.concatenate([[0], np.cumsum(chunks)])
        text = np.repeat(np.arange(len(counts)), chunks)
        rank = np.arange(total) - head[text]
        begin = first[text] + rank * CHUNK
        size = np.minimum(CHUNK, first[text + 1] - begin)
        at = begin[:, None] + np.minimum(np.arange(CHUNK), size[:, None] - 1)
        word = factors[at]
        live = np.arange(CHUNK) < size[:, None]

        product = np.broadcast_to(np.eye(n_labels), (total, n_labels, n_labels)).copy()
        for k in range(CHUNK):
            moved = (product @ step) * word[:, k, None, :]
            moved /= moved.max(axis=(1, 2), keepdims=True)
            product = np.where(live[:, k, None, None], moved, product)

        entering = np.full((total, n_labels), 1.0 / n_labels)
        leaving = np.full((total, n_labels), 1.0 / n_labels)
        by_length = np.argsort(-chunks, kind="stable")
        sorted_chunks = -chunks[by_length]
        for k in range(1, int(chunks.max())):
            longer = by_length[: np.searchsorted(sorted_chunks, -k)]
            here = head[longer] + k
            vector = np.einsum("ci,cij->cj", entering[here - 1], product[here - 1])
            entering[here] = vector / vector.sum(axis=1, keepdims=True)
            there = head[longer + 1] - 1 - k
            vector = np.einsum("cij,cj->ci", product[there + 1], leaving[there + 1])
            leaving[there] = vector / vector.sum(axis=1, keepdims=True)

        forward = np.empty((CHUNK, total, n_labels))
        vector = entering
        for k in range(CHUNK):
            moved = (vector @ step) * word[:, k]
            moved /= moved.sum(axis=1, keepdims=True)
            vector = np.where(live[:, k, None], moved, vector)
            forward[k] = vector
        vector = leaving
        for k in range(CHUNK - 1, -1, -1):
            forward[k] *= vector
            moved = (word[:, k] * vector) @ step.T
            moved /= moved.sum(axis=1, keepdims=True)
            vector = np.where(live[:, k, None], moved, vector)
        both = np.moveaxis(forward, 0, 1)[live]
        return both / both.sum(axis=1, keepdims=True)

    def document_shares(self, texts: pa.Array) -> np.ndarray:
        """Expected share of each language among a text's words; NaN where there are none."""
        vocabulary, index, first = split_words(texts)
        shares = np.full((len(texts), len(self.labels)), np.nan)
        if not self.labels:
            return shares
        filled = np.flatnonzero(np.diff(first))
        if len(filled):
            words = self.posteriors(self.emissions(vocabulary)[index], first)
            shares[filled] = np.add.reduceat(words, first[filled], axis=0) / np.diff(first)[filled, None]
        return shares


def train(texts: list[str], labels: list[str], seed: int = 0) -> LanguageCrf:
    """Fit by stochastic gradients (Adagrad) on sequences that switch language at random places."""
    names = sorted(set(labels))
    model = LanguageCrf(names)
    if len(names) < 2:
        return model
    vocabulary, index, first = split_words(pa.array(texts, pa.large_string()))
    gold = np.repeat([names.index(x) for x in labels], np.diff(first))
    numbers, starts = word_features(vocabulary)
    chance = np.random.default_rng(seed)
    # Runs of a few words to a few dozen, shuffled, so that neighbours often differ in language.
    cuts = np.flatnonzero(chance.random(len(index)) < 1 / 12)
    cuts = np.unique(np.concatenate([[0], first[:-1], cuts]))
    runs = np.split(np.arange(len(index)), cuts[1:])
    squares = np.full(model.weights.shape, 1e-3, np.float32)
    move_squares = np.full(model.moves.shape, 1e-3)
    per_step = TRAIN_BATCH * TRAIN_LENGTH
    if not len(index):
        return model
    # Few words are gone over more often, so that they are learned too.
    epochs = max(EPOCHS, 2 * EPOCHS * per_step // max(len(index), per_step // 4))
    for _ in range(epochs):
        order = np.concatenate([runs[i] for i in chance.permutation(len(runs))])
        for at in _sequences(order, per_step):
            rows = len(at)
            distinct, place = np.unique(index[at], return_inverse=True)
            place = place.reshape(at.shape)
            spans = [numbers[starts[w] : starts[w + 1]] for w in distinct]
            lengths = np.array([len(s) for s in spans])
            used = np.concatenate(spans)
            heads = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            scores = np.add.reduceat(model.weights[used], heads, axis=0).astype(float)[place]
            slope, move_slope = _gradient(scores, model.moves, gold[at])
            per_word = np.zeros((len(distinct), len(names)))
            np.add.at(per_word, place.ravel(), slope.reshape(-1, len(names)))
            fresh, where = np.unique(used, return_inverse=True)
            change = np.zeros((len(fresh), len(names)))
            np.add.at(change, where, np.repeat(per_word, lengths, axis=0))
            change = (change / rows + DECAY * model.weights[fresh]).astype(np.float32)
            squares[fresh] += change**2
            model.weights[fresh] -= RATE * change / np.sqrt(squares[fresh])
            move_slope = move_slope / rows + 1e-4 * model.moves
            move_squares += move_slope**2
            model.moves -= RATE * move_slope / np.sqrt(move_squares)
    return model


def _sequences(order: np.ndarray, per_step: int) -> Iterator[np.ndarray]:
    """Sequences of a step each; the last step has fewer, and what is left is one shorter sequence."""
    for low in range(0, len(order), per_step):
        part = order[low : low + per_step]
        whole = len(part) // TRAIN_LENGTH * TRAIN_LENGTH
        if whole:
            yield part[:whole].reshape(-1, TRAIN_LENGTH)
        if whole < len(part):
            yield part[whole:].reshape(1, -1)


def _gradient(scores: np.ndarray, moves: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected minus true counts, of words' labels and of transitions, over equal-long sequences."""
    rows, length, n = scores.shape
    word = np.exp(np.maximum(scores - scores.max(axis=2, keepdims=True), -60.0))
    step = np.exp(moves - moves.max())
    forward = np.empty((length + 1, rows, n))
    forward[0] = 1.0 / n
    for t in range(length):
        forward[t + 1] = (forward[t] @ step) * word[:, t]
        forward[t + 1] /= forward[t + 1].sum(axis=1, keepdims=True)
    backward = np.full((rows, n), 1.0 / n)
    slope = np.empty_like(scores)
    pairs = np.zeros((n, n))
    ones = np.eye(n)[gold]
    for t in range(length - 1, -1, -1):
        both = forward[t + 1] * backward
        slope[:, t] = both / both.sum(axis=1, keepdims=True) - ones[:, t]
        ahead = word[:, t] * backward
        joint = forward[t][:, :, None] * step * ahead[:, None, :]
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        if t:
            pairs -= np.einsum("bi,bj->ij", ones[:, t - 1], ones[:, t])
        else:
            pairs -= ones[:, 0].sum(axis=0) / n
        backward = ahead @ step.T
        backward /= backward.sum(axis=1, keepdims=True)
    return slope, pairs
