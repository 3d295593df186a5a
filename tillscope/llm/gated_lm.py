"""A gated recurrent language model in numpy with a class-factored softmax.

A token is predicted in two steps: its class from the state, and the word among its class. The
frequent words fill classes of about the root of their number, whose words are predicted from
the state too. How many words are frequent grows with the corpus (``room``).
All other words fall in classes by their last letters, within which the counts of the training
text decide; so every token, known or not, has a probability.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

STATE = 16
RARE_CLASSES = 32
# Places for frequent words in the smallest model, and words of its classes.
CLASS_WORDS = 32
WORDS = CLASS_WORDS * CLASS_WORDS

STREAMS = 32
WINDOW = 20
EPOCHS = 3
RATE = 0.01
# Tokens scored together: few enough that their logits stay in a core's cache.
FLUSH = 8_192

# The pass over all texts: streams at most, tokens of one at least where there are several, rate.
WIDE = 256
STREAM_TOKENS = 2_000
PASS_RATE = 0.003


def _class_words(words: int) -> int:
    """Words of a class: the power of two from the root of all words on."""
    size = CLASS_WORDS
    while size * size < words:
        size *= 2
    return size


def room(words: int) -> int:
    """Places of a model for so many frequent words: whole classes."""
    size = _class_words(words)
    return max(WORDS, -(-words // size) * size)


class Rows(NamedTuple):
    """A gradient that is zero but in some rows."""

    rows: np.ndarray
    values: np.ndarray


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x = np.negative(x)
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1.0
    return np.reciprocal(x, out=x)


def _logits(states: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Logits of each state, the largest of which is 0."""
    x = states @ weights
    x += bias
    x -= x.max(axis=1, keepdims=True)
    return x


def _log_chance(x: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Log probability of each row's target; ``x`` is used up."""
    chosen = x[np.arange(len(targets)), targets]
    np.exp(x, out=x)
    return chosen - np.log(x @ np.ones(x.shape[1], x.dtype))


def _slope(x: np.ndarray, targets: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Slope of the negative log probability of each row's target, by its weight; ``x`` is used up."""
    np.exp(x, out=x)
    x *= (weight / (x @ np.ones(x.shape[1], x.dtype)))[:, None]
    x[np.arange(len(targets)), targets] -= weight
    return x


class GatedModel:
    """Weights: ``inputs`` (token to gates), ``loop`` (state to gates), ``classes``, ``words``."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights
        self.word_classes, _, self.class_words = weights["words"].shape
        self.words = self.word_classes * self.class_words

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        """Class of a token number: below ``words`` a frequent word, from there on a rare class."""
        return np.where(ids < self.words, ids // self.class_words, ids - self.words + self.word_classes)

    def by_class(self, ids: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the frequent words, class by class; the classes among them; where each begins."""
        frequent = np.flatnonzero(ids < self.words)
        order = frequent[np.argsort(kinds[frequent].astype(np.int16), kind="stable")]
        counts = np.bincount(kinds[order], minlength=self.word_classes)
        found = np.flatnonzero(counts)
        return order, found, np.append(0, np.cumsum(counts[found]))

    @classmethod
    def fresh(cls, counts: np.ndarray, used: int, seed: int = 0) -> GatedModel:
        """Small random weights; biases are the logarithms of how often classes and words occur.

        ``counts`` has a number for each token number; word numbers from ``used`` on are free places.
        """
        chance = np.random.default_rng(seed)

        def small(*shape: int) -> np.ndarray:
            return (chance.standard_normal(shape) * 0.1).astype(np.float32)

        places = len(counts) - RARE_CLASSES
        size = _class_words(places)
        word_classes = places // size
        words = counts[:places].astype(float)
        per_class = np.append(words.reshape(word_classes, size).sum(axis=1), counts[places:])
        bias = np.log(words + 0.5)
        bias[used:] = -1e4
        return cls({
            "inputs": small(len(counts), 3 * STATE),
            "loop": small(STATE, 3 * STATE),
            "classes": small(STATE, len(per_class)),
            "class_bias": np.log(per_class + 0.5).astype(np.float32),
            "words": small(word_classes, STATE, size),
            "word_bias": bias.reshape(word_classes, size).astype(np.float32),
        })

    def step(self, ids: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, tuple]:
        """State after the tokens ``ids``, and what the way back needs."""
        x = self.weights["inputs"][ids]
        u = state @ self.weights["loop"]
        gates = _sigmoid(x[:, : 2 * STATE] + u[:, : 2 * STATE])
        keep, reset = gates[:, :STATE], gates[:, STATE:]
        u_new = u[:, 2 * STATE :]
        new = np.tanh(x[:, 2 * STATE :] + reset * u_new)
        return new + keep * (state - new), (ids, state, keep, reset, new, u_new)

    def log_chances(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log of each target's probability: of its class, and for frequent words of the word."""
        w = self.weights
        kinds = self.class_of(targets)
        result = _log_chance(_logits(states, w["classes"], w["class_bias"]), kinds).astype(np.float64)
        order, found, bounds = self.by_class(targets, kinds)
        own, places, inner = states[order], targets[order] % self.class_words, np.empty(len(order))
        for c, low, high in zip(found.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            x = _logits(own[low:high], w["words"][c], w["word_bias"][c])
            inner[low:high] = _log_chance(x, places[low:high])
        result[order] += inner
        return result

    def text_scores(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Natural log probability of each whole text, ``ids[first[i]:first[i + 1]]``.

        All texts advance together, a token at a time; those that end drop out. A text starts
        from the empty state and carries it to its end, whatever its length.
        """
        lengths = np.diff(first)
        order = np.argsort(-lengths, kind="stable")
        begin, down = first[:-1][order], -lengths[order]
        totals = np.zeros(len(lengths))
        state = np.zeros((len(lengths), STATE), np.float32)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for t in range(int(lengths.max(initial=0))):
            live = int(np.searchsorted(down, -t))
            state = state[:live]
            targets = ids[begin[:live] + t]
            held.append((state, targets))
            size += live
            if size >= FLUSH or t + 1 == -down[0]:
                chances = self.log_chances(np.concatenate([s for s, _ in held]), np.concatenate([x for _, x in held]))
                rows = np.concatenate([np.arange(len(x)) for _, x in held])
                totals += np.bincount(rows, chances, len(totals))
                held, size = [], 0
            state, _ = self.step(targets, state)
        result = np.zeros(len(lengths))
        result[order] = totals
        return result


def train(texts: list[np.ndarray], counts: np.ndarray, used: int, seed: int = 0) -> GatedModel:
    """Truncated backpropagation through time, with Adam.

    Texts are dealt to parallel streams. A window of ``WINDOW`` tokens is learned at a time; the
    state at its end is carried into the next window, and a text's first token starts from
    the empty state.
    """
    model = GatedModel.fresh(counts, used, seed)
    chance = np.random.default_rng(seed)
    adam = Adam(model)
    for epoch in range(EPOCHS):
        streams: list[list[np.ndarray]] = [[] for _ in range(STREAMS)]
        sizes = np.zeros(STREAMS, np.int64)
        for i in chance.permutation(len(texts)).tolist():
            k = int(sizes.argmin())
            streams[k].append(texts[i])
            sizes[k] += len(texts[i])
        length = int(sizes.max()) // WINDOW * WINDOW
        ids = np.full((STREAMS, length + WINDOW), -1, np.int64)
        heads = np.zeros((STREAMS, length + WINDOW), bool)
        for k, stream in enumerate(streams):
            at = 0
            for text in stream:
                ids[k, at : at + len(text)] = text
                heads[k, at] = True
                at += len(text)
        state = np.zeros((STREAMS, STATE), np.float32)
        for low in range(0, ids.shape[1], WINDOW):
            window = ids[:, low : low + WINDOW]
            if not (window >= 0).any():
                break
            grads, state = _window_gradient(model, window, heads[:, low : low + WINDOW], state)
            adam.step(grads, RATE * (0.3 if epoch == EPOCHS - 1 else 1.0))
    return model


class Adam:
    """Steps on a model's weights; rows without a gradient stay as they are."""

    def __init__(self, model: GatedModel):
        self.weights = model.weights
        self.means = {k: np.zeros_like(v) for k, v in model.weights.items()}
        self.squares = {k: np.zeros_like(v) for k, v in model.weights.items()}
        self.turn = 0

    def step(self, grads: dict, rate: float) -> None:
        self.turn += 1
        for k, g in grads.items():
            rows, g = g if isinstance(g, Rows) else (slice(None), g)
            mean, square = self.means[k][rows], self.squares[k][rows]
            mean = mean + np.float32(0.1) * (g - mean)
            square = square + np.float32(0.01) * (g * g - square)
            self.means[k][rows], self.squares[k][rows] = mean, square
            scale = np.float32(rate / (1 - 0.9**self.turn))
            self.weights[k][rows] -= scale * mean / (np.sqrt(square / np.float32(1 - 0.99**self.turn)) + np.float32(1e-6))


def learn(model: GatedModel, adam: Adam, ids: np.ndarray, first: np.ndarray) -> None:
    """Learn from every token of whole texts, ``ids[first[i]:first[i + 1]]``, once.

    The texts stand one after the other and are cut into equal streams, which advance together.
    """
    streams = max(1, min(WIDE, len(ids) // STREAM_TOKENS))
    length = -(-len(ids) // streams)
    own = np.full(streams * length, -1, np.int64)
    own[: len(ids)] = ids
    heads = np.zeros(len(own), bool)
    heads[first[:-1]] = True
    own, heads = own.reshape(streams, length), heads.reshape(streams, length)
    state = np.zeros((streams, STATE), np.float32)
    for low in range(0, length, WINDOW):
        window = slice(low, low + WINDOW)
        grads, state = _window_gradient(model, own[:, window], heads[:, window], state)
        adam.step(grads, PASS_RATE)


def _window_gradient(model: GatedModel, ids: np.ndarray, heads: np.ndarray, state: np.ndarray):
    """Mean gradient over one window (number -1 marks places without a token) and the state after it."""
    w = model.weights
    rows, length = ids.shape
    live = ids >= 0
    safe = np.where(live, ids, 0)
    states, saved = [], []
    for t in range(length):
        state = np.where(heads[:, t, None], np.float32(0), state)
        states.append(state)
        state, cache = model.step(safe[:, t], state)
        saved.append(cache)
    flat = np.concatenate(states)
    targets, weight = safe.T.ravel(), live.T.ravel().astype(np.float32)
    scale = np.float32(1.0 / weight.sum())
    grads: dict = {}

    kinds = model.class_of(targets)
    slope = _slope(_logits(flat, w["classes"], w["class_bias"]), kinds, weight * scale)
    grads["classes"], grads["class_bias"] = flat.T @ slope, slope.sum(axis=0)
    back = slope @ w["classes"].T
    # A place without a token counts as beyond the frequent words.
    order, found, bounds = model.by_class(np.where(weight > 0, targets, model.words), kinds)
    own, places, shares = flat[order], targets[order] % model.class_words, np.full(len(order), scale)
    slopes = np.zeros((len(found), STATE, model.class_words), flat.dtype)
    bias_slopes = np.zeros((len(found), model.class_words), flat.dtype)
    own_back = np.empty_like(own)
    for k, (c, low, high) in enumerate(zip(found.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        x = _logits(own[low:high], w["words"][c], w["word_bias"][c])
        inner = _slope(x, places[low:high], shares[low:high])
        slopes[k], bias_slopes[k] = own[low:high].T @ inner, inner.sum(axis=0)
        own_back[low:high] = inner @ w["words"][c].T
    back[order] += own_back
    grads["words"], grads["word_bias"] = Rows(found, slopes), Rows(found, bias_slopes)
    back = back.reshape(length, rows, STATE)

    ahead = np.zeros((rows, STATE), np.float32)
    grads["loop"] = np.zeros_like(w["loop"])
    inputs = np.empty((length, rows, 3 * STATE), flat.dtype)
    for t in range(length - 1, -1, -1):
        _, before, keep, reset, new, u_new = saved[t]
        d_new = ahead * (1 - keep) * (1 - new * new)
        d_keep = ahead * (before - new) * keep * (1 - keep)
        d_reset = d_new * u_new * reset * (1 - reset)
        d_u = np.concatenate([d_keep, d_reset, d_new * reset], axis=1)
        inputs[t] = np.concatenate([d_keep, d_reset, d_new], axis=1) * live[:, t, None]
        grads["loop"] += before.T @ d_u
        ahead = ahead * keep + d_u @ w["loop"].T + back[t]
        # A text's first token starts from the empty state, so nothing goes further back.
        ahead = np.where(heads[:, t, None], np.float32(0), ahead)
    tokens, row = np.unique(targets, return_inverse=True)
    cells = (row[:, None] * (3 * STATE) + np.arange(3 * STATE)).ravel()
    sums = np.bincount(cells, inputs.ravel(), len(tokens) * 3 * STATE)
    grads["inputs"] = Rows(tokens, sums.astype(flat.dtype).reshape(-1, 3 * STATE))
    plain = [g.values if isinstance(g, Rows) else g for g in grads.values()]
    norm = np.sqrt(sum(float((g * g).sum()) for g in plain))
    if norm > 1.0:
        for g in plain:
            g /= norm
    return grads, state
