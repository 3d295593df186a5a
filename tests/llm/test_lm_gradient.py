"""Slopes and chances of the recurrent model against plain sums in double precision."""

import numpy as np
import pytest

from tillscope.llm import gated_lm


@pytest.fixture
def model():
    counts = np.random.default_rng(1).integers(1, 50, gated_lm.WORDS + gated_lm.RARE_CLASSES)
    return gated_lm.GatedModel.fresh(counts, gated_lm.WORDS - 5)


def _plain(model, state, target):
    """Log chance of one token, word by word."""
    w = {k: v.astype(float) for k, v in model.weights.items()}
    logits = state @ w["classes"] + w["class_bias"]
    kind = int(model.class_of(np.array([target]))[0])
    result = logits[kind] - np.log(np.exp(logits).sum())
    if target < model.words:
        inner = state @ w["words"][kind] + w["word_bias"][kind]
        result += inner[target % model.class_words] - np.log(np.exp(inner).sum())
    return result


def test_chances_are_plain_ones(model):
    chance = np.random.default_rng(2)
    states = chance.standard_normal((60, gated_lm.STATE)).astype(np.float32)
    targets = chance.integers(0, gated_lm.WORDS - 5, 60)
    targets[::7] = gated_lm.WORDS + chance.integers(0, gated_lm.RARE_CLASSES, len(targets[::7]))
    plain = [_plain(model, s.astype(float), t) for s, t in zip(states, targets.tolist())]
    assert model.log_chances(states, targets) == pytest.approx(plain, abs=1e-4)


def test_texts_in_several_flushes_score_the_same(model, monkeypatch):
    chance = np.random.default_rng(3)
    first = np.append(0, np.cumsum(chance.integers(1, 40, 50)))
    ids = chance.integers(0, gated_lm.WORDS - 5, first[-1])
    whole = model.text_scores(ids, first)
    monkeypatch.setattr(gated_lm, "FLUSH", 10)
    assert model.text_scores(ids, first) == pytest.approx(whole, rel=1e-5)


def test_slopes_follow_the_loss(model):
    """A token that comes several times in a window, one that has no place, and a text that begins within."""
    chance = np.random.default_rng(4)
    ids = chance.integers(0, 40, (3, 6))
    ids[1, 2], ids[2, 4:] = gated_lm.WORDS + 3, -1
    heads = np.zeros(ids.shape, bool)
    heads[:, 0] = heads[1, 3] = True
    start = np.zeros((3, gated_lm.STATE), np.float32)

    def loss():
        total, state = 0.0, start
        for t in range(ids.shape[1]):
            state = np.where(heads[:, t, None], np.float32(0), state)
            for r in range(3):
                if ids[r, t] >= 0:
                    total -= _plain(model, state[r].astype(float), int(ids[r, t]))
            state, _ = model.step(np.maximum(ids[:, t], 0), state)
        return total / (ids >= 0).sum()

    grads, _ = gated_lm._window_gradient(model, ids, heads, start)
    norm = np.sqrt(sum(float(((g.values if isinstance(g, gated_lm.Rows) else g) ** 2).sum()) for g in grads.values()))
    # Slopes longer than 1 are cut to 1: all by the same factor, which the first of them gives.
    assert norm < 1.0 + 1e-5
    scale = None
    model.weights = {k: v.astype(float) for k, v in model.weights.items()}
    row = grads["inputs"].rows.tolist().index(int(ids[0, 0]))
    asked = [("loop", (2, 5), grads["loop"][2, 5]), ("class_bias", (0,), grads["class_bias"][0]),
             ("inputs", (int(ids[0, 0]), 40), grads["inputs"].values[row, 40])]
    for name, at, slope in asked:
        old, losses = model.weights[name][at], []
        for step in (1e-4, -1e-4):
            model.weights[name][at] = old + step
            losses.append(loss())
        model.weights[name][at] = old
        factor = (losses[0] - losses[1]) / 2e-4 / slope
        scale = scale or factor
        assert factor >= 0.99 and factor == pytest.approx(scale, rel=0.01)
