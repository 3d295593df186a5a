"""SetSketch registers: mergeable, locality-sensitive summaries of sets.

Each element of a set drops points on the positive axis, a Poisson process of rate
``RATE`` for every register; a register keeps the smallest point of all elements, on a scale
of powers of ``BASE``, as a truncated 16-bit number that grows as the point shrinks. The
registers of a union are the larger ones of either set, and equal registers are more likely
the more two sets overlap.
"""

from __future__ import annotations

import numpy as np

from tillscope.llm.textarrays import mix

REGISTERS = 150
BASE = 1.001
RATE = 20.0
LARGEST = (1 << 16) - 1


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of each set of 64-bit elements, a row each; an empty set has zeros.

    Points are made in ascending order, one per element and round, and an element drops out
    once its points lie beyond all its set's registers: large sets need two or three rounds.
    """
    rows = len(sets)
    least = np.full(rows * REGISTERS, np.inf)
    state = np.concatenate([*sets, np.empty(0, np.uint64)])
    owner = np.repeat(np.arange(rows, dtype=np.int64), [len(s) for s in sets])
    reach = np.zeros(len(state))
    step = -1.0 / (REGISTERS * RATE)
    turn = 0
    while len(state):
        state = mix(state, 7)
        # The upper bits give the distance to the next point, the lower ones its register.
        chance = ((state >> np.uint64(24)).astype(np.float64) + 1.0) * 2.0**-40
        reach = reach + np.log(chance) * step
        place = owner * REGISTERS + ((state & np.uint64(0xFFFFFF)) % np.uint64(REGISTERS)).astype(np.int64)
        np.minimum.at(least, place, reach)
        turn += 1
        # Looking at all registers costs as much as a round over few elements.
        if turn < 8 or turn % 16 == 0:
            bound = least.reshape(rows, REGISTERS).max(axis=1)
            live = reach < bound[owner]
            state, owner, reach = state[live], owner[live], reach[live]
    with np.errstate(divide="ignore"):
        scaled = np.floor(1.0 - np.log(least) / np.log(BASE))
    return np.clip(scaled, 0, LARGEST).astype(np.uint16).reshape(rows, REGISTERS)


def merged(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(left, right)


def band_keys(rows: np.ndarray, width: int, orders: int) -> np.ndarray:
    """Bucket keys of each row of registers: ``width`` registers a band, ``orders`` regroupings."""
    bands = []
    for k in range(orders):
        order = np.random.default_rng(k).permutation(REGISTERS)
        bands.append(order[: REGISTERS // width * width].reshape(-1, width))
    groups = np.concatenate(bands)
    values = mix(rows.astype(np.uint64), 11)[:, groups]
    weights = mix(np.arange(width, dtype=np.uint64), 12) | np.uint64(1)
    sums = (values * weights).sum(axis=2, dtype=np.uint64)
    return mix(sums + mix(np.arange(len(groups), dtype=np.uint64), 13))


def joint_similarity(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of pairs of sets of known sizes, from their registers.

    A register is larger on the left with probability p(u - v J), on the right with
    p(v - u J), equal otherwise, where u and v are the sizes' shares and
    p(x) = -log_b(1 - x (b - 1) / b). The log-likelihood of the three counts is concave in J,
    so its maximum is found by halving on the sign of the slope.
    """
    above = (left > right).sum(axis=1).astype(float)
    below = (left < right).sum(axis=1).astype(float)
    equal = REGISTERS - above - below
    u = n_left / (n_left + n_right)
    v = 1.0 - u
    c, log_b = (BASE - 1.0) / BASE, np.log(BASE)

    def p(x: np.ndarray) -> np.ndarray:
        return np.maximum(-np.log1p(-c * x) / log_b, 1e-12)

    def slope_of_p(x: np.ndarray) -> np.ndarray:
        return c / log_b / (1.0 - c * x)

    low, high = np.zeros(len(u)), np.minimum(u, v) / np.maximum(u, v)
    for _ in range(30):
        j = (low + high) / 2
        x, y = u - v * j, v - u * j
        dx, dy = -v * slope_of_p(x), -u * slope_of_p(y)
        same = np.maximum(1.0 - p(x) - p(y), 1e-12)
        slope = above * dx / p(x) + below * dy / p(y) - equal * (dx + dy) / same
        low, high = np.where(slope > 0, j, low), np.where(slope > 0, high, j)
    return (low + high) / 2
