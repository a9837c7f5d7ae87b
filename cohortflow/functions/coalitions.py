"""Contributions to any function of the inputs, from the worth of sets of features.

Shapley values solve a weighted least-squares fit of the worth of sets by sums of contributions, with
the weights of ``kernel_weight`` and the condition that all contributions add up to the score. Up to
``SETS`` sets all are taken, and the fit is exact; with more features, sizes are taken whole from the outside
in as far as they fit, and of the others sets are drawn with their complements. The sets are the same for all
rows, so the fit of a batch is one solve.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np

SETS = 2048
#: Inputs that the function is asked for at once.
ASKED_AT_ONCE = 200_000


def kernel_weight(features: int, size: int) -> float:
    """Weight of all sets of one size together."""
    return (features - 1) / (size * (features - size))


@dataclass(frozen=True)
class Coalitions:
    """``known``: sets as rows of booleans, without the empty and the full one; ``weight`` of each."""

    known: np.ndarray
    weight: np.ndarray

    @classmethod
    def of(cls, features: int, sets: int = SETS, seed: int = 0) -> Coalitions:
        if features < 2:
            return cls(np.zeros((0, features), bool), np.zeros(0))
        known: list[np.ndarray] = []
        weight: list[np.ndarray] = []
        left = max(sets, 2 * features)
        sizes = list(range(1, features // 2 + 1))  # with the size of the complement
        while sizes:
            size = sizes[0]
            pair = 2 * size != features
            number = comb(features, size) * (2 if pair else 1)
            if number > left:
                break
            sizes.pop(0)
            left -= number
            rows = np.zeros((comb(features, size), features), bool)
            rows[np.arange(len(rows))[:, None], list(combinations(range(features), size))] = True
            known += [rows, ~rows] if pair else [rows]
            weight.append(np.full(number, kernel_weight(features, size) * (2 if pair else 1) / number))
        if sizes:
            rng = np.random.default_rng([seed, features])
            mass = np.array([kernel_weight(features, s) * (2 if 2 * s != features else 1) for s in sizes])
            drawn = rng.choice(sizes, max(1, left // 2), p=mass / mass.sum())
            rows = rng.random((len(drawn), features)).argsort(axis=1) < drawn[:, None]
            known += [rows, ~rows]
            weight.append(np.full(2 * len(rows), mass.sum() / (2 * len(rows))))
        return cls(np.concatenate(known), np.concatenate(weight))

    def solve(self, worth: np.ndarray, base: float, score: np.ndarray) -> np.ndarray:
        """(rows, features): contributions that fit ``worth`` (rows, sets) and add up to score - base."""
        features = self.known.shape[1]
        if features == 1:
            return (score - base)[:, None]
        z = self.known.astype(float)
        inverse = np.linalg.pinv((z * self.weight[:, None]).T @ z)
        free = (worth - base) @ (z * self.weight[:, None]) @ inverse
        direction = inverse.sum(axis=1)
        return free - ((free.sum(axis=1) - (score - base)) / direction.sum())[:, None] * direction


def worths(
    predict: Callable[[np.ndarray], np.ndarray], rows: np.ndarray, background: np.ndarray, known: np.ndarray
) -> np.ndarray:
    """(rows, sets): the mean score with the known features of a row and all others as in each background row.

    A function that has ``worths`` of its own, the same numbers found without writing out the mixes, is asked for those.
    """
    if hasattr(predict, "worths"):
        return predict.worths(rows, background, known)
    found = np.zeros((len(rows), len(known)))
    some_background = max(1, min(len(background), ASKED_AT_ONCE))
    some_sets = max(1, ASKED_AT_ONCE // some_background)
    some_rows = max(1, some_sets // max(1, len(known)))
    for b in range(0, len(background), some_background):
        other = background[b : b + some_background]
        for r in range(0, len(rows), some_rows):
            own = rows[r : r + some_rows]
            for s in range(0, len(known), some_sets):
                sets = known[s : s + some_sets]
                mixed = np.where(sets[None, :, None, :], own[:, None, None, :], other[None, None, :, :])
                score = predict(mixed.reshape(-1, rows.shape[1])).reshape(len(own), len(sets), len(other))
                found[r : r + some_rows, s : s + some_sets] += score.sum(axis=2)
    return found / len(background)


def contributions(
    predict: Callable[[np.ndarray], np.ndarray], rows: np.ndarray, background: np.ndarray, coalitions: Coalitions
) -> np.ndarray:
    """(rows, features): inputs j, j + features, ... of a row belong to feature j."""
    features = coalitions.known.shape[1]
    owner = np.arange(rows.shape[1]) % features
    worth = worths(predict, rows, background, coalitions.known[:, owner])
    return coalitions.solve(worth, float(np.mean(predict(background))), predict(rows))
