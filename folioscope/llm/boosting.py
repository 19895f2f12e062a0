"""Gradient-boosted trees in numpy: fitted on the driver, scored in tasks.

Trees of a fixed depth are stored flat: one row of node arrays per tree, children of node
n at 2n + 1 and 2n + 2, so that a batch walks all its rows down one level at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """``feature`` and ``cut``: trees x inner nodes. ``leaf``: trees x leaves."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The probability of the positive class for each row."""
        total = np.full(len(rows), self.base)
        each = np.arange(len(rows))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(rows), np.int64)
            while node.size and node[0] < len(feature):
                node = 2 * node + 1 + (rows[each, feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def fit(
    rows: np.ndarray,
    target: np.ndarray,
    monotone: Sequence[int],
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    smoothing: float = 1.0,
) -> Trees:
    """Boosted trees for the logistic loss.

    ``monotone`` has 1, -1 or 0 per feature: the score may only rise, only fall, or do
    both as the feature grows. A split that breaks this is not taken, and the middle of
    its two sides bounds all leaves below it, so the constraint holds for whole trees.
    """
    count, width = rows.shape
    grid = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(grid[f], rows[:, f], side="left") for f in range(width)])
    share = np.clip(target.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    total = np.full(count, base)
    inner = 2**depth - 1
    features = np.zeros((trees, inner), np.int64)
    cuts = np.full((trees, inner), np.inf)
    leaves = np.zeros((trees, inner + 1))
    for tree in range(trees):
        chance = 1 / (1 + np.exp(-total))
        slope, curve = target - chance, chance * (1 - chance)
        node = np.zeros(count, np.int64)
        bounds = {0: (-np.inf, np.inf)}
        for at in range(inner):
            low, high = bounds[at]
            mine = np.flatnonzero(node == at)
            best = _best_split(
                binned[:, mine], slope[mine], curve[mine], grid, monotone, low, high, smoothing
            )
            right = np.zeros(len(mine), bool)
            left_bounds = right_bounds = (low, high)
            if best is not None:
                feature, bin_, left_value, right_value = best
                features[tree, at], cuts[tree, at] = feature, grid[feature][bin_]
                right = binned[feature, mine] > bin_
                middle = (left_value + right_value) / 2
                if monotone[feature] > 0:
                    left_bounds, right_bounds = (low, middle), (middle, high)
                elif monotone[feature] < 0:
                    left_bounds, right_bounds = (middle, high), (low, middle)
            node[mine] = 2 * at + 1 + right
            bounds[2 * at + 1], bounds[2 * at + 2] = left_bounds, right_bounds
        for leaf in range(inner + 1):
            mine = node == inner + leaf
            value = slope[mine].sum() / (curve[mine].sum() + smoothing)
            leaves[tree, leaf] = rate * np.clip(value, *bounds[inner + leaf])
        total += leaves[tree, node - inner]
    return Trees(base, features, cuts, leaves)


def _best_split(binned, slope, curve, grid, monotone, low, high, smoothing):
    """Feature, bin and the values of both sides of the split with the largest gain."""
    best, most = None, 1e-6
    if len(slope) < 2:
        return None
    parent = slope.sum() ** 2 / (curve.sum() + smoothing)
    for feature, cuts in enumerate(grid):
        if not len(cuts):
            continue
        size = len(cuts) + 1
        left_slope = np.cumsum(np.bincount(binned[feature], slope, size))[:-1]
        left_curve = np.cumsum(np.bincount(binned[feature], curve, size))[:-1]
        right_slope, right_curve = slope.sum() - left_slope, curve.sum() - left_curve
        gain = (
            left_slope**2 / (left_curve + smoothing) + right_slope**2 / (right_curve + smoothing) - parent
        )
        left_value = np.clip(left_slope / (left_curve + smoothing), low, high)
        right_value = np.clip(right_slope / (right_curve + smoothing), low, high)
        gain[monotone[feature] * (right_value - left_value) < 0] = 0
        at = int(gain.argmax())
        if gain[at] > most:
            most, best = gain[at], (feature, at, left_value[at], right_value[at])
    return best
