"""Gradient-boosted trees in numpy: histogram splits, monotonic constraints, flat nodes.

A model is five arrays over the nodes of all trees (feature, threshold, left child,
right child, value) and the root of each tree. Scoring moves all rows of a batch one
level down at a time.

A constraint of +1 (-1) on a feature makes the score never fall (rise) with it: a split
on it is taken only if its two values are in that order, and both sides keep to
their side of the middle from there on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROUNDS = 60
DEPTH = 3
RATE = 0.2
BINS = 64
SHRINK = 1.0  # added to a node's weight, pulls small leaves to 0
LEAST_ROWS = 20


@dataclass
class Trees:
    base: float
    roots: np.ndarray
    feature: np.ndarray  # -1 at a leaf
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every row."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while (split := self.feature[at] >= 0).any():
                here = at[split]
                goes_left = x[rows[split], self.feature[here]] <= self.threshold[here]
                at[split] = np.where(goes_left, self.left[here], self.right[here])
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


class _Grower:
    def __init__(self, binned: np.ndarray, cuts: list[np.ndarray], signs: np.ndarray) -> None:
        self.binned, self.cuts, self.signs = binned, cuts, signs
        self.nodes: list[list] = []

    def grow(self, rows, slope, curve, depth, low, high) -> int:
        """Add the subtree of these rows; its node number."""
        at = len(self.nodes)
        value = self._leaf(slope[rows].sum(), curve[rows].sum(), low, high)
        self.nodes.append([-1, 0.0, -1, -1, value])
        found = self._split(rows, slope, curve, low, high) if depth else None
        if found:
            column, cut, left_value, right_value = found
            goes_left = self.binned[rows, column] <= cut
            sign, middle = self.signs[column], (left_value + right_value) / 2
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
            left, right = bounds.get(int(sign), ((low, high), (low, high)))
            self.nodes[at][:2] = [column, self.cuts[column][cut]]
            self.nodes[at][2] = self.grow(rows[goes_left], slope, curve, depth - 1, *left)
            self.nodes[at][3] = self.grow(rows[~goes_left], slope, curve, depth - 1, *right)
        return at

    def _leaf(self, slope, curve, low, high):
        return np.clip(-slope / (curve + SHRINK), low, high)

    def _split(self, rows, slope, curve, low, high):
        best, gain_of_best = None, 1e-6
        s, c = slope[rows], curve[rows]
        for column, cuts in enumerate(self.cuts):
            if not len(cuts):
                continue
            bins, width = self.binned[rows, column], len(cuts) + 1
            n_left = np.bincount(bins, minlength=width).cumsum()[:-1]
            s_left = np.bincount(bins, s, width).cumsum()[:-1]
            c_left = np.bincount(bins, c, width).cumsum()[:-1]
            s_right, c_right = s.sum() - s_left, c.sum() - c_left
            left = self._leaf(s_left, c_left, low, high)
            right = self._leaf(s_right, c_right, low, high)

            def loss(value, slope_sum, curve_sum):
                return slope_sum * value + (curve_sum + SHRINK) * value**2 / 2

            whole = self._leaf(s.sum(), c.sum(), low, high)
            gain = loss(whole, s.sum(), c.sum()) - loss(left, s_left, c_left) - loss(
                right, s_right, c_right
            )
            fits = (n_left >= LEAST_ROWS) & (len(rows) - n_left >= LEAST_ROWS)
            if self.signs[column]:
                fits &= (right - left) * self.signs[column] >= 0
            gain = np.where(fits, gain, -1.0)
            cut = int(gain.argmax())
            if gain[cut] > gain_of_best:
                best, gain_of_best = (column, cut, left[cut], right[cut]), gain[cut]
        return best


def fit(
    x: np.ndarray, y: np.ndarray, signs: np.ndarray, rounds: int = ROUNDS, depth: int = DEPTH
) -> Trees:
    """Logistic boosting of labels 0 and 1; without rows every score is one half."""
    if not len(x):
        none = np.empty(0, dtype=np.int64)
        return Trees(0.0, none, none, np.empty(0), none, none, np.empty(0))
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    cuts = [np.unique(np.quantile(column, quantiles, method="lower")) for column in x.T]
    cuts = [c[c < column.max()] for c, column in zip(cuts, x.T, strict=True)]
    binned = np.stack(
        [np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T, strict=True)], 1
    )
    share = np.clip(y.mean(), 0.01, 0.99)
    base = float(np.log(share / (1 - share)))
    total, roots, grower = np.full(len(x), base), [], _Grower(binned, cuts, signs)
    every = np.arange(len(x))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        root = grower.grow(every, p - y, p * (1 - p), depth, -np.inf, np.inf)
        for node in grower.nodes[root:]:
            node[4] *= RATE
        roots.append(root)
        total += _leaves(grower.nodes, root, binned, cuts)
    feature, threshold, left, right, value = zip(*grower.nodes, strict=True)
    return Trees(
        base,
        np.array(roots),
        np.array(feature),
        np.array(threshold, dtype=float),
        np.array(left),
        np.array(right),
        np.array(value, dtype=float),
    )


def _leaves(nodes: list[list], root: int, binned: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Value of the newest tree for every training row."""
    found = np.zeros(len(binned))
    waiting = [(root, np.arange(len(binned)))]
    while waiting:
        at, rows = waiting.pop()
        column, threshold, left, right, value = nodes[at]
        if column < 0:
            found[rows] = value
            continue
        cut = np.searchsorted(cuts[column], threshold)
        goes_left = binned[rows, column] <= cut
        waiting += [(left, rows[goes_left]), (right, rows[~goes_left])]
    return found
