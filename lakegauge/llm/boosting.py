"""Gradient-boosted trees for two classes on a bounded sample, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 32


@dataclass
class Tree:
    """Nodes by number: feature (-1 at a leaf), threshold, children, value."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    below: list[int] = field(default_factory=list)
    above: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for column, item in (
            (self.feature, -1), (self.threshold, 0.0),
            (self.below, 0), (self.above, 0), (self.value, value),
        ):
            column.append(item)
        return len(self.value) - 1

    def predict(self, rows: np.ndarray) -> np.ndarray:
        made = np.empty(len(rows))
        pending = [(0, np.arange(len(rows)))]
        while pending:
            node, own = pending.pop()
            if self.feature[node] < 0:
                made[own] = self.value[node]
                continue
            low = rows[own, self.feature[node]] <= self.threshold[node]
            pending.append((self.below[node], own[low]))
            pending.append((self.above[node], own[~low]))
        return made


@dataclass
class Booster:
    base: float
    rate: float
    trees: list[Tree]

    def probability(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        for tree in self.trees:
            total += self.rate * tree.predict(rows)
        return 1 / (1 + np.exp(-total))


def _gain(gradient: np.ndarray, weight: np.ndarray, penalty: float = 1.0):
    return gradient * gradient / (weight + penalty)


def _grow(tree, rows, cuts, gradient, weight, own, depth) -> int:
    total_g, total_w = gradient[own].sum(), weight[own].sum()
    node = tree.add(float(total_g / (total_w + 1.0)))
    if depth == 0 or len(own) < 20:
        return node
    best = (1e-6, -1, 0.0)
    for feature, edges in enumerate(cuts):
        if not len(edges):
            continue
        bins = np.searchsorted(edges, rows[own, feature], side="left")
        g = np.cumsum(np.bincount(bins, gradient[own], len(edges) + 1))[:-1]
        w = np.cumsum(np.bincount(bins, weight[own], len(edges) + 1))[:-1]
        gains = _gain(g, w) + _gain(total_g - g, total_w - w) - _gain(total_g, total_w)
        at = int(np.argmax(gains))
        if gains[at] > best[0]:
            best = (float(gains[at]), feature, float(edges[at]))
    if best[1] < 0:
        return node
    low = rows[own, best[1]] <= best[2]
    if low.all() or not low.any():
        return node
    tree.feature[node], tree.threshold[node] = best[1], best[2]
    for side, part in ((tree.below, own[low]), (tree.above, own[~low])):
        child = _grow(tree, rows, cuts, gradient, weight, part, depth - 1)
        side[node] = child
    return node


def boost(
    rows: np.ndarray, labels: np.ndarray, trees: int = 40, depth: int = 4,
    rate: float = 0.3,
) -> Booster:
    """Trees by Newton steps on the logistic loss, over quantile bins."""
    share = np.clip(labels.mean(), 0.01, 0.99)
    model = Booster(float(np.log(share / (1 - share))), rate, [])
    points = np.linspace(0, 1, BINS + 1)[1:-1]
    cuts = []
    for column in rows.T:
        values = np.unique(column)
        few = (values[:-1] + values[1:]) / 2
        cuts.append(few if len(few) < BINS else np.unique(np.quantile(column, points)))
    total = np.full(len(rows), model.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        tree = Tree()
        _grow(tree, rows, cuts, labels - p, p * (1 - p), np.arange(len(rows)), depth)
        model.trees.append(tree)
        total += rate * tree.predict(rows)
    return model
