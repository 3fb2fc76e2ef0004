"""Gradient-boosted decision trees for two classes (numpy): histogram splits, logistic loss."""

from __future__ import annotations

import numpy as np

BINS = 32


class Boosted:
    """Trees as arrays: feature (-1 in a leaf), threshold, left child (the right one follows), value."""

    def __init__(self, base: float, trees: list[tuple[np.ndarray, ...]]):
        self.base, self.trees = base, trees

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, left, value in self.trees:
            at = np.zeros(len(x), np.int32)
            for _ in range(len(feature)):
                split = feature[at]
                inner = split >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(split, 0)] > threshold[at]
                at = np.where(inner, left[at] + right, at)
            out += value[at]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.25, smooth: float = 2.0,
        least: int = 8) -> Boosted:
    """``y`` is 0 or 1.  Deterministic: no sampling of rows or features."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    width = x.shape[1]
    columns = np.ascontiguousarray(binned.T.astype(np.uint8))
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    logit, grown = np.full(len(y), base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-logit))
        gradient, weight = y - p, p * (1 - p)
        feature, threshold, left, value = [-1], [0.0], [0], [0.0]
        open_nodes, step = [(0, np.arange(len(y)), 0)], np.zeros(len(y))
        while open_nodes:
            node, rows, level = open_nodes.pop()
            g, h = gradient[rows], weight[rows]
            total, mass = g.sum(), h.sum()
            value[node] = rate * total / (mass + smooth)
            step[rows] = value[node]
            if level == depth or len(rows) < 2 * least:
                continue
            cells = columns if len(rows) == len(y) else columns[:, rows]
            sums = np.array([[np.bincount(c, w, BINS) for c in cells] for w in (g, h, np.ones(len(rows)))])
            sums = sums.cumsum(axis=2)[:, :, :-1]
            gain = (sums[0] ** 2 / (sums[1] + smooth) + (total - sums[0]) ** 2 / (mass - sums[1] + smooth)
                    - total ** 2 / (mass + smooth))
            gain[(sums[2] < least) | (len(rows) - sums[2] < least)] = 0
            best = int(gain.argmax())
            f, b = divmod(best, BINS - 1)
            if gain[f, b] <= 1e-6 or b >= len(edges[f]):
                continue
            feature[node], threshold[node], left[node] = f, float(edges[f][b]), len(feature)
            over = binned[rows, f] > b
            for part in (rows[~over], rows[over]):
                open_nodes.append((len(feature), part, level + 1))
                feature.append(-1), threshold.append(0.0), left.append(0), value.append(0.0)
        logit += step
        grown.append((np.array(feature, np.int32), np.array(threshold), np.array(left, np.int32), np.array(value)))
    return Boosted(base, grown)
