"""Gradient-boosted trees for a small, bounded training set: logistic loss, binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    """Trees of equal depth as flat arrays: node k has children 2k+1 and 2k+2."""

    start: float
    features: np.ndarray  # trees x inner nodes
    cuts: np.ndarray
    leaves: np.ndarray  # trees x leaves

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.start)
        inner, every = self.features.shape[1], np.arange(len(rows))
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            at = np.zeros(len(rows), np.int64)
            while len(at) and at[0] < inner:
                at = 2 * at + 1 + (rows[every, feature[at]] > cut[at])
            out += leaf[at - inner]
        return out


def fit(rows: np.ndarray, wanted: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.4, bins: int = 16, smooth: float = 1.0) -> Boosted:
    """Second-order boosting; splits at quantiles of the features, ties to the first feature and cut."""
    n, width = rows.shape
    edges = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(edges[j], rows[:, j], "left") for j in range(width)], axis=1)
    share = wanted.mean()
    score = np.full(n, np.log(share / (1 - share)))
    inner = 2**depth - 1
    made = Boosted(score[0], np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    cells, first_of = binned + np.arange(width) * bins, binned > 0
    for tree in range(trees):
        p = 1 / (1 + np.exp(-score))
        slope, bend = wanted - p, p * (1 - p)
        at = np.zeros(n, np.int64)
        for node in range(inner):
            here = np.flatnonzero(at == node)
            if len(here) >= 10:
                # Rows with the first bin of a feature, most of the flags, are what is left of the total.
                keep = first_of[here]
                flat, who = cells[here][keep], np.broadcast_to(here[:, None], keep.shape)[keep]
                g = np.bincount(flat, slope[who], width * bins).reshape(width, bins)
                h = np.bincount(flat, bend[who], width * bins).reshape(width, bins)
                g[:, 0], h[:, 0] = slope[here].sum() - g.sum(axis=1), bend[here].sum() - h.sum(axis=1)
                g, h = g.cumsum(axis=1), h.cumsum(axis=1)
                total_g, total_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + smooth) + (total_g - g) ** 2 / (total_h - h + smooth) - total_g**2 / (total_h + smooth)
                gain[:, -1] = 0
                best = int(gain.argmax())
                feature, cut = best // bins, best % bins
                if gain.flat[best] > 1e-6 and cut < len(edges[feature]):
                    made.features[tree, node], made.cuts[tree, node] = feature, edges[feature][cut]
            right = rows[here, made.features[tree, node]] > made.cuts[tree, node]
            at[here] = 2 * node + 1 + right
        leaf = at - inner
        g, h = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, bend, inner + 1)
        made.leaves[tree] = rate * g / (h + smooth)
        score = score + made.leaves[tree][leaf]
    return made
