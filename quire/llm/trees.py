"""Small decision-tree learners on numpy: boosted trees, random forests, isotonic calibration.

They are fitted on the driver on bounded samples. A tree is nested tuples
(feature, threshold, below, above), rows with x < threshold going below; a leaf is a number.
"""

from __future__ import annotations

import numpy as np

Tree = tuple | float


def cuts_of(x: np.ndarray, n: int = 48) -> list[np.ndarray]:
    """Candidate thresholds of each feature: mid-points between its quantiles."""
    out = []
    for column in x.T:
        q = np.unique(np.quantile(column, np.linspace(0, 1, n + 1)))
        out.append((q[1:] + q[:-1]) / 2)
    return out


def grow(binned: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray, depth: int, least: float, ridge: float, pick=None) -> Tree:
    """The tree whose leaves sum(g) / (sum(h) + ridge) gain most. ``pick`` gives a node's features."""

    def node(rows: np.ndarray, left: int) -> Tree:
        gs, hs = g[rows].sum(), h[rows].sum()
        leaf = float(gs / (hs + ridge)) if hs + ridge > 0 else 0.0
        if not left or hs < 2 * least:
            return leaf
        best = (1e-9, 0, 0)
        for f in range(len(cuts)) if pick is None else pick():
            if not len(cuts[f]):
                continue
            b, size = binned[rows, f], len(cuts[f]) + 1
            gb = np.bincount(b, g[rows], size).cumsum()[:-1]
            hb = np.bincount(b, h[rows], size).cumsum()[:-1]
            gain = gb**2 / (hb + ridge + 1e-12) + (gs - gb) ** 2 / (hs - hb + ridge + 1e-12) - gs**2 / (hs + ridge + 1e-12)
            gain[(hb < least) | (hs - hb < least)] = 0
            at = int(gain.argmax())
            if gain[at] > best[0] + 1e-12:
                best = (float(gain[at]), f, at)
        if best[0] <= 1e-9:
            return leaf
        _, f, at = best
        below = binned[rows, f] <= at
        return (f, float(cuts[f][at]), node(rows[below], left - 1), node(rows[~below], left - 1))

    return node(np.flatnonzero(h > 0), depth)


def bin_rows(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, column, side="right") for c, column in zip(cuts, x.T, strict=True)], 1)


def predict(tree: Tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, cut, below, above = tree
    out, low = np.empty(len(x)), x[:, f] < cut
    out[low], out[~low] = predict(below, x[low]), predict(above, x[~low])
    return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.15) -> tuple[float, list[Tree]]:
    """Logistic boosting: (start, trees); the log-odds are start + sum of the trees."""
    cuts = cuts_of(x)
    binned = bin_rows(x, cuts)
    p = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    start, trees = float(np.log(p / (1 - p))), []
    f = np.full(len(y), start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        tree = scale(grow(binned, cuts, y - p, p * (1 - p), depth, 1.0, 1.0), rate)
        trees.append(tree)
        f += predict(tree, x)
    return start, trees


def scale(tree: Tree, by: float) -> Tree:
    return (*tree[:2], scale(tree[2], by), scale(tree[3], by)) if isinstance(tree, tuple) else tree * by


def margin(model: tuple[float, list[Tree]], x: np.ndarray) -> np.ndarray:
    start, trees = model
    return start + sum((predict(t, x) for t in trees), np.zeros(len(x)))


def forest(x: np.ndarray, y: np.ndarray, n_trees: int = 24, depth: int = 8, tried: float = 0.5, seed: int = 7) -> list[Tree]:
    """Random forest of probability leaves: bootstrap rows, a share of the features tried at each node."""
    rng = np.random.default_rng(seed)
    cuts = cuts_of(x)
    binned = bin_rows(x, cuts)
    some = max(1, round(x.shape[1] * tried))
    out = []
    for _ in range(n_trees):
        w = np.bincount(rng.integers(0, len(y), len(y)), minlength=len(y)).astype(float)
        out.append(grow(binned, cuts, w * y, w, depth, 2.0, 0.0, lambda: rng.choice(x.shape[1], some, replace=False)))
    return out


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[list[float], list[float]]:
    """Pool-adjacent-violators: knots (score, probability), to be read by linear interpolation."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # mean, weight, sum of scores
    for s, v in zip(score[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([v, 1.0, s])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, s2 = blocks.pop()
            v1, w1, s1 = blocks[-1]
            blocks[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, s1 + s2]
    return [s / w for _, w, s in blocks], [v for v, _, _ in blocks]
