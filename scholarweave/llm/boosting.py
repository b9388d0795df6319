"""Small boosted trees on binned features.

``grow`` takes its rows in memory; ``grow_from`` asks for sums by bin only, so its rows may lie in blocks
all over the cluster.
"""

from __future__ import annotations

import operator

import numpy as np
from pyspark import StorageLevel

RIDGE = 1.0


def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Inner edges of at most ``bins`` quantile bins of each column; bin(v) = searchsorted(edges, v, 'right')."""
    out = []
    for col in x.T:
        q = np.unique(np.quantile(col, np.linspace(0, 1, bins + 1)[1:-1])) if len(col) else np.zeros(0)
        out.append(q[q > col.min()] if len(q) else q)
    return out


def weighted_edges(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """As ``bin_edges`` of one column, from its distinct values and their weights; quantiles are values that occur."""
    order = np.argsort(values, kind="stable")
    share = np.cumsum(weights[order]) / weights.sum()
    at = np.searchsorted(share, np.linspace(0, 1, bins + 1)[1:-1] - 1e-12)
    q = np.unique(values[order][np.minimum(at, len(order) - 1)])
    return q[q > values.min()]


def to_bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)], axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def _best_split(bins, grad, hess, rows, columns):
    """(gain, column, bin): rows with a bin below go left."""
    best = (1e-9, -1, -1)
    g, h = grad[rows], hess[rows]
    whole = g.sum() ** 2 / (h.sum() + RIDGE)
    for f in columns:
        b = bins[rows, f]
        gs, hs = np.cumsum(np.bincount(b, g)), np.cumsum(np.bincount(b, h))
        if len(gs) < 2:
            continue
        left = gs[:-1] ** 2 / (hs[:-1] + RIDGE)
        right = (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + RIDGE)
        gain = left + right - whole
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (float(gain[k]), f, k + 1)
    return best


def grow(bins: np.ndarray, grad: np.ndarray, hess: np.ndarray, columns, leaves: int) -> list:
    """A tree of at most ``leaves`` leaves, best gain first.

    Nodes are [column, bin, left, right, value]; column -1 marks a leaf.
    """
    def value(rows):
        return float(grad[rows].sum() / (hess[rows].sum() + RIDGE))

    every = np.arange(len(grad))
    nodes = [[-1, 0, 0, 0, value(every)]]
    open_ = [(*_best_split(bins, grad, hess, every, columns), 0, every)]
    while open_ and sum(n[0] < 0 for n in nodes) < leaves:
        open_.sort(key=lambda s: s[0])
        _, f, at, node, rows = open_.pop()
        if f < 0:
            break
        below = bins[rows, f] < at
        nodes[node][:4] = [f, at, len(nodes), len(nodes) + 1]
        for part in (rows[below], rows[~below]):
            nodes.append([-1, 0, 0, 0, value(part)])
            open_.append((*_best_split(bins, grad, hess, part, columns), len(nodes) - 1, part))
    return nodes


def node_sums(bins: np.ndarray, at: np.ndarray, grad: np.ndarray, hess: np.ndarray, nodes, width: int) -> np.ndarray:
    """(nodes, columns, width, 2): grad and hess by bin of each column, summed over the rows ``at`` each node."""
    out = np.zeros((len(nodes), bins.shape[1], width, 2))
    for i, node in enumerate(nodes):
        rows = np.flatnonzero(at == node)
        g, h = grad[rows], hess[rows]
        for f in range(bins.shape[1]):
            b = bins[rows, f]
            out[i, f, :, 0] = np.bincount(b, g, width)
            out[i, f, :, 1] = np.bincount(b, h, width)
    return out


def _split_from(sums: np.ndarray):
    """(gain, column, bin, value below, value from it on) of the best split of a node with these sums."""
    g, h = sums[..., 0].cumsum(axis=1), sums[..., 1].cumsum(axis=1)
    whole = g[0, -1] ** 2 / (h[0, -1] + RIDGE)
    gr, hr = g[:, -1:] - g[:, :-1], h[:, -1:] - h[:, :-1]
    gain = g[:, :-1] ** 2 / (h[:, :-1] + RIDGE) + gr ** 2 / (hr + RIDGE) - whole
    f, k = np.unravel_index(np.argmax(gain), gain.shape)
    if gain[f, k] <= 1e-9:
        return 1e-9, -1, -1, 0.0, 0.0
    return (float(gain[f, k]), int(f), int(k) + 1,
            float(g[f, k] / (h[f, k] + RIDGE)), float(gr[f, k] / (hr[f, k] + RIDGE)))


def grow_from(sums, leaves: int) -> list:
    """The tree of ``grow``, where ``sums(tree, nodes)`` gives ``node_sums`` of all rows at some leaves of ``tree``."""
    first = sums([[-1, 0, 0, 0, 0.0]], [0])[0]
    g, h = first[0].sum(axis=0)
    nodes = [[-1, 0, 0, 0, float(g / (h + RIDGE))]]
    open_ = [(*_split_from(first), 0)]
    for left in range(leaves - 1, 0, -1):
        open_.sort(key=lambda s: s[0])
        _, f, at, below, above, node = open_.pop() if open_ else (0, -1, -1, 0, 0, 0)
        if f < 0:
            break
        new = [len(nodes), len(nodes) + 1]
        nodes[node][:4] = [f, at, *new]
        nodes += [[-1, 0, 0, 0, below], [-1, 0, 0, 0, above]]
        if left > 1:
            open_ += [(*_split_from(s), k) for s, k in zip(sums(nodes, new), new, strict=True)]
    return nodes


def total(blocks, of):
    """The sum of ``of(block)`` over a list or an RDD of blocks."""
    return sum(map(of, blocks)) if isinstance(blocks, list) else blocks.map(of).treeReduce(operator.add)


def renewed(blocks, by):
    """``by(block)`` of a list or an RDD of blocks; an RDD is kept in its executors and the former one given up."""
    if isinstance(blocks, list):
        return [by(b) for b in blocks]
    new = blocks.map(by).persist(StorageLevel.MEMORY_AND_DISK)
    new.count()
    blocks.unpersist()
    return new


def leaf_of(tree: list, bins: np.ndarray) -> np.ndarray:
    """The leaf (index of its node) of each row."""
    at = np.zeros(len(bins), dtype=np.int64)
    t = np.array(tree)
    column, split, left, right = (t[:, i].astype(np.int64) for i in range(4))
    while (inner := column[at] >= 0).any():
        rows = np.flatnonzero(inner)
        node = at[rows]
        below = bins[rows, column[node]] < split[node]
        at[rows] = np.where(below, left[node], right[node])
    return at


def evaluate(tree: list, bins: np.ndarray) -> np.ndarray:
    """The leaf value of each row."""
    return np.array(tree)[leaf_of(tree, bins), 4]
