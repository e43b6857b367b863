"""Random forests of the search: one task a fit, over all rows of a fold.

Spark's forest sends the histograms of every open node of every level through a shuffle and keeps all trees on the driver. Folds
that a task can hold are scored here; Spark's forest fits larger folds and the chosen setting. As there, a tree sees Poisson counts
of the rows, a node a random part of the inputs in at most BINS bins, a split lowers the weighted Gini impurity.
"""

from __future__ import annotations

import math

import numpy as np

from campaignry.operators.boosting import cut_points

BINS = 32
TREES = 25  # trees grown side by side,
SIDE_BY_SIDE = 60_000  # as long as they do not see more rows than these
KINDS = 8  # different labels and weights of rows up to which nodes are searched by sorting


def inputs_of_a_node(share, width: int) -> int:
    """How many inputs a node looks at, by the names of Spark's featureSubsetStrategy."""
    asked = {"sqrt": math.sqrt(width), "log2": math.log2(width)}.get(share)
    return min(width, max(1, math.ceil(share * width if asked is None else asked)))


def drawn_inputs(rng, many: int, width: int, used: int) -> np.ndarray:
    """Different inputs of each node: the first steps of a shuffle, all nodes side by side."""
    cols, node = np.tile(np.arange(width), (many, 1)), np.arange(many)
    for i in range(used if used < width else 0):
        j = rng.integers(i, width, many)
        swapped = cols[node, j]
        cols[node, j] = cols[:, i]
        cols[:, i] = swapped
    return cols[:, :used]


def _best(n, a, p, cols, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best split of each node from the rows, weights and positive weights of its bins."""
    many = len(cols)
    (nl, al, pl), (n, a, p) = [np.cumsum(v, axis=2) for v in (n, a, p)], [v.sum(axis=2, keepdims=True) for v in (n, a, p)]
    square = lambda w, pos: (pos ** 2 + (w - pos) ** 2) / np.maximum(w, 1e-300)
    gains = square(al, pl) + square(a - al, p - pl) - square(a, p)
    gains[(nl < least) | (n - nl < least) | (gains < 1e-9 * a)] = 0.0
    flat = gains.reshape(many, -1)
    best = flat.argmax(axis=1)
    return flat[np.arange(many), best], cols[np.arange(many), best // BINS], best % BINS


def best_splits(codes, node, cnt, cw, cpos, many: int, cols, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gain, column and last bin on the left of each node's best split; a gain of 0 where there is none."""
    used = cols.shape[1]
    key = ((node[:, None] * used + np.arange(used)) * BINS + codes).ravel()
    return _best(*[np.bincount(key, np.repeat(v, used), many * used * BINS).reshape(many, used, BINS) for v in (cnt, cw, cpos)], cols, least)


def counted_splits(codes, node, cnt, kind, kinds, many: int, cols, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``best_splits`` finds, from one count of the rows' pairs of label and weight, numbered by ``kind``, by bin."""
    used, labels, weights = cols.shape[1], *kinds
    start = (kind * many + node) * (used * BINS)
    key = start[:, None] + (np.arange(used) * BINS + codes)
    counts = np.bincount(key.ravel(), np.repeat(cnt, used), len(labels) * many * used * BINS).reshape(len(labels), many, used, BINS)
    return _best(*[np.tensordot(v, counts, 1) for v in (np.ones(len(labels)), weights, weights * labels)], cols, least)


def _bits(most: int) -> int:
    return max(1, int(most).bit_length())


def sorted_splits(codes, node, cnt, kind, kinds, many: int, cols, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``best_splits`` finds, without a histogram of every bin: a level of many small nodes costs no more than its rows.

    ``kind`` numbers the rows' pairs of label and weight, which ``kinds`` gives as arrays. All that is added up are whole counts.
    """
    used, labels, weights = cols.shape[1], *kinds
    cbits, kbits = _bits(cnt.max()), _bits(len(labels) - 1)
    low = (kind << cbits) | cnt
    place = (node * used)[:, None] + np.arange(used)
    key = (((place * BINS + codes) << (cbits + kbits)) | low[:, None]).ravel()
    key.sort()
    cell = key >> (cbits + kbits)
    count, which = key & ((1 << cbits) - 1), (key >> cbits) & ((1 << kbits) - 1)
    # The last row of a bin that is not the last bin of its node and input.
    run = cell // BINS
    ends = np.flatnonzero((cell[1:] != cell[:-1]) & (run[1:] == run[:-1]))
    run, at = run[ends], cell[ends] % BINS
    mine, slot = run // used, run % used
    nl = al = pl = n = a = p = 0.0
    for k, (label, weight) in enumerate(zip(labels, weights)):
        here = kind == k
        whole = np.bincount(node[here], cnt[here], many).astype(np.int64)
        before = (np.cumsum(whole) - whole) * used
        c = np.cumsum(np.where(which == k, count, 0))[ends] - before[mine] - slot * whole[mine]
        nl, al, pl = nl + c, al + weight * c, pl + weight * label * c
        n, a, p = n + whole, a + weight * whole, p + weight * label * whole
    best, cut, gain = np.zeros(many, dtype=np.int64), np.zeros(many, dtype=np.int64), np.zeros(many)
    if len(ends):
        square = lambda w, pos: (pos ** 2 + (w - pos) ** 2) / np.maximum(w, 1e-300)
        gains = square(al, pl) + square(a[mine] - al, p[mine] - pl) - square(a, p)[mine]
        gains[(nl < least) | (n[mine] - nl < least) | (gains < 1e-9 * a[mine])] = 0.0
        first = np.flatnonzero(np.diff(mine, prepend=-1))
        gain[mine[first]] = np.maximum.reduceat(gains, first)
        top = np.flatnonzero(gains == gain[mine])[::-1]  # the first of equal ones is written last
        best[mine[top]], cut[mine[top]] = slot[top], at[top]
    return gain, cols[np.arange(many), best], cut


def forest_scores(setting: dict, x: np.ndarray, y: np.ndarray, w: np.ndarray, held: np.ndarray, depth_limit: int = 30, seed: int = 42) -> np.ndarray:
    """Mean chance of each held row over all trees; the held rows go down each tree beside the rows it is grown from."""
    n, m = len(y), len(held)
    if not n or not m:
        return np.full(m, 0.5)
    width, depth, least = x.shape[1], setting["max_depth"] or depth_limit, setting["min_samples_leaf"]
    used, rng, cuts = inputs_of_a_node(setting["max_features"], width), np.random.default_rng(seed), cut_points(x, BINS)
    codes, held_codes = [np.stack([np.searchsorted(c, col, side="left").astype(np.uint8) for c, col in zip(cuts, v.T)], axis=1) for v in (x, held)]
    flat = codes.reshape(-1)
    pairs, kind = np.unique(w + 1j * y, return_inverse=True)
    kinds = pairs.imag, pairs.real
    together, out = max(1, min(TREES, SIDE_BY_SIDE // n)), np.zeros(m)
    for first in range(0, setting["n_estimators"], together):
        trees = min(together, setting["n_estimators"] - first)
        drawn = rng.poisson(1.0, (trees, n))
        node, row = np.nonzero(drawn)
        cnt = drawn[node, row]
        held_node, held_row, many = np.repeat(np.arange(trees), m), np.tile(np.arange(m), trees), trees
        for level in range(depth + 1):
            cw = cnt * w[row]
            cpos = cw * y[row]
            num, total, pos = [np.bincount(node, v, many) for v in (cnt, cw, cpos)]
            chance = np.where(total > 0, pos / np.maximum(total, 1e-300), 0.5)
            is_open = (num >= 2 * least) & (pos > 0) & (pos < total) & (level < depth)
            split, feature, at = np.zeros(many, dtype=bool), np.zeros(many, dtype=np.int64), np.zeros(many, dtype=np.int64)
            if is_open.any():
                opened = np.flatnonzero(is_open)
                cols = drawn_inputs(rng, len(opened), width, used)
                mine = is_open[node]
                local = (np.cumsum(is_open) - 1)[node[mine]]
                rows = row[mine]
                seen = flat.take(rows[:, None] * width + cols[local])
                if len(pairs) > KINDS:
                    gain, feature[opened], at[opened] = best_splits(seen, local, cnt[mine], cw[mine], cpos[mine], len(opened), cols, least)
                else:
                    found = sorted_splits if len(opened) * BINS * 4 > len(local) else counted_splits
                    gain, feature[opened], at[opened] = found(seen, local, cnt[mine], kind[rows], kinds, len(opened), cols, least)
                split[opened] = gain > 0
            ends = ~split[held_node]
            out += np.bincount(held_row[ends], chance[held_node[ends]], m)
            if not split.any():
                break
            child = 2 * (np.cumsum(split) - 1)
            stays, goes = split[node], ~ends
            node, row, cnt = node[stays], row[stays], cnt[stays]
            held_node, held_row = held_node[goes], held_row[goes]
            node = child[node] + (codes[row, feature[node]] > at[node])
            held_node = child[held_node] + (held_codes[held_row, feature[held_node]] > at[held_node])
            many = 2 * int(split.sum())
    return out / setting["n_estimators"]
