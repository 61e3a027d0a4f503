"""Boosted trees whose rows fit in one task, grown as Spark ML grows them.

Spark's boosting runs a job for each level of each tree: a grid of 45 fits with 30 trees of up to 15 levels is some 12,000 jobs,
whose cost is starting them and moving histograms of nodes of a few rows. Here a task does a whole fit. Thresholds (of
all rows), gains, the order of nodes and the drawing of features are Spark's (``RandomForest``, ``GradientBoostedTrees``), so that
a fit gives the same trees but where splits are equally good up to rounding.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BINS = 32          # Spark's maxBins
RATE = 0.1         # Spark's stepSize
#: Rows times features of a fit that one task may hold: 128 MB as numbers.
MOST_CELLS = 2 ** 24
#: Nodes whose sums are held at a time.
_NODES = 1024
_EPSILON = 2.0 ** -52
_MASK = (1 << 64) - 1


def subset_size(strategy: str, n: int) -> int:
    """Features that are drawn for a node."""
    return {"all": n, "sqrt": math.ceil(math.sqrt(n)), "log2": max(1, math.ceil(math.log(n) / math.log(2)))}[strategy]


class JavaRandom:
    """``nextLong`` of java.util.Random."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def _next(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        out = self.state >> 16
        return out - (1 << 32) if out >= 1 << 31 else out

    def next_long(self) -> int:
        return ((self._next() << 32) + self._next()) & _MASK


def _murmur(words: Sequence[np.ndarray], start: np.ndarray) -> np.ndarray:
    """scala.util.hashing.MurmurHash3.bytesHash of eight bytes each, as two little-endian words."""
    h = start.astype(np.uint32)
    rot = lambda x, r: (x << np.uint32(r)) | (x >> np.uint32(32 - r))
    for k in words:
        k = rot(k * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
        h = rot(h ^ k, 13) * np.uint32(5) + np.uint32(0xE6546B64)
    h = h ^ np.uint32(8)
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return h ^ (h >> np.uint32(16))


def reservoirs(seeds: Sequence[int], n: int, k: int) -> np.ndarray:
    """``k`` of 0..n-1 for each seed, as Spark's SamplingUtils draws them."""
    seed = np.array(seeds, np.uint64)
    words = [(seed >> np.uint64(32)).astype(np.uint32).byteswap(), seed.astype(np.uint32).byteswap()]
    low = _murmur(words, np.full(len(seed), 0x3C074A61, np.uint32))
    state = (_murmur(words, low).astype(np.uint64) << np.uint64(32)) | low.astype(np.uint64)

    def draw(bits):
        nonlocal state
        state = state ^ (state << np.uint64(21))
        state = state ^ (state >> np.uint64(35))
        state = state ^ (state << np.uint64(4))
        return state & np.uint64((1 << bits) - 1)

    out = np.tile(np.arange(k), (len(seed), 1))
    for i in range(k, n):
        unit = ((draw(26) << np.uint64(27)) + draw(27)).astype(float) * 2.0 ** -53
        at = (unit * (i + 1)).astype(np.int64)
        hit = np.flatnonzero(at < k)
        out[hit, at[hit]] = i
    return out


def thresholds(values: np.ndarray) -> np.ndarray:
    """Split points of one feature over all of its values, at most ``BINS`` - 1."""
    value, count = np.unique(values.astype(float), return_counts=True)
    most = min(BINS, len(values)) - 1
    middle = (value[:-1] + value[1:]) / 2
    if len(middle) <= most:
        return middle
    # a value ends a bin if the count up to it is nearer to a multiple of the stride than that of the next one
    done = np.cumsum(count)
    twice, stride = done[:-1] + done[1:], len(values) / (most + 1)
    target, at, out = stride, 0, []
    while (at := max(at, int(np.searchsorted(twice, 2 * target, side="right")))) < len(middle):
        out.append(middle[at])
        at, target = at + 1, target + stride
    return np.array(out)


def _impurity(n, total, squares):
    some = np.maximum(n, 1)
    return (squares - total * total / some) / some


def _best_splits(bins: np.ndarray, y: np.ndarray, node: np.ndarray, rows: np.ndarray, n_nodes: int, features: np.ndarray | None):
    """(feature, split) for each node, -1 without one. ``node``, in ascending order, and ``y`` are the nodes and the targets of
    ``rows``. The variance that is left is least where the sum of total^2 / count over both sides is largest."""
    k = bins.shape[0] if features is None else features.shape[1]
    most, feature, split = np.full(n_nodes, -np.inf), np.full(n_nodes, -1), np.zeros(n_nodes, np.int64)
    # some nodes at a time: their sums stay in the cache
    for start in range(0, n_nodes, _NODES):
        few = np.arange(start, min(n_nodes, start + _NODES))
        lo, hi = np.searchsorted(node, [start, start + _NODES])
        mine, here, w = rows[lo:hi], node[lo:hi] - start, y[lo:hi]
        base, size = here * BINS, len(few) * BINS
        for j in range(k):
            own = None if features is None else features[few, j]
            key = base + (bins[j, mine] if own is None else bins[own[here], mine])
            n = np.bincount(key, None, size)
            # a split behind an empty bin is the one before
            cell = np.flatnonzero(n)
            of = cell // BINS
            n_to, sum_to = (np.cumsum(h.reshape(-1, BINS), axis=1) for h in (n, np.bincount(key, w, size)))
            n_left, sum_left = n_to.ravel()[cell], sum_to.ravel()[cell]
            n_right, sum_right = n_to[:, -1][of] - n_left, sum_to[:, -1][of] - sum_left
            # nothing is behind the last bin
            score = np.where(n_right > 0, sum_left * sum_left / n_left + sum_right * sum_right / np.maximum(n_right, 1), -np.inf)
            first = np.flatnonzero(np.diff(of, prepend=-1))
            best = np.maximum.reduceat(score, first)
            better = best > most[few]
            if not better.any():
                continue
            at = np.flatnonzero((score == best[of]) & better[of])
            at = at[np.flatnonzero(np.diff(of[at], prepend=-1))]  # the first of equals
            to = few[of[at]]
            most[to], feature[to], split[to] = score[at], j if own is None else own[of[at]], cell[at] % BINS
    return feature, split


def grow(bins: np.ndarray, target: np.ndarray, depth: int, subset: int, seed: int):
    """A regression tree on binned rows (features x rows): (feature, split, left child or -1, prediction) of its nodes, and the
    node in which each row ends."""
    n_features, n = bins.shape
    rng = JavaRandom(seed)
    feature, split, child, value = [0], [0], [-1], [float(target.sum() / n)]
    at, nodes = np.zeros(n, np.int64), [0]  # nodes in the order in which Spark takes them
    impurity, squares = _impurity(np.array([n]), target.sum(keepdims=True), (target * target).sum(keepdims=True)), target * target
    for level in range(depth):
        place = np.full(len(child), -1)
        place[nodes] = np.arange(len(nodes))
        rows = np.flatnonzero(place[at] >= 0)
        rows = rows[np.argsort(place[at[rows]], kind="stable")]
        of, y = place[at[rows]], target[rows]
        drawn = None if subset == n_features else reservoirs([rng.next_long() for _ in nodes], n_features, subset)
        best, cut = _best_splits(bins, y, of, rows, len(nodes), drawn)
        own = bins[best[of], rows]
        # left sums by bins and right ones as what is left, as in Spark: whether a node counts as pure hangs on the last bits
        upto = [np.cumsum(np.bincount(of * BINS + own, w, len(nodes) * BINS).reshape(-1, BINS), axis=1) for w in (None, y, squares[rows])]
        below = [u[np.arange(len(nodes)), cut] for u in upto]
        count, total, square = (np.column_stack([b, u[:, -1] - b]).ravel() for b, u in zip(below, upto))
        left = _impurity(count, total, square)
        parts = count / np.repeat(np.maximum(count[::2] + count[1::2], 1), 2)
        gain = impurity - (parts * left)[::2] - (parts * left)[1::2]
        ok, new, following = (best >= 0) & (gain > 0), np.full(len(nodes), -1), []
        for i in np.flatnonzero(ok).tolist():
            feature[nodes[i]], split[nodes[i]], child[nodes[i]], new[i] = best[i], cut[i], len(child), len(child)
            for s in (2 * i, 2 * i + 1):
                if level + 1 < depth and not abs(left[s]) < _EPSILON:
                    following.append((len(child), left[s]))
                feature.append(0)
                split.append(0)
                child.append(-1)
                value.append(total[s] / count[s])
        some = ok[of]
        at[rows[some]] = new[of[some]] + (own > cut[of])[some]
        if not following:
            break
        nodes, impurity = [x for x, _ in following[::-1]], np.array([x for _, x in following[::-1]])
    return (np.array(feature), np.array(split), np.array(child), np.array(value)), at


def leaves(tree, bins: np.ndarray) -> np.ndarray:
    """The predictions of a tree for binned rows."""
    feature, split, child, value = tree
    at, rows = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
    while True:
        rows = rows[child[at[rows]] >= 0]
        if not len(rows):
            return value[at]
        own = at[rows]
        at[rows] = child[own] + (bins[feature[own], rows] > split[own])


def binned(blocks: Sequence[np.ndarray], train: np.ndarray) -> np.ndarray:
    """Bins (features x rows): each feature of ``blocks`` by the thresholds of its training rows."""
    n = blocks[0].shape[1] - 2
    bins = np.empty((n, len(train)), np.uint8)
    for j in range(n):
        column = np.concatenate([b[:, j + 2] for b in blocks])
        bins[j] = np.searchsorted(thresholds(column[train]), column)
    return bins


def held_hits(blocks: Sequence[np.ndarray], fold: int, depth: int, marks: Sequence[int], subset: str, seed: int) -> tuple[int, list[int]]:
    """(held rows, those whose class is met after each of ``marks`` iterations) of boosting on the rows that aren't in ``fold``.
    ``blocks`` are rows of (fold, label, features...)."""
    label, train = np.concatenate([b[:, 1] for b in blocks]), np.concatenate([b[:, 0] for b in blocks]) != fold
    if not train.any():
        raise ValueError("no training rows")
    bins = binned(blocks, train)
    held, bins = bins[:, ~train], bins[:, train]
    y, truth = 2 * label[train] - 1, label[~train]
    size = subset_size(subset, len(bins))
    margin, own, out = np.zeros(len(truth)), np.zeros(len(y)), {}
    for m in range(marks[-1]):
        target = 4 * y / (1 + np.exp(2 * y * own)) if m else y
        tree, at = grow(bins, target, depth, size, seed + m)
        rate = RATE if m else 1.0
        own = own + rate * tree[3][at]
        margin = margin + rate * leaves(tree, held)
        if m + 1 in marks:
            out[m + 1] = int(((margin > 0) == (truth > 0)).sum())
    return len(truth), [out[m] for m in marks]


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, rows, block) of batches of (fold, label, features): a block holds numbers, rows after each other."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    for i, batch in enumerate(b for b in batches if b.num_rows):
        fold, label, features = batch.columns
        if label.null_count or features.null_count or not set(label.unique().to_pylist()) <= {0, 1}:
            raise ValueError("labels must be 0 or 1, and features there")
        values = features.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        if not np.isfinite(values).all():
            raise ValueError("features must be finite")
        block = np.column_stack([fold.to_numpy(), label.to_numpy(), values])
        yield pa.RecordBatch.from_arrays([pa.array([(part << 32) + i]), pa.array([batch.num_rows]), pa.array([block.tobytes()], pa.binary())],
                                         ["place", "n", "block"])


def grid_hits(rows: DataFrame, jobs: Sequence[tuple[int, int, str]], marks: Sequence[int], seed: int) -> dict[tuple[int, int, str], tuple[int, list[int]]]:
    """``held_hits`` of each (fold, depth, subset strategy): a task for each, which all blocks of ``rows`` (fold, label, features)
    are sent to. The deepest come first."""
    order = sorted(jobs, key=lambda j: (-j[1], j[2] != "all"))
    sent = rows.mapInArrow(pack, "place long, n long, block binary").rdd.flatMap(
        lambda r: [(j, (r.place, r.n, bytes(r.block))) for j in range(len(order))]).partitionBy(len(order), int)

    def run(pairs):
        own: dict[int, list] = {}
        for j, block in pairs:
            own.setdefault(j, []).append(block)
        for j in list(own):
            blocks = [np.frombuffer(b).reshape(n, -1) for _, n, b in sorted(own.pop(j), key=lambda b: b[0])]
            fold, depth, subset = order[j]
            yield order[j], held_hits(blocks, fold, depth, marks, subset, seed)

    return dict(sent.mapPartitions(run).collect())  # one row for each fit
