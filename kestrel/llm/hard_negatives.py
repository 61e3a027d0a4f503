"""Hard-negative mining over a GNAT-style tree: exact windows of inner products.

Vectors become integers, floor(256 * x). A row's score for an anchor is their inner product. An anchor's positives are its
best rows of the same label; the negatives of a positive are the best rows of other labels whose score lies in the window
from 80 % of the positive's score to that score.

The index is a tree of split points (Brin 1995), fitted on a bounded sample (``SAMPLE`` rows, the first ones in the order
of a hash of vec_id): a node has up to ``WAYS`` split points, a row goes to the nearest one (the hyperplanes between them), and the
node stores, for each split point and each sibling subtree, the range of the distances between that point and *all* rows of
the subtree. As |a - x|^2 = |a|^2 + |x|^2 - 2 a.x, a window of scores is an annulus of distances around the anchor. A
sibling is eliminated for an anchor if, by the triangle inequality over some split point's range, none of its rows can lie
in the annulus; what is left are leaves, whose rows are scored exactly. The tree has at most ``WAYS`` ** ``LEVELS`` leaves
whatever the input; a leaf of many rows lies in many tasks.

Every row is indexed and every anchor is a query, taken in blocks of ``BLOCK`` that are broadcast; a task meets its rows,
sorted by leaf, with the anchors that are left for the leaf, and gives at most ``K`` rows for an anchor and window. The
sample's own scores are lower bounds to begin with, so tasks hand on little more than the result.

Rows with a null label, a null vector, a null or non-finite component, or without vec_id take no part; an empty vector
scores 0 with all; of vectors of different lengths the shorter one is filled up with zeros. Repeated rows are
rows of their own, but never partners of an anchor with the same vec_id; of several anchors with one vec_id the one with
the least (label, vector) is taken. Ties go to the smaller vec_id. Fewer rows than ``K`` give all; an anchor without
positives, and a positive without negatives, give no rows; an empty table gives an empty result. Scores beyond the range
of a long are taken as its ends. Extra columns are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.batches import lean, small_batches, struct
from kestrel.llm.tables import keep

K = 5
SAMPLE = 4096
WAYS = 16
LEVELS = 2
#: Least rows of the sample in a node that is split again.
SPLIT = 64
BLOCK = 1 << 14
_LOW, _HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max
#: What rounding may take from a distance; ranges and annuli are widened by it.
_SLACK = 1e-6


def integer_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, v array<double>) of the rows that take part; components are whole numbers."""
    x = F.col(vector)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()).where(~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.transform(x, lambda c: _whole(256 * c.cast("double"))).alias("v"))


def _whole(x: Column) -> Column:
    """floor as a double; beyond 2^53 every double is whole, beyond 2^100 it is taken as that."""
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(F.greatest(F.least(x, F.lit(2.0**100)), F.lit(-(2.0**100))))


def _matrix(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers as int64, through floats where these are exact."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if most < 2**24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if most < 2**53:
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    return np.clip(whole(a) @ whole(b).T, _LOW, _HIGH).astype(np.int64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances between rows; from sums of squares of differences where the products aren't exact."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)))
    if max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) ** 2 * max(1, a.shape[1]) < 2**51:
        return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0))
    return np.stack([np.sqrt(((a - x) ** 2).sum(1)) for x in b], axis=1)


@dataclass
class Node:
    points: np.ndarray  # split points
    children: list  # of each split point: a Node or the number of a leaf
    leaves: list  # of each split point: the numbers of the leaves below it
    number: int


def _spread(sample: np.ndarray, ways: int) -> np.ndarray:
    """Split points far from each other: each next one is the row farthest from those before."""
    at = [0]
    away = distances(sample, sample[:1])[:, 0]
    while len(at) < ways and away.max() > 0:
        at.append(int(away.argmax()))
        away = np.minimum(away, distances(sample, sample[at[-1:]])[:, 0])
    return sample[at]


class Tree:
    """Split points of all nodes; ``low`` and ``high`` [node, point, child] and the norms of leaves come from all rows."""

    def __init__(self, sample: np.ndarray, ways: int = WAYS, levels: int = LEVELS):
        self.nodes: list[Node] = []
        self.n_leaves, self.ways, self.width = 0, ways, sample.shape[1]
        self.root = self._grow(sample, levels) if len(sample) else self._leaf()
        shape = (len(self.nodes), ways, ways)
        self.low, self.high = np.full(shape, np.inf), np.full(shape, -np.inf)
        self.norm_low, self.norm_high = np.full(self.n_leaves, np.inf), np.full(self.n_leaves, -np.inf)

    def _leaf(self) -> int:
        self.n_leaves += 1
        return self.n_leaves - 1

    def _grow(self, sample: np.ndarray, levels: int):
        points = _spread(sample, self.ways) if levels and len(sample) >= SPLIT else sample[:0]
        if len(points) < 2:
            return self._leaf()
        node = Node(points, [], [], len(self.nodes))
        self.nodes.append(node)
        nearest = distances(sample, points).argmin(1)
        for j in range(len(points)):
            first = self.n_leaves
            node.children.append(self._grow(sample[nearest == j], levels - 1))
            node.leaves.append(range(first, self.n_leaves))
        return node

    def place(self, rows: np.ndarray, seen: np.ndarray | None = None) -> np.ndarray:
        """Leaf of each row. With ``seen`` [node, point, child, 2] the least and greatest distances go there."""
        leaf = np.zeros(len(rows), np.int64)

        def down(node, at):
            if isinstance(node, int):
                leaf[at] = node
                return
            d = distances(rows[at], node.points)
            nearest = d.argmin(1)
            for j, child in enumerate(node.children):
                here = nearest == j
                if here.any():
                    if seen is not None:
                        s = seen[node.number, :len(node.points), j]
                        s[:, 0], s[:, 1] = np.minimum(s[:, 0], d[here].min(0)), np.maximum(s[:, 1], d[here].max(0))
                    down(child, at[here])

        down(self.root, np.arange(len(rows)))
        return leaf

    def left(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """[anchor, leaf]: whether the leaf may hold a row with a score in one of the anchor's windows
        [low, high] (both [anchor, window]; high may be infinite)."""
        norm = (anchors * anchors).sum(1)
        out = np.ones((len(anchors), self.n_leaves), bool)
        some = self.norm_low <= self.norm_high
        out[:, ~some] = False  # no row came there
        if max(norm.max(initial=0), self.norm_high[some].max(initial=0)) > 2.0**50:
            return out  # squares of distances aren't exact any more: nothing is eliminated

        def annuli(leaves):
            """Inner and outer radius of the windows, [anchor, window], for rows with the norms of these leaves."""
            l, h = self.norm_low[leaves].min(initial=np.inf), self.norm_high[leaves].max(initial=-np.inf)
            with np.errstate(invalid="ignore"):
                inner = np.sqrt(np.maximum(norm[:, None] + l - 2 * high, 0))
                outer = np.sqrt(np.maximum(norm[:, None] + h - 2 * low, 0))
            empty = norm[:, None] + h - 2 * low < -_SLACK * (1 + norm[:, None] + h)  # no row is long enough for the score
            return inner * (1 - _SLACK) - _SLACK, np.where(empty, -1.0, outer * (1 + _SLACK) + _SLACK)

        def down(node, at):
            if isinstance(node, int) or not len(at):
                return
            d = distances(anchors[at], node.points)
            for j, child in enumerate(node.children):
                leaves = np.array(node.leaves[j])
                leaves = leaves[some[leaves]]
                if not len(leaves):
                    continue
                inner, outer = (x[at] for x in annuli(leaves))
                lo, hi = self.low[node.number, :len(node.points), j], self.high[node.number, :len(node.points), j]
                # rows of the subtree are at least ``near`` and at most ``far`` from the anchor, by every split point
                near = np.maximum(np.maximum(d - hi, lo - d), 0).max(1) * (1 - _SLACK) - _SLACK
                far = (d + hi).min(1) * (1 + _SLACK) + _SLACK
                may = ((near[:, None] <= outer) & (far[:, None] >= inner)).any(1)
                out[np.ix_(at[~may], np.array(node.leaves[j]))] = False
                down(child, at[may])

        down(self.root, np.arange(len(anchors)))
        return out


def _vectors(column, width: int) -> np.ndarray:
    """Arrow lists as a matrix."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return _matrix(column.to_pylist(), width)


def fit(rows: DataFrame, sample_rows: int = SAMPLE) -> tuple[Tree, tuple]:
    """The tree with the ranges of all ``rows``, and the sample (ids, labels, vectors) it was fitted on."""
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).toArrow()
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    vectors = _matrix(picked["v"].to_pylist(), width)
    tree = Tree(vectors)
    shared = rows.sparkSession.sparkContext.broadcast(tree)  # at most SAMPLE vectors

    def run(batches):
        t = shared.value
        seen = np.full((*t.low.shape, 2), np.inf)
        seen[..., 1] = -np.inf
        norms = np.full((t.n_leaves, 2), np.inf)
        norms[:, 1] = -np.inf
        for batch in batches:
            v = _vectors(batch.column(0), t.width)
            leaf, norm = t.place(v, seen), (v * v).sum(1)
            np.minimum.at(norms[:, 0], leaf, norm)
            np.maximum.at(norms[:, 1], leaf, norm)
        for kind, x in (("range", seen.reshape(-1, 2)), ("norm", norms)):
            at = np.flatnonzero(x[:, 0] <= x[:, 1])
            yield pa.RecordBatch.from_arrays([pa.array([kind] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(x[at, 0]), pa.array(x[at, 1])],
                                             ["kind", "at", "low", "high"])

    # a task gives at most WAYS^2 ranges for each node
    small_batches(rows.sparkSession)
    found = rows.select("v").mapInArrow(lean(run), struct("kind string, at long, low double, high double")).groupBy("kind", "at").agg(
        F.min("low").alias("low"), F.max("high").alias("high")).collect()
    for r in found:
        if r.kind == "range":
            tree.low.reshape(-1)[r.at], tree.high.reshape(-1)[r.at] = r.low, r.high
        else:
            tree.norm_low[r.at], tree.norm_high[r.at] = r.low, r.high
    return tree, (np.array(picked["vec_id"].to_pylist(), np.int64), np.array(picked["label"].to_pylist(), np.int64), vectors)


def index(rows: DataFrame, tree: Tree) -> DataFrame:
    """(leaf, vec_id, label, v) of every row, written in the order of the leaves; many rows of one leaf are several files."""
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    def run(batches):
        for batch in batches:
            leaf = shared.value.place(_vectors(batch.column(2), shared.value.width))
            yield pa.RecordBatch.from_arrays([pa.array(leaf), *batch.columns], ["leaf", "vec_id", "label", "v"])

    small_batches(rows.sparkSession)
    placed = rows.select("vec_id", "label", "v").mapInArrow(lean(run), struct("leaf long, vec_id long, label long, v array<double>"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keep(placed.repartitionByRange(n, "leaf", "vec_id").sortWithinPartitions("leaf", "vec_id"), "leaves")


@dataclass
class Search:
    """Anchors and their windows: the best ``K`` rows with a score in [low, high], of the anchor's label or of the others."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    low: np.ndarray  # [anchor, window] scores as int64
    high: np.ndarray
    same: bool
    tree: Tree

    def start(self) -> None:
        shape = (*self.low.shape, K)
        self.scores, self.found = np.full(shape, _LOW), np.full(shape, _HIGH)
        self.count = np.zeros(self.low.shape, np.int64)

    def add(self, at: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        """Meet the anchors ``at`` with these rows."""
        scores = products(self.vectors[at], vectors)
        floor = np.where(self.count[at] == K, np.maximum(self.scores[at][:, :, -1], self.low[at]), self.low[at])
        hit = (scores >= floor.min(1)[:, None]) & (scores <= self.high[at].max(1)[:, None])
        hit &= (self.labels[at][:, None] == labels[None, :]) == self.same
        hit &= self.ids[at][:, None] != ids[None, :]
        a, r = np.nonzero(hit)
        s = scores[a, r]
        for w in range(self.low.shape[1]):
            ok = (s >= floor[a, w]) & (s <= self.high[at][a, w])
            self._merge(w, at[a[ok]], s[ok], ids[r[ok]])

    def _merge(self, w: int, a: np.ndarray, s: np.ndarray, ids: np.ndarray) -> None:
        if not len(a):
            return
        touched = np.unique(a)
        n = self.count[touched, w]
        old = np.arange(K)[None, :] < n[:, None]
        a = np.concatenate([np.repeat(touched, n), a])
        s = np.concatenate([self.scores[touched, w][old], s])
        ids = np.concatenate([self.found[touched, w][old], ids])
        order = np.lexsort((ids, -s.astype(object) if (s == _LOW).any() else -s, a))
        a, s, ids = a[order], s[order], ids[order]
        rank = np.arange(len(a)) - np.searchsorted(a, a)
        top = rank < K
        self.scores[a[top], w, rank[top]], self.found[a[top], w, rank[top]] = s[top], ids[top]
        self.count[touched, w] = np.minimum(np.bincount(np.searchsorted(touched, a), minlength=len(touched)), K)


def _best(rows: DataFrame, search: Search, known: tuple) -> DataFrame:
    """(anchor, slot, score, vec_id, rank) of the best ``K`` rows in each window, over all leaves."""
    spark = rows.sparkSession
    search.start()
    search.add(np.arange(len(search.ids)), *known)
    # the scores of sample rows are bounds that the best ones reach at least; the rows themselves come from the leaves
    bound = np.where(search.count == K, np.maximum(search.scores[:, :, -1], search.low), search.low)
    search.scores = search.found = search.count = None
    search.low = bound
    shared = spark.sparkContext.broadcast(search)  # at most BLOCK anchors

    def run(batches):
        q = shared.value
        q.start()
        may = q.tree.left(q.vectors, q.low.astype(float), q.high.astype(float))
        for batch in batches:
            leaf = batch.column(0).to_numpy(zero_copy_only=False)
            ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            vectors = _vectors(batch.column(3), q.tree.width)
            for own in np.unique(leaf):
                left, mine = np.flatnonzero(may[:, own]), np.flatnonzero(leaf == own)
                for i in range(0, len(left), 512):
                    for j in range(0, len(mine), 2048):
                        m = mine[j:j + 2048]
                        q.add(left[i:i + 512], ids[m], labels[m], vectors[m])
        a, w, k = np.nonzero(np.arange(K)[None, None, :] < q.count[:, :, None])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, w, q.scores[a, w, k], q.found[a, w, k])], ["anchor", "slot", "score", "vec_id"])

    found = rows.select("leaf", "vec_id", "label", "v").mapInArrow(lean(run), struct("anchor long, slot long, score long, vec_id long"))
    w = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= K)


def _mine_block(rows: DataFrame, anchors: list, tree: Tree, known: tuple) -> DataFrame:
    spark = rows.sparkSession
    ids, labels = (np.array([getattr(r, c) for r in anchors], np.int64) for c in ("vec_id", "label"))
    vectors = _matrix([r.v for r in anchors], tree.width)
    everything = lambda x: np.full((len(ids), 1), x, np.int64)
    best = _best(rows, Search(ids, labels, vectors, everything(_LOW), everything(_HIGH), True, tree), known)
    got = best.select("anchor", "rank", "vec_id", "score").toArrow()  # at most K rows for each anchor of the block
    a, k, positive, score = (got[c].to_numpy() for c in ("anchor", "rank", "vec_id", "score"))
    low, high = np.full((len(ids), K), _HIGH), np.full((len(ids), K), _LOW)
    high[a, k - 1] = score
    low[a, k - 1] = [-(-4 * int(s) // 5) for s in score]  # the least score n with 100 n >= 80 s
    negatives = _best(rows, Search(ids, labels, vectors, low, high, False, tree), known)
    names = spark.createDataFrame(pa.table({"anchor": a, "slot": k.astype(np.int64) - 1, "anchor_id": ids[a], "positive_id": positive, "positive_score": score}))
    return negatives.join(F.broadcast(names), ["anchor", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def mine(rows: DataFrame, is_anchor: Column, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the anchors among ``rows``
    (vec_id, label, v), as ``integer_vectors`` gives them."""
    spark = rows.sparkSession
    rows = keep(rows, "vectors")
    tree, known = fit(rows)
    leaves = index(rows, tree)
    once = rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")
    # hashed blocks of about ``block`` anchors; each is one broadcast and two passes over the index
    n = once.count()
    blocks = max(1, -(-n // block))
    once = keep(once.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))), "anchors")
    out = None
    for b in range(blocks if n else 0):
        anchors = once.where(F.col("block") == b).collect()
        if anchors:
            found = keep(_mine_block(leaves, anchors, tree, known), "negatives")
            out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], struct("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"))
    return out
