"""MinHash near-dedup with tensored banding.

A table key of four MinHash values is formed from a pair: one of ``t`` two-value keys of collection A and one
of ``t`` two-value keys of collection B. t * t tables need 2 * t * 2 hash functions instead of t * t * 4 (48
instead of 576), and a pair of texts with similarity s meets in some table with probability
(1 - (1 - s^2)^t)^2, 0.9999 at s = 0.75 for t = 12. A table key can repeat only if both of its halves do, so
texts are first matched on the 2 * t halves and only halves that repeat are paired.

Texts with equal shingle sets are one node (aggregated by digest). In a table's bucket no pairs are listed: each
node is compared with one of the bucket's largest component, links merge components, and buckets whose nodes lie
in one component are done. When such turns find few links, the nodes that open buckets connect are compared in blocks of a bounded
size, all with all, and only links leave a block; so no link that some bucket shows is lost. Links are confirmed
on the full shingle sets: 100 * intersection >= 75 * union.

Null or empty texts have no shingles and link with nothing; rows that share a doc_id are one document; rows
with a null doc_id stay alone (component null, kept); repeated rows are returned as often; extra columns are
dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.batches import id_and_text, lean, map_rows, pieces, struct
from kestrel.llm.shingles import WORDS, mix, shingle_hashes
from kestrel.llm.tables import among, components, keep

HALVES = 12
PER_HALF = 2
SIMILAR = 75  # per cent
#: Bounds of a block whose nodes are compared in one task, and of the columns of its incidence matrix at a time.
BLOCK_NODES = 1024
BLOCK_SHINGLES = 2_000_000
TOKENS_AT_ONCE = 4096

_N = 2 * HALVES * PER_HALF
_rng = np.random.default_rng(20240611)
_FLIP = _rng.integers(0, 2**64, _N, np.uint64)
_MULT = _rng.integers(0, 2**64, _N, np.uint64) | np.uint64(1)


def minhash(h: np.ndarray) -> np.ndarray:
    """The 48 minima of a non-empty set of hashes."""
    low = np.full(_N, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(h), 2048):
        x = (h[None, start:start + 2048] ^ _FLIP[:, None]) * _MULT[:, None]
        low = np.minimum(low, x.min(axis=1))
    return low


def half_keys(low: np.ndarray) -> np.ndarray:
    """Keys of the two collections, A first; the place of each is part of it."""
    pairs = mix(low).reshape(2 * HALVES, PER_HALF)
    key = np.arange(1, 2 * HALVES + 1, dtype=np.uint64)
    for i in range(PER_HALF):
        key = mix(key + pairs[:, i])
    return key.view(np.int64)


def signatures(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, digest, halves) of every row."""

    def make():
        def one(doc_id, text):
            h = shingle_hashes(text, words)
            if not len(h):
                return doc_id, 0, None, None
            return doc_id, len(h), xxhash.xxh3_128_digest(h.tobytes()), half_keys(minhash(h)).tolist()

        return one

    return map_rows(id_and_text(docs), make, struct("doc_id long, n_shingles long, digest binary, halves array<long>"))


def table_keys(nodes: DataFrame) -> DataFrame:
    """(node, key): keys of the pairs of repeated halves, only those of buckets with two or more nodes."""
    halves = nodes.select("node", F.posexplode("halves").alias("place", "half"))
    repeated = halves.groupBy("half").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("half")
    per_node = (halves.join(repeated, "half", "left_semi").groupBy("node")
                .agg(F.collect_set(F.when(F.col("place") < HALVES, F.col("half"))).alias("a"),
                     F.collect_set(F.when(F.col("place") >= HALVES, F.col("half"))).alias("b")))
    per_node = keep(per_node.where("size(a) > 0 and size(b) > 0"), "halves")
    keys = (per_node.select("node", "b", F.explode("a").alias("x")).select("node", "x", F.explode("b").alias("y"))
            .select("node", F.xxhash64("x", "y").alias("key")))
    buckets = keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("key", F.col("lo").alias("first"))
    return keep(keys.join(buckets, "key"), "buckets")


def confirm(pairs: DataFrame, texts: DataFrame, words: int = WORDS) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    both = (pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
            .select("a", "b", "text_a", "text_b"))

    def run(batches):
        last, of_last = None, None
        for batch in pieces(batches, 256):
            out = []
            for a, b, text_a, text_b in zip(*(c.to_pylist() for c in batch.columns)):
                if last != text_a:
                    last, of_last = text_a, shingle_hashes(text_a, words)
                mine = shingle_hashes(text_b, words)
                if min(len(mine), len(of_last)) * 100 < max(len(mine), len(of_last)) * SIMILAR:
                    continue
                common = len(np.intersect1d(of_last, mine, assume_unique=True))
                if 100 * common >= SIMILAR * (len(mine) + len(of_last) - common):
                    out.append((a, b))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*out)], ["a", "b"])

    return both.mapInArrow(lean(run), struct("a long, b long"))


def _open(members: DataFrame, label: DataFrame) -> DataFrame:
    """(key, node, component, size) of the buckets whose nodes lie in several components."""
    sizes = label.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    placed = label.join(sizes, "component").select("node", "component", "size")
    now = members.select("key", "node").join(placed, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component"), F.coalesce("size", F.lit(1)).alias("size"))
    several = now.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    return keep(now.join(several, "key", "left_semi"), "open")


def _more(label: DataFrame, linked: DataFrame) -> DataFrame:
    """The components with more links."""
    return keep(components(label.select(F.col("node").alias("a"), F.col("component").alias("b")).union(linked)), "labels")


def _one_each(open_: DataFrame, turn: int) -> DataFrame:
    """(a, b): each node outside the largest component of a bucket, with a node of that one; one pair a node."""
    best = open_.groupBy("key").agg(F.min(F.struct(-F.col("size"), F.xxhash64("node", F.lit(turn)).alias("draw"), F.col("node").alias("p"),
                                                   F.col("component").alias("of_p"))).alias("best")).select("key", "best.draw", "best.p", "best.of_p")
    return (open_.join(best, "key").where("component <> of_p").groupBy("node").agg(F.min(F.struct("draw", "p")).alias("best"))
            .select(F.least("best.p", "node").alias("a"), F.greatest("best.p", "node").alias("b")).distinct())


def _block_links(node: np.ndarray, component: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links (a, b) that join different components of a block: of all pairs, one tree for each group they form."""
    n, size = len(node), np.array([len(x) for x in sets], np.int64)
    token, at = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), size)
    shared = np.bincount(at, minlength=len(token)) > 1
    place = np.cumsum(shared) - 1
    owner, at = owner[shared[at]], place[at[shared[at]]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    common = np.zeros((n, n), np.float32)  # exact: counts stay far below 2^24
    for start in range(0, int(shared.sum()), TOKENS_AT_ONCE):
        lo, hi = np.searchsorted(at, (start, start + TOKENS_AT_ONCE))
        x = np.zeros((n, TOKENS_AT_ONCE), np.float32)
        x[owner[lo:hi], at[lo:hi] - start] = 1
        common += x @ x.T
    common = common.astype(np.int64)
    linked = 100 * common >= SIMILAR * (size[:, None] + size[None, :] - common)
    linked |= component[:, None] == component[None, :]
    out, seen = [], np.zeros(n, bool)
    for root in range(n):
        if seen[root]:
            continue
        todo = [root]
        seen[root] = True
        while todo:
            x = todo.pop()
            fresh = np.flatnonzero(linked[x] & ~seen)
            seen[fresh] = True
            todo += fresh.tolist()
            out += [(int(node[x]), int(node[y])) for y in fresh if component[x] != component[y]]
    return out


def _all_left(open_: DataFrame, nodes: DataFrame, texts: DataFrame, words: int = WORDS) -> DataFrame:
    """(a, b): links between different components of the open buckets, from all their pairs.

    Nodes that open buckets connect form a cluster. A cluster is cut into blocks of a bounded size, and every pair of
    blocks is compared in a task of its own; tasks give links, never pairs.
    """
    first = open_.groupBy("key").agg(F.min("node").alias("first"))
    ties = open_.join(first, "key").select(F.col("node").alias("a"), F.col("first").alias("b")).where("a <> b").distinct()
    cluster = components(ties).withColumnRenamed("component", "cluster")
    placed = keep(open_.select("node", "component").distinct().join(cluster, "node")
                  .join(nodes.groupBy("node").agg(F.max("n_shingles").alias("n_shingles")), "node"), "clusters")
    cuts = placed.groupBy("cluster").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_NODES), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("cuts"))
    block = F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int")
    pairs = placed.join(cuts, "cluster").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    pairs = pairs.select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "component")
    rows = pairs.join(texts.withColumnRenamed("doc_id", "node"), "node").select("cluster", "i", "j", "node", "component", "text")

    def run(t: pa.Table) -> pa.Table:
        found = _block_links(t["node"].to_numpy(), t["component"].to_numpy(), [shingle_hashes(x.as_py(), words) for x in t["text"]])
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return rows.groupBy("cluster", "i", "j").applyInArrow(run, struct("a long, b long"))


def links(nodes: DataFrame, texts: DataFrame) -> DataFrame | None:
    """(node, component) over confirmed links; None if no bucket holds two nodes."""
    buckets = table_keys(nodes)
    if not buckets.head(1):
        return None
    wanted = keep(buckets.select(F.col("node").alias("doc_id")).distinct(), "wanted")
    texts = keep(among(texts, wanted, "doc_id"), "texts")
    # first each node with the smallest first node of its buckets
    pairs = buckets.where("first < node").groupBy("node").agg(F.min("first").alias("a")).select("a", F.col("node").alias("b"))
    label = keep(components(confirm(pairs, texts)), "labels")
    open_ = _open(buckets, label)
    turn = 0
    while open_.head(1):
        turn += 1
        pairs = keep(_one_each(open_, turn), "pairs")
        fresh = keep(confirm(pairs, texts), "links")
        found = fresh.count()
        if found:
            label = _more(label, fresh)
            open_ = _open(open_, label)
        if found * 4 < pairs.count():  # few of the nodes left link with many others: compare with all
            if open_.head(1):
                fresh = keep(_all_left(open_, nodes, texts), "links")
                if fresh.head(1):
                    label = _more(label, fresh)
            break
    return label


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    rows = keep(signatures(docs, words), "signatures")
    sets = rows.where("n_shingles > 0 and doc_id is not null")
    same = sets.groupBy("digest").agg(F.min("doc_id").alias("node"))
    member = keep(sets.select("doc_id", "digest").distinct().join(same, "digest").select("doc_id", "node"), "members")
    nodes = keep(sets.join(same.withColumnRenamed("node", "doc_id"), ["digest", "doc_id"], "left_semi")
                 .select(F.col("doc_id").alias("node"), "n_shingles", "halves"), "nodes")
    texts = id_and_text(docs).where("doc_id is not null")
    label = links(nodes, texts)
    if label is None:
        label = member.select("node", F.col("node").alias("component")).limit(0)
    placed = member.join(label, "node", "left").select("doc_id", F.coalesce("component", "node").alias("component"))
    # a doc_id with several texts ties their components together
    ties = placed.groupBy("doc_id").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    if ties.head(1):
        tied = components(placed.join(ties, "doc_id").select(F.col("component").alias("a"), F.col("lo").alias("b")))
        final = tied.select(F.col("node").alias("component"), F.col("component").alias("final"))
        placed = placed.join(final, "component", "left").select("doc_id", F.coalesce("final", "component").alias("component"))
    placed = placed.groupBy("doc_id").agg(F.min("component").alias("component"))
    return (rows.select("doc_id", "n_shingles").join(placed, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
