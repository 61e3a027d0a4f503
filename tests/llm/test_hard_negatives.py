"""Hard negatives: the tree's elimination and the mined windows against brute force."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.llm import hard_negatives as hn
from kestrel.llm.queries import ORACLE, op13_hard_negatives


def brute(rows, every=10):
    """Mined rows of anchors whose id is divisible by ``every``, from all pairs."""
    ok = [(i, l, [math.floor(256 * float(x)) for x in v]) for i, l, v in rows
          if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a in {i: min(((l, v) for j, l, v in ok if j == i)) for i, *_ in ok if i % every == 0}.items():
        i, (label, v) = a
        s = sorted((-dot(v, w), j, l) for j, l, w in ok if j != i)
        for p, j, _ in [x for x in s if x[2] == label][:5]:
            fit = [x for x in s if x[2] != label and 80 * -p <= 100 * -x[0] <= 100 * -p][:5]
            out += [(i, j, k, n, -p, -m) for k, (m, n, _) in enumerate(fit, 1)]
    return sorted(out)


def mined(df, every=10, **how):
    got = hn.mine(hn.integer_vectors(df), F.col("vec_id") % every == 0, **how).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(map(tuple, got.collect()))


def clusters(n, width, seed=0, spread=0.1):
    """Rows around a few centres, each centre with rows of several labels."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((8, width))
    at = rng.integers(0, 8, n)
    v = (centres[at] + spread * rng.standard_normal((n, width))).astype(np.float32)
    return [(int(i), int(rng.integers(0, 3)), [float(x) for x in v[i]]) for i in range(n)]


SCHEMA = "vec_id long, label int, embedding array<float>"


def test_against_all_pairs(spark, monkeypatch):
    rows = clusters(600, 6)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(rows)
    assert len(want) > 500
    assert mined(df) == want
    assert mined(df, block=7) == want  # several blocks of anchors
    monkeypatch.setattr(hn, "SAMPLE", 100)
    monkeypatch.setattr(hn, "SPLIT", 8)
    assert mined(df) == want


def test_odd_rows(spark):
    rows = clusters(120, 3, 5) + [(None, 1, [1.0, 1.0, 1.0]), (500, None, [1.0, 1.0, 1.0]), (510, 1, None), (520, 1, [1.0, None, 1.0]), (530, 1, [float("nan")] * 3),
                                  (540, 1, [float("inf"), 0.0, 0.0]), (550, 1, []), (560, 2, [0.5]), (570, 0, [0.5, 0.5, 0.5, 2.0]), (580, 1, [0.0] * 3), (590, 9, [-0.001] * 3)]
    rows += [(601 + i, i % 3, [0.25, 0.5, 0.25]) for i in range(30)]  # ties
    rows += [rows[3], rows[3], (40, 7, [0.5, 0.5, 0.5]), rows[601 - 600]]  # repeated rows and ids
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA + ", leaf int, score int, v int").repartition(3)
    assert mined(df) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(0, 1, [1.0])], [(0, 1, [1.0]), (1, 1, [2.0])], [(1, 1, [1.0]), (3, 2, [1.0])]])
def test_next_to_nothing(spark, rows):
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows) == []


def test_large_components(spark):
    rows = [(i, i % 2, [float(2**40 + i), float(i)]) for i in range(40)]
    got = mined(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"))
    assert got and all(r[4] == r[5] == 2**63 - 1 for r in got)  # beyond a long: its end


def test_elimination_keeps_every_hit_and_drops_leaves():
    rows = clusters(3000, 8, 2, 0.03)
    v = np.floor(256 * np.array([r[2] for r in rows]))
    tree = hn.Tree(v[:800])
    seen = np.full((*tree.low.shape, 2), np.inf)
    seen[..., 1] = -np.inf
    leaf = tree.place(v, seen)
    tree.low, tree.high = seen[..., 0], seen[..., 1]
    norm = (v * v).sum(1)
    for k in range(tree.n_leaves):
        if (leaf == k).any():
            tree.norm_low[k], tree.norm_high[k] = norm[leaf == k].min(), norm[leaf == k].max()
    anchors = v[::30]
    scores = hn.products(anchors, v)
    best = np.sort(scores, axis=1)[:, -40:].astype(float)
    low, high = best[:, :1], best[:, -1:] * 1.0
    left = tree.left(anchors, low, high)
    for a in range(len(anchors)):
        hits = (scores[a] >= low[a]) & (scores[a] <= high[a])
        assert left[a, leaf[hits]].all()
    used = np.unique(leaf)
    assert tree.n_leaves > 20 and left[:, used].mean() < 0.6


def test_query_against_its_sql(spark, small_dir):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{small_dir}/embeddings.parquet'")
    want = con.execute(ORACLE["op13_hard_negatives"]).df()
    got = op13_hard_negatives(spark, small_dir).toPandas()[list(want.columns)]
    assert len(want) and sorted(got.values.tolist()) == sorted(want.values.tolist())
