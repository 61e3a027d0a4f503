"""Near-dedup against brute force over the whole texts, and its edge cases."""

import random

import pytest

from kestrel.llm import near_dups, tables
from kestrel.llm.near_dups import half_keys, minhash
from kestrel.llm.queries import op1_near_duplicates
from kestrel.llm.shingles import shingle_hashes

SCHEMA = "doc_id long, text string, component_id string, kept string, digest int"


def shingles(text):
    ws = (text or "").encode().lower().split()
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4)))


def brute(rows):
    """doc_id -> smallest doc_id reachable."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, (a, s) in enumerate(sets):
        for b, t in sets[:x]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    return {i: find(i) for i, _ in rows}


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def result(spark, rows):
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA)
    return near_dups.near_duplicates(df).collect()


def test_matches_brute_force_on_chains_and_groups(spark):
    rng = random.Random(5)
    rows = []
    for g in range(6):  # chains: each text differs a little from the one before, the ends a lot
        ws = words(rng, 120)
        for k in range(8):
            ws = list(ws)
            ws[rng.randrange(len(ws))] = f"edit{g}-{k}"
            rows.append((len(rows) * 3 + 1, " ".join(ws)))
    big = words(rng, 200)
    for k in range(60):  # one large group of near copies
        ws = list(big)
        ws[k] = f"own{k}"
        rows.append((1000 + k, "\t".join(ws)))
    rows += [(2000 + k, " ".join(words(rng, 60))) for k in range(30)]
    half = words(rng, 100)  # shares a long passage without being alike
    rows += [(3000 + k, " ".join(half + words(rng, 60 + k))) for k in range(12)]
    rng.shuffle(rows)
    want = brute(rows)
    for r in result(spark, rows):
        assert r.component_id == want[r.doc_id], r
        assert r.n_shingles == len(shingles(dict(rows)[r.doc_id]))
        assert r.kept == (r.doc_id == r.component_id)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "Two Words"), (5, "two  words"), (6, "two words more"), (7, "ÄB ab"), (8, "äb ab"),
            (9, "a b c d e f g"), (9, "a b c d e f g"), (None, "a b c d e f g"), (10, "A B C D E F G"),
            (11, "x " * 30000), (12, "x x x x x")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in result(spark, rows)), key=lambda r: (r[0] is None, r))
    assert got == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True),
                   (7, 1, 7, True), (8, 1, 8, True), (9, 3, 9, True), (9, 3, 9, True), (10, 3, 9, False), (11, 1, 11, True),
                   (12, 1, 11, False), (None, 3, None, True)]


def test_a_doc_id_with_two_texts_ties_both_groups(spark):
    a, b = "one two three four five six seven", "red green blue black white grey pink"
    got = {(r.doc_id, r.component_id) for r in result(spark, [(5, a), (5, b), (7, a), (3, b)])}
    assert got == {(5, 3), (7, 3), (3, 3)}


def test_empty_table(spark):
    df = near_dups.near_duplicates(spark.createDataFrame([], "doc_id long, text string"))
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"] and df.collect() == []


@pytest.mark.parametrize("edits", [1, 2, 4])
def test_similar_sets_meet_in_a_table(edits):
    rng = random.Random(edits)
    met = alike = 0
    for _ in range(60):
        ws = words(rng, 160)
        other = list(ws)
        for _ in range(edits):
            other[rng.randrange(160)] = "edit"
        x, y = shingle_hashes(" ".join(ws)), shingle_hashes(" ".join(other))
        common = len(set(x.tolist()) & set(y.tolist()))
        if 100 * common >= 75 * (len(x) + len(y) - common):
            alike += 1
            same = half_keys(minhash(x)) == half_keys(minhash(y))
            met += bool(same[:near_dups.HALVES].any() and same[near_dups.HALVES:].any())
    assert alike and met == alike


def test_query_matches_brute_force(spark, small_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(docs)
    got = {r.doc_id: r.component_id for r in op1_near_duplicates(spark, small_dir).collect()}
    assert got == want


def test_rows_are_picked_by_id_without_shuffling_the_others(spark):
    rows = spark.createDataFrame([(i, f"text {i}", i) for i in range(3000)] + [(7, "again", 0), (None, "none", 1)], "doc_id long, text string, slot int")
    ids = spark.createDataFrame([(i,) for i in range(0, 3000, 100)] + [(7,), (9999,)], "doc_id long")
    inside, outside = tables.among(rows, ids, "doc_id"), tables.not_among(rows, ids, "doc_id")
    assert inside.columns == outside.columns == rows.columns
    assert sorted(map(tuple, inside.collect())) == sorted(map(tuple, rows.join(ids, "doc_id", "left_semi").collect()))
    assert sorted(map(str, outside.collect())) == sorted(map(str, rows.join(ids, "doc_id", "left_anti").collect()))
    maybe, others = tables._marked(rows, ids, "doc_id")
    assert maybe.count() < 100 and maybe.count() + others.count() == rows.count()
    assert "Exchange hashpartitioning(doc_id" not in others._jdf.queryExecution().executedPlan().toString()


def test_stage_leaves_no_copies_of_texts(spark, small_dir):
    import os

    import corpus_pipeline
    from kestrel.session import ensure_checkpoint_dir

    rng = random.Random(3)
    text = [" ".join(words(rng, 60)) for _ in range(20)]
    docs = spark.createDataFrame([(k, t + (" more" if k > 20 else "")) for k, t in enumerate(text * 2)], "doc_id long, text string")
    at = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "tables")
    there = lambda: set(os.listdir(at)) if os.path.exists(at) else set()
    before = there()
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, small_dir).collect()) == list(range(20))
    assert {x.split("-")[0] for x in there() - before} == {"several", "result", "others"}
