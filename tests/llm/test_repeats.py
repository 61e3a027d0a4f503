"""Removal of repeated 100-byte strings against brute force, and the merge of front-coded runs."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kestrel.llm import repeats
from kestrel.llm.queries import op8_repeated_strings
from kestrel.llm.suffix_runs import common_prefix, decode, front_code, merge


def brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, kept) in the order of doc_id."""
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            w = data[s:s + 100]
            if w in seen:
                gone[s:s + 100] = b"\x01" * 100
            seen.add(w)
        spans = sum(1 for i, x in enumerate(gone) if x and (not i or not gone[i - 1]))
        out.append((doc_id, len(data), sum(gone), spans, bytes(b for b, x in zip(data, gone) if not x)))
    return out


def result(spark, rows, **options):
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, key int, place string")
    return [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.without_repeats(df, **options).collect()]


def texts(rng):
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(40), prose(60), prose(25)]
    out = []
    for i in range(60):
        parts = [prose(rng.randrange(2, 60))]
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 2)
            parts += [p[a:a + rng.randrange(60, len(p))], prose(rng.randrange(1, 20))]
        out.append((i * 2, " ".join(parts)))
    out += [(500 + k, out[3][1]) for k in range(5)]
    out += [(600, "ab" * 400), (601, "ab" * 60), (602, "x" * 1000), (603, "x" * 100), (604, "x" * 99)]
    return out


@pytest.mark.parametrize("hot", [repeats.HOT, 3])
def test_matches_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = texts(random.Random(hot))
    assert sorted(result(spark, rows[::-1])) == sorted(brute(sorted(rows)))


def test_edge_cases(spark):
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefgh") for _ in range(300))
    rows = [(1, None), (2, ""), (3, "short"), (4, long), (4, long), (None, long), (0, long[50:260])]
    got = sorted(result(spark, rows), key=lambda r: (r[0] is None, r[0], r[2]))
    assert [r[:4] for r in got] == [(0, 210, 0, 0), (1, 0, 0, 0), (2, 0, 0, 0), (3, 5, 0, 0), (4, 300, 210, 1), (4, 300, 300, 1), (None, 300, 300, 1)]
    assert repeats.without_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_matches_brute_force(spark, small_dir):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect())
    want = sorted((i, a, b, c, hashlib.sha256(kept).hexdigest()) for i, a, b, c, kept in brute(docs))
    assert sorted(tuple(r) for r in op8_repeated_strings(spark, small_dir).collect()) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6).map(lambda b: bytes(x & 1 for x in b)), max_size=12), max_size=9))
def test_merge_keeps_order_and_common_prefixes(runs):
    runs = [sorted(r) for r in runs]
    out = list(merge([decode(*front_code(r)) for r in runs]))
    assert [x[0] for x in out] == sorted(s for r in runs for s in r)
    last = b""
    for s, shared, _ in out:
        assert shared == common_prefix(last, s)
        last = s
