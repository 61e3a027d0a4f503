"""Filter interaction audit: popcounts, every order by brute force, and the query against its SQL."""

import random
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from kestrel.llm import filter_audit
from kestrel.llm.queries import ORACLE, op11_filter_audit


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=70), max_size=4))
def test_popcount(lists):
    counter = filter_audit.Popcount()
    for words in lists:
        counter.add(np.array(words, np.uint32))
    assert counter.counts() == [sum(w >> bit & 1 for words in lists for w in words) for bit in range(32)]


def test_survival_words():
    for failed in range(32):
        for subset in range(32):
            assert bool(int(filter_audit.WORDS[failed]) >> subset & 1) == (failed & subset == 0)


def fails(text, copy):
    words = text.encode().split()
    return {x for x, bad in zip("ABCDE", (len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
                                          any(c in "#$%&*|" for c in text), copy)) if bad}


def brute(docs, labels):
    """The audit by applying the filters in every order."""
    first = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    good, toxic = ({d for d, *x in labels if x[i] == 1 and d is not None} for i in (0, 1))
    parts = defaultdict(list)
    for doc_id, text, source in docs:
        parts[source or ""].append((doc_id, fails(text or "", doc_id is not None and first[text or ""] < doc_id)))
    out = {}
    for part, rows in parts.items():
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(f in r[1] for r in rows) - len(gone), sum(r[1] == {f} for r in rows),
                                          sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def answer(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


def test_every_order_by_brute_force(spark):
    rng = random.Random(3)
    words = ["alpha", "Beta", "GAMMA", "d#", "é", "İ", "x" * 9]
    docs = []
    for i in range(150):
        n = rng.choice([0, 5, 49, 50, 51, 80])
        text = " ".join(rng.choice(words) if rng.random() < 0.5 else f"w{rng.randrange(500)}" for _ in range(n))
        docs.append((i, rng.choice([text, text, docs[rng.randrange(len(docs))][1] if docs else None]), rng.choice(["s", "t", "", None])))
    docs += [(7, docs[7][1], "s"), (7, "another text of one id", "s"), (None, docs[3][1], "t"), (None, None, None), (900, "a\x1cb c " * 60, "s"), (901, "Z" * 300_000, "long"), (902, "Z" * 300_000, "long")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (9999, 1, 1)]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, source string, part int, failed int").repartition(5)
    lab = spark.createDataFrame([(*x, "z") for x in labels], "doc_id long, quality int, toxic int, label string")
    assert answer(filter_audit.audit(df, lab)) == brute(docs, labels)


def test_many_parts_and_no_rows(spark, monkeypatch):
    docs = [(i, "a b", str(i % 40)) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = answer(filter_audit.audit(df, none))
    assert got == brute(docs, [])
    monkeypatch.setattr(filter_audit, "_GROUPS", 3)
    assert answer(filter_audit.audit(df, none)) == got
    assert filter_audit.audit(df.limit(0), none).collect() == []


def test_query_against_its_sql(spark, small_dir):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"create view {name} as select * from '{small_dir}/{name}.parquet'")
    want = con.execute(ORACLE["op11_filter_audit"]).df()
    got = op11_filter_audit(spark, small_dir).toPandas()[list(want.columns)]
    key = ["part", "filter_order", "step"]
    assert len(got) == 600 * want.part.nunique()
    assert got.sort_values(key).values.tolist() == want.sort_values(key).values.tolist()
