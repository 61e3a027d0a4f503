"""The pruned search against scoring every pair, frequent terms in salts, and indexes of several segments."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from kestrel.operators import index as ix
from kestrel.operators import retrieval as rt
from kestrel.operators import topk
from kestrel.operators.text import STOPWORDS_NLP2
from kestrel.sources import fixtures as fx

VARIANTS = [("binary", "fixed"), ("binary", "literal"), ("tf", "fixed"), ("tfidf", "fixed"), ("tfidf", "literal")]


def _shown(df):
    return [(q, d, rank, None if s is None else round(s, 9)) for q, d, rank, s in rows(df, "qid", "docid", "rank", "score")]


@pytest.fixture(scope="module")
def random_texts(spark):
    rng = random.Random(11)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 2, 3, 10, 40, 200])) + (["everywhere"] if i % 10 else []))) for i in range(400)]
    queries = [(q, " ".join(rng.choices(words, k=rng.choice([1, 2, 5, 15])) + ["everywhere"] * (q % 3))) for q in range(25)]
    queries += [(90, docs[17][1]), (91, "unknown words"), (92, ""), (93, "everywhere")]
    return (rt.build_postings(spark.createDataFrame(docs, "doc_id long, text string")),
            rt.query_terms(spark.createDataFrame(queries, "qid long, text string")))


@pytest.fixture(scope="module")
def index(random_texts):
    return ix.write_index(random_texts[0])


@pytest.mark.parametrize("weighting,mode", VARIANTS)
@pytest.mark.parametrize("k", [1, 10])
def test_equals_scoring_everything(index, random_texts, weighting, mode, k):
    want = _shown(rt.rank_top(rt.score(index, random_texts[1], weighting, mode), k))
    assert want and _shown(rt.retrieve(index, random_texts[1], weighting, k, mode)) == want


def test_salts_and_segments_change_nothing(index, random_texts):
    postings, queries = random_texts
    want = _shown(rt.rank_top(rt.score(index, queries, "tfidf"), 10))
    salted = ix.write_index(postings, salt_rows=7)
    assert salted.segment_terms.agg(F.max("fanout")).first()[0] > 20
    halves = [postings.where(F.col("docid") % 2 == i) for i in (0, 1)]
    two = ix.add_documents(ix.write_index(halves[0], salt_rows=9), halves[1], salt_rows=50)
    for other in (salted, two, ix.compact(two)):
        assert other.n_docs == index.n_docs
        assert rows(other.terms, "term", "df") == rows(index.terms, "term", "df")
        assert rows(other.blocks.selectExpr("term", "band", "level", "n", "round(binary, 9)", "round(tf, 9)", "round(tfidf, 9)")) == rows(
            index.blocks.selectExpr("term", "band", "level", "n", "round(binary, 9)", "round(tf, 9)", "round(tfidf, 9)"))
        assert rows(other.norms.selectExpr("docid", "band", "binary", "tf", "round(tfidf, 6)")) == rows(index.norms.selectExpr("docid", "band", "binary", "tf", "round(tfidf, 6)"))
        assert rows(ix.hits(other, queries)) == rows(ix.hits(index, queries))
        assert _shown(rt.retrieve(other, queries, "tfidf", 10)) == want
        assert _shown(rt.retrieve(other, queries, "binary", 10, "literal")) == _shown(rt.rank_top(rt.score(index, queries, "binary", "literal"), 10))
    assert len(two.segments) == 2 and len(ix.compact(two).segments) == 1


def test_no_task_holds_a_whole_frequent_term(random_texts):
    salted = ix.write_index(random_texts[0], salt_rows=7)
    most = salted.postings.groupBy("segment", "term", "salt").count().agg(F.max("count")).first()[0]
    assert most <= 30 < salted.terms.agg(F.max("df")).first()[0]


def test_empty_index(spark):
    none = ix.write_index(rt.build_postings(spark.createDataFrame([], "doc_id long, text string")))
    queries = rt.query_terms(spark.createDataFrame([(1, "a b")], "qid long, text string"))
    for weighting, mode in VARIANTS:
        assert rt.retrieve(none, queries, weighting, 10, mode).collect() == []


def test_documents_without_a_norm_rank_last(spark):
    # both terms are in all documents: idf 0, so no document has a tf-idf norm
    docs = spark.createDataFrame([(i, "a b") for i in range(4)], "doc_id long, text string")
    index = ix.write_index(rt.build_postings(docs))
    queries = rt.query_terms(spark.createDataFrame([(1, "a")], "qid long, text string"))
    assert _shown(rt.retrieve(index, queries, "tfidf", 3)) == [(1, 0, 1, None), (1, 1, 2, None), (1, 2, 3, None)]


@pytest.fixture(scope="module")
def test_table(spark):
    """998 documents of random words and queries of 30 terms: the tenth best of them is little better than the others."""
    where = "/root/testdata/sf0.01"
    return (ix.write_index(rt.build_postings(fx.table(spark, where, "documents"), stopwords=STOPWORDS_NLP2)),
            rt.query_terms(fx.queries(spark, where), stopwords=STOPWORDS_NLP2))


@pytest.mark.parametrize("weighting,most", [("binary", 0.5), ("tf", 0.55), ("tfidf", 0.28)])
def test_pairs_that_are_formed(test_table, weighting, most):
    index, queries = test_table
    every = ix.hits(index, queries).select("qid", "docid").distinct().count()
    terms = topk.weights(index, queries, weighting, "fixed").cache()
    first = topk.start(index, terms, index.postings, 10).cache()
    least = topk.thresholds(topk._in_full(index, first, terms, index.postings, weighting), 10)
    pairs = topk.candidates(index, topk.essential(index, terms, least, weighting), index.postings, weighting)
    formed = first.unionByName(pairs.select("qid", "docid")).distinct().count()
    assert formed <= most * every
    terms.unpersist()
    first.unpersist()


def test_lookups_write_no_blocks(spark, random_texts):
    index = ix.write_index(random_texts[0])
    assert ix.hits(index, random_texts[1]).count() and index.norms.count()
    assert _shown(rt.retrieve(index, random_texts[1], "binary", 10, "literal"))
    assert "blocks" not in vars(index)
    assert rt.retrieve(index, random_texts[1], "tf", 10).count() and "blocks" in vars(index)


def test_documents_stay_in_one_file_and_one_task(spark, random_texts, index):
    files = ix._read(spark, index.segments, "postings").select("docid", F.input_file_name().alias("file")).distinct()
    assert files.count() == files.select("docid").distinct().count() == index.n_docs


@pytest.mark.parametrize("weighting", ["binary", "tf", "tfidf"])
def test_scores_move_postings_and_no_pairs(spark, random_texts, index, weighting):
    terms = topk.weights(index, random_texts[1], weighting, "fixed").localCheckpoint()
    least = terms.select("qid").distinct().withColumn("least", F.lit(-1.0)).localCheckpoint()
    found = topk.scored(index, terms, index.postings, weighting, least, 29)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(docid" in plan and "hashpartitioning(qid" not in plan
    every = rt.score(index, random_texts[1], weighting).select("qid", "docid", F.round("score", 9))
    assert rows(found.select("qid", "docid", F.round("score", 9))) == rows(every)


def test_queries_in_blocks_give_the_same(index, random_texts, monkeypatch):
    want = _shown(rt.rank_top(rt.score(index, random_texts[1], "tfidf"), 10))
    monkeypatch.setattr(topk, "BLOCK", 40)
    assert _shown(rt.retrieve(index, random_texts[1], "tfidf", 10)) == want


def test_norms_of_rare_and_common_terms_add_up(random_texts, index, monkeypatch):
    shown = lambda i: rows(i.norms.selectExpr("docid", "band", "binary", "tf", "round(tfidf, 6)"))
    for most in (1, 30):
        monkeypatch.setattr(ix, "COMMON", most)
        assert shown(ix.write_index(random_texts[0])) == shown(index)
