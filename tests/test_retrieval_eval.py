import math

import pytest

from conftest import rows
from kestrel.operators import index as ix
from kestrel.operators import ireval as ev
from kestrel.operators import retrieval as rt

DOCS = [(1, "apple banana apple"), (2, "banana cherry"), (3, "cherry cherry cherry date"), (4, "elder")]


def _postings(spark):
    return rt.build_postings(spark.createDataFrame(DOCS, "doc_id long, text string"))


def _index(spark):
    return ix.write_index(_postings(spark))


def test_postings(spark):
    p = _postings(spark)
    assert ("apple", 1, 2) in rows(p)
    assert p.count() == 7


def test_tfidf_scores_match_formula(spark):
    p = _index(spark)
    q = rt.query_terms(spark.createDataFrame([(9, "banana cherry cherry")], "qid long, text string"))
    got = dict(rows(rt.score(p, q, "tfidf").select("docid", "score")))
    n = 4
    idf = {"apple": math.log(n / 1), "banana": math.log(n / 2), "cherry": math.log(n / 2),
           "date": math.log(n / 1), "elder": math.log(n / 1)}
    tf = {1: {"apple": 2, "banana": 1}, 2: {"banana": 1, "cherry": 1}, 3: {"cherry": 3, "date": 1}}
    qtf = {"banana": 1, "cherry": 2}
    for d, terms in tf.items():
        num = sum(qtf.get(t, 0) * idf[t] * c * idf[t] for t, c in terms.items())
        norm = math.sqrt(sum((c * idf[t]) ** 2 for t, c in terms.items()))
        assert abs(got[d] - num / norm) < 1e-12
    assert 4 not in got


def test_binary_and_rank_ties(spark):
    p = _index(spark)
    q = rt.query_terms(spark.createDataFrame([(9, "banana")], "qid long, text string"))
    r = rt.retrieve(p, q, "binary", k=1)
    # docs 1 and 2 both score 1/sqrt(2): the lower docid wins
    assert rows(r, "qid", "docid", "rank") == [(9, 1, 1)]


def test_containing_documents_matches_brute_force(spark, small_dir):
    from kestrel.sources import fixtures as fx

    docs = fx.table(spark, small_dir, "documents")
    q = fx.queries(spark, small_dir)
    got = rows(rt.containing_documents(q, docs))
    qs = {r.qid: r.text for r in q.collect()}
    want = sorted((qid, r.doc_id) for r in docs.select("doc_id", "text").collect()
                  for qid, t in qs.items() if t in r.text)
    assert got == want


RUN = [(1, 10, 0), (1, 11, 1), (1, 10, 2), (1, 12, 3), (2, 20, 4), (2, 21, 5)]
GOLD = [(1, 10), (1, 12), (1, 13), (3, 30)]


def _rg(spark):
    return (spark.createDataFrame(RUN, "qid int, docid int, line_no long"),
            spark.createDataFrame(GOLD, "qid int, docid int"))


def test_duplicates_use_ranks_but_score_once(spark):
    run, gold = _rg(spark)
    pq = {r.qid: r for r in ev.ir_per_query(run, gold).collect()}
    assert (pq[1].retrieved, pq[1].relevant, pq[1].rel_ret) == (4, 3, 2)
    assert (pq[2].retrieved, pq[2].relevant, pq[2].rel_ret) == (2, 0, 0)
    assert (pq[3].retrieved, pq[3].relevant, pq[3].rel_ret) == (0, 1, 0)
    s = ev.ir_summary(run, gold).first()
    assert abs(s.precision - 2 / 6) < 1e-12 and abs(s.recall - 2 / 4) < 1e-12
    cut = {r.qid: r for r in ev.ir_per_query(run, gold, n=1).collect()}
    assert cut[1].rel_ret == 1 and cut[1].retrieved == 1


def test_precision_at_hits_and_interpolation(spark):
    run, gold = _rg(spark)
    pah = rows(ev.precision_at_hits(run, gold), "qid", "hit_no", "rank", "precision")
    assert pah == [(1, 1, 1, 1.0), (1, 2, 4, 0.5)]
    ip = {(q, p): v for q, p, v in rows(ev.interpolated_precision(run, gold))}
    # query 1: hit 1 -> point floor(10/3)=3 (p=1), hit 2 -> point 6 (p=0.5)
    assert ip[(1, 0)] == 1.0 and ip[(1, 3)] == 1.0 and ip[(1, 4)] == 0.5 and ip[(1, 7)] == 0.0
    # suffix maximum: never increases with the recall point
    for q in (1, 2, 3):
        vals = [ip[(q, p)] for p in range(11)]
        assert all(a >= b for a, b in zip(vals, vals[1:]))
    avg = {p: v for p, r, v in rows(ev.interpolated_precision_avg(run, gold))}
    assert abs(avg[0] - 1.0 / 3) < 1e-12   # averaged over all three query ids


def test_scan_pairs_rejects_bad_arity(spark, tmp_path):
    from kestrel.sources.files import scan_pairs

    good = tmp_path / "good.txt"
    good.write_text("# comment\n\n001 0002\n3 4\n")
    assert rows(scan_pairs(spark, str(good)), "qid", "docid") == [(1, 2), (3, 4)]
    bad = tmp_path / "bad.txt"
    bad.write_text("1 2\n3 4 5\n")
    with pytest.raises(Exception, match="bad line in pair file"):
        scan_pairs(spark, str(bad)).collect()


def test_containment_of_short_passages(spark):
    docs = spark.createDataFrame(
        [(1, "the othello worldwide tour"), (2, "hello world"), (3, "shell"), (4, "nothing here")],
        "doc_id long, text string")
    passages = spark.createDataFrame(
        [(1, "hello world"), (2, "ell"), (3, "o"), (4, "a longer passage with many words"), (5, "")],
        "qid long, text string")
    got = rows(rt.containing_documents(passages, docs))
    ps = {r.qid: r.text for r in passages.collect()}
    want = sorted((q, d) for d, t in [(r.doc_id, r.text) for r in docs.collect()]
                  for q, pt in ps.items() if pt and pt in t)
    assert got == want
    assert (1, 1) in got and (2, 3) in got


def test_short_passages_match_without_longer_ones_in_the_batch(spark):
    docs = spark.createDataFrame([(123456, "say hello world again"), (2, "other")], "doc_id long, text string")
    passages = spark.createDataFrame([(1234, "hello world")], "qid long, text string")
    assert rows(rt.containing_documents(passages, docs)) == [(1234, 123456)]


def test_a_common_opening_phrase_does_not_hide_or_pair_too_much(spark):
    docs = spark.createDataFrame([(i, f"a very common opening phrase then word{i} here.") for i in range(30)], "doc_id long, text string")
    passages = spark.createDataFrame([(i, f"very common opening phrase then word{i} here") for i in range(30)], "qid long, text string")
    assert rows(rt.containing_documents(passages, docs)) == [(i, i) for i in range(30)]


def test_run_folder_of_many_files_keeps_its_order_at_the_defaults(spark, tmp_path):
    from kestrel.sources.files import scan_pairs, write_ranked_run

    ranked = spark.range(3000).selectExpr("cast(id % 30 as bigint) as qid", "id * 7919 as docid", "cast(id div 30 as int) + 1 as rank").repartition(8)
    path = str(tmp_path / "run")
    write_ranked_run(ranked, path)
    got = ev.run_ranks(scan_pairs(spark, path)).select("qid", "docid", "rank")
    assert rows(got) == rows(ranked)


def test_scans_of_the_index_are_filtered_by_the_query_terms(spark):
    q = rt.query_terms(spark.createDataFrame([(9, "banana")], "qid long, text string"))
    plan = rt.score(_index(spark), q, "tf")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,banana)" in plan or "In(term, [banana])" in plan


def test_containment_cuts_the_documents_once(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"some text with word{i} and word{i + 1} in it") for i in range(20)], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    passages = spark.createDataFrame([(1, "with word3 and word4 in"), (2, "and word7 in it"), (3, "word2 and word9")], "qid long, text string")
    found = rt.containing_documents(passages, docs)
    assert "regexp_extract_all" not in found._jdf.queryExecution().optimizedPlan().toString()  # what is left checks candidates
    assert rows(found) == [(1, 3), (2, 6)]
