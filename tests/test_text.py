import math

from pyspark.sql import functions as F

from conftest import rows
from kestrel.functions import alpha_tokens, word_tokens
from kestrel.operators import text as tx


def test_unicode_word_tokens(spark):
    df = spark.createDataFrame([("Café don't x_y 42, naïve!",)], "text string")
    assert df.select(word_tokens("text", lower=True)).first()[0] == ["café", "don't", "x_y", "42", "naïve"]
    # ASCII-letter words of two or more letters, whole runs only
    assert df.select(alpha_tokens("text")).first()[0] == []
    df2 = spark.createDataFrame([("an apple a day",)], "text string")
    assert df2.select(alpha_tokens("text")).first()[0] == ["an", "apple", "day"]


def test_char_ngrams_apple(spark):
    df = spark.createDataFrame([(["apple"],)], "t array<string>")
    got = df.select(tx.char_ngrams("t", 3, 5)).first()[0]
    assert got == ["app", "ppl", "ple", "appl", "pple", "apple"]
    short = spark.createDataFrame([(["ab"],)], "t array<string>")
    # a term no longer than n is emitted whole once per n
    assert short.select(tx.char_ngrams("t", 3, 4)).first()[0] == ["ab", "ab"]


def test_word_ngrams_order(spark):
    df = spark.createDataFrame([(["a", "b", "c"],)], "t array<string>")
    assert df.select(tx.word_ngrams("t", 1, 2)).first()[0] == ["a", "b", "c", "a b", "b c"]
    assert df.select(tx.word_ngrams("t", 4, 4)).first()[0] == []


def test_stopwords(spark):
    df = spark.createDataFrame([(["The", "cat", "the"],)], "t array<string>")
    assert df.select(tx.remove_stopwords("t", ["the"])).first()[0] == ["The", "cat"]
    assert df.select(tx.remove_stopwords("t", ["the"], case_sensitive=False)).first()[0] == ["cat"]


def _feats(spark):
    docs = [(1, "a b b c"), (2, "b c d"), (3, "c")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return tx.features_long(df.select("doc_id", F.split("text", " ").alias("f")), "f")


def test_vocab_modes_and_ids(spark):
    f = _feats(spark)
    v = tx.build_vocab(f, keep_top_n=2)
    # counts: b 3, c 3, a 1, d 1; ties by text
    assert rows(v, "feature", "count", "rank") == [("b", 3, 1), ("c", 3, 2)]
    ids = tx.vocab_ids(tx.build_vocab(f))
    assert rows(ids) == [("a", 2), ("b", 0), ("c", 1), ("d", 3)]
    dv = tx.build_vocab(f, min_df=2, mode="docfreq")
    assert rows(dv, "feature", "df", "rank") == [("b", 2, 1), ("c", 3, 2)]


def test_tfidf_log10(spark):
    f = _feats(spark)
    ids = tx.vocab_ids(tx.build_vocab(f))
    counts = tx.count_vectors(f, ids)
    idf = dict(rows(tx.idf_log10(counts, 3)))
    assert abs(idf[1] - 0.0) < 1e-12                      # c in all 3 documents
    assert abs(idf[2] - math.log10(3)) < 1e-12            # a in one
    t = {(d, i): v for d, i, v in rows(tx.tfidf(counts, tx.idf_log10(counts, 3)))}
    assert abs(t[(1, 0)] - 2 * math.log10(1.5)) < 1e-12


def test_doc_to_ids_keeps_order(spark):
    docs = spark.createDataFrame([(1, ["z", "b", "a", "b"]), (2, ["z"]), (3, []), (4, None), (5, [None, "a"]), (6, ["b"])] * 3, "doc_id long, tokens array<string>").repartition(2)
    ids = spark.createDataFrame([("a", 5), ("b", 7)], "feature string, term_id int")
    got = tx.doc_to_ids(docs, ids)
    assert rows(got) == sorted([(1, [7, 5, 7]), (5, [5]), (6, [7])] * 3)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString().replace("Exchange RoundRobin", "").split("MapInArrow")[0]
    assert tx.doc_to_ids(docs.limit(0), ids).collect() == []
    assert tx.doc_to_ids(docs, ids.limit(0)).collect() == []


def test_dictionary_grams_equal_grams_of_every_occurrence(spark):
    docs = [(1, ["apple", "apple", "ab", "éclair"]), (2, ["papple", "ab"]), (3, [])]
    df = spark.createDataFrame(docs, "doc_id long, toks array<string>")
    long = df.select("doc_id", F.explode(tx.char_ngrams("toks", 2, 4)).alias("feature"))
    counts = tx.term_frequency(df.select("doc_id", F.explode("toks").alias("term")), feature="term")
    grams = tx.gram_dictionary(counts, 2, 4)
    assert rows(tx.gram_totals(counts, grams)) == rows(long.groupBy("feature").agg(F.count(F.lit(1)).alias("count")))
    ids = tx.vocab_ids(tx.build_vocab(long, keep_top_n=6))
    assert rows(tx.gram_counts(counts, grams, ids, "doc_id", vocab_bound=6), "doc_id", "term_id", "tf") == rows(tx.count_vectors(long, ids, vocab_bound=6), "doc_id", "term_id", "tf")


def test_first_n_is_a_prefix_of_the_order(spark):
    df = spark.range(5000).select((F.col("id") % 40).alias("count"), F.md5(F.col("id").cast("string")).alias("feature")).repartition(16)
    want = [tuple(r) for r in df.orderBy(F.desc("count"), "feature").limit(300).collect()]
    got = tx.first_n(df, 300, "feature", F.desc("count"), F.asc("feature"))
    assert [tuple(r) for r in got.collect()] == want
    vocab = tx.vocab_of_totals(df, keep_top_n=300)
    assert [(r["count"], r.feature) for r in vocab.orderBy("rank").collect()] == want
    assert "rangepartitioning" not in vocab._jdf.queryExecution().executedPlan().toString()


def test_mean_embedding_modes(spark):
    toks = spark.createDataFrame([(1, 0, "a"), (1, 1, "a"), (1, 2, "b"), (1, 3, "oov")],
                                 "doc_id long, pos int, token string")
    vec = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [4.0, 3.0])], "word string, vector array<double>")
    m = dict(((d, k), v) for d, k, v in rows(tx.mean_embedding(toks, vec)))
    assert m[(1, 0)] == 2.0 and m[(1, 1)] == 1.0
    md = dict(((d, k), v) for d, k, v in rows(tx.mean_embedding(toks, vec, mode="distinct")))
    assert md[(1, 0)] == 2.5 and md[(1, 1)] == 1.5


def test_vocab_of_counts_equals_vocab_of_features(spark):
    f = _feats(spark)
    for mode in ("count", "docfreq"):
        a = rows(tx.build_vocab(f, min_df=1, keep_top_n=3, mode=mode), "feature", "count", "df", "rank")
        assert a == rows(tx.vocab_of_counts(tx.term_frequency(f), 1, 3, mode), "feature", "count", "df", "rank")
        assert [r[3] for r in sorted(a, key=lambda r: r[3])] == list(range(1, len(a) + 1))
