"""Text-feature plans (F1-F14, A10-A12, J9, S9) over ``texts`` and ``topics``."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from kestrel.functions import alpha_tokens, round6, word_tokens
from kestrel.operators import text as tx
from kestrel.plans.registry import register
from kestrel.session import materialise, scratch_path
from kestrel.sources import fixtures as fx
from kestrel.sources.files import scan_embeddings

WORD_RE = r"[\p{L}\p{N}_'']+"  # SQL literal of the word pattern (quote doubled)
VOCAB_N = 5000        # word vocabulary size (count mode)
CHAR_VOCAB_N = 5000   # character n-gram vocabulary size
MIN_COUNT = 5         # raw count above which a feature enters either vocabulary
WORD_GRAMS = (1, 3)
CHAR_GRAMS = (4, 7)
TOPIC_VOCAB_N = 5000  # topic vocabulary (document-frequency mode)
TOPIC_MIN_DF = 10


def _list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


STOP1 = _list(tx.STOPWORDS_NLP1)
STOP2 = _list(tx.STOPWORDS_NLP2)

# ------------------------------------------------------------------ SQL building blocks
_ALPHA = (f"list_filter(regexp_extract_all(text, '{WORD_RE}'), "
          "lambda x: regexp_full_match(x, '[A-Za-z]{2,}'))")
_SQL_ST = f"SELECT doc_id, split, list_filter({_ALPHA}, lambda x: NOT list_contains({STOP1}, x)) AS toks FROM texts"


def _ngram_sql(src: str, lo: int, hi: int) -> str:
    parts = []
    for n in range(lo, hi + 1):
        if n == 1:
            parts.append(f"SELECT doc_id, split, unnest(toks) AS feature FROM {src}")
        else:
            parts.append(
                f"SELECT doc_id, split, array_to_string(toks[i:i + {n - 1}], ' ') AS feature FROM "
                f"(SELECT doc_id, split, toks, unnest(generate_series(1, len(toks) - {n - 1})) AS i FROM {src})")
    return "\nUNION ALL\n".join(parts)


def _char_sql(src: str, lo: int, hi: int) -> str:
    return f"""
      SELECT doc_id, split, CASE WHEN length(w) > n THEN substr(w, i, n) ELSE w END AS feature
      FROM (SELECT doc_id, split, w, n,
                   unnest(CASE WHEN length(w) > n THEN generate_series(1, length(w) - n + 1) ELSE [1] END) AS i
            FROM (SELECT doc_id, split, unnest(toks) AS w FROM {src}),
                 (SELECT unnest(generate_series({lo}, {hi})) AS n))"""


def _vocab_count_sql(tf: str, top_n: int, min_count: int = MIN_COUNT) -> str:
    return f"""
      SELECT feature, cnt AS count, df, rank FROM (
        SELECT feature, CAST(sum(tf) AS BIGINT) AS cnt, count(*) AS df,
               row_number() OVER (ORDER BY sum(tf) DESC, feature) AS rank
        FROM {tf} WHERE split = 'train' GROUP BY feature HAVING sum(tf) > {min_count})
      WHERE rank <= {top_n}"""


_TEXT_CTES = [("st", _SQL_ST), ("ng", _ngram_sql("st", *WORD_GRAMS)), ("cg", _char_sql("st", *CHAR_GRAMS)),
              ("ngtf", "SELECT doc_id, split, feature, count(*) AS tf FROM ng GROUP BY ALL"),
              ("cgtf", "SELECT doc_id, split, feature, count(*) AS tf FROM cg GROUP BY ALL"),
              ("vocab", _vocab_count_sql("ngtf", VOCAB_N)), ("cvocab", _vocab_count_sql("cgtf", CHAR_VOCAB_N)),
              ("ntrain", "SELECT count(*) AS n FROM texts WHERE split = 'train'"),
              ("cnt", "SELECT doc_id, split, rank - 1 AS term_id, tf FROM ngtf JOIN vocab USING (feature)"),
              ("ccnt", "SELECT doc_id, split, rank - 1 AS term_id, tf FROM cgtf JOIN cvocab USING (feature)"),
              ("idf", "SELECT term_id, log10((SELECT n FROM ntrain) / count(*)) AS idf FROM cnt "
                      "WHERE split = 'train' GROUP BY term_id"),
              ("cidf", "SELECT term_id, log10((SELECT n FROM ntrain) / count(*)) AS idf FROM ccnt "
                       "WHERE split = 'train' GROUP BY term_id")]


def _tsql(body: str) -> str:
    # each step is computed once, however many later ones read it, and only those that the body needs
    needed, names = [], [name for name, _ in _TEXT_CTES]
    wanted = {n for n in names if re.search(rf"\b{n}\b", body)}
    for name, sql in reversed(_TEXT_CTES):
        if name in wanted:
            needed.insert(0, (f"{name} AS MATERIALIZED", sql))
            wanted |= {n for n in names if n != name and re.search(rf"\b{n}\b", sql)}
    lists = [f"texts AS MATERIALIZED ({fx.FIXTURE_SQL['texts']})", *(f"{name} ({sql})" for name, sql in needed)]
    return "WITH " + ",\n".join(lists) + "\n" + body


# ------------------------------------------------------------------ Spark building blocks

def _stopped(spark, sf):
    t = fx.texts(spark, sf)
    return t.select("doc_id", "split", tx.remove_stopwords(alpha_tokens("text"), tx.STOPWORDS_NLP1).alias("toks"))


def _word_feats(spark, sf):
    st = _stopped(spark, sf)
    return st.select("doc_id", "split", F.explode(tx.word_ngrams("toks", *WORD_GRAMS)).alias("feature"))


def _vocab(feats, n):
    return tx.build_vocab(feats.where("split = 'train'"), min_df=MIN_COUNT, keep_top_n=n, mode="count")


def _counted(feats, n, name):
    """(counts of features per document, ids of the first ``n`` features of the training part), both written."""
    tf = materialise(feats.groupBy("doc_id", "split", "feature").agg(F.count(F.lit(1)).alias("tf")), name)
    return tf, materialise(tx.vocab_ids(tx.vocab_of_counts(tf.where("split = 'train'"), MIN_COUNT, n)), f"{name}-ids")


def _space(feats, n, name):
    """(counts, ids) of a feature space: the vocabulary is cut from totals, and only features in it are counted per document."""
    totals = feats.where("split = 'train'").groupBy("feature").agg(F.count(F.lit(1)).alias("count"))
    ids = materialise(tx.vocab_ids(tx.vocab_of_totals(totals, MIN_COUNT, n)), f"{name}-ids")
    known = tx.filter_to_vocab(feats, ids, vocab_bound=n).groupBy("doc_id", "split", "feature").agg(F.count(F.lit(1)).alias("tf"))
    counts = known.join(tx.bounded_broadcast(ids, n), "feature").select("doc_id", "split", "term_id", "tf")
    return materialise(counts, name), ids


def _words(spark, sf):
    return _space(_word_feats(spark, sf), VOCAB_N, "word-counts")


def _chars(spark, sf):
    """The character space by dictionary: each distinct term is cut into n-grams once."""
    terms = _stopped(spark, sf).select("doc_id", "split", F.explode("toks").alias("term"))
    counts = materialise(terms.groupBy("doc_id", "split", "term").agg(F.count(F.lit(1)).alias("tf")), "term-counts")
    grams = materialise(tx.gram_dictionary(counts, *CHAR_GRAMS), "grams")
    totals = tx.gram_totals(counts.where("split = 'train'"), grams)
    ids = materialise(tx.vocab_ids(tx.vocab_of_totals(totals, MIN_COUNT, CHAR_VOCAB_N)), "char-ids")
    return tx.gram_counts(counts, grams, ids, "doc_id", "split", vocab_bound=CHAR_VOCAB_N), ids


def _n_train(spark, sf):
    return fx.texts(spark, sf).where("split = 'train'").count()


def _idf(spark, sf, counts):
    return tx.idf_log10(counts.where("split = 'train'"), _n_train(spark, sf))


def _weighted(spark, sf, space, n):
    counts, ids = space
    return tx.tfidf(counts, _idf(spark, sf, counts), vocab_bound=n), ids


# ------------------------------------------------------------------ plans

@register("tokenize_words", fx.with_views(["texts"], f"""
    SELECT doc_id, CAST(u.pos - 1 AS INTEGER) AS pos, u.token
    FROM texts, unnest(regexp_extract_all(text, '{WORD_RE}')) WITH ORDINALITY AS u(token, pos)"""))
def q_tokenize_words(spark, sf):
    return tx.explode_tokens(tx.tokenize(fx.texts(spark, sf), pattern="words"))


@register("tokenize_alpha", fx.with_views(["texts"], f"""
    SELECT doc_id, CAST(u.pos - 1 AS INTEGER) AS pos, u.token
    FROM texts, unnest(list_filter(regexp_extract_all(lower(text), '{WORD_RE}'),
                                   lambda x: regexp_full_match(x, '[A-Za-z]{{2,}}'))) WITH ORDINALITY AS u(token, pos)"""))
def q_tokenize_alpha(spark, sf):
    return tx.explode_tokens(tx.tokenize(fx.texts(spark, sf), pattern="alpha", lower=True))


@register("remove_stopwords", _tsql("""
    SELECT doc_id, CAST(u.pos - 1 AS INTEGER) AS pos, u.token
    FROM st, unnest(toks) WITH ORDINALITY AS u(token, pos)"""))
def q_remove_stopwords(spark, sf):
    return tx.explode_tokens(_stopped(spark, sf), "toks")


@register("word_ngrams", _tsql(
    "SELECT feature, count(*) AS count FROM (" + _ngram_sql("st", 1, 3) + ") GROUP BY feature"))
def q_word_ngrams(spark, sf):
    st = _stopped(spark, sf)
    return (st.select(F.explode(tx.word_ngrams("toks", 1, 3)).alias("feature"))
            .groupBy("feature").agg(F.count(F.lit(1)).alias("count")))


@register("char_ngrams", _tsql("SELECT feature, count(*) AS count FROM cg GROUP BY feature"))
def q_char_ngrams(spark, sf):
    terms = _stopped(spark, sf).select(F.explode("toks").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("tf"))
    terms = materialise(terms, "terms")
    return tx.gram_totals(terms, tx.gram_dictionary(terms, *CHAR_GRAMS))


@register("build_vocab", _tsql("SELECT * FROM vocab"))
def q_build_vocab(spark, sf):
    return _vocab(_word_feats(spark, sf), VOCAB_N).select("feature", "count", "df", "rank")


@register("vocab_ids", _tsql("SELECT feature, rank - 1 AS term_id FROM vocab"))
def q_vocab_ids(spark, sf):
    return tx.vocab_ids(_vocab(_word_feats(spark, sf), VOCAB_N))


@register("filter_to_vocab", _tsql(
    "SELECT doc_id, feature, count(*) AS tf FROM ng WHERE feature IN (SELECT feature FROM vocab) GROUP BY ALL"))
def q_filter_to_vocab(spark, sf):
    tf, ids = _counted(_word_feats(spark, sf), VOCAB_N, "word-counts")
    return tx.filter_to_vocab(tf, ids, vocab_bound=VOCAB_N).select("doc_id", "feature", "tf")


@register("count_vectors", _tsql("SELECT doc_id, term_id, tf FROM cnt"))
def q_count_vectors(spark, sf):
    return _words(spark, sf)[0].select("doc_id", "term_id", "tf")


@register("idf_log10", _tsql("SELECT term_id, round(idf, 6) AS idf FROM idf"))
def q_idf_log10(spark, sf):
    return _idf(spark, sf, _words(spark, sf)[0]).select("term_id", round6(F.col("idf")).alias("idf"))


@register("tfidf_vectors", _tsql(
    "SELECT doc_id, term_id, round(tf * idf, 6) AS tfidf FROM cnt JOIN idf USING (term_id)"))
def q_tfidf_vectors(spark, sf):
    wt, _ = _weighted(spark, sf, _words(spark, sf), VOCAB_N)
    return wt.select("doc_id", "term_id", round6(F.col("tfidf")).alias("tfidf"))


@register("concat_feature_spaces", _tsql(f"""
    SELECT doc_id, term_id, round(tf * idf, 6) AS tfidf FROM cnt JOIN idf USING (term_id)
    UNION ALL
    SELECT doc_id, term_id + (SELECT count(*) FROM vocab) AS term_id, round(tf * idf, 6) AS tfidf
    FROM ccnt JOIN cidf USING (term_id)"""))
def q_concat_feature_spaces(spark, sf):
    wt, ids = _weighted(spark, sf, _words(spark, sf), VOCAB_N)
    ct, _ = _weighted(spark, sf, _chars(spark, sf), CHAR_VOCAB_N)
    out = tx.concat_spaces([(wt, ids.count()), (ct, CHAR_VOCAB_N)], "tfidf")
    return out.select("doc_id", "term_id", round6(F.col("tfidf")).alias("tfidf"))


@register("term_frequency", fx.with_views(["texts"], f"""
    SELECT doc_id, token, count(*) AS tf
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{WORD_RE}')) AS token FROM texts) GROUP BY ALL"""))
def q_term_frequency(spark, sf):
    toks = tx.explode_tokens(tx.tokenize(fx.texts(spark, sf)))
    return tx.term_frequency(toks, feature="token")


@register("document_frequency", fx.with_views(["texts"], f"""
    SELECT token, count(DISTINCT doc_id) AS df, count(*) AS count
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{WORD_RE}')) AS token FROM texts) GROUP BY token"""))
def q_document_frequency(spark, sf):
    toks = tx.explode_tokens(tx.tokenize(fx.texts(spark, sf)))
    return tx.document_frequency(toks, feature="token")


@register("collection_size", fx.with_views(["texts"], "SELECT count(DISTINCT doc_id) AS n_docs FROM texts"))
def q_collection_size(spark, sf):
    return spark.range(1).select(F.lit(tx.collection_size(fx.texts(spark, sf))).cast("bigint").alias("n_docs"))


# ---- topic vocabulary (document-frequency mode, lower-cased, second stop list)

_TOPIC_TOK = (f"list_filter(list_filter(regexp_extract_all(lower(text), '{WORD_RE}'), "
              f"lambda x: regexp_full_match(x, '[A-Za-z]{{2,}}')), lambda x: NOT list_contains({STOP2}, x))")
_TOPIC_CTES = [
    ("tt", f"SELECT doc_id, split, u.token, CAST(u.pos - 1 AS INTEGER) AS pos FROM topics, "
           f"unnest({_TOPIC_TOK}) WITH ORDINALITY AS u(token, pos)"),
    ("tstats", "SELECT token AS feature, count(*) AS cnt, count(DISTINCT doc_id) AS df, "
               "row_number() OVER (ORDER BY count(*) DESC, token) AS r FROM tt WHERE split = 'train' GROUP BY token"),
    ("tvocab", f"SELECT feature, cnt AS count, df, row_number() OVER (ORDER BY cnt DESC, feature) AS rank "
               f"FROM tstats WHERE r <= {TOPIC_VOCAB_N} AND df >= {TOPIC_MIN_DF}"),
]


def _topsql(body: str) -> str:
    return fx.with_views(["topics"], body, _TOPIC_CTES)


def _topic_tokens(spark, sf):
    t = fx.topics(spark, sf)
    toks = tx.remove_stopwords(alpha_tokens("text", lower=True), tx.STOPWORDS_NLP2)
    return t.select("doc_id", "split", "label", F.posexplode(toks).alias("pos", "token"))


def _topic_vocab(spark, sf):
    tt = _topic_tokens(spark, sf).where("split = 'train'")
    return tx.build_vocab(tt.withColumnRenamed("token", "feature"), min_df=TOPIC_MIN_DF,
                          keep_top_n=TOPIC_VOCAB_N, mode="docfreq")


@register("build_vocab_docfreq", _topsql("SELECT * FROM tvocab"))
def q_build_vocab_docfreq(spark, sf):
    return _topic_vocab(spark, sf).select("feature", "count", "df", "rank")


@register("join_vocab_ids", _topsql(
    "SELECT doc_id, pos, rank - 1 AS term_id FROM tt JOIN tvocab ON tt.token = tvocab.feature"))
def q_join_vocab_ids(spark, sf):
    ids = tx.vocab_ids(_topic_vocab(spark, sf)).withColumnRenamed("feature", "token")
    # the vocabulary is cut to its top TOPIC_VOCAB_N entries: a bounded broadcast
    return _topic_tokens(spark, sf).join(tx.bounded_broadcast(ids, TOPIC_VOCAB_N), "token").select(
        "doc_id", "pos", "term_id")


@register("doc_to_ids", _topsql(
    "SELECT doc_id, string_agg(CAST(rank - 1 AS VARCHAR), ' ' ORDER BY pos) AS ids "
    "FROM tt JOIN tvocab ON tt.token = tvocab.feature GROUP BY doc_id"))
def q_doc_to_ids(spark, sf):
    toks = tx.remove_stopwords(alpha_tokens("text", lower=True), tx.STOPWORDS_NLP2)
    d = tx.doc_to_ids(fx.topics(spark, sf).select("doc_id", toks.alias("tokens")), tx.vocab_ids(_topic_vocab(spark, sf)))
    return d.select("doc_id", F.array_join(F.transform("ids", lambda i: i.cast("string")), " ").alias("ids"))


# ---- word vectors

_WV_DIM = 8
_WV_SQL = ("SELECT word, [CAST(('0x' || substr(md5(word), 2 * i + 1, 2))::INTEGER / 255.0 AS FLOAT) "
           f"FOR i IN range({_WV_DIM})] AS vector FROM "
           f"(SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{WORD_RE}')) AS word FROM documents)")
_TL_SQL = (f"SELECT doc_id, u.word FROM texts, unnest(regexp_extract_all(lower(text), '{WORD_RE}')) "
           "AS u(word)")


@register("mean_embedding", fx.with_views(["texts"], """
    SELECT doc_id, CAST(d.i - 1 AS INTEGER) AS dim, round(avg(CAST(d.x AS DOUBLE)), 6) AS value
    FROM tl JOIN wv USING (word), unnest(wv.vector) WITH ORDINALITY AS d(x, i) GROUP BY ALL""",
    [("wv", _WV_SQL), ("tl", _TL_SQL)]))
def q_mean_embedding(spark, sf):
    t = fx.texts(spark, sf).select("doc_id", F.explode(word_tokens("text", lower=True)).alias("token"))
    e = tx.mean_embedding(t, fx.word_vectors(spark, sf))
    return e.select("doc_id", "dim", round6(F.col("value")).alias("value"))


@register("mean_embedding_distinct", fx.with_views(["texts"], """
    SELECT doc_id, CAST(d.i - 1 AS INTEGER) AS dim, round(avg(CAST(d.x AS DOUBLE)), 6) AS value
    FROM (SELECT DISTINCT doc_id, word FROM tl) JOIN wv USING (word),
         unnest(wv.vector) WITH ORDINALITY AS d(x, i) GROUP BY ALL""",
    [("wv", _WV_SQL), ("tl", _TL_SQL)]))
def q_mean_embedding_distinct(spark, sf):
    t = fx.texts(spark, sf).select("doc_id", F.explode(word_tokens("text", lower=True)).alias("token"))
    e = tx.mean_embedding(t, fx.word_vectors(spark, sf), mode="distinct")
    return e.select("doc_id", "dim", round6(F.col("value")).alias("value"))


@register("scan_embeddings", fx.with_views(["texts", "topics"], """
    SELECT v.feature AS word, CAST(d.i - 1 AS INTEGER) AS dim, round(CAST(d.x AS DOUBLE), 6) AS value
    FROM tvocab v LEFT JOIN wv ON wv.word = v.feature,
         unnest(coalesce(wv.vector, [0, 0, 0, 0, 0, 0, 0, 0]::FLOAT[])) WITH ORDINALITY AS d(x, i)""",
    [("wv", _WV_SQL)] + _TOPIC_CTES))
def q_scan_embeddings(spark, sf):
    """Word-vector text file written by Spark from the texts, read back for
    the topic vocabulary: absent words get the zero vector."""
    lines = fx.word_vectors(spark, sf).select(
        F.concat_ws(" ", F.col("word"), F.array_join(F.transform("vector", lambda x: x.cast("string")), " "))
        .alias("value"))
    path = scratch_path(spark, "word-vectors")
    lines.write.mode("overwrite").text(path)
    vocab = _topic_vocab(spark, sf).select(F.col("feature").alias("word"))
    vec = scan_embeddings(spark, path, vocab, _WV_DIM)
    return vec.select("word", F.posexplode("vector").alias("dim", "x")).select(
        "word", "dim", round6(F.col("x")).alias("value"))
