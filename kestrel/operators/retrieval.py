"""Document retrieval (S8, A13, J6, R1-R5) and passage containment.

Postings are a long table ``(term, docid, tf)``, kept in an ``index``; a query batch is
``(qid, term, qtf)``. ``score`` gives every document that shares a term with a query:
query terms x postings -> partial sums by (qid, docid) -> join with document norms.
``retrieve`` gives the best k of them without forming all those pairs (``topk``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions import WORD_PATTERN, word_tokens
from kestrel.operators.index import Index, hits
from kestrel.operators.text import remove_stopwords
from kestrel.session import materialise

#: Documents whose terms one task sorts, at most.
TASK_DOCS = 1 << 13


def terms(df: DataFrame, id_col: str, text: str = "text", stopwords: Sequence[str] | None = None,
          lower: bool = True) -> DataFrame:
    """(id, term) one row per token occurrence: lower-cased word tokens,
    stop words removed when a list is given (R5 configuration)."""
    toks = word_tokens(text, lower)
    if stopwords:
        toks = remove_stopwords(toks, stopwords)
    return df.select(F.col(id_col), F.explode(toks).alias("term"))


def build_postings(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                   stopwords: Sequence[str] | None = None) -> DataFrame:
    """(term, docid, tf) (S8), the postings of a document in one partition: the texts are dealt by document before they are
    cut into terms, which moves less than their terms would."""
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // TASK_DOCS))
    t = terms(docs.select(id_col, text).repartition(n, id_col), id_col, text, stopwords).withColumnRenamed(id_col, "docid")
    return t.groupBy("term", "docid").agg(F.count(F.lit(1)).alias("tf"))


def query_terms(queries: DataFrame, id_col: str = "qid", text: str = "text",
                stopwords: Sequence[str] | None = None) -> DataFrame:
    """(qid, term, qtf): query term counts (repeats kept as qtf)."""
    t = terms(queries, id_col, text, stopwords).withColumnRenamed(id_col, "qid")
    return t.groupBy("qid", "term").agg(F.count(F.lit(1)).alias("qtf"))


def document_frequency(postings: DataFrame) -> DataFrame:
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def idf_ln(postings: DataFrame, n_docs: int) -> DataFrame:
    """(term, idf) with idf = ln(N / df)."""
    return document_frequency(postings).select("term", F.log(F.lit(float(n_docs)) / F.col("df")).alias("idf"))


def doc_norms(postings: DataFrame, weighting: str, idf: DataFrame | None = None) -> DataFrame:
    """(docid, norm_sq) (A13): number of terms (binary), sum tf^2 (tf) or
    sum (tf * idf)^2 (tfidf)."""
    if weighting == "binary":
        return postings.groupBy("docid").agg(F.count(F.lit(1)).cast("double").alias("norm_sq"))
    if weighting == "tf":
        return postings.groupBy("docid").agg(F.sum(F.col("tf") * F.col("tf")).cast("double").alias("norm_sq"))
    w = postings.join(idf, "term").select("docid", (F.col("tf") * F.col("idf")).alias("w"))
    return w.groupBy("docid").agg(F.sum(F.col("w") * F.col("w")).alias("norm_sq"))


def score(index: Index, qterms: DataFrame, weighting: str = "tfidf", mode: str = "fixed") -> DataFrame:
    """(qid, docid, score) for every document sharing a term with the query.

    * binary: |q terms in d| / sqrt(|d|); ``mode='literal'`` reproduces the
      original: numerator 1 only when at least two query tokens hit, norm 1
      only when the document has two or more terms (0 -> NULL score);
    * tf: sum over query tokens of tf / sqrt(sum tf^2);
    * tfidf: sum qtf * idf * tf * idf / sqrt(sum (tf idf)^2); ``mode='literal'``
      uses qtf^2 (a repeated query term counted once per repeat).

    A frequent term meets its postings in several tasks (``index.by_salt``).
    """
    found = hits(index, qterms)
    norm = F.col(weighting)
    if weighting == "binary":
        if mode == "literal":
            value = F.when(F.sum("qtf") >= 2, F.lit(1.0)).otherwise(F.lit(0.0))
            norm = F.when(F.col("binary") >= 2, F.lit(1.0)).otherwise(F.lit(0.0))
        else:
            value = F.count(F.lit(1)).cast("double")
    elif weighting == "tf":
        value = F.sum(F.col("qtf") * F.col("tf")).cast("double")
    else:
        idf = F.log(F.lit(float(max(index.n_docs, 1))) / F.col("df"))
        weighted = qterms.join(index.terms, "term").withColumn("idf", idf).drop("df")
        found = hits(index, weighted.withColumn("qtf", F.struct("qtf", "idf"))).select(
            "qid", "docid", "tf", F.col("qtf.qtf").alias("qtf"), F.col("qtf.idf").alias("idf"))
        qpow = F.col("qtf") * F.col("qtf") if mode == "literal" else F.col("qtf")
        value = F.sum(qpow * F.col("idf") * F.col("idf") * F.col("tf"))
    num = found.groupBy("qid", "docid").agg(value.alias("num"))
    j = num.join(index.norms.select("docid", norm.alias("norm_sq")), "docid")  # J6: numerator x document norm
    return j.select("qid", "docid", F.try_divide(F.col("num"), F.sqrt("norm_sq")).alias("score"))


def rank_top(scores: DataFrame, k: int = 10) -> DataFrame:
    """(qid, docid, score, rank): best k per query, ties by docid.
    ``row_number <= k`` is cut per task before the shuffle (WindowGroupLimit)."""
    # rounded, so that documents of equal weight tie whatever the order of summation
    w = Window.partitionBy("qid").orderBy(F.desc_nulls_last(F.round("score", 9)), F.asc("docid"))
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def retrieve(index: Index, qterms: DataFrame, weighting: str = "tfidf", k: int = 10,
             mode: str = "fixed") -> DataFrame:
    """(qid, docid, score, rank): the rows of ``rank_top(score(...), k)``, without moving the pairs that it forms."""
    from kestrel.operators import topk

    return topk.best(index, qterms, weighting, k, mode)


# ------------------------------------------------------------------ containment

_WORD_CHARS = r"\p{L}\p{N}_'"
# a whole token with a non-word character on both sides
_INTERIOR = rf"(?<=[^{_WORD_CHARS}]){WORD_PATTERN}(?=[^{_WORD_CHARS}])"


def containing_documents(passages: DataFrame, docs: DataFrame, key_len: int = 3,
                         pid: str = "qid", did: str = "doc_id") -> DataFrame:
    """(qid, docid) for each document whose text contains the whole passage.

    A document containing the passage contains every *interior* token of the
    passage (one with a non-word character on both sides) as a complete token,
    in order. So every run of ``key_len`` interior tokens is an exact join key
    against the token k-grams of the documents, and the rarest one of a passage
    is used: a common opening phrase does not pair it with every document that
    has the phrase. Candidates are verified with ``contains`` on the full texts.

    A passage without an interior token (at most two tokens, no delimiter
    around them) is keyed instead by its first ``CHAR_KEY`` characters against
    the distinct character grams of each document; that scan runs only when
    such passages exist. An empty passage has no key and matches nothing.
    """
    p = passages.select(F.col(pid).alias("qid"), F.col("text").alias("ptext"))
    inner = F.regexp_extract_all(F.col("ptext"), F.lit(_INTERIOR), 0)
    texts = docs.select(F.col(did).alias("docid"), F.col("text").alias("dtext"))
    short = F.least(F.size("toks"), F.lit(key_len))
    runs = p.select("qid", inner.alias("toks")).where(F.size("toks") > 0).withColumn("k", short)
    ks = [r.k for r in runs.select("k").distinct().collect()]  # at most key_len values
    out = p.join(texts.limit(0), F.lit(False)).select("qid", "docid") if not ks else None
    if ks:
        pick = F.lit(None).cast("array<string>")
        for k in ks:
            pick = F.when(F.col("k") == k, _kgrams(k)).otherwise(pick)
        keys = runs.select("qid", "k", F.explode(F.array_distinct(pick)).alias("key"))
        d = docs.select(F.col(did).alias("docid"), word_tokens("text").alias("toks"))
        found = None
        for k in ks:
            # the tokens at a place and after it are joined as they are: no string is made for a run that is no key
            at = [f"t{i}" for i in range(k)]
            shifted = [F.slice("toks", i + 1, F.greatest(F.size("toks"), F.lit(0))).alias(a) for i, a in enumerate(at)]
            placed = d.select("docid", F.inline(F.arrays_zip(*shifted)).alias(*at))
            parts = F.split("key", " ")
            wanted = keys.where(F.col("k") == k).select("k", "key").distinct().select("k", "key", *[parts[i].alias(a) for i, a in enumerate(at)])
            g = placed.join(wanted, at).select("k", "key", "docid")
            found = g if found is None else found.unionByName(g)
        found = materialise(found.distinct(), "passage-keys")
        often = found.groupBy("k", "key").agg(F.count(F.lit(1)).alias("n"))
        # a key that no document has is the rarest of all: its passage has no document
        rarest = (keys.join(often, ["k", "key"], "left").groupBy("qid")
                  .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "k", "key")).alias("best")).select("qid", "best.k", "best.key"))
        # written, so that the planner knows how few they are before it moves the texts
        cand = materialise(found.join(rarest, ["k", "key"]).select("qid", "docid").distinct(), "candidates")
        ver = cand.join(texts, "docid").join(p, "qid").where(F.contains(F.col("dtext"), F.col("ptext")))
        out = ver.select("qid", "docid")
    loose = p.where((F.size(inner) == 0) & (F.length("ptext") > 0))
    if loose.head(1):
        out = out.unionByName(_contain_by_chars(loose, texts))
    return out


CHAR_KEY = 3


def _contain_by_chars(passages: DataFrame, texts: DataFrame) -> DataFrame:
    """Exact containment for passages that token keys cannot reach: join the
    passage's leading character gram (length min(len, CHAR_KEY)) with the
    distinct character grams of that length in each document, verify with
    ``contains``."""
    keyed = passages.select("qid", "ptext", F.least(F.length("ptext"), F.lit(CHAR_KEY)).alias("k"))
    keyed = keyed.select("qid", "ptext", "k", F.substr("ptext", F.lit(1), F.col("k")).alias("key"))
    ks = [r.k for r in keyed.select("k").distinct().collect()]  # at most CHAR_KEY values
    grams = None
    for k in ks:
        idx = F.sequence(F.lit(1), F.length("dtext") - k + 1)
        g = texts.where(F.length("dtext") >= k).select(
            "docid", F.explode(F.array_distinct(F.transform(idx, _char_at(k)))).alias("key")).withColumn("k", F.lit(k))
        grams = g if grams is None else grams.unionByName(g)
    cand = grams.join(keyed.select("qid", "k", "key"), ["k", "key"]).select("qid", "docid")
    ver = (cand.distinct().join(texts, "docid").join(keyed.select("qid", "ptext"), "qid")
           .where(F.contains(F.col("dtext"), F.col("ptext"))))
    return ver.select("qid", "docid")


def _char_at(k: int):
    def f(i):
        return F.substr(F.col("dtext"), i, F.lit(k))

    return f


def _kgrams(k: int):
    t = F.col("toks")
    if k == 1:
        return t
    idx = F.sequence(F.lit(1), F.size(t) - k + 1)

    def at(i):
        return F.array_join(F.slice(t, i, F.lit(k)), " ")

    return F.when(F.size(t) >= k, F.transform(idx, at)).otherwise(F.array().cast("array<string>"))

