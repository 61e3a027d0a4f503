"""Text features (F1-F14, A9-A13): tokens, stop words, word and character
n-grams, vocabularies, count / tf-idf vectors in long form, document id lists
and mean embeddings.

Long tables ``(doc_id, feature, value)`` are the sparse representation: a
document-term matrix is never materialised densely, and every step is a
projection, a join on the term, or an aggregation by (doc, term).
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions import alpha_tokens, word_tokens

# fixed values: the two stop-word lists. The first is case-sensitive and, as
# written, joins 'they' and 'will' into one entry 'theywill'.
STOPWORDS_NLP1 = ['a', 'in', 'on', 'at', 'and', 'or',
                  'to', 'the', 'of', 'an', 'by',
                  'as', 'is', 'was', 'were', 'been', 'be',
                  'are', 'for', 'this', 'that', 'these', 'those', 'you', 'i',
                  'it', 'he', 'she', 'we', 'theywill', 'have', 'has',
                  'do', 'did', 'can', 'could', 'who', 'which', 'what',
                  'his', 'her', 'they', 'them', 'from', 'with', 'its', 'The', 'will', 'about']
# fixed values: the second list (applied to lower-cased text)
STOPWORDS_NLP2 = ['a', 'in', 'on', 'at', 'and', 'or',
                  'to', 'the', 'of', 'an', 'by',
                  'as', 'is', 'was', 'were', 'been', 'be',
                  'are', 'for', 'this', 'that', 'these', 'those', 'you', 'i', 'if',
                  'it', 'he', 'she', 'we', 'they', 'will', 'have', 'has',
                  'do', 'did', 'can', 'could', 'who', 'which', 'what',
                  'but', 'not', 'there', 'no', 'does', 'not', 'so', 've', 'their',
                  'his', 'her', 'they', 'them', 'from', 'with', 'its']

def bounded_broadcast(df: DataFrame, bound: int | None) -> DataFrame:
    """Broadcast ``df`` when the caller has cut it to a constant number of rows (a
    top-N vocabulary, a fixed word list). Without such a bound the join is left to
    the planner and AQE, which broadcast only what they have measured to be small."""
    return F.broadcast(df) if bound is not None else df


def tokenize(df: DataFrame, text: str = "text", pattern: str = "words", lower: bool = False,
             keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Array column ``tokens`` per row (F1 ``words``: Unicode word runs with
    apostrophes; F2 ``alpha``: ASCII letter words of length >= 2)."""
    toks = word_tokens(text, lower) if pattern == "words" else alpha_tokens(text, lower)
    return df.select(*keep, toks.alias("tokens"))


def explode_tokens(df: DataFrame, tokens: str = "tokens", keep: Sequence[str] = ("doc_id",),
                   out: str = "token") -> DataFrame:
    """Long form (keep..., pos, token); pos is 0-based."""
    return df.select(*keep, F.posexplode(tokens).alias("pos", out))


def remove_stopwords(tokens: Column | str, stopwords: Sequence[str], case_sensitive: bool = True) -> Column:
    """Drop listed words from a token array."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    stop = [w if case_sensitive else w.lower() for w in stopwords]  # looked up in a set
    if case_sensitive:
        return F.filter(t, lambda w: ~w.isin(stop))
    return F.filter(t, lambda w: ~F.lower(w).isin(stop))


# Higher-order-function bodies are built by factories: a Python lambda with a
# default argument would be taken for the (element, index) form.
def _gram_at(t: Column, n: int, sep: str):
    def f(i):
        return F.array_join(F.slice(t, i, F.lit(n)), sep)

    return f


def _chars_of(n: int):
    def f(w):
        subs = F.transform(F.sequence(F.lit(1), F.length(w) - n + 1), lambda i: F.substr(w, i, F.lit(n)))
        return F.when(F.length(w) > n, subs).otherwise(F.array(w))

    return f


def word_ngrams(tokens: Column | str, lo: int, hi: int, sep: str = " ") -> Column:
    """All n-grams for n in lo..hi (F4), n ascending then position, joined by
    ``sep``. Computed inside the row: the document never leaves its task."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    per_n = []
    for n in range(lo, hi + 1):
        if n == 1:
            per_n.append(t)
        else:
            idx = F.sequence(F.lit(1), F.size(t) - n + 1)
            grams = F.transform(idx, _gram_at(t, n, sep))
            per_n.append(F.when(F.size(t) >= n, grams).otherwise(F.array().cast("array<string>")))
    return F.flatten(F.array(*per_n))


def char_ngrams(tokens: Column | str, lo: int, hi: int) -> Column:
    """Character n-grams inside each term for n in lo..hi (F5): a term no longer
    than n is emitted whole, once per such n."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    per_n = []
    for n in range(lo, hi + 1):
        per_n.append(F.flatten(F.transform(t, _chars_of(n))))
    return F.flatten(F.array(*per_n))


def gram_dictionary(terms: DataFrame, lo: int, hi: int, term: str = "term") -> DataFrame:
    """(term, feature, times): the character n-grams of each distinct term, cut once however often the term occurs."""
    grams = terms.select(term).distinct().select(term, F.explode(char_ngrams(F.array(term), lo, hi)).alias("feature"))
    return grams.groupBy(term, "feature").agg(F.count(F.lit(1)).alias("times"))


def gram_totals(term_counts: DataFrame, grams: DataFrame, term: str = "term", tf: str = "tf") -> DataFrame:
    """(feature, count): occurrences of each n-gram, from the totals of the terms that hold it."""
    totals = term_counts.groupBy(term).agg(F.sum(tf).alias("total"))
    return totals.join(grams, term).groupBy("feature").agg(F.sum(F.col("total") * F.col("times")).alias("count"))


def gram_counts(term_counts: DataFrame, grams: DataFrame, ids: DataFrame, *keep: str, term: str = "term", tf: str = "tf",
                vocab_bound: int | None = None) -> DataFrame:
    """(keep..., term_id, tf): counts of the n-grams in the vocabulary ``ids`` per document. A document's term meets one row,
    with the ids of its n-grams in it; n-grams outside the vocabulary never form a row of a document."""
    known = grams.join(bounded_broadcast(ids, vocab_bound), "feature").groupBy(term).agg(F.collect_list(F.struct("term_id", "times")).alias("known"))
    return (term_counts.join(known, term).select(*keep, tf, F.inline("known"))
            .groupBy(*keep, "term_id").agg(F.sum(F.col(tf) * F.col("times")).alias("tf")))


def features_long(df: DataFrame, features: str, doc: str = "doc_id") -> DataFrame:
    """(doc_id, feature) one row per occurrence."""
    return df.select(doc, F.explode(features).alias("feature"))


def term_frequency(feats: DataFrame, doc: str = "doc_id", feature: str = "feature") -> DataFrame:
    """(doc_id, feature, tf) (A10); partial counts per task before the shuffle."""
    return feats.groupBy(doc, feature).agg(F.count(F.lit(1)).alias("tf"))


def document_frequency(feats: DataFrame, doc: str = "doc_id", feature: str = "feature") -> DataFrame:
    """(feature, df, count): distinct documents and raw occurrences (A11),
    from the (doc, feature) counts so no distinct-set is kept per feature."""
    tf = term_frequency(feats, doc, feature)
    return tf.groupBy(feature).agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("count"))


def collection_size(df: DataFrame, doc: str = "doc_id") -> int:
    """Number of distinct documents (A12), as a scalar."""
    return df.select(doc).distinct().count()


def build_vocab(feats: DataFrame, min_df: int = 0, keep_top_n: int = 0, mode: str = "count",
                doc: str = "doc_id", feature: str = "feature") -> DataFrame:
    """Vocabulary (F7) with (feature, count, df, rank), rank 1 = most frequent.

    * ``mode='count'``: raw count > min_df, the first ``keep_top_n`` by count;
    * ``mode='docfreq'``: document frequency >= min_df, intersected with the
      top ``keep_top_n`` by raw count.
    Ties are broken by the feature text. ``keep_top_n=0`` keeps all.
    """
    return vocab_of_counts(term_frequency(feats, doc, feature), min_df, keep_top_n, mode, feature)


#: Groups in which the first rows are cut before they meet in one task.
_HEADS = 64


def first_n(df: DataFrame, n: int, key: str, *order: Column) -> DataFrame:
    """The first ``n`` rows of ``order``: cut in each task, then in each of ``_HEADS`` groups by ``key``, then once more, so that
    no task receives more than ``_HEADS`` * n rows, whatever the number of tasks (a plain limit sends n rows of every task
    to one)."""
    group = F.pmod(F.xxhash64(key), F.lit(_HEADS))
    heads = df.withColumn("_place", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_place") <= n)
    return heads.drop("_place").orderBy(*order).limit(n)


def vocab_of_counts(tf: DataFrame, min_df: int = 0, keep_top_n: int = 0, mode: str = "count",
                    feature: str = "feature") -> DataFrame:
    """``build_vocab`` from (doc, feature, tf) counts that are there already."""
    return vocab_of_totals(tf.groupBy(feature).agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("count")), min_df, keep_top_n, mode, feature)


def vocab_of_totals(stats: DataFrame, min_df: int = 0, keep_top_n: int = 0, mode: str = "count",
                    feature: str = "feature") -> DataFrame:
    """``build_vocab`` from (feature, df, count) totals; without ``df`` in count mode if there is none. With a size the
    features are cut, not sorted, and only the ``keep_top_n`` rows that are left get their ranks in one task; a whole
    vocabulary is ranked by the distributed ordinal."""
    from kestrel.operators.splits import ordinal_by

    order = [F.desc("count"), F.asc(feature)]
    if mode == "count":
        stats = stats.where(F.col("count") > min_df)
    if keep_top_n:
        kept = first_n(stats, keep_top_n, feature, *order)
        if mode != "count":
            kept = kept.where(F.col("df") >= min_df)  # ids stay contiguous after the document-frequency cut
        return kept.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long"))
    if mode != "count":
        stats = stats.where(F.col("df") >= min_df)
    return ordinal_by(stats.withColumn("_neg", -F.col("count")), ["_neg", feature], "rank").drop("_neg")


def vocab_ids(vocab: DataFrame, feature: str = "feature") -> DataFrame:
    """(feature, term_id) with ids 0.. in vocabulary rank order (F8)."""
    return vocab.select(feature, (F.col("rank") - 1).alias("term_id"))


def filter_to_vocab(feats: DataFrame, vocab: DataFrame, feature: str = "feature",
                    vocab_bound: int | None = None) -> DataFrame:
    """Keep feature occurrences that are in the vocabulary (F6, exact match)."""
    return feats.join(bounded_broadcast(vocab.select(feature), vocab_bound), feature, "left_semi")


def count_vectors(feats: DataFrame, ids: DataFrame, doc: str = "doc_id", feature: str = "feature",
                  vocab_bound: int | None = None) -> DataFrame:
    """(doc_id, term_id, tf) sparse counts over the vocabulary."""
    return counts_in_vocab(term_frequency(feats, doc, feature), ids, doc, feature, vocab_bound)


def counts_in_vocab(tf: DataFrame, ids: DataFrame, doc: str = "doc_id", feature: str = "feature",
                    vocab_bound: int | None = None) -> DataFrame:
    """``count_vectors`` from (doc, feature, tf) counts that are there already."""
    return tf.join(bounded_broadcast(ids, vocab_bound), feature).select(doc, "term_id", "tf")


def idf_log10(counts: DataFrame, n_docs: int, doc: str = "doc_id") -> DataFrame:
    """(term_id, idf) with idf = log10(N / df) over the documents of ``counts``."""
    df_ = counts.groupBy("term_id").agg(F.count(F.lit(1)).alias("df"))
    return df_.select("term_id", F.log10(F.lit(float(n_docs)) / F.col("df")).alias("idf"))


def tfidf(counts: DataFrame, idf: DataFrame, doc: str = "doc_id", vocab_bound: int | None = None) -> DataFrame:
    """(doc_id, term_id, tfidf) = tf x idf."""
    return counts.join(bounded_broadcast(idf, vocab_bound), "term_id").select(
        doc, "term_id", (F.col("tf") * F.col("idf")).alias("tfidf"))


def concat_spaces(spaces: Sequence[tuple[DataFrame, int]], value: str, doc: str = "doc_id") -> DataFrame:
    """Side-by-side feature spaces (F12): each (long table, its width) gets
    its term ids shifted past the previous spaces."""
    out = None
    offset = 0
    for df, width in spaces:
        part = df.select(doc, (F.col("term_id") + F.lit(offset)).alias("term_id"), F.col(value))
        out = part if out is None else out.unionByName(part)
        offset += width
    return out


def doc_to_ids(docs: DataFrame, ids: DataFrame, doc: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """(doc_id, ids array) in token order, out-of-vocabulary words dropped (F13). ``docs`` has the tokens as an array, and
    ``ids`` (feature, term_id) is a bounded vocabulary: it is broadcast, and each batch of documents is looked up in it as it
    lies, without a row for each token and without a shuffle. Documents without a known word are left out."""
    got = ids.select("feature", F.col("term_id").cast("long")).toArrow()
    shared = docs.sparkSession.sparkContext.broadcast((got["feature"].to_pylist(), got["term_id"].to_pylist()))

    def run(batches):
        words, numbers = (pa.array(x, t) for x, t in zip(shared.value, (pa.string(), pa.int64())))
        for batch in batches:
            lists = batch.column(1)
            found = numbers.take(pc.index_in(lists.flatten(), value_set=words))
            known = found.is_valid()
            # known words before each place give where a document's ids begin and end
            before = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(known.cast(pa.int64()))])
            ends = pc.cumulative_sum(pc.fill_null(lists.value_lengths(), 0)).cast(pa.int64())
            offsets = before.take(pa.concat_arrays([pa.array([0], pa.int64()), ends]))
            out = pa.ListArray.from_arrays(offsets.cast(pa.int32()), found.filter(known))
            some = pc.greater(out.value_lengths(), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), out], [doc, "ids"]).filter(some)

    schema = T.StructType([docs.schema[doc], T.StructField("ids", T.ArrayType(T.LongType()))])
    return docs.select(doc, tokens).mapInArrow(run, schema)


def mean_embedding(tokens_long: DataFrame, vectors: DataFrame, mode: str = "tokens", doc: str = "doc_id",
                   token: str = "token", word: str = "word", vector: str = "vector") -> DataFrame:
    """(doc_id, dim, value): mean of the word vectors of a document.

    ``mode='tokens'`` averages over token occurrences (the stated intent);
    ``mode='distinct'`` counts each distinct word once. Words without a vector
    are skipped.
    """
    # one row for each word of a document before the join, whatever its number of occurrences
    t = tokens_long.groupBy(doc, F.col(token).alias(word)).agg(F.count(F.lit(1)).alias("n"))
    if mode == "distinct":
        t = t.withColumn("n", F.lit(1))
    # whole vectors are added up in each task; a document leaves it as one row
    weighted = t.join(vectors.select(word, array_to_vector(F.col(vector).cast("array<double>")).alias("v")), word)
    means = weighted.groupBy(doc).agg(Summarizer.mean(F.col("v"), F.col("n").cast("double")).alias("mean"))
    return means.select(doc, F.posexplode(vector_to_array("mean")).alias("dim", "value"))
