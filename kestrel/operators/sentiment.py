"""Naive Bayes and lexicon sentiment.

Inputs are long token tables ``(doc_id, pos, word)`` plus a label table.
Scores are sums of logs per document, so no product underflows to zero; the
decision is the same as comparing the two products.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.text import bounded_broadcast

# fixed values: modifier words of the rule-based scorer and their weights
NEGATIONS = ["not"]
INTENSIFIERS = ["definitely", "very", "extremely"]
DIMINISHERS = ["somewhat", "barely", "rarely"]
NEGATION_WEIGHT = -1.0
INTENSIFIER_WEIGHT = 2.0
DIMINISHER_WEIGHT = 1.0 / INTENSIFIER_WEIGHT  # 0.5
CAPS_WEIGHT = 2.0
MIN_P_WORD = 1e-8


def token_totals(tokens: DataFrame, label: str = "label") -> DataFrame:
    """One row: all / positive / negative token totals."""
    return tokens.agg(F.count(F.lit(1)).alias("n_all"),
                      F.count_if(F.col(label) == 1).alias("n_pos"),
                      F.count_if(F.col(label) == 0).alias("n_neg"))


def nb_train(tokens: DataFrame, word: str = "word", label: str = "label") -> DataFrame:
    """(word, c_pos, c_neg, p_pos, p_neg, p_word) (B1).

    A class count of zero becomes 1 (not add-one smoothing); denominators are
    the raw token totals of each class and of the corpus.
    """
    counts = tokens.groupBy(word).agg(F.count_if(F.col(label) == 1).alias("c_pos"),
                                      F.count_if(F.col(label) == 0).alias("c_neg"))
    tot = token_totals(tokens, label).first()
    fpos = F.greatest(F.col("c_pos"), F.lit(1))
    fneg = F.greatest(F.col("c_neg"), F.lit(1))
    return counts.select(
        word, "c_pos", "c_neg",
        (fpos / F.lit(float(tot.n_pos))).alias("p_pos"),
        (fneg / F.lit(float(tot.n_neg))).alias("p_neg"),
        ((fpos + fneg) / F.lit(float(tot.n_all))).alias("p_word"))


def nb_score(tokens: DataFrame, model: DataFrame, docs: DataFrame, prior: float = 0.5,
             doc: str = "doc_id", word: str = "word") -> DataFrame:
    """(doc_id, log_pos, log_neg, prob, predicted) (B2).

    Only words of the model with p(w) > 1e-8 take part; unknown words are
    skipped; a document without known words keeps the prior. Tokens are
    counted per (doc, word) before the join so a frequent word costs one row
    per document, and AQE splits a skewed word partition at run time.
    """
    m = model.where(F.col("p_word") > MIN_P_WORD).select(
        word, F.log("p_pos").alias("lp"), F.log("p_neg").alias("ln"))
    tf = tokens.groupBy(doc, word).agg(F.count(F.lit(1)).alias("n"))
    sums = (tf.join(m, word).groupBy(doc)
            .agg(F.sum(F.col("n") * F.col("lp")).alias("s_pos"), F.sum(F.col("n") * F.col("ln")).alias("s_neg")))
    out = docs.select(doc).join(sums, doc, "left")
    lpos = F.lit(math.log(prior)) + F.coalesce(F.col("s_pos"), F.lit(0.0))
    lneg = F.lit(math.log(1.0 - prior)) + F.coalesce(F.col("s_neg"), F.lit(0.0))
    return out.select(doc, lpos.alias("log_pos"), lneg.alias("log_neg")).select(
        doc, "log_pos", "log_neg",
        posterior(F.col("log_pos"), F.col("log_neg")).alias("prob"),
        (F.col("log_pos") > F.col("log_neg")).cast("int").alias("predicted"))


def posterior(log_pos: Column, log_neg: Column) -> Column:
    """pos / (pos + neg) from the two logs without overflow."""
    d = log_pos - log_neg
    return F.when(d >= 0, F.lit(1.0) / (F.lit(1.0) + F.exp(-d))).otherwise(F.exp(d) / (F.lit(1.0) + F.exp(d)))


def nb_errors(scored: DataFrame, labels: DataFrame, doc: str = "doc_id", label: str = "label") -> DataFrame:
    """Misclassified documents with their posterior."""
    return scored.join(labels.select(doc, label), doc).where(F.col("predicted") != F.col(label))


def predictive_power(model: DataFrame, word: str = "word") -> DataFrame:
    return model.select(word, (F.col("p_pos") / (F.col("p_pos") + F.col("p_neg"))).alias("power"))


def top_bottom_n(df: DataFrame, score: str, n: int, key: str) -> DataFrame:
    """The n smallest and n largest rows by ``score`` (T3): two top-k plans
    (per-partition top-n, then an n-row merge), tagged head / tail."""
    head = df.orderBy(F.asc(score), F.asc(key)).limit(n).withColumn("side", F.lit("head"))
    tail = df.orderBy(F.desc(score), F.desc(key)).limit(n).withColumn("side", F.lit("tail"))
    return head.unionByName(tail)


def most_useful_words(model: DataFrame, n: int, word: str = "word") -> DataFrame:
    """(word, power, side): n most negative (head) and n most positive (tail)
    predictors by p(w|pos) / (p(w|pos) + p(w|neg)) (B4)."""
    return top_bottom_n(predictive_power(model, word), "power", n, word)


def lexicon_from_useful(useful: DataFrame, word: str = "word") -> DataFrame:
    """(word, polarity): tail words +1, head words -1."""
    return useful.select(word, F.when(F.col("side") == "tail", 1).otherwise(-1).alias("polarity"))


def lexicon_overlap(useful: DataFrame, lexicon: DataFrame, word: str = "word",
                    lexicon_bound: int | None = None) -> DataFrame:
    """(side, n_in_lexicon): how many useful words per side are in the lexicon."""
    hit = useful.join(bounded_broadcast(lexicon.select(word), lexicon_bound), word, "left_semi")
    return useful.select("side").distinct().join(
        hit.groupBy("side").agg(F.count(F.lit(1)).alias("n_in_lexicon")), "side", "left").select(
        "side", F.coalesce("n_in_lexicon", F.lit(0)).alias("n_in_lexicon"))


def join_tokens_lexicon(tokens: DataFrame, lexicon: DataFrame, word: str = "word",
                        lexicon_bound: int | None = None, how: str = "inner") -> DataFrame:
    """Token x lexicon probe."""
    return tokens.join(bounded_broadcast(lexicon, lexicon_bound), word, how)


def lexicon_score(tokens: DataFrame, lexicon: DataFrame, docs: DataFrame, threshold: float,
                  doc: str = "doc_id", word: str = "word", lexicon_bound: int | None = None) -> DataFrame:
    """(doc_id, score, predicted): sum of polarities, positive iff score >= threshold."""
    hits = join_tokens_lexicon(tokens, lexicon, word, lexicon_bound)
    s = hits.groupBy(doc).agg(F.sum("polarity").alias("score"))
    return (docs.select(doc).join(s, doc, "left")
            .select(doc, F.coalesce(F.col("score"), F.lit(0)).cast("double").alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def _modifier(w: Column) -> Column:
    return (F.when(w.isin(NEGATIONS), F.lit(NEGATION_WEIGHT))
            .when(w.isin(INTENSIFIERS), F.lit(INTENSIFIER_WEIGHT))
            .when(w.isin(DIMINISHERS), F.lit(DIMINISHER_WEIGHT))
            .otherwise(F.lit(1.0)))


# Positions per block of the running product: a document is scanned in blocks
# of this many tokens, so one huge document is spread over many tasks.
WEIGHT_BLOCK = 65_536


def running_weight_product(tokens: DataFrame, doc: str = "doc_id", pos: str = "pos",
                           word: str = "word", block: int = WEIGHT_BLOCK) -> DataFrame:
    """Adds ``weight`` = product of the modifiers of all tokens up to and
    including this one in the document (W4); never reset inside a document.

    The product is (-1)^a * 2^(b - c) with a, b, c the running counts of
    negations, intensifiers and diminishers, so it is computed as a two-level prefix sum: counts
    per (document, block of positions), an exclusive prefix over the blocks of
    each document, plus the running counts inside the block. No window holds
    more than one block or one document's block list, whatever the length of
    a document.
    """
    w_ = F.col(word)
    kind = F.when(w_.isin(NEGATIONS), "n").when(w_.isin(INTENSIFIERS), "i").when(w_.isin(DIMINISHERS), "d")
    t = tokens.withColumn("_blk", F.floor(F.col(pos) / F.lit(block))).withColumn("_kind", kind)
    cnt = {k: F.when(F.col("_kind") == k, 1).otherwise(0) for k in "nid"}
    blocks = t.groupBy(doc, "_blk").agg(*[F.sum(cnt[k]).alias(f"_b{k}") for k in "nid"])
    before = Window.partitionBy(doc).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(doc, "_blk", *[F.coalesce(F.sum(f"_b{k}").over(before), F.lit(0)).alias(f"_o{k}")
                                           for k in "nid"])
    upto = Window.partitionBy(doc, "_blk").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    t = t.select(*tokens.columns, "_blk", *[F.sum(cnt[k]).over(upto).alias(f"_c{k}") for k in "nid"])
    t = t.join(offsets, [doc, "_blk"])

    # sign from the parity of the negations, magnitude from the difference of the exponents: intensifiers and
    # diminishers are powers of one base, and inf * 0 never arises
    count = {k: F.col(f"_o{k}") + F.col(f"_c{k}") for k in "nid"}
    sign = F.when(F.pmod(count["n"], F.lit(2)) == 1, F.lit(NEGATION_WEIGHT)).otherwise(F.lit(1.0))
    weight = sign * F.pow(F.lit(INTENSIFIER_WEIGHT), (count["i"] - count["d"]).cast("double"))
    return t.select(*tokens.columns, weight.alias("weight"))


def lexicon_score_rules(tokens: DataFrame, lexicon: DataFrame, docs: DataFrame, threshold: float,
                        caps: bool = False, doc: str = "doc_id", pos: str = "pos", word: str = "word",
                        lexicon_bound: int | None = None) -> DataFrame:
    """(doc_id, score, predicted): lexicon score with negation / intensifier /
    diminisher weights (B6). With ``caps`` an all-capitals word is looked up
    in lower case and counts double."""
    t = running_weight_product(tokens, doc, pos, word)
    if caps:
        is_caps = (F.col(word) == F.upper(F.col(word))) & (F.col(word) != F.lower(F.col(word)))
        t = t.withColumn("_key", F.when(is_caps, F.lower(F.col(word))).otherwise(F.col(word))) \
             .withColumn("_mult", F.when(is_caps, F.lit(CAPS_WEIGHT)).otherwise(F.lit(1.0)))
    else:
        t = t.withColumn("_key", F.col(word)).withColumn("_mult", F.lit(1.0))
    lex = bounded_broadcast(lexicon.select(F.col(word).alias("_key"), "polarity"), lexicon_bound)
    hits = t.join(lex, "_key")
    s = hits.groupBy(doc).agg(F.sum(F.col("_mult") * F.col("weight") * F.col("polarity")).alias("score"))
    return (docs.select(doc).join(s, doc, "left")
            .select(doc, F.coalesce(F.col("score"), F.lit(0.0)).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def binary_report(pred: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """One row: accuracy and precision / recall / F1 of both classes (B7),
    zero-safe, from one aggregation."""
    y, p = F.col(label), F.col(predicted)
    a = pred.agg(F.count(F.lit(1)).alias("n"),
                 F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 0)).alias("tn"),
                 F.count_if((y == 0) & (p == 1)).alias("fp"), F.count_if((y == 1) & (p == 0)).alias("fn"))

    def ratio(n, d):
        return F.coalesce(F.try_divide(n.cast("double"), d.cast("double")), F.lit(0.0))

    def f1(pr, rc):
        return F.coalesce(F.try_divide(2 * pr * rc, pr + rc), F.lit(0.0))

    tp, tn, fp, fn = F.col("tp"), F.col("tn"), F.col("fp"), F.col("fn")
    out = a.select(
        "n", ratio(tp + tn, F.col("n")).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision_pos"), ratio(tp, tp + fn).alias("recall_pos"),
        ratio(tn, tn + fn).alias("precision_neg"), ratio(tn, tn + fp).alias("recall_neg"))
    return out.select("*", f1(F.col("precision_pos"), F.col("recall_pos")).alias("f1_pos"),
                      f1(F.col("precision_neg"), F.col("recall_neg")).alias("f1_neg"))


def words_long(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(keep..., pos, word) Unicode word tokens, case kept (F1)."""
    from kestrel.functions import word_tokens

    return df.select(*keep, F.posexplode(word_tokens(text)).alias("pos", "word"))
