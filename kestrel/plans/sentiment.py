"""Sentiment plans (A9, B1-B7, J3, J4, J10, T3, W4) over the labelled ``texts``:
Naive Bayes trained on the train split, scored on the test split, and a
lexicon taken from the model's most useful words."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions import round6
from kestrel.operators import sentiment as se
from kestrel.plans.registry import register
from kestrel.plans.text import WORD_RE
from kestrel.sources import fixtures as fx

USEFUL_N = 50
LEXICON_BOUND = 2 * USEFUL_N
THRESHOLD = 0.0

_CTES = [
    ("tok", f"SELECT t.doc_id, t.label, t.split, CAST(u.pos - 1 AS INTEGER) AS pos, u.word FROM texts t, "
            f"unnest(regexp_extract_all(t.text, '{WORD_RE}')) WITH ORDINALITY AS u(word, pos)"),
    ("tr", "SELECT * FROM tok WHERE split = 'train'"),
    ("tot", "SELECT count(*) AS n_all, count(*) FILTER (WHERE label = 1) AS n_pos, "
            "count(*) FILTER (WHERE label = 0) AS n_neg FROM tr"),
    ("model", """SELECT word, c_pos, c_neg, greatest(c_pos, 1) / n_pos AS p_pos, greatest(c_neg, 1) / n_neg AS p_neg,
                        (greatest(c_pos, 1) + greatest(c_neg, 1)) / n_all AS p_word
                 FROM (SELECT word, count(*) FILTER (WHERE label = 1) AS c_pos,
                              count(*) FILTER (WHERE label = 0) AS c_neg FROM tr GROUP BY word), tot"""),
    ("tst", "SELECT * FROM tok WHERE split = 'test'"),
    ("tdocs", "SELECT doc_id, label FROM texts WHERE split = 'test'"),
    ("sums", """SELECT doc_id, sum(n * ln(p_pos)) AS s_pos, sum(n * ln(p_neg)) AS s_neg
                FROM (SELECT doc_id, word, count(*) AS n FROM tst GROUP BY ALL) JOIN model USING (word)
                WHERE p_word > 1e-8 GROUP BY doc_id"""),
    ("sc", """SELECT d.doc_id, ln(0.5) + coalesce(s_pos, 0) AS log_pos, ln(0.5) + coalesce(s_neg, 0) AS log_neg
              FROM tdocs d LEFT JOIN sums USING (doc_id)"""),
    ("scored", """SELECT doc_id, log_pos, log_neg,
                         CASE WHEN log_pos - log_neg >= 0 THEN 1 / (1 + exp(-(log_pos - log_neg)))
                              ELSE exp(log_pos - log_neg) / (1 + exp(log_pos - log_neg)) END AS prob,
                         CAST(log_pos > log_neg AS INTEGER) AS predicted FROM sc"""),
    ("power", "SELECT word, p_pos / (p_pos + p_neg) AS power FROM model"),
    ("useful", f"""(SELECT word, power, 'head' AS side FROM power ORDER BY power, word LIMIT {USEFUL_N})
                  UNION ALL
                  (SELECT word, power, 'tail' AS side FROM power ORDER BY power DESC, word DESC LIMIT {USEFUL_N})"""),
    ("lexicon", "SELECT word, CASE WHEN side = 'tail' THEN 1 ELSE -1 END AS polarity FROM useful"),
]


def _model_ctes(src: str, suffix: str):
    """The Naive Bayes model and its lexicon over another token table, under names with a suffix."""
    out = []
    for name, sql in _CTES:
        if name in ("tot", "model", "power", "useful", "lexicon"):
            for used in ("model", "power", "useful"):
                sql = sql.replace(f"FROM {used}", f"FROM {used}{suffix}")
            out.append((name + suffix, sql.replace("FROM tr", f"FROM {src}").replace(", tot", f", tot{suffix}")))
    return out


def _sql(body: str, extra=None) -> str:
    return fx.with_views(["texts"], body, _CTES + (extra or []))


def _tokens(spark, sf):
    return se.words_long(fx.texts(spark, sf), keep=("doc_id", "label", "split"))


def _model(spark, sf):
    return se.nb_train(_tokens(spark, sf).where("split = 'train'"))


def _test(spark, sf):
    return _tokens(spark, sf).where("split = 'test'")


def _test_docs(spark, sf):
    return fx.texts(spark, sf).where("split = 'test'").select("doc_id", "label")


def _docs(spark, sf):
    """All texts: the lexicon scorers have no training part."""
    return fx.texts(spark, sf).select("doc_id", "label")


def _scored(spark, sf):
    return se.nb_score(_test(spark, sf), _model(spark, sf), _test_docs(spark, sf), prior=0.5)


def _lexicon(spark, sf):
    return se.lexicon_from_useful(se.most_useful_words(_model(spark, sf), USEFUL_N))


def _r6(df, cols):
    return df.select(*[round6(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


@register("token_totals", _sql("SELECT * FROM tot"))
def q_token_totals(spark, sf):
    return se.token_totals(_tokens(spark, sf).where("split = 'train'"))


@register("nb_train", _sql("SELECT * FROM model"))
def q_nb_train(spark, sf):
    return _model(spark, sf)


@register("nb_score", _sql(
    "SELECT doc_id, round(log_pos, 6) AS log_pos, round(log_neg, 6) AS log_neg, round(prob, 6) AS prob, "
    "predicted FROM scored"))
def q_nb_score(spark, sf):
    return _r6(_scored(spark, sf), ["log_pos", "log_neg", "prob"])


@register("nb_errors", _sql(
    "SELECT doc_id, label, predicted, round(prob, 6) AS prob FROM scored JOIN tdocs USING (doc_id) "
    "WHERE predicted <> label"))
def q_nb_errors(spark, sf):
    e = se.nb_errors(_scored(spark, sf), _test_docs(spark, sf))
    return e.select("doc_id", "label", "predicted", round6(F.col("prob")).alias("prob"))


_REPORT = """
    SELECT n, round(coalesce((tp + tn) / n, 0), 6) AS accuracy,
           round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision_pos,
           round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall_pos,
           round(coalesce(tn / nullif(tn + fn, 0), 0), 6) AS precision_neg,
           round(coalesce(tn / nullif(tn + fp, 0), 0), 6) AS recall_neg,
           round(coalesce(2 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0))
                 / nullif(tp / nullif(tp + fp, 0) + tp / nullif(tp + fn, 0), 0), 0), 6) AS f1_pos,
           round(coalesce(2 * (tn / nullif(tn + fn, 0)) * (tn / nullif(tn + fp, 0))
                 / nullif(tn / nullif(tn + fn, 0) + tn / nullif(tn + fp, 0), 0), 0), 6) AS f1_neg
    FROM (SELECT count(*) AS n,
                 count(*) FILTER (WHERE label = 1 AND predicted = 1) AS tp,
                 count(*) FILTER (WHERE label = 0 AND predicted = 0) AS tn,
                 count(*) FILTER (WHERE label = 0 AND predicted = 1) AS fp,
                 count(*) FILTER (WHERE label = 1 AND predicted = 0) AS fn FROM {src})"""

_REPORT_COLS = ["accuracy", "precision_pos", "recall_pos", "precision_neg", "recall_neg", "f1_pos", "f1_neg"]


@register("binary_report", _sql(_REPORT.format(src="scored JOIN tdocs USING (doc_id)")))
def q_binary_report(spark, sf):
    pred = _scored(spark, sf).join(_test_docs(spark, sf), "doc_id")
    return _r6(se.binary_report(pred), _REPORT_COLS)


@register("most_useful_words", _sql("SELECT word, round(power, 6) AS power, side FROM useful"))
def q_most_useful_words(spark, sf):
    return _r6(se.most_useful_words(_model(spark, sf), USEFUL_N), ["power"])


@register("top_bottom_n", _sql("""
    (SELECT doc_id, round(log_pos - log_neg, 6) AS margin, 'head' AS side FROM scored
     ORDER BY round(log_pos - log_neg, 6), doc_id LIMIT 10)
    UNION ALL
    (SELECT doc_id, round(log_pos - log_neg, 6) AS margin, 'tail' AS side FROM scored
     ORDER BY round(log_pos - log_neg, 6) DESC, doc_id DESC LIMIT 10)"""))
def q_top_bottom_n(spark, sf):
    s = _scored(spark, sf).select("doc_id", round6(F.col("log_pos") - F.col("log_neg")).alias("margin"))
    return se.top_bottom_n(s, "margin", 10, "doc_id")


@register("join_tokens_model", _sql(
    "SELECT doc_id, word, n, p_pos, p_neg FROM (SELECT doc_id, word, count(*) AS n FROM tok GROUP BY ALL) "
    "JOIN model USING (word)"))
def q_join_tokens_model(spark, sf):
    """Words of all texts with the model's probabilities: counted per document before the join, so that a frequent
    word is one row a document."""
    m = _model(spark, sf).select("word", "p_pos", "p_neg")
    counted = _tokens(spark, sf).groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(m, "word").select("doc_id", "word", "n", "p_pos", "p_neg")


@register("nb_score_prior", _sql("""
    SELECT doc_id, round(ln(0.7) + coalesce(s_pos, 0), 6) AS log_pos, round(ln(0.3) + coalesce(s_neg, 0), 6) AS log_neg,
           CAST(ln(0.7) + coalesce(s_pos, 0) > ln(0.3) + coalesce(s_neg, 0) AS INTEGER) AS predicted
    FROM texts LEFT JOIN (
      SELECT doc_id, sum(n * ln(p_pos)) AS s_pos, sum(n * ln(p_neg)) AS s_neg
      FROM (SELECT doc_id, word, count(*) AS n FROM tok GROUP BY ALL) JOIN model USING (word)
      WHERE p_word > 1e-8 GROUP BY doc_id) USING (doc_id)"""))
def q_nb_score_prior(spark, sf):
    """Train and test texts scored with prior 0.7 for the positive class."""
    s = se.nb_score(_tokens(spark, sf), _model(spark, sf), _docs(spark, sf), prior=0.7)
    return _r6(s.select("doc_id", "log_pos", "log_neg", "predicted"), ["log_pos", "log_neg"])


@register("join_tokens_lexicon", _sql(
    "SELECT doc_id, pos, word, polarity FROM tok JOIN lexicon USING (word)"))
def q_join_tokens_lexicon(spark, sf):
    j = se.join_tokens_lexicon(_tokens(spark, sf), _lexicon(spark, sf), lexicon_bound=LEXICON_BOUND)
    return j.select("doc_id", "pos", "word", "polarity")


@register("lexicon_overlap", _sql(
    f"""SELECT side, count(*) FILTER (WHERE word IN (SELECT word FROM lexicon)) AS n_in_lexicon
        FROM ((SELECT word, 'head' AS side FROM power ORDER BY power, word LIMIT {2 * USEFUL_N})
              UNION ALL
              (SELECT word, 'tail' AS side FROM power ORDER BY power DESC, word DESC LIMIT {2 * USEFUL_N}))
        GROUP BY side""".replace("FROM lexicon)", "FROM lexicon2)"), _model_ctes("tst", "2")))
def q_lexicon_overlap(spark, sf):
    """Useful words of the training texts against the lexicon that the other texts give."""
    useful = se.most_useful_words(_model(spark, sf), 2 * USEFUL_N)
    other = se.lexicon_from_useful(se.most_useful_words(se.nb_train(_test(spark, sf)), USEFUL_N))
    return se.lexicon_overlap(useful, other, lexicon_bound=LEXICON_BOUND)


@register("lexicon_score", _sql(f"""
    SELECT d.doc_id, CAST(coalesce(s.score, 0) AS DOUBLE) AS score,
           CAST(coalesce(s.score, 0) >= {THRESHOLD} AS INTEGER) AS predicted
    FROM texts d LEFT JOIN (SELECT doc_id, sum(polarity) AS score FROM tok JOIN lexicon USING (word)
                            GROUP BY doc_id) s USING (doc_id)"""))
def q_lexicon_score(spark, sf):
    return se.lexicon_score(_tokens(spark, sf), _lexicon(spark, sf), _docs(spark, sf), THRESHOLD,
                            lexicon_bound=LEXICON_BOUND)


_WEIGHTS = """
    SELECT doc_id, pos, word,
           product(CASE WHEN word IN ('not') THEN -1.0
                        WHEN word IN ('definitely', 'very', 'extremely') THEN 2.0
                        WHEN word IN ('somewhat', 'barely', 'rarely') THEN 0.5 ELSE 1.0 END)
             OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS weight
    FROM tok"""


@register("running_weight_product", _sql("SELECT doc_id, pos, word, weight FROM wt", [("wt", _WEIGHTS)]))
def q_running_weight_product(spark, sf):
    return se.running_weight_product(_tokens(spark, sf)).select("doc_id", "pos", "word", "weight")


@register("lexicon_score_rules", _sql(f"""
    SELECT d.doc_id, coalesce(s.score, 0.0) AS score, CAST(coalesce(s.score, 0.0) >= {THRESHOLD} AS INTEGER) AS predicted
    FROM texts d LEFT JOIN (SELECT doc_id, sum(weight * polarity) AS score FROM wt JOIN lexicon USING (word)
                            GROUP BY doc_id) s USING (doc_id)""", [("wt", _WEIGHTS)]))
def q_lexicon_score_rules(spark, sf):
    return se.lexicon_score_rules(_tokens(spark, sf), _lexicon(spark, sf), _docs(spark, sf), THRESHOLD,
                                  lexicon_bound=LEXICON_BOUND)


@register("lexicon_score_caps", _sql(f"""
    SELECT d.doc_id, coalesce(s.score, 0.0) AS score, CAST(coalesce(s.score, 0.0) >= {THRESHOLD} AS INTEGER) AS predicted
    FROM texts d LEFT JOIN (
        SELECT doc_id, sum(CASE WHEN upper(wt.word) = wt.word AND lower(wt.word) <> wt.word THEN 2.0 ELSE 1.0 END
                           * weight * polarity) AS score
        FROM wt JOIN lexicon ON lexicon.word = CASE WHEN upper(wt.word) = wt.word AND lower(wt.word) <> wt.word
                                                    THEN lower(wt.word) ELSE wt.word END
        GROUP BY doc_id) s USING (doc_id)""", [("wt", _WEIGHTS)]))
def q_lexicon_score_caps(spark, sf):
    return se.lexicon_score_rules(_tokens(spark, sf), _lexicon(spark, sf), _docs(spark, sf), THRESHOLD,
                                  caps=True, lexicon_bound=LEXICON_BOUND)
