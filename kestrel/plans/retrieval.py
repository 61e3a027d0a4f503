"""Retrieval and evaluation plans (S7, S8, S11, A13, A14, J5-J8, U2, W5, W6,
R1-R5, E1-E6): every benchmark passage is a query over all documents; gold =
documents containing the whole passage; the run = tf-idf top 10."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions import round6
from kestrel.operators import index as ix
from kestrel.operators import ireval as ev
from kestrel.operators import retrieval as rt
from kestrel.operators.text import STOPWORDS_NLP2
from kestrel.plans.registry import register
from kestrel.plans.text import STOP2, WORD_RE
from kestrel.session import materialise, scratch_path
from kestrel.sources import fixtures as fx
from kestrel.sources.files import scan_pairs, write_ranked_run

K = 10

_TERMS = f"list_filter(regexp_extract_all(lower(text), '{WORD_RE}'), lambda x: NOT list_contains({STOP2}, x))"
_TERMS_ALL = f"regexp_extract_all(lower(text), '{WORD_RE}')"


def _ctes(terms_sql: str):
    return [
        ("post", f"SELECT term, docid, count(*) AS tf FROM (SELECT doc_id AS docid, unnest({terms_sql}) AS term "
                 "FROM documents) GROUP BY ALL"),
        ("qt", f"SELECT qid, term, count(*) AS qtf FROM (SELECT item_id AS qid, unnest({terms_sql}) AS term "
               "FROM benchmark) GROUP BY ALL"),
        ("ndocs", "SELECT count(DISTINCT docid) AS n FROM post"),
        ("idf", "SELECT term, ln((SELECT n FROM ndocs) / count(*)) AS idf FROM post GROUP BY term"),
        ("hits", "SELECT * FROM post JOIN qt USING (term)"),
        ("norm_bin", "SELECT docid, CAST(count(*) AS DOUBLE) AS norm_sq FROM post GROUP BY docid"),
        ("norm_tf", "SELECT docid, CAST(sum(tf * tf) AS DOUBLE) AS norm_sq FROM post GROUP BY docid"),
        ("norm_tfidf", "SELECT docid, sum((tf * idf) * (tf * idf)) AS norm_sq FROM post JOIN idf USING (term) "
                       "GROUP BY docid"),
        ("num_bin", "SELECT qid, docid, CAST(count(*) AS DOUBLE) AS num FROM hits GROUP BY ALL"),
        ("num_tf", "SELECT qid, docid, CAST(sum(qtf * tf) AS DOUBLE) AS num FROM hits GROUP BY ALL"),
        ("num_tfidf", "SELECT qid, docid, sum(qtf * idf * idf * tf) AS num FROM hits JOIN idf USING (term) "
                      "GROUP BY ALL"),
        ("num_tfidf_lit", "SELECT qid, docid, sum(qtf * qtf * idf * idf * tf) AS num FROM hits JOIN idf USING (term) "
                          "GROUP BY ALL"),
    ]


def _rank_sql(num: str, norm: str) -> str:
    return f"""
      SELECT qid, docid, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
        SELECT qid, docid, score,
               row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC NULLS LAST, docid) AS rank
        FROM (SELECT qid, docid, num / sqrt(norm_sq) AS score FROM {num} JOIN {norm} USING (docid)))
      WHERE rank <= {K}"""


_EVAL_CTES = [
    ("run", "SELECT qid, docid, rank AS line_no FROM ranked"),
    ("rr", "SELECT qid, docid, CAST(row_number() OVER (PARTITION BY qid ORDER BY line_no) AS INTEGER) AS rank, "
           "row_number() OVER (PARTITION BY qid, docid ORDER BY line_no) = 1 AS first FROM run"),
    ("gd", "SELECT DISTINCT qid, docid FROM gold"),
    ("jr", "SELECT rr.*, (gd.qid IS NOT NULL) AND first AS hit FROM rr LEFT JOIN gd USING (qid, docid)"),
    ("pq", """SELECT qid, coalesce(retrieved, 0) AS retrieved, coalesce(relevant, 0) AS relevant,
                     coalesce(rel_ret, 0) AS rel_ret
              FROM (SELECT qid, count(*) AS retrieved, count(*) FILTER (WHERE hit) AS rel_ret FROM jr GROUP BY qid) r
              FULL OUTER JOIN (SELECT qid, count(*) AS relevant FROM gd GROUP BY qid) g USING (qid)"""),
    ("pah", """SELECT qid, CAST(row_number() OVER (PARTITION BY qid ORDER BY rank) AS INTEGER) AS hit_no, rank,
                      row_number() OVER (PARTITION BY qid ORDER BY rank) / rank AS precision FROM jr WHERE hit"""),
    ("best", """SELECT qid, CAST(floor(hit_no * 10 / relevant) AS INTEGER) AS point, max(precision) AS p
                FROM pah JOIN (SELECT qid, count(*) AS relevant FROM gd GROUP BY qid) USING (qid) GROUP BY ALL"""),
    ("grid", """SELECT q.qid, CAST(r.point AS INTEGER) AS point, coalesce(b.p, 0.0) AS p
                FROM (SELECT qid FROM run UNION SELECT qid FROM gd) q
                CROSS JOIN (SELECT range AS point FROM range(0, 11)) r
                LEFT JOIN best b ON b.qid = q.qid AND b.point = r.point"""),
    ("ip", """SELECT qid, point, p, max(p) OVER (PARTITION BY qid ORDER BY point
                                              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS precision
              FROM grid"""),
]


def _sql(body: str, extra=None, terms_sql: str = _TERMS) -> str:
    return fx.with_views([], body, _ctes(terms_sql) + (extra or []))


def _esql(body: str) -> str:
    return fx.with_views(["gold"], body, _ctes(_TERMS) + [("ranked", _rank_sql("num_tfidf", "norm_tfidf"))]
                         + _EVAL_CTES)


# ------------------------------------------------------------------ Spark side

def _postings(spark, sf, stop=True):
    return rt.build_postings(fx.table(spark, sf, "documents"), stopwords=STOPWORDS_NLP2 if stop else None)


def _qterms(spark, sf, stop=True):
    return rt.query_terms(fx.queries(spark, sf), stopwords=STOPWORDS_NLP2 if stop else None)


def _index(spark, sf, stop=True):
    """The index of the documents, written under the checkpoint folder."""
    return ix.write_index(_postings(spark, sf, stop))


def _retrieve(spark, sf, weighting, mode="fixed", stop=True):
    r = rt.retrieve(_index(spark, sf, stop), _qterms(spark, sf, stop), weighting, K, mode)
    return r.select("qid", "docid", round6(F.col("score")).alias("score"), "rank")


def _run(spark, sf):
    """The tf-idf run, written: evaluation reads it more than once."""
    return materialise(_retrieve(spark, sf, "tfidf").select("qid", "docid", F.col("rank").alias("line_no")), "run")


@register("build_postings", _sql("SELECT term, docid, tf FROM post"))
def q_build_postings(spark, sf):
    return _postings(spark, sf)


@register("vector_norms", _sql("SELECT docid, norm_sq FROM norm_tf"))
def q_vector_norms(spark, sf):
    return rt.doc_norms(_postings(spark, sf), "tf")


@register("vector_norms_tfidf", _sql("SELECT docid, round(norm_sq, 6) AS norm_sq FROM norm_tfidf"))
def q_vector_norms_tfidf(spark, sf):
    return _index(spark, sf).norms.select("docid", round6(F.col("tfidf")).alias("norm_sq"))


@register("join_query_postings", _sql("SELECT qid, term, docid, qtf, tf FROM hits"))
def q_join_query_postings(spark, sf):
    return ix.hits(_index(spark, sf), _qterms(spark, sf))


@register("join_scores_norms", _sql("SELECT qid, docid, num, norm_sq FROM num_tf JOIN norm_tf USING (docid)"))
def q_join_scores_norms(spark, sf):
    index = _index(spark, sf)
    num = ix.hits(index, _qterms(spark, sf)).groupBy("qid", "docid").agg(F.sum(F.col("qtf") * F.col("tf")).cast("double").alias("num"))
    return num.join(index.norms.select("docid", F.col("tf").alias("norm_sq")), "docid").select("qid", "docid", "num", "norm_sq")


@register("retrieve_binary", _sql(_rank_sql("num_bin", "norm_bin")))
def q_retrieve_binary(spark, sf):
    return _retrieve(spark, sf, "binary")


@register("retrieve_binary_literal", _sql("""
    SELECT qid, docid, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
      SELECT qid, docid, score,
             row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC NULLS LAST, docid) AS rank
      FROM (SELECT qid, docid, CASE WHEN nrm = 0 THEN NULL ELSE num / sqrt(nrm) END AS score
            FROM (SELECT qid, docid, CASE WHEN sum(qtf) >= 2 THEN 1.0 ELSE 0.0 END AS num FROM hits GROUP BY ALL)
            JOIN (SELECT docid, CASE WHEN count(*) >= 2 THEN 1.0 ELSE 0.0 END AS nrm FROM post GROUP BY docid)
            USING (docid)))
    WHERE rank <= 10"""))
def q_retrieve_binary_literal(spark, sf):
    return _retrieve(spark, sf, "binary", "literal")


@register("retrieve_tf", _sql(_rank_sql("num_tf", "norm_tf")))
def q_retrieve_tf(spark, sf):
    return _retrieve(spark, sf, "tf")


@register("retrieve_tfidf", _sql(_rank_sql("num_tfidf", "norm_tfidf")))
def q_retrieve_tfidf(spark, sf):
    return _retrieve(spark, sf, "tfidf")


@register("retrieve_tfidf_literal", _sql(_rank_sql("num_tfidf_lit", "norm_tfidf")))
def q_retrieve_tfidf_literal(spark, sf):
    return _retrieve(spark, sf, "tfidf", "literal")


@register("rank_top10", _sql(_rank_sql("num_tf", "norm_tf").replace("round(score, 6) AS score, ", "")))
def q_rank_top10(spark, sf):
    return _retrieve(spark, sf, "tf").select("qid", "docid", "rank")


@register("retrieval_config", _sql(_rank_sql("num_tfidf", "norm_tfidf"), terms_sql=_TERMS_ALL))
def q_retrieval_config(spark, sf):
    """tf-idf without the stop list (the other index / query variant)."""
    return _retrieve(spark, sf, "tfidf", stop=False)


# ------------------------------------------------------------------ evaluation

@register("gold_pairs", fx.with_views(["gold"], "SELECT qid, docid FROM gold"))
def q_gold_pairs(spark, sf):
    return fx.gold(spark, sf)


@register("scan_pairs", fx.with_views(["gold"], "SELECT CAST(qid AS BIGINT) AS qid, CAST(docid AS BIGINT) AS docid "
                                                "FROM gold"))
def q_scan_pairs(spark, sf):
    """Gold pairs written as a zero-padded ``qid docid`` text file with a
    comment line, read back by the pair scanner."""
    g = fx.gold(spark, sf)
    path = scratch_path(spark, "gold")
    lines = g.select(F.concat_ws(" ", F.format_string("%03d", "qid"),
                                 F.format_string("%05d", "docid")).alias("value"))
    lines.unionByName(spark.range(1).select(F.lit("# THE END").alias("value"))).write.mode("overwrite").text(path)
    return scan_pairs(spark, path).select("qid", "docid")


@register("write_ranked_run", _esql("SELECT CAST(qid AS BIGINT) AS qid, CAST(docid AS BIGINT) AS docid, rank FROM rr"))
def q_write_ranked_run(spark, sf):
    """The tf-idf run written as ``qid docid`` lines and read back; the rank
    is recovered from file and line order."""
    path = scratch_path(spark, "run")
    write_ranked_run(_run(spark, sf).withColumnRenamed("line_no", "rank"), path)
    r = ev.run_ranks(scan_pairs(spark, path))
    return r.select("qid", "docid", F.col("rank").cast("int").alias("rank"))


def _gold(spark, sf):
    return materialise(fx.gold(spark, sf), "gold")


@register("run_rank_with_dups", _esql("SELECT qid, docid, rank, first FROM rr"))
def q_run_rank_with_dups(spark, sf):
    return ev.run_ranks(_run(spark, sf)).select("qid", "docid", F.col("rank").cast("int").alias("rank"), "first")


@register("join_run_gold", _esql("SELECT qid, docid, rank, hit FROM jr"))
def q_join_run_gold(spark, sf):
    j = ev.judged(ev.run_ranks(_run(spark, sf)), _gold(spark, sf))
    return j.select("qid", "docid", F.col("rank").cast("int").alias("rank"), "hit")


@register("ir_per_query", _esql("SELECT * FROM pq"))
def q_ir_per_query(spark, sf):
    return ev.ir_per_query(_run(spark, sf), _gold(spark, sf))


@register("full_join_query_ids", _esql("SELECT qid, retrieved, relevant FROM pq"))
def q_full_join_query_ids(spark, sf):
    return ev.ir_per_query(_run(spark, sf), _gold(spark, sf)).select("qid", "retrieved", "relevant")


@register("union_ids", _esql("SELECT qid FROM run UNION SELECT qid FROM gd"))
def q_union_ids(spark, sf):
    return ev.all_qids(_run(spark, sf), _gold(spark, sf))


@register("run_totals", _esql(
    "SELECT count(*) AS n_queries, sum(retrieved) AS retrieved, sum(relevant) AS relevant, "
    "sum(rel_ret) AS rel_ret FROM pq"))
def q_run_totals(spark, sf):
    return ev.run_totals(ev.ir_per_query(_run(spark, sf), _gold(spark, sf)))


_SUMMARY = """
    SELECT n_queries, retrieved, relevant, rel_ret, round(precision, 6) AS precision, round(recall, 6) AS recall,
           round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0), 6) AS f_measure
    FROM (SELECT *, coalesce(rel_ret / nullif(retrieved, 0), 0) AS precision,
                 coalesce(rel_ret / nullif(relevant, 0), 0) AS recall
          FROM (SELECT count(*) AS n_queries, sum(retrieved) AS retrieved, sum(relevant) AS relevant,
                       sum(rel_ret) AS rel_ret FROM {pq}))"""


def _summary_r6(df):
    return df.select(*[round6(F.col(c)).alias(c) if c in ("precision", "recall", "f_measure") else c
                       for c in df.columns])


@register("ir_summary", _esql(_SUMMARY.format(pq="pq")))
def q_ir_summary(spark, sf):
    return _summary_r6(ev.ir_summary(_run(spark, sf), _gold(spark, sf)))


@register("ir_cutoff", _esql(_SUMMARY.format(pq="""(
    SELECT qid, coalesce(retrieved, 0) AS retrieved, coalesce(relevant, 0) AS relevant,
           coalesce(rel_ret, 0) AS rel_ret
    FROM (SELECT qid, count(*) AS retrieved, count(*) FILTER (WHERE hit) AS rel_ret FROM jr WHERE rank <= 5
          GROUP BY qid) r
    FULL OUTER JOIN (SELECT qid, count(*) AS relevant FROM gd GROUP BY qid) g USING (qid))""")))
def q_ir_cutoff(spark, sf):
    return _summary_r6(ev.ir_summary(_run(spark, sf), _gold(spark, sf), n=5))


@register("precision_at_hits", _esql("SELECT qid, hit_no, rank, round(precision, 6) AS precision FROM pah"))
def q_precision_at_hits(spark, sf):
    p = ev.precision_at_hits(_run(spark, sf), _gold(spark, sf))
    return p.select("qid", F.col("hit_no").cast("int").alias("hit_no"), F.col("rank").cast("int").alias("rank"),
                    round6(F.col("precision")).alias("precision"))


@register("interpolated_precision", _esql("SELECT qid, point, round(precision, 6) AS precision FROM ip"))
def q_interpolated_precision(spark, sf):
    ip = ev.interpolated_precision(_run(spark, sf), _gold(spark, sf))
    return ip.select("qid", "point", round6(F.col("precision")).alias("precision"))


@register("suffix_max", _esql("SELECT qid, point, round(p, 6) AS best, round(precision, 6) AS precision FROM ip"))
def q_suffix_max(spark, sf):
    """Per-point best precision next to its suffix maximum."""
    cells = ev.suffix_max(ev.best_at_points(_run(spark, sf), _gold(spark, sf)), "qid", "point", "p")
    return cells.select("qid", "point", round6(F.col("p")).alias("best"), round6(F.col("suffix_max")).alias("precision"))


@register("interpolated_precision_avg", _esql(
    "SELECT point, round(point / 10.0, 6) AS recall, round(avg(precision), 6) AS precision FROM ip GROUP BY point"))
def q_interpolated_precision_avg(spark, sf):
    a = ev.interpolated_precision_avg(_run(spark, sf), _gold(spark, sf))
    return a.select("point", round6(F.col("recall")).alias("recall"), round6(F.col("precision")).alias("precision"))
