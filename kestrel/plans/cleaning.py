"""Cleaning, profiling, sampling and split plans over ``claims``, ``ratings``,
``items``, ``topics`` and ``texts`` (P8-P18, C1-C5, A8, X1-X3, U1, W1, W2, W7, T2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import clean as cl
from kestrel.operators import splits as sp
from kestrel.plans.registry import register
from kestrel.sources import fixtures as fx
from kestrel.sources.files import dedup_last_wins

CLAIM_COLS = ["row_id", "household_id", "calendar_year", "o_orderpriority", "p_brand", "p_type",
              "l_linestatus", "o_orderstatus", "p_size", "l_quantity", "l_extendedprice", "l_discount",
              "l_tax", "p_retailprice", "o_totalprice", "claim_amount"]
CLAIM_STR = ["o_orderpriority", "p_brand", "p_type", "l_linestatus", "o_orderstatus"]

_CLEAN_SQL = "SELECT " + ", ".join(
    f"CASE WHEN trim({c}) IN ('?', '') THEN NULL ELSE {c} END AS {c}" if c in CLAIM_STR else c
    for c in CLAIM_COLS) + " FROM claims"


def _csql(body: str, extra=None) -> str:
    return fx.with_views(["claims"], body, [("clean", _CLEAN_SQL)] + (extra or []))


def _clean(spark, sf):
    return cl.token_to_null(fx.claims(spark, sf))


@register("token_to_null", _csql("SELECT * FROM clean"))
def q_token_to_null(spark, sf):
    return _clean(spark, sf)


_PROFILE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100.0, 6) AS null_pct "
    f"FROM clean" for c in CLAIM_COLS)


@register("null_profile", _csql("SELECT * FROM prof WHERE null_pct > 0", [("prof", _PROFILE_SQL)]))
def q_null_profile(spark, sf):
    return cl.null_profile(_clean(spark, sf))


@register("null_profile_ranked", _csql(
    "SELECT column_name, null_pct, CAST(row_number() OVER (ORDER BY null_pct DESC, column_name) AS INTEGER) AS rank "
    "FROM prof WHERE null_pct > 0", [("prof", _PROFILE_SQL)]))
def q_null_profile_ranked(spark, sf):
    return cl.null_profile_ranked(_clean(spark, sf))


# o_orderpriority carries the planted '?' on every third order (~33 % > 30 %)
@register("drop_sparse_columns", _csql(
    "SELECT " + ", ".join(c for c in CLAIM_COLS if c != "o_orderpriority") + " FROM clean"))
def q_drop_sparse_columns(spark, sf):
    return cl.drop_sparse_columns(_clean(spark, sf), 0.3)


@register("drop_incomplete_rows", _csql(
    "SELECT * FROM clean WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in CLAIM_COLS)))
def q_drop_incomplete_rows(spark, sf):
    return cl.drop_incomplete_rows(_clean(spark, sf))


@register("fill_missing", _csql("SELECT " + ", ".join(
    f"coalesce({c}, '0') AS {c}" if c in CLAIM_STR else c for c in CLAIM_COLS) + " FROM clean"))
def q_fill_missing(spark, sf):
    return cl.fill_missing(_clean(spark, sf), "0")


@register("drop_columns", _csql("SELECT " + ", ".join(
    c for c in CLAIM_COLS if c not in ("row_id", "household_id", "calendar_year")) + " FROM clean"))
def q_drop_columns(spark, sf):
    return cl.drop_columns(_clean(spark, sf), ["row_id", "household_id", "calendar_year"])


@register("select_columns", _csql("SELECT row_id, p_type, claim_amount FROM clean"))
def q_select_columns(spark, sf):
    return cl.select_columns(_clean(spark, sf), ["row_id", "p_type", "claim_amount"])


@register("columns_by_type", _csql("SELECT " + ", ".join(CLAIM_STR) + " FROM clean"))
def q_columns_by_type(spark, sf):
    df = _clean(spark, sf)
    return df.select(*cl.columns_by_type(df, ["string"], exclude=["claim_amount"]))


@register("cast_columns", _csql(
    "SELECT row_id, CAST(p_size AS DOUBLE) AS p_size, CAST(calendar_year AS DOUBLE) AS calendar_year FROM clean"))
def q_cast_columns(spark, sf):
    return cl.cast_columns(_clean(spark, sf), ["p_size", "calendar_year"], "double").select(
        "row_id", "p_size", "calendar_year")


@register("binarise_target", _csql(
    "SELECT row_id, claim_amount, CAST(claim_amount <> 0 AS INTEGER) AS is_claim FROM clean"))
def q_binarise_target(spark, sf):
    return cl.binarise_target(_clean(spark, sf), "claim_amount", "is_claim").select(
        "row_id", "claim_amount", "is_claim")


@register("class_balance", _csql(
    """SELECT n_zero, n_nonzero, round(n_zero * 1.0 / n_nonzero, 6) AS ratio,
              CAST(floor(n_zero * 1.0 / n_nonzero) AS INTEGER) AS replicate
       FROM (SELECT count(*) FILTER (WHERE claim_amount = 0) AS n_zero,
                    count(*) FILTER (WHERE claim_amount <> 0) AS n_nonzero FROM clean)"""))
def q_class_balance(spark, sf):
    return cl.class_balance(_clean(spark, sf), "claim_amount")


_OVERSAMPLED = """
    SELECT c.* FROM clean c WHERE claim_amount = 0
    UNION ALL
    SELECT c.* FROM clean c, range(1, 1 + (SELECT CAST(floor((count(*) FILTER (WHERE claim_amount = 0)) * 1.0
                                                         / (count(*) FILTER (WHERE claim_amount <> 0))) AS BIGINT)
                                           FROM clean)) r
    WHERE claim_amount <> 0"""


@register("oversample_minority", _csql("SELECT * FROM over", [("over", _OVERSAMPLED)]))
def q_oversample_minority(spark, sf):
    return cl.oversample(_clean(spark, sf), F.col("claim_amount") != 0)


@register("replicate_rows", _csql(
    "SELECT c.row_id, c.claim_amount FROM clean c, range(3) r WHERE claim_amount <> 0"))
def q_replicate_rows(spark, sf):
    return cl.replicate_rows(_clean(spark, sf).where("claim_amount <> 0"), 3).select("row_id", "claim_amount")


@register("union_all", _csql(
    """SELECT 'zero' AS part, row_id, claim_amount FROM clean WHERE claim_amount = 0
       UNION ALL SELECT 'claim' AS part, row_id, claim_amount FROM clean WHERE claim_amount <> 0"""))
def q_union_all(spark, sf):
    c = _clean(spark, sf).select("row_id", "claim_amount")
    return cl.union_all(c.where("claim_amount = 0").select(F.lit("zero").alias("part"), "*"),
                        c.where("claim_amount <> 0").select(F.lit("claim").alias("part"), "*"))


@register("undersample_majority", _csql(
    """SELECT row_id, claim_amount FROM clean WHERE claim_amount <> 0
       UNION ALL
       SELECT row_id, claim_amount FROM (
         SELECT row_id, claim_amount,
                row_number() OVER (ORDER BY md5('7:' || CAST(row_id AS VARCHAR)), row_id) AS o
         FROM clean WHERE claim_amount = 0)
       WHERE o <= (SELECT count(*) FROM clean WHERE claim_amount <> 0)"""))
def q_undersample_majority(spark, sf):
    return cl.undersample(_clean(spark, sf).select("row_id", "claim_amount"),
                          F.col("claim_amount") != 0, "row_id", seed=7)


# ------------------------------------------------------------------ ratings / items / topics

def _rsql(body: str, extra=None, views=("ratings",)) -> str:
    return fx.with_views(list(views), body, extra)


@register("filter_range", _rsql("SELECT event_id, rating FROM ratings WHERE rating BETWEEN 2 AND 4"))
def q_filter_range(spark, sf):
    return cl.filter_range(fx.ratings(spark, sf), "rating", 2, 4).select("event_id", "rating")


@register("filter_threshold", _rsql("SELECT event_id, user_id, item, rating FROM ratings WHERE rating >= 4"))
def q_filter_threshold(spark, sf):
    return cl.filter_threshold(fx.ratings(spark, sf), F.col("rating") >= 4).select(
        "event_id", "user_id", "item", "rating")


@register("format_metric", _rsql(
    "SELECT item, format('{:,.3f}', avg(rating)) AS avg_rating FROM ratings GROUP BY item"))
def q_format_metric(spark, sf):
    r = fx.ratings(spark, sf).groupBy("item").agg(F.avg("rating").alias("m"))
    return r.select("item", cl.format_metric("m", 3).alias("avg_rating"))


@register("split_multivalue", _rsql(
    "SELECT item, CAST(g.pos AS INTEGER) AS pos, g.genre FROM items, "
    "unnest(string_split(genres, '|')) WITH ORDINALITY AS g(genre, pos)", views=("items",)))
def q_split_multivalue(spark, sf):
    it = fx.items(spark, sf)
    return it.select("item", F.posexplode(cl.split_multivalue("genres")).alias("pos", "genre")).select(
        "item", (F.col("pos") + 1).alias("pos"), "genre")


@register("relabel_zero_based", _rsql("SELECT doc_id, CAST(label - 1 AS INTEGER) AS label FROM topics",
                                      views=("topics",)))
def q_relabel_zero_based(spark, sf):
    return cl.relabel_zero_based(fx.topics(spark, sf)).select("doc_id", "label")


@register("ordinal_by_time", _rsql(
    "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS ordinal FROM ratings"))
def q_ordinal_by_time(spark, sf):
    return sp.ordinal_by(fx.ratings(spark, sf), ["ts", "event_id"]).select("event_id", "ordinal")


@register("sequential_split", _rsql(
    """SELECT event_id, CASE WHEN row_number() OVER (ORDER BY ts, event_id)
                                  <= floor(0.8 * count(*) OVER ()) THEN 'train' ELSE 'test' END AS split
       FROM ratings"""))
def q_sequential_split(spark, sf):
    return sp.sequential_split(fx.ratings(spark, sf), ["ts", "event_id"], 0.8).select("event_id", "split")


@register("split_sizes", _rsql(
    """SELECT CAST(f.fraction AS DOUBLE) AS fraction, s.split, count(*) AS n FROM (VALUES (0.5), (0.65), (0.8)) f(fraction),
       LATERAL (SELECT CASE WHEN row_number() OVER (ORDER BY ts, event_id)
                                 <= floor(f.fraction * count(*) OVER ()) THEN 'train' ELSE 'test' END AS split
                FROM ratings) s
       GROUP BY ALL"""))
def q_split_sizes(spark, sf):
    parts = [sp.sequential_split(fx.ratings(spark, sf), ["ts", "event_id"], x).groupBy("split").agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(x).alias("fraction"), "split", "n") for x in (0.5, 0.65, 0.8)]
    return cl.union_all(*parts)


@register("sort_by_time", _rsql("SELECT event_id, user_id, item, rating FROM ratings ORDER BY ts, event_id"))
def q_sort_by_time(spark, sf):
    return sp.sort_by(fx.ratings(spark, sf), ["ts", "event_id"]).select("event_id", "user_id", "item", "rating")


@register("hash_split", _rsql(
    """SELECT event_id, CASE WHEN ('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8))::BIGINT % 100 < 80
                             THEN 'train' ELSE 'test' END AS split FROM ratings"""))
def q_hash_split(spark, sf):
    return sp.hash_split(fx.ratings(spark, sf), "event_id", [0.8, 0.2], ["train", "test"]).select(
        "event_id", "split")


@register("random_split")
def q_random_split(spark, sf):
    parts = sp.random_split(fx.ratings(spark, sf).select("event_id"), [0.8, 0.2], seed=42)
    return parts[0].select(F.lit("train").alias("split"), "event_id").unionByName(
        parts[1].select(F.lit("test").alias("split"), "event_id"))


@register("dedup_last_wins", fx.with_views(["texts"], """
    SELECT md5(text) AS text_md5, max_by(doc_id, doc_id) AS doc_id, max_by(label, doc_id) AS label
    FROM texts GROUP BY text"""))
def q_dedup_last_wins(spark, sf):
    t = fx.texts(spark, sf).select("text", "doc_id", "label")
    d = dedup_last_wins(t, "text", "doc_id")
    return d.select(F.md5("text").alias("text_md5"), "doc_id", "label")
