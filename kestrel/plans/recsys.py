"""Recommendation plans (A5-A7, J1, J2, G1-G4) over ``ratings`` and ``items``.

The cluster -> genre chain is checked by SQL on a given assignment (md5
bucket of the user); the same chain on ALS + KMeans clusters is rows-only.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions import hash_bucket, round6
from kestrel.operators import recsys as rs
from kestrel.plans.registry import register
from kestrel.sources import fixtures as fx

_ASSIGN = ("SELECT DISTINCT user_id, CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8))::BIGINT % 20 "
           "AS INTEGER) AS cluster FROM ratings")
_CTES = [
    ("assign", _ASSIGN),
    ("sizes", "SELECT cluster, count(*) AS size, row_number() OVER (ORDER BY count(*) DESC, cluster) AS rank "
              "FROM assign GROUP BY cluster"),
    ("cusers", "SELECT user_id FROM assign WHERE cluster = (SELECT cluster FROM sizes WHERE rank = 1)"),
    ("cratings", "SELECT * FROM ratings WHERE user_id IN (SELECT user_id FROM cusers)"),
    ("liked", "SELECT DISTINCT item FROM cratings WHERE rating >= 4"),
    ("litems", "SELECT * FROM items WHERE item IN (SELECT item FROM liked)"),
    ("genres", "SELECT genre, count(*) AS n FROM (SELECT unnest(string_split(genres, '|')) AS genre FROM litems) "
               "GROUP BY genre"),
]


def _sql(body: str) -> str:
    return fx.with_views(["ratings", "items"], body, _CTES)


def _assign(spark, sf):
    r = fx.ratings(spark, sf)
    return r.select("user_id").distinct().select("user_id", hash_bucket("user_id", 20).alias("cluster"))


def _chain(spark, sf):
    users = rs.users_of_largest(_assign(spark, sf))
    cr = rs.semi_join_users(fx.ratings(spark, sf), users)
    liked = rs.distinct_items(cr)
    li = rs.semi_join_items(fx.items(spark, sf), liked)
    return cr, liked, li


@register("cluster_sizes", _sql("SELECT cluster, size, rank FROM sizes"))
def q_cluster_sizes(spark, sf):
    return rs.cluster_sizes(_assign(spark, sf)).select("cluster", "size", F.col("rank").cast("long").alias("rank"))


@register("semi_join_users", _sql("SELECT event_id, user_id, item, rating FROM cratings"))
def q_semi_join_users(spark, sf):
    return _chain(spark, sf)[0].select("event_id", "user_id", "item", "rating")


@register("distinct_items", _sql("SELECT item FROM liked"))
def q_distinct_items(spark, sf):
    return _chain(spark, sf)[1]


@register("semi_join_items", _sql("SELECT item, genres FROM litems"))
def q_semi_join_items(spark, sf):
    return _chain(spark, sf)[2]


@register("genre_counts", _sql("SELECT genre, n FROM genres"))
def q_genre_counts(spark, sf):
    return rs.genre_counts(_chain(spark, sf)[2])


@register("largest_cluster_top_genres", _sql("SELECT genre, n FROM genres ORDER BY n DESC, genre LIMIT 5"))
def q_largest_cluster_top_genres(spark, sf):
    return rs.largest_cluster_top_genres(_assign(spark, sf), fx.ratings(spark, sf), fx.items(spark, sf), 5)


# ------------------------------------------------------------------ ALS / KMeans (rows-only)

def _splits(spark, sf, fractions=(0.5, 0.65, 0.8)):
    return rs.time_splits(rs.pair_ratings_keep(fx.ratings(spark, sf)), fractions)


@register("als_fit")
def q_als_fit(spark, sf):
    """Default ALS on the first 80 % of ratings by time, scored on the rest."""
    train, test = _splits(spark, sf, (0.8,))["0.8"]
    model = rs.als_fit(rs.pair_ratings(train))
    m = rs.regression_metrics(model.transform(test), "rating", "prediction")
    return m.select(*[round6(F.col(c)).alias(c) for c in m.columns])


@register("als_grid")
def q_als_grid(spark, sf):
    sp = {k: (rs.pair_ratings(tr), te) for k, (tr, te) in _splits(spark, sf).items()}
    g = rs.als_grid(sp)
    return g.select("split", "setting", *[round6(F.col(c)).alias(c) for c in ("rmse", "mse", "mae")])


@register("kmeans_user_factors")
def q_kmeans_user_factors(spark, sf):
    """Three largest of k=20 user clusters for each time split."""
    out = None
    for name, (tr, _te) in _splits(spark, sf).items():
        model = rs.als_fit(rs.pair_ratings(tr))
        sizes = rs.cluster_sizes(rs.cluster_factors(model, k=20)).where("rank <= 3")
        part = sizes.select(F.lit(name).alias("split"), "cluster", "size", "rank")
        out = part if out is None else out.unionByName(part)
    return out


@register("largest_cluster_top_genres_kmeans")
def q_largest_cluster_top_genres_kmeans(spark, sf):
    """G4 on ALS + KMeans clusters: top 5 genres liked by the largest cluster,
    in the train and test part of the three time splits."""
    items = fx.items(spark, sf)
    out = None
    for split, (tr, te) in _splits(spark, sf).items():
        assign = rs.cluster_factors(rs.als_fit(rs.pair_ratings(tr)), k=20)
        for part, rows in (("train", tr), ("test", te)):
            top = rs.largest_cluster_top_genres(assign, rows, items).select(
                F.lit(split).alias("split"), F.lit(part).alias("part"), "genre", "n")
            out = top if out is None else out.unionByName(top)
    return out
