"""Collaborative filtering and user clustering.

ALS and KMeans are Spark ML estimators; everything around them is joins,
aggregations and windows -- user ids of a cluster never travel to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.clean import split_multivalue
from kestrel.operators.metrics import regression_metrics

# fixed values: the three ALS settings compared
ALS_SETTINGS = {
    "default": {},
    "reg_0.01": {"regParam": 0.01},
    "iter15_nonneg": {"maxIter": 15, "nonnegative": True},
}


def pair_ratings(ratings: DataFrame, user: str = "user_id", item: str = "item",
                 rating: str = "rating") -> DataFrame:
    """One rating per (user, item): repeated pairs averaged."""
    return ratings.groupBy(user, item).agg(F.avg(rating).alias(rating))


def pair_ratings_keep(ratings: DataFrame) -> DataFrame:
    """Ratings with the columns the time split needs."""
    return ratings.select("user_id", "item", "rating", "ts", "event_id")


def als_fit(train: DataFrame, seed: int = 42, user: str = "user_id", item: str = "item",
            rating: str = "rating", **params) -> ALSModel:
    """Explicit-feedback ALS (Spark defaults: rank 10, 10 iterations, reg 0.1);
    users or items unseen in training are dropped at scoring time."""
    als = ALS(userCol=user, itemCol=item, ratingCol=rating, coldStartStrategy="drop", seed=seed, **params)
    return als.fit(train)


def als_grid(splits: dict[str, tuple[DataFrame, DataFrame]], settings: dict[str, dict] | None = None,
             seed: int = 42) -> DataFrame:
    """(split, setting, rmse, mse, mae) for each split x ALS setting.
    Each fit is a Spark job chain; the three metrics come from one aggregation."""
    rows = None
    for sname, (train, test) in splits.items():
        for cname, params in (settings or ALS_SETTINGS).items():
            model = als_fit(train, seed=seed, **params)
            m = regression_metrics(model.transform(test), "rating", "prediction").select(
                F.lit(sname).alias("split"), F.lit(cname).alias("setting"), "*")
            rows = m if rows is None else rows.unionByName(m)
    return rows


def cluster_factors(model: ALSModel, k: int = 20, seed: int = 42, user: str = "user_id") -> DataFrame:
    """(user_id, cluster): KMeans on the ALS user factors."""
    f = model.userFactors.select(F.col("id").alias(user), array_to_vector("features").alias("features"))
    km = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(f)
    return km.transform(f).select(user, "cluster")


def cluster_sizes(assign: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(cluster, size, rank) rank 1 = largest, ties by cluster id (A5)."""
    s = assign.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"))
    # one row per cluster: k rows in a single window
    return s.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("size"), F.asc(cluster))))


def users_of_largest(assign: DataFrame, cluster: str = "cluster", user: str = "user_id") -> DataFrame:
    top = cluster_sizes(assign, cluster).where("rank = 1").select(cluster)
    # a single row: the broadcast is bounded
    return assign.join(F.broadcast(top), cluster, "left_semi").select(user)


def semi_join_users(ratings: DataFrame, users: DataFrame, user: str = "user_id") -> DataFrame:
    """Ratings of the given users (J1): a semi join, not an IN-list built on the driver."""
    return ratings.join(users.select(user), user, "left_semi")


def distinct_items(ratings: DataFrame, min_rating: float = 4.0, item: str = "item") -> DataFrame:
    """Items rated at least ``min_rating``."""
    return ratings.where(F.col("rating") >= min_rating).select(item).distinct()


def semi_join_items(items: DataFrame, ids: DataFrame, item: str = "item") -> DataFrame:
    """Items whose id is in ``ids``."""
    return items.join(ids.select(item), item, "left_semi")


def genre_counts(items: DataFrame, genres: str = "genres", sep: str = "|") -> DataFrame:
    """(genre, n, rank): items per genre, rank 1 = most common, ties by name."""
    g = items.select(F.explode(split_multivalue(genres, sep)).alias("genre")).groupBy("genre").agg(
        F.count(F.lit(1)).alias("n"))
    return g


def largest_cluster_top_genres(assign: DataFrame, ratings: DataFrame, items: DataFrame, k: int = 5,
                               min_rating: float = 4.0) -> DataFrame:
    """Top ``k`` genres of the items liked (>= min_rating) by the users of the
    largest cluster (G4): J1 -> A6 -> J2 -> A7 -> top-k, one plan."""
    users = users_of_largest(assign)
    liked = distinct_items(semi_join_users(ratings, users), min_rating)
    g = genre_counts(semi_join_items(items, liked))
    return g.orderBy(F.desc("n"), F.asc("genre")).limit(k)


def time_splits(ratings: DataFrame, fractions: Sequence[float] = (0.5, 0.65, 0.8),
                order_cols: Sequence[str] = ("ts", "event_id")) -> dict[str, tuple[DataFrame, DataFrame]]:
    """{fraction: (train, test)}: the ratings before and after the row at each cut, which is located by counting
    (``splits.row_at``); the ratings are neither sorted nor copied."""
    from kestrel.operators.splits import sequential_split

    out = {}
    for fr in fractions:
        parts = sequential_split(ratings, list(order_cols), fr, "_split")
        out[str(fr)] = tuple(parts.where(F.col("_split") == name).drop("_split") for name in ("train", "test"))
    return out
