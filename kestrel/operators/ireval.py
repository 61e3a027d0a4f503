"""Retrieval evaluation.

``run``: (qid, docid) plus the columns that give the file's line order (the
line order is the rank). ``gold``: (qid, docid) relevance pairs. A document
listed twice for a query uses up two ranks but earns credit once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def run_ranks(run: DataFrame, order_cols: Sequence[str] = ("line_no",)) -> DataFrame:
    """(qid, docid, rank, first): rank by line order within the query, and
    whether this is the first listing of the document (W5)."""
    w = Window.partitionBy("qid").orderBy(*order_cols)
    wd = Window.partitionBy("qid", "docid").orderBy(*order_cols)
    return run.select("qid", "docid", *order_cols,
                      F.row_number().over(w).alias("rank"),
                      (F.row_number().over(wd) == 1).alias("first")).drop(*order_cols)


def cutoff(ranked: DataFrame, n: int | None) -> DataFrame:
    """Only the first n responses of each query (E3); None or 0 keeps all."""
    return ranked.where(F.col("rank") <= n) if n else ranked


def judged(ranked: DataFrame, gold: DataFrame) -> DataFrame:
    """Run rows with ``hit`` = relevant and first listing."""
    g = gold.select("qid", "docid").distinct().withColumn("_rel", F.lit(True))
    return (ranked.join(g, ["qid", "docid"], "left")
            .withColumn("hit", F.coalesce(F.col("_rel"), F.lit(False)) & F.col("first")).drop("_rel"))


def all_qids(run: DataFrame, gold: DataFrame) -> DataFrame:
    """Query ids of the gold set and the run."""
    return run.select("qid").union(gold.select("qid")).distinct()


def ir_per_query(run: DataFrame, gold: DataFrame, n: int | None = None,
                 order_cols: Sequence[str] = ("line_no",)) -> DataFrame:
    """(qid, retrieved, relevant, rel_ret) for every query of gold or run (E1):
    a full outer join of the two per-query aggregates, missing side = 0 (J8)."""
    j = judged(cutoff(run_ranks(run, order_cols), n), gold)
    r = j.groupBy("qid").agg(F.count(F.lit(1)).alias("retrieved"), F.count_if("hit").alias("rel_ret"))
    g = gold.select("qid", "docid").distinct().groupBy("qid").agg(F.count(F.lit(1)).alias("relevant"))
    return (r.join(g, "qid", "full_outer")
            .select("qid", F.coalesce("retrieved", F.lit(0)).alias("retrieved"),
                    F.coalesce("relevant", F.lit(0)).alias("relevant"),
                    F.coalesce("rel_ret", F.lit(0)).alias("rel_ret")))


def run_totals(per_query: DataFrame) -> DataFrame:
    """One row of totals over all queries."""
    return per_query.agg(F.count(F.lit(1)).alias("n_queries"), F.sum("retrieved").alias("retrieved"),
                         F.sum("relevant").alias("relevant"), F.sum("rel_ret").alias("rel_ret"))


def ir_summary(run: DataFrame, gold: DataFrame, n: int | None = None,
               order_cols: Sequence[str] = ("line_no",)) -> DataFrame:
    """Micro precision / recall / F over all queries, zero-safe."""
    t = run_totals(ir_per_query(run, gold, n, order_cols))
    p = F.coalesce(F.try_divide(F.col("rel_ret").cast("double"), F.col("retrieved").cast("double")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("rel_ret").cast("double"), F.col("relevant").cast("double")), F.lit(0.0))
    t = t.select("*", p.alias("precision"), r.alias("recall"))
    f = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
                   F.lit(0.0))
    return t.select("*", f.alias("f_measure"))


def precision_at_hits(run: DataFrame, gold: DataFrame, n: int | None = None,
                      order_cols: Sequence[str] = ("line_no",)) -> DataFrame:
    """(qid, hit_no, rank, precision = hit_no / rank) at each relevant hit."""
    hits = judged(cutoff(run_ranks(run, order_cols), n), gold).where("hit")
    w = Window.partitionBy("qid").orderBy("rank")
    return hits.select("qid", F.row_number().over(w).alias("hit_no"), "rank").select(
        "qid", "hit_no", "rank", (F.col("hit_no") / F.col("rank")).alias("precision"))


def best_at_points(run: DataFrame, gold: DataFrame, points: int = 10, n: int | None = None,
                   order_cols: Sequence[str] = ("line_no",)) -> DataFrame:
    """(qid, point, p): best precision of the hits at recall points 0..P of every
    query. Hit i of a query with R relevant documents goes to point floor(i*P/R);
    the point grid is generated per query (no join)."""
    pah = precision_at_hits(run, gold, n, order_cols)
    rel = gold.select("qid", "docid").distinct().groupBy("qid").agg(F.count(F.lit(1)).alias("relevant"))
    best = (pah.join(rel, "qid")
            .select("qid", F.floor(F.col("hit_no") * points / F.col("relevant")).cast("int").alias("point"),
                    "precision")
            .groupBy("qid", "point").agg(F.max("precision").alias("p")))
    grid = all_qids(run, gold).select("qid", F.explode(F.sequence(F.lit(0), F.lit(points))).alias("point"))
    return grid.join(best, ["qid", "point"], "left").withColumn("p", F.coalesce("p", F.lit(0.0)))


def suffix_max(df: DataFrame, group: str, order: str, value: str, out: str = "suffix_max") -> DataFrame:
    """Adds the maximum of ``value`` over this row and all later ones of its group."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return df.withColumn(out, F.max(value).over(w))


def interpolated_precision(run: DataFrame, gold: DataFrame, points: int = 10, n: int | None = None,
                           order_cols: Sequence[str] = ("line_no",)) -> DataFrame:
    """(qid, point, precision) for recall points 0..P of every query (E5): the best
    precision at the point or any point to its right."""
    cells = suffix_max(best_at_points(run, gold, points, n, order_cols), "qid", "point", "p", "precision")
    return cells.select("qid", "point", "precision")


def interpolated_precision_avg(run: DataFrame, gold: DataFrame, points: int = 10, n: int | None = None,
                               order_cols: Sequence[str] = ("line_no",)) -> DataFrame:
    """(point, recall, precision) averaged over ALL query ids of gold and run."""
    per_q = interpolated_precision(run, gold, points, n, order_cols)
    return per_q.groupBy("point").agg(F.avg("precision").alias("precision")).select(
        "point", (F.col("point") / F.lit(float(points))).alias("recall"), "precision")
