"""Tables written between the steps of an operator (``keep``), rows picked by id, and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.batches import fresh

# Executors that are lost after a table is written take nothing of it with them, and the steps before aren't run again.
from kestrel.session import materialise as keep

__all__ = ["among", "components", "keep", "not_among"]

#: Rows of 64 marks that are broadcast to tell most rows without an id of a list; their number doesn't follow the list's.
SLOTS = 1 << 17


def _marked(rows: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` that may have an id of ``ids``, and those that have none. Nothing of ``rows`` is shuffled."""
    slot, marks = fresh(rows, "slot", "marks")
    h = F.xxhash64(F.col(key).cast("long"))
    at, bit = F.pmod(h, F.lit(SLOTS)), F.shiftrightunsigned(h, 58).cast("int")
    spark = rows.sparkSession
    every = spark.range(SLOTS).select(F.col("id").alias(slot), F.lit(0).cast("long").alias(marks))
    own = ids.select(at.alias(slot), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias(marks))
    table = every.union(own).groupBy(slot).agg(F.bit_or(marks).alias(marks))
    looked = rows.join(F.broadcast(table), at == F.col(slot))
    hit = F.getbit(F.col(marks), bit) == 1
    return looked.where(hit).select(*rows.columns), looked.where(~hit).select(*rows.columns)


def among(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is in ``ids`` (of one column, ``key``), which are best written: they are read twice.

    Only rows that may be among them meet the ids, so that long texts aren't shuffled to be thrown away."""
    return _marked(rows, ids, key)[0].join(ids, key, "left_semi").select(*rows.columns)


def not_among(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is null or not in ``ids``, as ``among``."""
    maybe, others = _marked(rows, ids, key)
    return others.unionByName(maybe.join(ids, key, "left_anti").select(*rows.columns))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge (a, b): the smallest node that it reaches.

    Large-star and small-star rounds (Kiveris et al. 2014) until nothing changes; nodes with many edges are
    only ever aggregated by their minimum.
    """
    now = keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        after = keep(small.distinct(), "edges")
        before, mark, now = mark, _mark(after), after
        if mark == before:
            break
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
