"""Ordered and hashed splits.

``ordinal_by`` gives every row its exact 1-based position in a global order
without an unpartitioned window: rows are range-partitioned on the full sort
key (so a hot key value is spread by its tie-breakers), sorted inside each
partition, numbered locally, and shifted by the row count of all earlier
partitions. Only one count per partition passes through a window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions import hash_bucket

_LOCAL_BITS = 33  # monotonically_increasing_id: partition index << 33 | row in partition


def ordinal_by(df: DataFrame, order_cols: Sequence[str], ordinal_col: str = "ordinal",
               partitions: int | None = None, keep_total: bool = False) -> DataFrame:
    """Append ``ordinal_col`` = row_number() over the global order of
    ``order_cols`` (which should form a total order).

    The range-partitioned, numbered rows are checkpointed to the session's
    checkpoint folder before the offsets are taken: the partition a row went
    to is then fixed, whatever a recomputation after an executor loss would
    sample, and the lineage is cut.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (df.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in order_cols])
               .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order_cols])
               .withColumn("_mid", F.monotonically_increasing_id()))
    frozen = ordered.checkpoint(eager=True)
    pid = F.shiftright(F.col("_mid"), _LOCAL_BITS)
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    counts = frozen.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: the window and the broadcast are bounded by the
    # partition count, never by the data
    w = Window.orderBy("_pid")
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"))
    out = (frozen.withColumn("_pid", pid).join(F.broadcast(offsets), "_pid")
           .withColumn(ordinal_col, F.col("_off") + local + 1))
    out = out.drop("_mid", "_pid", "_off")
    return out if keep_total else out.drop("_total")


#: Rows that a selection sorts in the end, rows it samples each round, and pivots in units of the sample's deviation.
FEW = 4096
SAMPLE = 8192
_SPREAD = (-16, -8, -4, -2, -1, -0.5, 0, 0.5, 1, 2, 4, 8, 16)


def _comparable(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """The columns as values that stay the same on their way to the driver and back: instants as numbers."""
    types = dict(df.dtypes)
    return [F.unix_micros(c).alias(c) if types[c] == "timestamp" else F.col(c) for c in cols]


def _key(df: DataFrame, cols: Sequence[str]) -> Column:
    return F.struct(*_comparable(df, cols))


def _literal(df: DataFrame, cols: Sequence[str], row) -> Column:
    types = {c: "bigint" if t == "timestamp" else t for c, t in df.dtypes}
    return F.struct(*[F.lit(row[c]).cast(types[c]).alias(c) for c in cols])


def row_at(df: DataFrame, cols: Sequence[str], position: int):
    """The values of ``cols`` in the row at 1-based ``position`` of their order; None beyond the last row.

    Exact selection by repeated histograms: a bounded sample of the rows that are still possible gives pivots around the
    wanted position, one pass counts the rows below and at each pivot, and only the rows between two neighbouring pivots are
    possible from then on. With ``FEW`` rows or fewer left, these are sorted. A pivot is a row, so every round leaves fewer
    rows, and a key that all rows share is its own pivot. Order: nulls before values, NaN last (``ordinal_by``'s).
    Instants come back as microseconds, as ``up_to`` takes them.
    """
    keys = df.select(*_comparable(df, cols))
    possible, below = keys, 0
    n = keys.count()
    if not 1 <= position <= n:
        return None
    seed = 0
    while n > FEW:
        seed += 1
        sample = possible.sample(min(1.0, SAMPLE / n), seed).orderBy(*[F.col(c).asc_nulls_first() for c in cols]).collect()  # about SAMPLE rows
        if not sample:
            continue
        m, at = len(sample), (position - below) / n * len(sample)
        places = sorted({min(m - 1, max(0, round(at + x * math.sqrt(m) / 2))) for x in _SPREAD})
        pivots = list(dict.fromkeys(sample[i] for i in places))
        key = F.struct(*cols)
        limits = [_literal(keys, cols, p) for p in pivots]
        got = possible.agg(*[F.count_if(key < x) for x in limits], *[F.count_if(key <= x) for x in limits]).first()
        less, upto = [below + x for x in got[:len(pivots)]], [below + x for x in got[len(pivots):]]
        i = sum(position > x for x in upto)  # pivots that lie before the position
        if i < len(pivots) and position > less[i]:
            return pivots[i]
        if i:
            possible = possible.where(key > limits[i - 1])
        if i < len(pivots):
            possible = possible.where(key < limits[i])
        n = (less[i] if i < len(pivots) else below + n) - (upto[i - 1] if i else below)
        below = upto[i - 1] if i else below
    return possible.orderBy(*[F.col(c).asc_nulls_first() for c in cols]).offset(position - below - 1).limit(1).first()


def up_to(df: DataFrame, cols: Sequence[str], row) -> Column:
    """True for the rows of ``df`` at or before ``row`` (of ``row_at``) in the order of ``cols``."""
    return _key(df, cols) <= _literal(df, cols, row)


def sequential_split(df: DataFrame, order_cols: Sequence[str], fraction: float,
                     split_col: str = "split") -> DataFrame:
    """First floor(fraction * n) rows of the order -> 'train', the rest -> 'test' (W2).

    The row at the cut is located by counting (``row_at``) and the table is filtered by its key: no full sort, no copy of
    the rows. Rows without a key come first; rows equal in all of ``order_cols`` lie on one side of the cut.
    """
    position = math.floor(df.count() * fraction)
    if not position:
        return df.withColumn(split_col, F.lit("test"))
    row = row_at(df, order_cols, position)
    return df.withColumn(split_col, F.when(up_to(df, order_cols, row), "train").otherwise("test"))


def sort_by(df: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    """Global ascending sort (T2): range exchange + per-partition sort."""
    return df.orderBy(*order_cols)


def hash_split(df: DataFrame, key: str, weights: Sequence[float], names: Sequence[str] | None = None,
               split_col: str = "split", buckets: int = 100) -> DataFrame:
    """Deterministic weighted split by md5 bucket of ``key`` (X1): the same
    row always lands in the same part, in any engine, with no shuffle."""
    names = list(names) if names else [f"part{i}" for i in range(len(weights))]
    total = float(sum(weights))
    b = hash_bucket(key, buckets)
    expr = None
    acc = 0.0
    for i, (w, nm) in enumerate(zip(weights, names)):
        acc += w / total
        hi = int(round(acc * buckets))
        if i == len(weights) - 1:
            expr = F.lit(nm) if expr is None else expr.otherwise(F.lit(nm))
        else:
            expr = F.when(b < hi, F.lit(nm)) if expr is None else expr.when(b < hi, F.lit(nm))
    return df.withColumn(split_col, expr)


def random_split(df: DataFrame, weights: Sequence[float], seed: int = 42) -> list[DataFrame]:
    """Spark's seeded Bernoulli split (sizes vary around the weights)."""
    return df.randomSplit(list(weights), seed)
