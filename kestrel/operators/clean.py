"""Cleaning, profiling and simple projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPE_NAMES = {
    "string": T.StringType, "int": T.IntegerType, "bigint": T.LongType, "long": T.LongType,
    "double": T.DoubleType, "float": T.FloatType, "boolean": T.BooleanType,
}


def token_to_null(df: DataFrame, tokens: Sequence[str] = ("?",), blank: bool = True) -> DataFrame:
    """Replace missing-value tokens (and blank strings) by NULL in every string
    column, in one projection."""
    toks = list(tokens) + ([""] if blank else [])
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            cols.append(F.when(F.trim(F.col(f.name)).isin(toks), F.lit(None).cast("string"))
                        .otherwise(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def null_profile(df: DataFrame, only_positive: bool = True) -> DataFrame:
    """(column_name, null_pct) from ONE aggregation pass over all columns
    (partial aggregates per task, then a one-row merge)."""
    names = df.columns
    agg = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100.0).alias(c) for c in names])
    long = agg.unpivot([], names, "column_name", "null_pct")
    long = long.select("column_name", F.round("null_pct", 6).alias("null_pct"))
    return long.where(F.col("null_pct") > 0) if only_positive else long


def null_profile_ranked(df: DataFrame) -> DataFrame:
    """C1 ordered by null share (descending), ties by column name, with rank."""
    prof = null_profile(df)
    # one row per column: a single-partition window over a schema-sized table
    from pyspark.sql import Window

    w = Window.orderBy(F.desc("null_pct"), F.asc("column_name"))
    return prof.withColumn("rank", F.row_number().over(w))


def sparse_columns(df: DataFrame, max_share: float = 0.3) -> list[str]:
    """Names of columns whose NULL share exceeds ``max_share`` (0..1). The
    profile has one row per column, so bringing it to the driver is bounded by
    the schema, not the data."""
    prof = null_profile(df)
    return [r.column_name for r in prof.where(F.col("null_pct") > max_share * 100).collect()]


def drop_sparse_columns(df: DataFrame, max_share: float = 0.3) -> DataFrame:
    return df.drop(*sparse_columns(df, max_share))


def drop_incomplete_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def fill_missing(df: DataFrame, value: str = "0", columns: Sequence[str] | None = None) -> DataFrame:
    """NULL -> constant category (string columns by default)."""
    cols = list(columns) if columns else [f.name for f in df.schema.fields
                                          if isinstance(f.dataType, T.StringType)]
    return df.na.fill(value, subset=cols)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def columns_by_type(df: DataFrame, types: Sequence[str], exclude: Sequence[str] = ()) -> list[str]:
    """Column names whose type is one of ``types`` (e.g. 'string', 'int'),
    minus ``exclude``; read from the schema, no job."""
    wanted = tuple(_TYPE_NAMES[t] for t in types)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, wanted) and f.name not in exclude]


def cast_columns(df: DataFrame, columns: Sequence[str], to: str) -> DataFrame:
    """Cast the named columns in one projection (others kept in place)."""
    cs = set(columns)
    return df.select(*[F.col(c).try_cast(to).alias(c) if c in cs else F.col(c) for c in df.columns])


def binarise_target(df: DataFrame, target: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or f"{target}_bin", (F.col(target) != 0).cast("int"))


def format_metric(c: Column | str, decimals: int = 3) -> Column:
    return F.format_number(F.col(c) if isinstance(c, str) else c, decimals)


def split_multivalue(c: Column | str, sep: str = "|") -> Column:
    import re

    return F.split(F.col(c) if isinstance(c, str) else c, re.escape(sep), -1)


def replicate_rows(df: DataFrame, times: int | Column) -> DataFrame:
    """Each row ``times`` times (a generator, no join)."""
    t = F.lit(times) if isinstance(times, int) else times
    return df.withColumn("_rep", F.explode(F.sequence(F.lit(1), t))).drop("_rep")


def relabel_zero_based(df: DataFrame, label: str = "label") -> DataFrame:
    return df.withColumn(label, (F.col(label) - 1).cast("int"))


def filter_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    return df.where(F.col(col).between(lo, hi))


def filter_threshold(df: DataFrame, predicate: Column) -> DataFrame:
    return df.where(predicate)


def class_balance(df: DataFrame, target: str) -> DataFrame:
    """One row: zero / non-zero counts, their ratio and its integer part
    (the replication factor for oversampling)."""
    t = F.col(target)
    agg = df.agg(F.count_if(t == 0).alias("n_zero"), F.count_if(t != 0).alias("n_nonzero"))
    ratio = F.try_divide(F.col("n_zero").cast("double"), F.col("n_nonzero").cast("double"))
    return agg.select("n_zero", "n_nonzero", F.round(ratio, 6).alias("ratio"),
                      F.floor(ratio).cast("int").alias("replicate"))


def oversample(df: DataFrame, is_minor: Column, ratio: int | None = None,
               balance_target: str | None = None) -> DataFrame:
    """Majority rows once plus each minority row ``ratio`` times, where ratio
    defaults to floor(#major / #minor) (X2). The ratio is a single scalar; each
    replica is produced by a generator in the task that holds the row."""
    if ratio is None:
        counts = df.agg(F.count_if(is_minor).alias("mi"), F.count_if(~is_minor).alias("ma")).first()
        ratio = int(counts.ma // counts.mi) if counts.mi else 1
    return df.where(~is_minor).unionByName(replicate_rows(df.where(is_minor), max(ratio, 1)))


def oversample_weights(df: DataFrame, is_minor: Column, ratio: int | None = None,
                       weight_col: str = "weight") -> DataFrame:
    """X2 for estimators that take instance weights: each minority row gets
    weight ``ratio`` (default floor(#major / #minor)), every other row 1.
    Spark ML's linear, logistic and generalised linear models normalise their
    loss by the weight total, so the fit equals the fit on ``oversample``'s
    replicated rows while the training data keeps its size."""
    if ratio is None:
        counts = df.agg(F.count_if(is_minor).alias("mi"), F.count_if(~is_minor).alias("ma")).first()
        ratio = int(counts.ma // counts.mi) if counts.mi else 1
    return df.withColumn(weight_col, F.when(is_minor, F.lit(float(max(ratio, 1)))).otherwise(F.lit(1.0)))


def seeded_order_key(key: str, seed: int) -> Column:
    """md5 of ``seed:key`` -- a reproducible pseudo-random order (same in DuckDB)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def undersample(df: DataFrame, is_minor: Column, key: str, seed: int = 0) -> DataFrame:
    """All minority rows plus exactly as many majority rows, chosen without
    replacement by a seeded hash order (X3). The hash at the cut is located by
    counting rows per hash range, and the table is filtered by it: no sort of the
    majority and no copy of it."""
    from kestrel.operators.splits import row_at, up_to

    n = df.agg(F.count_if(is_minor).alias("minor"), F.count_if(~is_minor).alias("major")).first()
    if n.major <= n.minor:
        return df
    if not n.minor:
        return df.where(is_minor)
    ordered = df.withColumn("_h", seeded_order_key(key, seed))
    row = row_at(ordered.where(~is_minor), ["_h", key], n.minor)
    return ordered.where(is_minor | up_to(ordered, ["_h", key], row)).drop("_h")


def union_all(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out

