"""Helpers shared by the text operators: reading a table, and walking Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Most bytes of an Arrow batch on its way to a Python worker; Spark's own 64 MB, on both sides and for each core, is
#: much beside an executor's heap.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Lower the session's bound for Arrow batches to ``BATCH_BYTES``."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


#: Caches of a worker that a task's end empties.
CACHES: list[dict] = []


def lean(run: Callable) -> Callable:
    """``run`` for mapInArrow, giving back what it no longer needs when a task ends: workers stay for later stages, and
    what they hold counts beside the executor's heap."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            for cache in CACHES:
                cache.clear()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # only glibc has it
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each made longer until no column of ``df`` has it (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the whole text (null: empty); other columns, whatever their names, are dropped."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias(id_col), F.coalesce(F.col(text_col), F.lit("")).alias(text_col))


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that a task holds few texts as Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_rows(df: DataFrame, make: Callable[[], Callable[..., tuple]], schema: T.StructType) -> DataFrame:
    """One output row per input row. ``make`` is called once per task and returns a function that takes
    the values of a row and returns those of the output row."""
    small_batches(df.sparkSession)
    names = schema.fieldNames()
    types = arrow_types(schema)

    def run(batches):
        one = make()
        for batch in pieces(batches):
            out = [one(*row) for row in zip(*(c.to_pylist() for c in batch.columns))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), types)], names)

    return df.mapInArrow(lean(run), schema)


def append(df: DataFrame, inputs: list[str], make: Callable[[], Callable[..., tuple]], schema: T.StructType) -> DataFrame:
    """All columns of ``df`` and those of ``schema``, computed for each row from its ``inputs`` as in ``map_rows``."""
    small_batches(df.sparkSession)
    at = [df.columns.index(c) for c in inputs]
    types = arrow_types(schema)
    names = [*df.columns, *schema.fieldNames()]

    def run(batches):
        one = make()
        for batch in pieces(batches):
            out = [one(*row) for row in zip(*(batch.column(i).to_pylist() for i in at))]
            if out:
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(v, t) for v, t in zip(zip(*out), types))], names)

    return df.mapInArrow(lean(run), T.StructType([*df.schema.fields, *schema.fields]))


_ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(),
    "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
    "array<string>": pa.list_(pa.string()), "array<double>": pa.list_(pa.float64()),
}


def arrow_types(schema: T.StructType) -> list[pa.DataType]:
    return [_ARROW[f.dataType.simpleString()] for f in schema.fields]


def struct(ddl: str) -> T.StructType:
    """A schema from ``name type, ...``."""
    simple = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
              "boolean": T.BooleanType(), "binary": T.BinaryType(), "array<long>": T.ArrayType(T.LongType()),
              "array<int>": T.ArrayType(T.IntegerType()), "array<string>": T.ArrayType(T.StringType()),
              "array<double>": T.ArrayType(T.DoubleType())}
    return T.StructType([T.StructField(n, simple[t]) for n, t in (f.split() for f in ddl.split(","))])
