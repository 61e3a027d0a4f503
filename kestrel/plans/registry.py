"""Registry of named plans: each key maps to a ``(spark, sf_dir) -> DataFrame``
callable and, when the result is expressible in SQL, to the DuckDB text of the
same result (the correctness oracle)."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kestrel.session import result_of

Plan = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Plan] = {}
ORACLE: dict[str, str] = {}


def _released(fn: Plan) -> Plan:
    """``fn`` in a scope: what it persists or writes for reuse is gone when its result is returned."""

    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return result_of(spark, lambda: fn(spark, sf_dir))

    return run


def register(key: str, sql: str | None = None):
    def deco(fn: Plan) -> Plan:
        if key in QUERIES:
            raise ValueError(f"duplicate plan key {key}")
        QUERIES[key] = _released(fn)
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco
