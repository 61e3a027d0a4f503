"""Session settings shared by tests, the bench and the driver entry points.

ANSI mode stays on (Spark 4 default): operators use ``try_*`` functions where
malformed input must become NULL instead of failing the job.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Sizes used when a session is created here (tests, bench). A cluster session
# keeps whatever its submitter configured.
LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # explicit broadcast hints in the operators are guarded by a size check;
    # automatic broadcast stays at Spark's default threshold
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "kestrel") -> SparkSession:
    """Create (or reuse) a session with the library's settings."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("KESTREL_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode
    session without that setting (tests, bench) gets a fresh scratch folder;
    a cluster session without one is a configuration error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running kestrel jobs")
    path = tempfile.mkdtemp(prefix="kestrel-ckpt-", dir=os.environ.get("KESTREL_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


class Scope:
    """Owns the persisted frames and scratch tables that are made while it is the innermost one, and releases both."""

    def __init__(self, spark: SparkSession):
        self.spark, self.frames, self.paths = spark, [], []

    def release(self) -> None:
        for frame in self.frames:
            frame.unpersist()
        for path in self.paths:
            remove(self.spark, path)
        self.frames, self.paths = [], []


_SCOPES: list[Scope] = []


@contextmanager
def reuse(spark: SparkSession):
    """``with reuse(spark):`` what is persisted or written for reuse inside is gone afterwards (S13). Results that read it
    have to be computed inside, or written with ``result_of``."""
    scope = Scope(spark)
    _SCOPES.append(scope)
    try:
        yield scope
    finally:
        _SCOPES.remove(scope)
        scope.release()


def result_of(spark: SparkSession, make) -> DataFrame:
    """``make()`` in a scope of its own. A result that stands on persisted frames or scratch tables is written, so that these
    can go; its own table belongs to the scope around, or to the session."""
    with reuse(spark) as scope:
        out = make()
        if not scope.frames and not scope.paths:
            return out
        path = scratch_path(spark, "result")
        scope.paths.remove(path)
        out.write.parquet(path)
    if _SCOPES:
        _SCOPES[-1].paths.append(path)
    return spark.read.schema(out.schema).parquet(path)


def persist(df: DataFrame) -> DataFrame:
    """Persist a frame that is read several times, spilling to disk; the scope that it is made in releases it."""
    frame = df.persist(StorageLevel.MEMORY_AND_DISK)
    if _SCOPES:
        _SCOPES[-1].frames.append(frame)
    return frame


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table, wherever its file system is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the checkpoint folder and read back: several
    branches read the files instead of computing the rows again, and the lineage ends
    there. The scope that it is made in removes it; without one it stays with the
    checkpoints of the session."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path for a written intermediate table under the checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES:
        _SCOPES[-1].paths.append(path)
    return path
