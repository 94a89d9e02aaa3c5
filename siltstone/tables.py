"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


#: Bytes of an Arrow batch that a task hands to Python at once; pages differ too much for a count to bound them.
BATCH_BYTES = 4 << 20
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def bound_batches(spark: SparkSession | None = None) -> None:
    """Arrow batches of BATCH_BYTES at most in this session, unless it asks for smaller ones."""
    spark, name = spark or SparkSession.active(), "spark.sql.execution.arrow.maxBytesPerBatch"
    given = spark.conf.get(name).lower().rstrip("b")
    number = int(given.rstrip("kmg")) * {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(given[-1:], 1)
    if not 0 < number <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. A session of one machine that names none gets a local folder; on a cluster that fails."""
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return (base or local_dir(spark.sparkContext.applicationId)).rstrip("/")


@lru_cache(maxsize=1)
def local_dir(application: str) -> str:
    return "file://" + tempfile.mkdtemp(prefix="spark-")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/siltstone/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write and read back: what follows sees one and the same rows, however often it is computed."""
    spark, path = df.sparkSession, new_path(df.sparkSession, label)
    if (made := _made.get()) is not None:
        made.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables that this thread writes within go at the end; what comes of them must have been written elsewhere by then."""
    token = _made.set([])
    try:
        yield
    finally:
        made = _made.get()
        _made.reset(token)
        for path in made:
            discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
