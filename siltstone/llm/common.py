"""Helpers shared by the training-data operators.

Conventions that hold for every operator here:

* an operator reads only the columns whose names it is given and returns only its own columns, so extra
  columns of the input, whatever they are called, never reach it;
* a null text is an empty text;
* intermediate tables go to the shared folder that the session names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key that holds at least this share of the rows is hot; there are at most 1/share such keys.
HOT_SHARE = 1 / 200


#: Bytes of an Arrow batch that a task hands to Python at once; rows of text differ too much for a count to bound them.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_BYTES at most, unless the session asks for smaller ones."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    given = spark.conf.get(name).lower().rstrip("b")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(given[-1:], 1)
    if int(given.rstrip("kmg")) * unit > BATCH_BYTES or int(given.rstrip("kmg")) <= 0:
        spark.conf.set(name, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. A session of one machine that names none gets
    a local folder; on a cluster that fails."""
    bound_batches(spark)
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return (base or local_dir(spark.sparkContext.applicationId)).rstrip("/")


@lru_cache(maxsize=1)
def local_dir(application: str) -> str:
    """A folder of this machine, for sessions of one machine that name no shared one."""
    return "file://" + tempfile.mkdtemp(prefix="spark-")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/siltstone/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    return written(df, label)[0]


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """What was written and read back, and where it is, for ``discard``."""
    spark, path = df.sparkSession, new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from fn(batch)

    return df.mapInArrow(run, schema)


def held_out(id_col: str, buckets: int, remainder: int) -> Column:
    """True for rows whose crc32(id as text) mod ``buckets`` is ``remainder``; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % buckets == remainder, F.lit(False))


def attach(df: DataFrame, key: str, groups: DataFrame, size_col: str, total: int) -> DataFrame:
    """Left rows joined with one row per key of ``groups`` (inner), with no hot key in one task.

    ``size_col`` of groups says how many rows of ``df`` have the key; ``groups`` is read several times, so it should be a
    written table. At most 1/HOT_SHARE keys can hold HOT_SHARE of the rows each, so those few go by broadcast and the
    others by a shuffled join."""
    hot = F.col(size_col) >= F.lit(max(2, int(total * HOT_SHARE)))
    if groups.where(hot).isEmpty():
        return df.join(groups, key)
    few = F.broadcast(groups.where(hot))
    many = df.join(F.broadcast(groups.where(hot).select(key)), key, "left_anti").join(groups.where(~hot), key)
    return many.unionByName(df.join(few, key))
