"""What is new: rows whose key no known set has, and the sets themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Largest limit that Spark pushes below a window's shuffle, and parts of a group beyond it.
SPARK_CUTS, PARTS = 1000, 64


def known_set(*frames: DataFrame) -> DataFrame:
    """The union of one-column frames, each key once."""
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out.distinct()


def new_rows(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not known; rows with a null key are new. Spark broadcasts ``known`` if it is small enough."""
    return df.join(known.select(key).distinct(), key, "left_anti")


def with_known_flag(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """All rows with ``is_known``."""
    flags = known.select(key).where(F.col(key).isNotNull()).distinct().withColumn("is_known", F.lit(True))
    return df.join(flags, key, "left").withColumn("is_known", F.coalesce("is_known", F.lit(False)))


def insert_absent(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``existing`` and the rows of ``new`` whose key it has not: the first to come stays. Keys of ``new`` must differ."""
    return existing.unionByName(new.join(existing.select(key), key, "left_anti").select(*existing.columns))


def upsert(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``new`` and the rows of ``existing`` whose key it has not: the last to come stays."""
    return existing.join(new.select(key), key, "left_anti").select(*existing.columns).unionByName(new.select(*existing.columns))


def cap_per_group(df: DataFrame, group: str, order: list, most: int) -> DataFrame:
    """The first ``most`` rows of each group.

    Up to SPARK_CUTS rows Spark cuts each task's rows before the shuffle; for larger limits rows are cut in PARTS parts
    of each group first, so that no task gets more than that many times the limit of one group."""
    from pyspark.sql import Window

    w = Window.partitionBy(group).orderBy(*order)
    if most > SPARK_CUTS:
        parts = Window.partitionBy(group, "part").orderBy(*order)
        df = df.withColumn("part", F.pmod(F.xxhash64(*df.columns), F.lit(PARTS)))
        df = df.withColumn("place", F.row_number().over(parts)).where(F.col("place") <= most).drop("place", "part")
    return df.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most).drop("place")


def counts_with_zeros(df: DataFrame, group: str, dimension: DataFrame) -> DataFrame:
    """(group, n) for each row of the one-column ``dimension``, 0 where there is none."""
    counts = df.groupBy(group).agg(F.count("*").alias("n"))
    return dimension.join(counts, group, "left").select(group, F.coalesce("n", F.lit(0)).alias("n"))
