"""The stop rule for feeds: after ``stop_after`` known rows in a row, nothing later counts as new."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..tables import materialize
from .skew import attach


def before_known_sequence(df: DataFrame, group: str, order: str, known: str, stop_after: int, blocks_of: int | None = None) -> DataFrame:
    """Unknown rows of each group before its first run of ``stop_after`` known rows; without a limit all unknown rows.

    ``order`` is unique in a group. Runs are counted in blocks of the range-partitioned order, and what a block begins
    with is carried over from the summaries of the blocks before it, so a feed with a third of all rows is counted by
    many tasks. ``blocks_of`` is the number of blocks (default: Spark's shuffle partitions)."""
    if stop_after <= 0:
        return df.where(~F.col(known))
    spark = df.sparkSession
    n = blocks_of or int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = df.columns
    # written, so that all that follows sees the same ranges
    ranges = materialize(df.repartitionByRange(n, F.col(group), F.col(order)).withColumn("block", F.spark_partition_id()), "frontier-ranges")
    here = Window.partitionBy(group, "block").orderBy(order)
    unknowns = ranges.withColumn("gaps", F.sum((~F.col(known)).cast("int")).over(here))
    runs = unknowns.withColumn("run", F.sum(F.col(known).cast("int")).over(Window.partitionBy(group, "block", "gaps").orderBy(order)))
    blocks = runs.groupBy(group, "block").agg(F.max("gaps").alias("gaps"), F.count("*").alias("n"), F.max_by("run", order).alias("tail"))
    # a block without an unknown row lengthens the run that enters it; the summaries are few: one for each block and group
    order_of_blocks = Window.partitionBy(group).orderBy("block")
    islands = blocks.withColumn("island", F.sum((F.col("gaps") > 0).cast("int")).over(order_of_blocks))
    reach = F.sum("tail").over(Window.partitionBy(group, "island").orderBy("block"))
    entering = islands.withColumn("reach", reach).withColumn("carry", F.coalesce(F.lag("reach").over(order_of_blocks), F.lit(0)))
    runs = runs.join(entering.select(group, "block", "carry"), [group, "block"])
    total = F.col("run") + F.when(F.col("gaps") == 0, F.col("carry")).otherwise(0)
    stops = runs.groupBy(group).agg(F.min(F.when(F.col(known) & (total >= stop_after), F.col(order))).alias("stop"), F.count("*").alias("rows_of_key"))
    return attach(ranges.drop("block").where(~F.col(known)), group, materialize(stops, "frontier-stops")).where(F.col("stop").isNull() | (F.col(order) < F.col("stop"))).select(*columns)


def recent(df: DataFrame, group: str, order: str, most: int) -> DataFrame:
    """The last ``most`` rows of each group."""
    from .delta import cap_per_group

    return cap_per_group(df, group, [F.col(order).desc()], most)
