"""Joins that a hot key does not turn into one long task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with this share of the rows is hot. There are at most 1/HOT_SHARE of them, so they may be broadcast.
HOT_SHARE = 1 / 200


def hot_rows(groups: DataFrame) -> Column:
    """Whether a key of ``groups`` has HOT_SHARE of all rows; ``rows_of_key`` says how many it has."""
    total = groups.agg(F.sum("rows_of_key")).first()[0] or 0
    return F.col("rows_of_key") >= max(2, int(total * HOT_SHARE))


def attach(df: DataFrame, key: str, groups: DataFrame, how: str = "inner") -> DataFrame:
    """``df`` with the columns of ``groups``, one row for each key with its number of rows in ``rows_of_key``.

    ``groups`` is read several times, so it should be a written table. Keys with HOT_SHARE of all rows are broadcast, a bounded number whatever the data; the others are shuffled."""
    hot = hot_rows(groups)
    few, many = groups.where(hot).drop("rows_of_key"), groups.where(~hot).drop("rows_of_key")
    values = [c for c in few.columns if c != key]
    ours = [*df.columns, *values]
    rest = df.join(F.broadcast(few.select(key)), key, "left_anti")  # hot rows are not shuffled
    return df.join(F.broadcast(few), key).select(*ours).unionByName(rest.join(many, key, how).select(*ours))


def best_row(df: DataFrame, key: str, order: Column) -> DataFrame:
    """For each key the row with the smallest ``order``: an aggregate, so rows are reduced before the shuffle."""
    others = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.min_by(F.struct(*others), order).alias("best"))
    return best.select(*[F.col(key) if c == key else F.col(f"best.{c}").alias(c) for c in df.columns])
