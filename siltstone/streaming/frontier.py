"""The stop rule over a stream: state of each source lives in Spark's state store and survives runs."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..schemas import FRONTIERS
from ..sources.keyed import merge
from ..tables import materialize

STATE = T.StructType([T.StructField("streak", T.IntegerType()), T.StructField("matched", T.BooleanType()), T.StructField("recent", T.ArrayType(T.StringType()))])
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows of one source that a micro-batch of ``run_in_order`` holds at most, and so its frame.
BLOCK_ROWS = 1_000_000


class KnownSequence(StatefulProcessor):
    """Rows of one source in the order of ``seq``: emits unknown rows until ``stop_after`` known ones came in a row.

    An address among the last ``recent_limit`` ones neither lengthens nor breaks a run. Rows of a micro-batch are
    sorted before they change the state: one source's rows of a micro-batch are one pandas frame, so whoever starts the
    stream has to bound its micro-batches, as ``run_in_order`` does."""

    def __init__(self, stop_after: int, recent_limit: int):
        self.stop_after, self.recent_limit = stop_after, recent_limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("sequence", STATE)

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        """What a store remembers of the source; its runs begin anew."""
        recent = [u for urls in initialState["recent_urls"] for u in (urls if urls is not None else ())]
        self.state.update((0, False, recent[-self.recent_limit :]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator:  # noqa: N802, N803
        import pandas as pd

        frame = pd.concat(rows).sort_values("seq")
        streak, matched, recent = self.state.get() if self.state.exists() else (0, False, [])
        recent, kept = list(recent or []), []
        for k, (url, known) in enumerate(zip(frame["url"], frame["is_known"], strict=True)):
            if url not in recent:
                recent = [*recent, url][-self.recent_limit :]
                if self.stop_after > 0:
                    streak = streak + 1 if known else 0
                    matched = matched or streak >= self.stop_after
            if not known and not matched:
                kept.append(k)
        self.state.update((streak, matched, recent))
        yield frame.iloc[kept][["source", "seq", "url"]]

    def close(self) -> None:
        pass


def new_before_known(stream: DataFrame, stop_after: int, recent_limit: int = 20, initial: DataFrame | None = None) -> DataFrame:
    """stream(source, seq, url, is_known) -> (source, seq, url) of new rows. Needs ROCKSDB as the state store provider.

    ``initial``(source, recent_urls), one row for each source, is what a store knows when the stream begins for the first
    time; sources that never come keep it. A checkpoint that is there already counts more."""
    schema = "source string, seq long, url string"
    start = initial.select("source", "recent_urls").groupBy("source") if initial is not None else None
    return stream.groupBy("source").transformWithStateInPandas(KnownSequence(stop_after, recent_limit), schema, "Append", "none", start)


def state_of(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(source, streak, matched, recent_urls): the state of each source as the stream's last batch left it."""
    rows = spark.read.format("statestore").option("stateVarName", "sequence").load(checkpoint)
    return rows.select("key.source", "value.streak", "value.matched", F.col("value.recent").alias("recent_urls"))


def save_state(spark: SparkSession, checkpoint: str, folder: str, now: Column) -> None:
    """What a stream remembers, into the store of frontiers; sources that the stream does not know stay there."""
    merge(state_of(spark, checkpoint).select("source", now.alias("updated_at"), "recent_urls"), folder, FRONTIERS, "source", "last")


def run_in_order(rows: DataFrame, stop_after: int, folder: str, block_rows: int = BLOCK_ROWS, recent_limit: int = 20, initial: DataFrame | None = None) -> list[int]:
    """``new_before_known`` over all of rows(source, seq, url, is_known), into Parquet in ``folder``/rows.

    What has to be bounded is one source's rows in a micro-batch, so only sources with more than ``block_rows`` rows are cut,
    each by quantiles of its own ``seq`` (rows of one ``seq`` stay together); all others are worked off whole in the first
    block. So there are as many blocks as the longest feed needs, however many feeds there are. A block is put into the
    stream's folder when the one before it has been worked off; state is carried over in the checkpoint. Returns the number
    of rows of each micro-batch."""
    spark = rows.sparkSession
    counts = materialize(rows.groupBy("source").agg(F.count("*").alias("n")), "rows-of-sources")
    longest = counts.agg(F.max("n")).first()[0] or 0
    n = -(-longest * 5 // (4 * block_rows)) if longest > block_rows else 1  # quantiles may err by an eighth of a block on either side
    ranged = rows.withColumn("block", F.lit(0))
    if n > 1:
        long = F.broadcast(counts.where(F.col("n") > block_rows).select("source"))  # at most one for each block_rows rows
        parts = F.percentile_approx("seq", F.array(*[F.lit(k / n) for k in range(1, n)]), 20 * n)
        same = rows["source"].eqNullSafe(long["source"])
        cuts = materialize(rows.join(long, same, "left_semi").groupBy("source").agg(parts.alias("cuts")), "cuts-of-sources").withColumnRenamed("source", "long_source")
        dealt = rows.join(F.broadcast(cuts), rows["source"].eqNullSafe(cuts["long_source"]), "left")
        # of a long feed the last block has the rows without a seq
        block = F.when(F.col("cuts").isNull(), 0).when(F.col("seq").isNull(), n).otherwise(F.size(F.filter("cuts", lambda c: c <= F.col("seq"))))
        ranged = dealt.select(*rows.columns, block.alias("block"))
    ranged.write.partitionBy("block").parquet(f"{folder}/blocks")
    blocks = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("block", T.IntegerType())])).parquet(f"{folder}/blocks")
    sizes = []
    for k in range(n + 1 if n > 1 else 1):
        blocks.where(F.col("block") == k).drop("block").write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        query = new_before_known(stream, stop_after, recent_limit, initial).writeStream.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start(path=f"{folder}/rows", format="parquet")
        query.awaitTermination()
        sizes += [p["numInputRows"] for p in query.recentProgress]
    return sizes
