"""Incremental runs: new addresses once and for all, dead letters beside good rows, offsets after the work is done."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.urls import normalize_url
from ..tables import temporary


def once_per_url(stream: DataFrame, url: str = "url") -> DataFrame:
    """Rows whose canonical address the stream has not had before, in this run or an earlier one."""
    return stream.withColumn("norm_url", normalize_url(F.col(url))).dropDuplicates(["norm_url"])


def run(stream: DataFrame, process: Callable[[DataFrame], tuple[DataFrame, DataFrame]], good_path: str, bad_path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start a query that writes what ``process`` makes of each micro-batch: good rows and dead letters.

    Offsets are committed after both writes, so a failed batch is done again; each batch has a folder of its own, which
    a second try overwrites. Without ``every`` all that is there is worked off and the query ends (a catch-up run);
    with it, e.g. '6 hours', the query goes on."""

    def batch(rows: DataFrame, number: int) -> None:
        rows.persist(StorageLevel.DISK_ONLY)  # a batch may be all that a feed has: kept in the heap it leaves tasks no room
        with temporary(rows.sparkSession):
            good, bad = process(rows)
            good.write.mode("overwrite").option("compression", "zstd").parquet(f"{good_path}/batch={number}")
            bad.write.mode("overwrite").json(f"{bad_path}/batch={number}")
        rows.unpersist()

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
