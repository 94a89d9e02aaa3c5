"""State between runs: cursors, processed addresses and frontiers, as keyed stores, and in the JSON files of earlier runs.

A store (``sources.keyed``) is changed by merging rows into it: a save costs what the buckets of its own keys hold, a run
that dies while saving leaves the version before, and of two runs that save at a time neither undoes the other. A store
that is not there is empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import normalize_url
from ..operators.dedupe import first_seen
from ..schemas import CURSORS, FRONTIERS, PROCESSED
from .keyed import load, merge


def save_cursors(new: DataFrame, folder: str) -> None:
    """new(source, cursor, mode, last_run): sources in it are replaced, others stay."""
    merge(new, folder, CURSORS, "source", "last")


def load_processed(spark: SparkSession, folder: str) -> DataFrame:
    """Processed addresses under today's canonical form; of entries that it brings together the first seen stays."""
    rows = load(spark, folder, PROCESSED).withColumn("norm_url", normalize_url(F.col("norm_url")))
    return first_seen(rows, "norm_url", "first_seen", "source").select(*PROCESSED.fieldNames())


def add_processed(new: DataFrame, folder: str) -> None:
    """new(norm_url, first_seen, source): an address that is there keeps its entry."""
    merge(first_seen(new.withColumn("norm_url", normalize_url(F.col("norm_url"))), "norm_url", "first_seen", "source"), folder, PROCESSED, "norm_url", "first")


def save_frontiers(observed: DataFrame, folder: str, most: int, now: Column) -> None:
    """observed(source, seq, url): the last ``most`` canonical addresses of each source, in order; other sources stay."""
    from ..operators.frontier import recent

    rows = recent(observed.select("source", "seq", normalize_url(F.col("url")).alias("norm_url")), "source", "seq", most)
    lists = rows.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("seq", "norm_url"))).alias("found"))  # ``most`` rows each
    new = lists.select("source", now.alias("updated_at"), F.col("found.norm_url").alias("recent_urls"))
    merge(new, folder, FRONTIERS, "source", "last")


def frontier_urls(spark: SparkSession, folder: str) -> DataFrame:
    """(source, norm_url) of all frontiers, under today's canonical form."""
    rows = load(spark, folder, FRONTIERS).select("source", F.explode("recent_urls").alias("url"))
    return rows.select("source", normalize_url(F.col("url")).alias("norm_url")).distinct()


def _entries(spark: SparkSession, path: str, inside: str, kind: str) -> DataFrame:
    """(key, entry) of a JSON object in a file; none if the file is missing or broken."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], f"key string, entry {kind}")
    whole = F.try_parse_json("value")
    return spark.read.text(path, wholetext=True).select(F.explode(F.try_variant_get(whole, inside, f"map<string,{kind}>")).alias("key", "entry"))


def cursors_from_json(spark: SparkSession, path: str) -> DataFrame:
    rows = _entries(spark, path, "$", "struct<cursor:string,mode:string,last_run:string>")
    return rows.select(F.col("key").alias("source"), "entry.cursor", "entry.mode", F.try_to_timestamp("entry.last_run").alias("last_run"))


def processed_from_json(spark: SparkSession, path: str) -> DataFrame:
    rows = _entries(spark, path, "$.urls", "struct<first_seen:string,source:string>")
    return rows.select(normalize_url(F.col("key")).alias("norm_url"), F.try_to_timestamp("entry.first_seen").alias("first_seen"), "entry.source")


def frontiers_from_json(spark: SparkSession, path: str) -> DataFrame:
    rows = _entries(spark, path, "$", "struct<updated_at:string,recent_urls:array<string>>")
    return rows.select(F.col("key").alias("source"), F.try_to_timestamp("entry.updated_at").alias("updated_at"), F.transform("entry.recent_urls", normalize_url).alias("recent_urls"))
