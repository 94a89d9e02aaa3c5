"""Feeds as they were captured, page by page, as a source for Spark: a stream whose offsets are the feeds' cursors, or a table.

A captured feed is a folder for each source, with a JSON file for each page: its number (from 0, without gaps), the address
that was asked, the status, the body, and the cursor that the body gives for the next page. ``capture`` writes such folders.

The stream's offset holds, for each source, the number of the last page and the last cursor that was not null up to it, as the
log of a live run would. A page is taken up when all pages before it are there, so one that comes late is not lost. Spark
writes the offset before a batch is worked off: a run that dies in between reads the very same pages again when it comes back,
and no others. The driver looks for pages and reads the last one; bodies are read by tasks.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .feeds import post_cursor, status_cursor
from .files import BATCH_BYTES, children, read_bytes, resolve

SCHEMA = "source string, seq long, url string, status int, body string, cursor string"
NAMES = ["source", "seq", "url", "status", "body", "cursor"]
TYPES = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.string()]
#: Pages that one task reads, at least and at most; tasks that a batch should have before they read more than the least; files
#: that are looked for at once. A task's start costs as much as the reading of some hundred pages.
PAGES_OF_TASK, MOST_OF_TASK, TASKS, LOOKED_FOR = 16, 256, 64, 256


def page_path(source: str, seq: int) -> str:
    return f"{source}/{seq:012d}.json"


@dataclass
class Pages(InputPartition):
    source: str
    first: int
    last: int


def read_page(store: fs.FileSystem, root: str, source: str, seq: int) -> dict:
    return json.loads(read_bytes(store, f"{root}/{page_path(source, seq)}"))


def read_pages(folder: str, part: Pages) -> Iterator[pa.RecordBatch]:
    """A task holds a batch of pages, however many it reads."""
    store, root = resolve(folder)
    rows, held = [], 0
    for seq in range(part.first, part.last + 1):
        page = read_page(store, root, part.source, seq)
        rows.append((part.source, seq, as_text(page.get("url")), page.get("status"), as_text(page.get("body")), as_text(page.get("cursor"))))
        held += len(rows[-1][4] or "")
        if held >= BATCH_BYTES or seq == part.last:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)], names=NAMES)
            rows, held = [], 0


def as_text(value: object) -> str | None:
    """As Spark makes strings of Python's values."""
    return value if value is None or isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


class Feeds:
    """What the driver knows of the folders."""

    def __init__(self, folder: str, pages_of_task: int | None = None):
        self.folder, self.pages_of_task = folder, pages_of_task
        self.last: dict[str, int] = {}  # pages up to these were seen

    def latest(self) -> dict:
        store, root = resolve(self.folder)
        out = {}
        for source in [f.base_name for f in children(store, root) if f.type == fs.FileType.Directory and not f.base_name.startswith("_")]:
            seq = self.last.get(source, -1)
            while True:
                found = store.get_file_info([f"{root}/{page_path(source, seq + k)}" for k in range(1, LOOKED_FOR + 1)])
                there = next((k for k, f in enumerate(found) if f.type == fs.FileType.NotFound), LOOKED_FOR)
                seq += there
                if there < LOOKED_FOR:
                    break
            if seq >= 0:
                self.last[source] = seq
                out[source] = {"seq": seq, "cursor": self.cursor(store, root, source, seq)}
        return out

    @staticmethod
    def cursor(store: fs.FileSystem, root: str, source: str, seq: int) -> str:
        """The last page's, or that of the nearest page before it that has one."""
        for k in range(seq, -1, -1):
            if found := read_page(store, root, source, k).get("cursor"):
                return found
        return ""

    def between(self, start: dict, end: dict) -> list[Pages]:
        spans = [(source, start.get(source, {"seq": -1})["seq"] + 1, at["seq"]) for source, at in end.items()]
        pages = sum(last + 1 - first for _, first, last in spans)
        n = self.pages_of_task or min(MOST_OF_TASK, max(PAGES_OF_TASK, -(-pages // TASKS)))
        return [Pages(source, k, min(k + n - 1, last)) for source, first, last in spans for k in range(first, last + 1, n)]


class FeedStream(DataSourceStreamReader):
    def __init__(self, folder: str, pages_of_task: int | None):
        self.folder, self.feeds = folder, Feeds(folder, pages_of_task)

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        return self.feeds.latest()

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return self.feeds.between(start, end)

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        return read_pages(self.folder, partition)


class FeedTable(DataSourceReader):
    def __init__(self, folder: str, pages_of_task: int | None):
        self.folder, self.pages_of_task = folder, pages_of_task

    def partitions(self) -> Sequence[InputPartition]:
        feeds = Feeds(self.folder, self.pages_of_task)
        return feeds.between({}, feeds.latest()) or [Pages("", 0, -1)]

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        return read_pages(self.folder, partition)


class CapturedFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "captured_feed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FeedTable:
        return FeedTable(self.options["path"], self.pages_of_task())

    def streamReader(self, schema) -> FeedStream:  # noqa: N802
        return FeedStream(self.options["path"], self.pages_of_task())

    def pages_of_task(self) -> int | None:
        """As many as the option says, else as the pages of a batch make it."""
        return int(given) if (given := self.options.get("pages_of_task")) else None


def feed_table(spark: SparkSession, folder: str) -> DataFrame:
    spark.dataSource.register(CapturedFeed)
    return spark.read.format("captured_feed").load(folder)


def feed_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The stream. It sets the session to let catch-up runs over sources like this one go on after a batch that they repeat;
    without that a run that comes back does the unfinished batch alone."""
    spark.conf.set("spark.sql.streaming.triggerAvailableNowWrapper.enabled", "true")
    spark.dataSource.register(CapturedFeed)
    return spark.readStream.format("captured_feed").load(folder)


def capture(responses: DataFrame, folder: str) -> None:
    """responses(source, seq, url, status, body) as a captured feed, each page with the cursor that its body gives.

    Numbers are those of ``seq``, unique in a source; pages of several runs add up. All of them appear, or none."""
    from ..plans.named_files import write_named

    v = F.try_parse_json("body")
    rows = responses.withColumn("cursor", F.when(F.col("source") == "x", status_cursor(v)).when(F.col("source") == "linkedin", post_cursor(v)))
    path = F.format_string("%s/%012d.json", "source", F.col("seq").cast("long"))
    write_named(rows.select(path.alias("path"), F.to_json(F.struct("url", "status", "body", "cursor")).alias("content")), folder)


def offset_log(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(source, seq, cursor): where a stream of ``feed_stream`` stands, from the newest offset in its checkpoint."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/offsets")
    names = [s.getPath().getName() for s in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)]
    newest = max(int(n) for n in names if n.isdigit())
    line = spark.read.text(f"{checkpoint}/offsets/{newest}", wholetext=True).select(F.element_at(F.split(F.rtrim("value"), "\n"), -1).alias("offset"))
    return line.select(F.explode(F.from_json("offset", "map<string,struct<seq:long,cursor:string>>")).alias("source", "at")).select("source", "at.seq", F.nullif("at.cursor", F.lit("")).alias("cursor"))
