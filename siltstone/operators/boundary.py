"""The stop rule as a walk has it, for feeds in which addresses come back.

A walk remembers the last ``recent_limit`` addresses that it took up. An address among them is passed over: it neither
lengthens a run of known ones nor breaks it, and it is not taken up again. So whether a row counts depends on the rows before
it, not on how often its address occurs, and rows cannot be dropped beforehand.

Rows are dealt into blocks of the range-partitioned order and all blocks are walked at a time, each as if nothing stood before
it. What a walk of a block's last feed leaves behind is a summary: the run that it begins with, the run that it ends with,
whether a run inside was long enough, and the addresses it remembers. Summaries are put together from block to block. Runs
add up; only where a block holds a single feed and the addresses remembered before it are others than it was walked with, it
is walked again with those, and so on until nothing changes. As a block's last ``recent_limit`` addresses hardly ever depend
on what came before it, that takes one or two more rounds of such blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from ..tables import materialize
from .skew import attach


@dataclass
class Walk:
    """One feed from some row on: what it remembers, and its runs."""

    stop_after: int
    recent_limit: int
    recent: list[str | None] = field(default_factory=list)
    streak: int = 0
    head: int = 0  # known rows before the first unknown one
    broken: bool = False  # an unknown row has come
    inner: bool = False  # a run after it was long enough
    rows: int = 0

    def observe(self, url: str | None, known: bool) -> bool:
        """Whether a run is long enough now."""
        self.rows += 1
        if url in self.recent:
            return False
        self.recent = [*self.recent, url][-self.recent_limit :]
        self.streak = self.streak + 1 if known else 0
        self.broken |= not known
        self.head += known and not self.broken
        done = known and self.streak >= self.stop_after
        self.inner |= done and self.broken
        return done


@dataclass
class State:
    """What a block begins with."""

    recent: list[str | None] = field(default_factory=list)
    streak: int = 0
    matched: bool = False


@dataclass
class Summary:
    block: int
    first: Any
    last: Any
    head: int
    streak: int
    broken: bool
    inner: bool
    recent: list[str | None]

    @property
    def single(self) -> bool:
        return self.first == self.last

    def after(self, entry: State, stop_after: int) -> State:
        matched = entry.matched or self.inner or (self.head > 0 and entry.streak + self.head >= stop_after)
        return State(self.recent, self.streak if self.broken else entry.streak + self.head, matched)


SUMMARY = "block int, first {kind}, last {kind}, head long, streak long, broken boolean, inner boolean, recent array<string>"


def segments(batches: Iterator[pa.RecordBatch], entries: dict[int, State], stop_after: int, recent_limit: int) -> Iterator[tuple[int, Any, bool, Walk, Any]]:
    """(block, feed, whether it is the block's first, walk, place of the stop) of each feed in each block, in their order.

    Rows (block, feed, place, url, known) come sorted; one row and one walk are held at a time."""
    block = group = walk = stop = None
    begun, first = False, True
    for batch in batches:
        for b, g, place, url, known in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not begun or b != block or g != group:
                if begun:
                    yield block, group, first, walk, stop
                first = not begun or b != block
                entry = entries.get(b, State()) if first else State()
                block, group, begun, stop = b, g, True, None
                walk = Walk(stop_after, recent_limit, list(entry.recent), entry.streak)
            if walk.observe(url, known) and stop is None:
                stop = place
    if begun:
        yield block, group, first, walk, stop


def record_batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c)).cast(t) for c, t in zip(columns, schema.types, strict=True)], names=schema.names)


def summaries(rows: DataFrame, entries: dict[int, State], stop_after: int, recent_limit: int, kind: str) -> list[Summary]:
    """Of each block, what its last feed leaves behind. Runs are counted from the block on; ``entries`` only lend their addresses."""
    lent = {b: State(list(s.recent)) for b, s in entries.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[int, list] = {}
        for block, group, _, walk, _ in segments(batches, lent, stop_after, recent_limit):
            begin = out[block][1] if block in out else group
            out[block] = [block, begin, group, walk.head, walk.streak, walk.broken, walk.inner, walk.recent]
        yield record_batch(list(out.values()), schema)

    schema = to_arrow_schema(_parse_datatype_string(SUMMARY.format(kind=kind)))
    return [Summary(**r.asDict()) for r in rows.mapInArrow(run, SUMMARY.format(kind=kind)).collect()]  # a row for each block


def before_known_walk(df: DataFrame, group: str, order: str, url: str, known: str, stop_after: int, recent_limit: int = 20, blocks_of: int | None = None) -> DataFrame:
    """Unknown rows of each feed before the row with which a walk of it would stop; without a limit all unknown rows.

    ``order`` is unique in a feed and not null, ``url`` a string; a null flag is not known, null
    addresses are one address, and rows without a feed are left out. All columns come back. A feed with a third of all rows is walked by many tasks; the driver
    holds a summary of each block."""
    if stop_after <= 0:
        return df.where(~F.coalesce(known, F.lit(False)))
    if recent_limit < 1:
        raise ValueError("recent_limit must be positive")
    n = blocks_of or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = df.schema[group].dataType.simpleString()
    place = df.schema[order].dataType.simpleString()
    ranges = materialize(df.repartitionByRange(n, F.col(group), F.col(order)).withColumn("walk_block", F.spark_partition_id()), "walk-ranges")
    narrow = ranges.where(F.col(group).isNotNull()).select(F.col("walk_block").alias("block"), F.col(group).alias("feed"), F.col(order).alias("place"), F.col(url).cast("string").alias("url"), F.coalesce(known, F.lit(False)).alias("known"))
    sort = lambda rows: rows.repartition(n, "block").sortWithinPartitions("block", "feed", "place")

    found = {s.block: s for s in summaries(sort(narrow), {}, stop_after, recent_limit, kind)}
    walked_with: dict[int, list] = {b: [] for b in found}
    while True:
        entries, before = {}, None
        for b in sorted(found):
            own = found[b]
            same = before is not None and before[0] == own.first
            entries[b] = before[1] if same else State()
            before = (own.last, own.after(entries[b] if own.single else State(), stop_after))
        again = [b for b, s in found.items() if s.single and not entries[b].matched and entries[b].recent != walked_with[b]]
        if not again:
            break
        for s in summaries(sort(narrow.where(F.col("block").isin(again))), {b: entries[b] for b in again}, stop_after, recent_limit, kind):
            found[s.block] = s
            walked_with[s.block] = list(entries[s.block].recent)

    def stops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for _, feed, _, walk, stop in segments(batches, entries, stop_after, recent_limit):
            rows.append((feed, stop, walk.rows))
            if len(rows) == 10_000:
                yield record_batch(rows, schema)
                rows = []
        yield record_batch(rows, schema)

    ddl = f"feed {kind}, stop {place}, n long"
    schema = to_arrow_schema(_parse_datatype_string(ddl))
    # a block that a feed enters after its stop may find another one, which is later
    per_feed = sort(narrow).mapInArrow(stops, ddl).groupBy(F.col("feed").alias(group)).agg(F.min("stop").alias("walk_stop"), F.sum("n").alias("rows_of_key"))
    # columns of the caller's own stay in a struct, whatever they are called
    unknown = ranges.where(~F.coalesce(known, F.lit(False))).select(F.col(group), F.struct(*df.columns).alias("walk_row"))
    kept = attach(unknown, group, materialize(per_feed, "walk-stops"))
    return kept.where(F.col("walk_stop").isNull() | (F.col(f"walk_row.{order}") < F.col("walk_stop"))).select("walk_row.*")
