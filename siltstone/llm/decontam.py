"""Benchmark decontamination: test items that stand in documents, by size-partitioned MinHash containment search.

An item's sketch is its m smallest shingle hashes (bottom-m MinHash). With m = n - ceil(t n) + 1 for an item of n
shingles, a document that holds a share t of the item holds at least one hash of the sketch, whatever the document's own
size, so the search misses nothing. Items are partitioned by shingle width and by size (powers of two), so that a
partition has one small range of hashes in which its sketches lie, and only a document's hashes in that range are
looked up. Candidates are verified by exact containment of the item's shingles in the document's.

Items are a stated query set: they go to the documents in blocks of bounded size, one block after the other if there
are several, and documents are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .hashing import NOT_ALNUM, groups, text_words, window_hashes

GRAM = 5
PART, WHOLE = 80, 100
#: Characters of the items of one block: its sketches and shingles are bounded by them.
BLOCK_CHARS = 8_000_000


def item_shingles(text: str | None) -> tuple[int, np.ndarray]:
    """Width and sorted distinct hashes; an item of fewer than GRAM words has its whole sequence as one shingle."""
    words, _ = text_words([text], NOT_ALNUM)
    width = min(GRAM, len(words))
    return width, np.unique(window_hashes(words, width)) if width else np.empty(0, np.uint64)


@dataclass
class Partition:
    """Items of one width and size range."""

    width: int
    hashes: np.ndarray  # of all sketches, sorted
    first: np.ndarray  # where each hash's items begin in ``items``
    items: np.ndarray
    top: np.uint64


class ItemIndex:
    def __init__(self, ids: list[int | None], texts: list[str | None]):
        self.ids, self.sets, parts = ids, [], {}
        for i, text in enumerate(texts):
            width, s = item_shingles(text)
            self.sets.append(s)
            if len(s):
                parts.setdefault((width, int(len(s)).bit_length()), []).append(i)
        self.partitions = []
        for (width, _), members in sorted(parts.items()):
            sketches = [self.sets[i][: len(self.sets[i]) + (-len(self.sets[i]) * PART // WHOLE) + 1] for i in members]
            h, owner = np.concatenate(sketches), np.repeat(members, [len(x) for x in sketches])
            order = np.argsort(h, kind="stable")
            hashes, first = np.unique(h[order], return_index=True)
            self.partitions.append(Partition(width, hashes, np.append(first, len(h)), owner[order], hashes[-1]))
        self.widths = sorted({p.width for p in self.partitions})

    def search(self, texts: list[str | None]) -> Iterator[tuple[int, int, int]]:
        """(text, item, shared shingles) of each text that holds enough of an item."""
        for a, b in groups(texts):
            words, first = text_words(texts[a:b], NOT_ALNUM)
            for width in self.widths:
                grams = window_hashes(words, width)
                size = np.maximum(first[1:] - first[:-1] - width + 1, 0)
                owner = np.repeat(np.arange(b - a), size)
                at = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(int(size.sum()))
                h = grams[at]
                pairs = set()
                for p in self.partitions:
                    if p.width != width:
                        continue
                    low = np.flatnonzero(h <= p.top)
                    place = np.searchsorted(p.hashes, h[low])
                    hit = p.hashes[place] == h[low]
                    for i, k in zip(owner[low[hit]].tolist(), place[hit].tolist(), strict=True):
                        pairs.update((i, x) for x in p.items[p.first[k] : p.first[k + 1]].tolist())
                known, own = -1, None
                for i, item in sorted(pairs):
                    if i != known:
                        known, own = i, np.unique(grams[first[i] : first[i] + size[i]])
                    s = self.sets[item]
                    shared = int(np.isin(s, own, assume_unique=True).sum())
                    if shared * WHOLE >= len(s) * PART:
                        yield a + i, item, shared


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, item_id, n_shingles, n_shared, containment): a row for each document and item it holds 0.8 or more of.

    Words are runs of ASCII letters, digits and non-ASCII characters, ASCII in lower case, so punctuation and case do
    not hide an item; shingles are 5 words and count once. Items of fewer words match where their words follow each
    other in a document. Null and wordless items and documents match nothing. Repeated rows give repeated pairs, null
    ids stay null; very long texts are read whole; empty tables give no row."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    items = items.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    chars = items.agg(F.sum(F.length("text") + 100)).first()[0] or 0
    blocks = 1 + chars // BLOCK_CHARS
    if blocks > 1:
        items = materialize(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "items")
    out = None
    for k in range(blocks):
        block = (items.where(F.col("block") == k) if blocks > 1 else items).collect()
        block.sort(key=lambda r: (r["item_id"] is None, r["item_id"] or 0))
        shared = spark.sparkContext.broadcast(ItemIndex([r["item_id"] for r in block], [r["text"] for r in block]))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = list(shared.value.search(batch.column(1).to_pylist()))
                if not found:
                    continue
                index = shared.value
                ids = batch.column(0).take(pa.array([i for i, _, _ in found]))
                n = [len(index.sets[j]) for _, j, _ in found]
                cols = [ids, pa.array([index.ids[j] for _, j, _ in found], pa.int64()), pa.array(n, pa.int64()), pa.array([s for _, _, s in found], pa.int64()), pa.array([s / m for (_, _, s), m in zip(found, n, strict=True)], pa.float64())]
                yield pa.RecordBatch.from_arrays(cols, names=["id", "item_id", "n_shingles", "n_shared", "containment"])

        part = rows.mapInArrow(search, "id long, item_id long, n_shingles long, n_shared long, containment double")
        if blocks > 1:  # only one block is held at a time
            part = materialize(part, "leaks")
            shared.destroy()
        out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed("id", id_col)
