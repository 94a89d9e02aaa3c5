"""Ranked lexical search, reversed: the items are the index, and documents stream through it.

The items' terms become an inverted index (term, items that have it and how often), which goes to all tasks by broadcast. A
first pass over the documents counts what the weights need: documents, terms, and documents that hold each of the items'
terms. A second pass takes each document's counts of those terms through the index, sums the scores of all items at once and
keeps for each item a heap of its best documents, never more than are asked for. Tasks return their heaps, which are merged
by item. No text is shuffled.

Items are a stated query set: they go to the documents in blocks of bounded size, one block after the other if there are
several.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, materialize
from .hashing import FIRST_BYTES, LOWER, NOT_ALNUM, eights, joined, trim, word_hashes, word_spans

#: Characters of the items of one block, which bound its index.
BLOCK_CHARS = 4_000_000
#: Characters of documents that are handled at once, and sums of scores (documents times items).
SPAN, CELLS = 300_000, 1 << 21
#: Entries of the index that are added up at once.
ENTRIES = 1 << 20
#: Heaps of an item are merged in so many groups first.
SALTS = 32
#: No term: printable and control ASCII but letters and digits.
GAP = re.compile(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]")
DOCUMENTS, TERMS = -1, -2


def spans(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Some texts at a time, or parts of long ones that end where a term ends, and whose they are."""
    owners, parts, size = [], [], 0
    for i, t in enumerate(texts):
        a = 0
        while t and a < len(t):
            end = GAP.search(t, a + SPAN) if len(t) - a > SPAN else None
            part = t[a : end.start()] if end else t[a:]
            a += len(part)
            owners.append(i)
            parts.append(part)
            size += len(part)
            if size >= SPAN:
                yield owners, parts
                owners, parts, size = [], [], 0
    if parts:
        yield owners, parts


@dataclass
class Index:
    """Terms of a block of items, found by hash and compared by their bytes; their entries are ``item[first[t]:first[t + 1]]``."""

    ids: list[int | None]
    hashes: np.ndarray  # sorted
    terms: list[bytes]
    heads: np.ndarray  # first eight bytes of each term
    sizes: np.ndarray
    first: np.ndarray
    item: np.ndarray
    repeats: np.ndarray

    @classmethod
    def of(cls, ids: list[int | None], texts: list[str | None]) -> Index:
        entries: dict[bytes, list[tuple[int, int]]] = {}
        for i, text in enumerate(texts):
            data, begin, end = words([text or ""])
            raw = data.tobytes()
            for term, n in sorted(Counter(raw[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)).items()):
                entries.setdefault(term, []).append((i, n))
        terms = list(entries)
        data, offsets = joined(terms)
        hashes = word_hashes(data, offsets[:-1], offsets[1:])
        order = np.argsort(hashes, kind="stable")
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two terms of the items have one hash")
        terms = [terms[k] for k in order.tolist()]
        data, offsets = joined(terms)
        size = np.diff(offsets)
        flat = [x for t in terms for x in entries[t]]
        first = np.concatenate([[0], np.cumsum([len(entries[t]) for t in terms])]).astype(np.int64)
        heads = eights(data)[offsets[:-1]] & FIRST_BYTES[np.minimum(size, 8)]
        return cls(ids, hashes[order], terms, heads, size, first, np.array([x[0] for x in flat], np.int64), np.array([x[1] for x in flat], np.int64))

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(documents, terms, occurrences) of the index's terms in the texts, sorted, and each text's number of words."""
        width, length = max(1, len(self.terms)), np.zeros(len(texts), np.int64)
        keys, numbers = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for owners, parts in spans(texts):
            data, begin, end, first = words(parts, bounds=True)
            n = np.diff(first)
            np.add.at(length, np.array(owners), n)
            if not len(begin) or not len(self.terms):
                continue
            h = word_hashes(data, begin, end)
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            hit = np.flatnonzero(self.hashes[at] == h)
            at = at[hit]
            size = (end - begin)[hit]
            same = (size == self.sizes[at]) & ((eights(data)[begin[hit]] & FIRST_BYTES[np.minimum(size, 8)]) == self.heads[at])
            for k in np.flatnonzero(same & (size > 8)).tolist():
                a = int(begin[hit[k]])
                same[k] = data[a : a + int(size[k])].tobytes() == self.terms[at[k]]
            key, number = np.unique(np.repeat(np.array(owners), n)[hit[same]] * width + at[same], return_counts=True)
            keys.append(key)
            numbers.append(number)
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, back, np.concatenate(numbers))
        return key // width, key % width, total, length


def words(texts: list[str], bounds: bool = False):
    """Bytes with A-Z in lower case, begins and ends of terms; with ``bounds`` also the index of each text's first term."""
    data, offsets = joined(texts)
    data = LOWER[data]
    begin, end = word_spans(data, offsets[:-1][offsets[:-1] < offsets[1:]], NOT_ALNUM)
    return (data, begin, end, np.searchsorted(begin, offsets)) if bounds else (data, begin, end)


@dataclass
class Weights:
    documents: int
    terms: int
    weight: np.ndarray

    def length_part(self, n: int) -> int:
        return 100 - 25 + (25 * n * self.documents) // self.terms


class Heaps:
    """For each item its best documents so far, the worst of them on top; of equal scores the larger id is worse, and none the worst."""

    def __init__(self, items: int, best: int):
        self.best, self.heaps = best, [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)  # scores that can still get in

    def take(self, ids: list[int | None], scores: np.ndarray) -> None:
        """scores: a row for each document, a column for each item."""
        for d, i in zip(*(x.tolist() for x in np.nonzero(scores >= self.least)), strict=True):
            heap, own = self.heaps[i], (int(scores[d, i]), -math.inf if ids[d] is None else -ids[d])
            if len(heap) < self.best:
                heapq.heappush(heap, own)
            elif own > heap[0]:
                heapq.heapreplace(heap, own)
            if len(heap) == self.best:
                self.least[i] = heap[0][0]


def add_scores(index: Index, weights: Weights, ids: list[int | None], texts: list[str | None], heaps: Heaps) -> None:
    doc, term, tf, length = index.counts(texts)
    m = np.array([weights.length_part(n) if n else 0 for n in length.tolist()], np.int64)
    worth = weights.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc])) if len(doc) else tf
    rows = max(1, CELLS // max(1, len(index.ids)))
    for a in range(0, len(texts), rows):
        low, high = np.searchsorted(doc, [a, a + rows])
        if low == high:
            continue
        scores = np.zeros((min(rows, len(texts) - a), len(index.ids)), np.int64)
        flat = scores.reshape(-1)
        entries = index.first[term[low:high] + 1] - index.first[term[low:high]]
        upto = np.cumsum(entries)
        x = int(low)
        while x < high:
            y = max(x + 1, int(low + np.searchsorted(upto, (upto[x - low - 1] if x > low else 0) + ENTRIES, "right")))
            n = entries[x - low : y - low]
            at = np.repeat(index.first[term[x:y]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            np.add.at(flat, np.repeat((doc[x:y] - a) * len(index.ids), n) + index.item[at], np.repeat(worth[x:y], n) * index.repeats[at])
            x = y
        heaps.take(ids[a : a + rows], scores)


def search_block(docs: DataFrame, ids: list[int | None], texts: list[str | None], best: int) -> DataFrame:
    """(item, id, score, salt): the heaps of all tasks."""
    spark = docs.sparkSession
    index = spark.sparkContext.broadcast(Index.of(ids, texts))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        held, documents, terms = np.zeros(len(own.terms), np.int64), 0, 0
        for batch in batches:
            _, term, _, length = own.counts(batch.column(1).to_pylist())
            held += np.bincount(term, minlength=len(held))
            documents += int((length > 0).sum())
            terms += int(length.sum())
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array([DOCUMENTS, TERMS, *some.tolist()], pa.int64()), pa.array([documents, terms, *held[some].tolist()], pa.int64())], names=["term", "n"])
        trim()

    found = dict(map(tuple, docs.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()))  # two more than the index has terms
    n, total = found.get(DOCUMENTS, 0), found.get(TERMS, 0)
    weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * found.get(t, 0) + 1))) for t in range(len(index.value.terms))]
    weights = Weights(n, max(1, total), np.array(weight, np.int64))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(len(index.value.ids), best)
        for batch in batches:
            add_scores(index.value, weights, batch.column(0).to_pylist(), batch.column(1).to_pylist(), heaps)
        rows = [(i, None if own == -math.inf else -own, score) for i, heap in enumerate(heaps.heaps) for score, own in heap]
        salt = TaskContext.get().partitionId() % SALTS
        columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([salt] * len(rows), pa.int32())], names=["item", "id", "score", "salt"])
        trim()

    out = docs.mapInArrow(search, "item long, id long, score long, salt int")
    names = spark.createDataFrame(list(enumerate(ids)), "item long, item_id long")
    return out.join(F.broadcast(names), "item")


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", best: int = 20) -> DataFrame:
    """(item_id, ``rank`` int, id, ``score`` long): the ``best`` highest-scoring documents of each item, equal scores by id.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case. With N documents that
    have a term, L terms in all of them, n in this one, df documents with the term and tf of it in this one, a term is worth
    floor(1000 ln((2N + 2) / (2 df + 1))) * (1e9 tf div (1000 tf + 12 m)), m = 75 + 25 n N div L; a score sums this over the
    item's terms with their repeats. Only scores above 0 are given.

    Null and empty texts have no terms. Documents without an id count and are ranked, after others of an equal score, with a
    null id; repeated rows are ranked one by one. Of several items with one id the smallest text counts, a null id is one
    item, and items that nothing matches give no row. Very long texts are read whole, in parts; empty tables give no row."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    items = items.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).groupBy("item_id").agg(F.min("text").alias("text"))
    chars = items.agg(F.sum(F.coalesce(F.length("text"), F.lit(0)) + 100)).first()[0] or 0
    blocks = 1 + chars // BLOCK_CHARS
    if blocks > 1:
        items = materialize(items.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks))), "items")
    heaps = None
    for k in range(blocks):
        block = sorted((items.where(F.col("block") == k) if blocks > 1 else items).select("item_id", "text").collect(), key=lambda r: (r["item_id"] is None, r["item_id"] or 0))
        part = search_block(rows, [r["item_id"] for r in block], [r["text"] for r in block], best)
        part = materialize(part, "heaps") if blocks > 1 else part
        heaps = part if heaps is None else heaps.unionByName(part)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    some = heaps.withColumn("place", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order))).where(F.col("place") <= best)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= best)
    return ranked.select(F.col("item_id").alias(item_id_col), "rank", F.col("id").alias(id_col), "score")
