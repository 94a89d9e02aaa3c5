"""Repeated passages: words covered by a window of ``size`` words that a document with a smaller id has too.

1. Anchors. Of the word k-grams in each window the one with the smallest hash is its anchor, so equal windows have
   equal anchors wherever they stand. Anchors that several documents have are found with one shuffle. The stretches of
   words under repeated anchors, each once for all documents of a batch that have it, go to the shard of their anchor.
2. Recurring passages are confirmed in the shard: windows that several documents have, each with the smallest document.
   Neighbouring windows that only one stretch has are one passage; windows of several stretches are passages of their own.
3. Each shard compiles its passages into an Aho-Corasick automaton (a word is one code point of the shard's own
   alphabet), and all stretches that hold one stream through it: every occurrence of every passage is located, word for
   word. Nothing else makes a word go.
4. The occurrences go back to all documents that have the stretch; those in documents with a larger id than the
   passage's first one are merged into spans of words to remove.

An anchor with more words than a shard takes is dealt over several: an aggregate over window hashes finds what its
documents have in common, and each shard is told which of its own windows recur, and in which document first.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, materialize
from .hashing import groups, joined, mix, text_words, trim, window_hashes, word_hashes, word_spans
from .repeats import KeyFilter, repeated_items, split_by_filter

GRAM = 5
#: Words of the different stretches that a shard holds at once. Only one stretch, which is never cut, can be longer.
SHARD_WORDS = 100_000
#: Pairs of a document and a find that are handled at once (those of one stretch in one batch always are).
PAIRS_AT_ONCE = 300_000


def anchors(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows that lie in one text: (first word, anchor hash, text)."""
    grams = window_hashes(words, GRAM)
    span = size - GRAM + 1
    n = len(grams) - span + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    low = grams[:n].copy()
    for j in range(1, span):
        np.minimum(low, grams[j : j + n], out=low)
    count = np.maximum(first[1:] - first[:-1] - size + 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    at = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(int(count.sum()))
    return at, low[at].view(np.int64), text


def window_groups(codes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The number of each window's group of equal windows. Hashes form the groups, words are compared."""
    h = window_hashes(mix(codes.astype(np.uint64) + np.uint64(1)), size)[at]
    _, index, group = np.unique(h, return_index=True, return_inverse=True)
    for j in range(size):
        if (codes[at + j] != codes[at[index[group]] + j]).any():
            return np.unique(np.stack([codes[at + k] for k in range(size)], axis=1), axis=0, return_inverse=True)[1].reshape(-1)
    return group


def two_hashes(texts: list[bytes], n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of texts of n words each: (text, two hashes of 64 bits that have nothing to do with each other)."""
    words, first = text_words(texts, lower=False)
    count = np.maximum(n - size + 1, 0)
    row = np.repeat(np.arange(len(n)), count)
    at = np.repeat(first[:-1] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    return row, window_hashes(words, size)[at], window_hashes(mix(words ^ np.uint64(0xA0761D6478BD642F)), size)[at]


def locate(texts: list[bytes], least: np.ndarray, most: np.ndarray, size: int, told: dict[bytes, tuple[int, int]] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One shard of different stretches, words parted by a blank, with the smallest and the largest document of each.

    Returns (stretch, first window, number of windows, first document) of each passage found in a stretch that a later
    document has. ``told`` says which windows (by their hashes) of an anchor that has other shards too recur, and their
    smallest and largest documents."""
    none = tuple(np.empty(0, np.int64) for _ in range(4))
    alphabet: dict[bytes, int] = defaultdict(count().__next__)
    n = np.array([t.count(b" ") + 1 for t in texts], np.int64)
    codes = np.fromiter(map(alphabet.__getitem__, b" ".join(texts).split(b" ")), np.int64)
    if len(alphabet) > 1_100_000:
        raise ValueError("a shard has more words than there are code points")
    many = n - size + 1
    row = np.repeat(np.arange(len(n)), many)
    at = np.repeat(np.cumsum(n) - n - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    if not len(at):
        return none
    # confirm: which windows recur, and where first
    group = window_groups(codes, at, size)
    order = np.argsort(group, kind="stable")
    begin = np.flatnonzero(np.concatenate([[True], np.diff(group[order]) != 0]))
    owner, last = np.minimum.reduceat(least[row[order]], begin), np.maximum.reduceat(most[row[order]], begin)
    if told is not None:
        _, one, other = two_hashes(texts, n, size)
        names = np.stack([one[order[begin]], other[order[begin]]], axis=1).astype("<u8").tobytes()
        known = [told.get(names[16 * k : 16 * k + 16], (0, 0)) for k in range(len(begin))]
        owner, last = np.array([k[0] for k in known], np.int64), np.array([k[1] for k in known], np.int64)
    recurs = owner < last
    if not recurs.any():
        return none
    times = np.diff(np.append(begin, len(order)))
    alone = (recurs & (times == 1))[group]
    goes_on = np.zeros(len(at), bool)
    goes_on[1:] = alone[1:] & alone[:-1] & (row[1:] == row[:-1]) & (owner[group[1:]] == owner[group[:-1]])
    opens = np.flatnonzero(alone & ~goes_on)
    run = np.diff(np.append(np.flatnonzero(~goes_on), len(at)))[(np.cumsum(~goes_on) - 1)[opens]]
    shared = order[begin[recurs & (times > 1)]]
    phrase_at = np.concatenate([at[opens], at[shared]])
    phrase_windows = np.concatenate([run, np.ones(len(shared), np.int64)])
    phrase_owner = np.concatenate([owner[group[opens]], owner[group[shared]]])
    # compile; a separator after each stretch, so that no passage runs over its end
    row_of = np.repeat(np.arange(len(n)), n)
    letter = (codes + 1).astype(np.uint32)
    letter[letter >= 0xD800] += 0x800
    spaced = np.zeros(len(codes) + len(n), np.uint32)
    spaced[np.arange(len(codes)) + row_of] = letter
    text = spaced.astype("<u4").tobytes().decode("utf-32-le")
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for k, (a, w) in enumerate(zip((phrase_at + row_of[phrase_at]).tolist(), phrase_windows.tolist(), strict=True)):
        automaton.add_word(text[a : a + w + size - 1], k)
    automaton.make_automaton()
    # stream; a stretch without a recurring window has no occurrence
    busy = np.zeros(len(n), bool)
    busy[row[recurs[group]]] = True
    begins = np.cumsum(n + 1) - (n + 1)
    hits = []
    for lo, hi in zip(begins[busy].tolist(), (begins + n)[busy].tolist(), strict=True):
        hits += automaton.iter(text, lo, hi)
    found = np.array(hits, np.int64).reshape(-1, 2)
    windows = phrase_windows[found[:, 1]]
    start = found[:, 0] - windows - size + 2
    hit_row = np.searchsorted(begins, start, "right") - 1
    later = most[hit_row] > phrase_owner[found[:, 1]]
    return hit_row[later], (start - begins[hit_row])[later], windows[later], phrase_owner[found[later, 1]]


def merge_spans(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Ranges in order, those that touch or overlap as one."""
    if not len(begin):
        return np.empty((0, 2), np.int64)
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], begin[1:] > reach[:-1]])
    return np.stack([begin[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]], axis=1)


def packed(keys: list[np.ndarray], values: np.ndarray) -> tuple[list[np.ndarray], list[bytes]]:
    """Rows of 64-bit values by keys: the different keys, and the rows of each in a row."""
    order = np.lexsort(keys[::-1])
    keys, raw, width = [k[order] for k in keys], values[order].astype("<i8").tobytes(), 8 * values.shape[1]
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    cut = [*(np.flatnonzero(new) * width).tolist(), len(raw)]
    return [k[new] for k in keys], [raw[a:b] for a, b in zip(cut, cut[1:], strict=False)]


#: A stretch of words once for a batch: its key, how many rows have it, its smallest and largest document, and
#: (document, text, place) of all who have it.
STRETCH = "anchor long, key binary, n long, least long, most long, words binary, who binary"
#: What a shard reads: stretches, and before them (without words) the windows that it is told of.
SHARD = "anchor long, salt long, key binary, least long, most long, words binary"


def batch_of(columns: list, schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    names = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, names, strict=True)], names=[n for n, _ in names])


def keyed(df: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    text = F.col(text_col).cast("string")
    return df.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("text_hash"), text.alias("text"), *more)


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 13) -> DataFrame:
    """(doc long, text_hash long, spans binary): word ranges to remove as little-endian 64-bit pairs (begin, end).

    Rows with a null id or text neither lose words nor make others lose any. Rows that share an id don't affect each
    other; spans are told by id and a hash of the text, so rows with one id and different texts keep apart."""
    docs = keyed(df.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()), id_col, text_col)

    def extract(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        ids, texts = batch.column(0).to_numpy(), batch.column(2).to_pylist()
        for a, b in groups(texts):
            words, first = text_words(texts[a:b], lower=False)
            _, anchor, text = anchors(words, first, size)
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
            yield anchor[new], ids[a:b][text[new]]

    repeated = materialize(repeated_items(docs, extract).withColumnRenamed("owner", "doc"), "passage-anchors")
    lists = repeated.groupBy("doc").agg(F.collect_list("packed").alias("packed"))  # as many as the document's own anchors at most
    # by a shuffle, however small: the next step is Python again, and in one task the two would be two workers
    chosen = split_by_filter(docs, "doc", KeyFilter.build(repeated.select("doc")))[0].join(lists.hint("merge"), "doc").select("doc", "text_hash", "text", "packed")

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes, texts, listed = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_pylist(), batch.column(3)
            found, known, lengths = [], {}, []
            for a, b in groups(texts):
                data, offsets = joined([b" ".join(t.encode("utf-8", "surrogatepass").split()) for t in texts[a:b]])
                begin, end = word_spans(data, offsets[:-1][offsets[:-1] < offsets[1:]])
                first = np.searchsorted(begin, offsets)
                at, anchor, text = anchors(word_hashes(data, begin, end), first, size)
                keep = np.zeros(len(at), bool)
                cut = np.searchsorted(text, np.arange(b - a + 1))
                for i in range(b - a):
                    if cut[i] < cut[i + 1]:
                        keep[cut[i] : cut[i + 1]] = np.isin(anchor[cut[i] : cut[i + 1]], np.frombuffer(b"".join(listed[a + i].as_py()), "<i8"))
                at, anchor, text = at[keep], anchor[keep], text[keep]
                if not len(at):
                    continue
                # neighbouring windows with one anchor make a stretch
                new = np.ones(len(at), bool)
                new[1:] = (np.diff(at) != 1) | (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
                opens = np.flatnonzero(new)
                head, n = at[opens], np.diff(np.append(opens, len(at))) + size - 1
                raw = data.tobytes()
                number = [known.setdefault(raw[x:y], len(known)) for x, y in zip(begin[head].tolist(), end[head + n - 1].tolist(), strict=True)]
                lengths += [0] * (len(known) - len(lengths))
                for k, m in zip(number, n.tolist(), strict=True):
                    lengths[k] = m
                owner = text[opens]
                found.append((np.array(number, np.int64), anchor[opens], ids[a:b][owner], hashes[a:b][owner], head - first[owner]))
            if found:
                number, anchor, doc, text_hash, place = (np.concatenate(x) for x in zip(*found, strict=True))
                order = np.argsort(number, kind="stable")
                start = np.searchsorted(number[order], np.arange(len(known)))
                _, who = packed([number], np.stack([doc, text_hash, place], axis=1))
                names = list(known)
                columns = [anchor[order[start]], [xxhash.xxh3_128_digest(w) for w in names], lengths, np.minimum.reduceat(doc[order], start), np.maximum.reduceat(doc[order], start), names, who]
                for i in range(0, len(names), 20_000):
                    yield batch_of([c[i : i + 20_000] for c in columns], STRETCH)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: dict[bytes, int] = {}
        told: dict[bytes, tuple[int, int]] = {}
        keys, least, most, uses = [], [], [], []
        words_held, current = 0, None

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal index, keys, least, most, uses, words_held
            row, place, windows, owner = locate(list(index), np.array(least, np.int64), np.array(most, np.int64), size, told if current[1] >= 0 else None)
            if len(row):
                order = np.lexsort((place, row))
                row, place, windows, owner = row[order], place[order], windows[order], owner[order]
                # neighbouring finds with one first document are one
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (owner[1:] != owner[:-1]) | (place[1:] > (place + windows)[:-1])
                at = np.flatnonzero(new)
                many = np.maximum.reduceat(place + windows, at) - place[at]
                (who,), hits = packed([row[at]], np.stack([place[at], many, owner[at]], axis=1))
                yield batch_of([[keys[k] for k in who.tolist()], [uses[k] for k in who.tolist()], hits], "key binary, uses long, hits binary")
            index, keys, least, most, uses, words_held = {}, [], [], [], [], 0

        for batch in batches:
            for anchor, salt, key, low, high, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (anchor, salt) != current:
                    if index and (words_held >= SHARD_WORDS // 2 or salt >= 0 or current[1] >= 0):
                        yield from flush()
                    current, told = (anchor, salt), {}
                if words is None:
                    told[key] = (low, high)
                elif (k := index.get(words)) is None:
                    index[words] = len(index)
                    keys.append(key)
                    least.append(low)
                    most.append(high)
                    uses.append(1)
                    words_held += words.count(b" ") + 1
                else:
                    least[k], most[k], uses[k] = min(least[k], low), max(most[k], high), uses[k] + 1
        if index:
            yield from flush()
        trim()

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows of a batch's stretches, each once for a shard, with the smallest and the largest document."""
        for batch in batches:
            anchor, salt, low, high = (batch.column(k).to_numpy() for k in (0, 1, 3, 4))
            texts = batch.column(5).to_pylist()
            row, one, other = two_hashes(texts, np.array([t.count(b" ") + 1 for t in texts], np.int64), size)
            a, s, one, other, low, high = anchor[row], salt[row], one.view(np.int64), other.view(np.int64), low[row], high[row]
            order = np.lexsort((other, one, s, a))
            a, s, one, other, low, high = (x[order] for x in (a, s, one, other, low, high))
            new = np.ones(len(order), bool)
            new[1:] = np.any([x[1:] != x[:-1] for x in (a, s, one, other)], axis=0)
            start = np.flatnonzero(new)
            names = np.stack([one[start], other[start]], axis=1).astype("<i8").tobytes()
            yield batch_of([a[start], s[start], [names[16 * k : 16 * k + 16] for k in range(len(start))], np.minimum.reduceat(low, start), np.maximum.reduceat(high, start)], "anchor long, salt long, key binary, least long, most long")

    def dealt(heavy: DataFrame) -> DataFrame:
        """Stretches of the anchors in ``heavy(anchor, shards)``, in so many shards each, and what these are told."""
        salt = F.pmod(F.xxhash64("key"), F.col("shards")).alias("salt")
        salted = travelling.join(heavy, "anchor").select("anchor", salt, "key", "least", "most", "words")
        windows = salted.mapInArrow(seen, "anchor long, salt long, key binary, least long, most long")
        windows = materialize(windows.groupBy("anchor", "salt", "key").agg(F.min("least").alias("least"), F.max("most").alias("most")), "passage-windows")
        recurring = windows.groupBy("anchor", "key").agg(F.min("least").alias("least"), F.max("most").alias("most")).where("least < most")
        tell = windows.select("anchor", "salt", "key").join(recurring, ["anchor", "key"])
        return salted.unionByName(tell.select("anchor", "salt", "key", "least", "most", F.lit(None).cast("binary").alias("words")))

    travelling = materialize(chosen.mapInArrow(stretches, STRETCH), "passage-stretches")
    # anchors with more than half of what a shard holds; more shards than the words need, as stretches are dealt by hash
    words = travelling.groupBy("anchor").agg(F.sum("n").alias("words")).where(F.col("words") > SHARD_WORDS // 2)
    heavy = materialize(words.select("anchor", F.ceil(F.col("words") * 4 / SHARD_WORDS).cast("long").alias("shards")), "passage-heavy")
    rows = travelling.select("anchor", F.lit(-1).cast("long").alias("salt"), "key", "least", "most", "words")
    if not heavy.isEmpty():
        # read from files, so Spark knows its size and broadcasts it only while it is small
        rows = rows.join(heavy.select("anchor"), "anchor", "left_anti").unionByName(dealt(heavy))
    ordered = rows.repartition(F.col("anchor"), F.col("salt")).sortWithinPartitions("anchor", "salt", F.col("words").isNotNull())
    found = materialize(ordered.mapInArrow(shard, "key binary, uses long, hits binary"), "passage-hits")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Occurrences in all documents that have a stretch and come after the passage's first."""
        for batch in batches:
            who, hits = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            n_who, n_hits = (np.array([len(x) // 24 for x in lists], np.int64) for lists in (who, hits))
            reach = np.cumsum(n_who * n_hits)
            lo = 0
            while lo < len(who):
                hi = max(lo + 1, int(np.searchsorted(reach, (reach[lo - 1] if lo else 0) + PAIRS_AT_ONCE, "right")))
                w, h = (np.frombuffer(b"".join(lists[lo:hi]), "<i8").reshape(-1, 3) for lists in (who, hits))
                nw, nh = n_who[lo:hi], n_hits[lo:hi]
                row = np.repeat(np.arange(hi - lo), nw * nh)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(nw * nh) - nw * nh, nw * nh)
                i, j = (np.cumsum(nw) - nw)[row] + nth // nh[row], (np.cumsum(nh) - nh)[row] + nth % nh[row]
                later = w[i, 0] > h[j, 2]
                i, j, lo = i[later], j[later], hi
                if len(i):
                    begin = w[i, 2] + h[j, 0]
                    (doc, text_hash), blobs = packed([w[i, 0], w[i, 1]], np.stack([begin, begin + h[j, 1] + size - 1], axis=1))
                    yield batch_of([doc, text_hash, blobs], "doc long, text_hash long, spans binary")

    placed = attach(travelling.select("key", "who"), "key", found, "uses", travelling.count())
    located = placed.select("who", "hits").mapInArrow(expand, "doc long, text_hash long, spans binary")

    @F.pandas_udf("binary")
    def merged(lists):
        def one(parts) -> bytes:
            both = np.frombuffer(b"".join(parts), "<i8").reshape(-1, 2)
            return merge_spans(both[:, 0], both[:, 1]).astype("<i8").tobytes()

        return lists.map(one)

    return located.groupBy("doc", "text_hash").agg(F.collect_list("spans").alias("spans")).select("doc", "text_hash", merged("spans").alias("spans"))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 13, carry: list[str] | None = None) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_removed`` longs, ``kept`` string, and the columns in ``carry``.

    ``kept`` holds the words that stay, joined by one space. A null text has no words and a kept text of ''. The
    smallest id that has a passage keeps it, so equal texts under one id all stay. Whole texts are read."""
    spans = materialize(repeated_spans(df, id_col, text_col, size), "passage-spans")
    touched = KeyFilter.build(spans.select("doc"))
    more = F.struct(*[F.col(c) for c in carry]).alias("more") if carry else F.lit(0).alias("more")
    rows = keyed(df, id_col, text_col, more)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                n, removed, kept = [], [], []
                listed = part.column("spans").to_pylist() if "spans" in part.schema.names else [None] * part.num_rows
                for text, span in zip(part.column("text").to_pylist(), listed, strict=True):
                    words = (text or "").encode("utf-8", "surrogatepass").split()
                    n.append(len(words))
                    if span:
                        left, at = [], 0
                        for begin, end in np.frombuffer(span, "<i8").reshape(-1, 2).tolist():
                            left += words[at:begin]
                            at = end
                        words = left + words[at:]
                    removed.append(n[-1] - len(words))
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), part.column("more")], names=["doc", "n_words", "n_removed", "kept", "more"])

    schema = f"doc long, n_words long, n_removed long, kept string, more {rows.schema['more'].dataType.simpleString()}"
    doubtful, clear = split_by_filter(rows, "doc", touched, cut, schema)
    # by a shuffle, however small, as above
    joined = doubtful.join(spans.hint("merge"), ["doc", "text_hash"], "left").select("doc", "text", "spans", "more")
    out = clear.unionByName(joined.mapInArrow(cut, schema))
    return out.select(F.col("doc").alias(id_col), "n_words", "n_removed", "kept", *([f"more.{c}" for c in carry] if carry else []))
