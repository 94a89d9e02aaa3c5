"""Similarity join on word n-grams: documents whose shingle sets have a Jaccard similarity of 0.8 or more.

Equal sets are one class from the start. Classes that can have a partner are found by two exact filters, each one
shuffle of shingles; the last one gives document frequencies, and with them one global order, rare first. Two similar
sets share a shingle of their prefixes in that order. The sets that have a prefix shingle are stored in a prefix tree;
each set walks the tree, sharing the overlap of common prefixes, and leaves subtrees that their remaining lengths keep
below the threshold. All links that a tree finds are exact, and components of links are what counts, so trees come in
two passes:

1. Each set goes to the trees of SEEDS of its prefix shingles, those with the lowest hashes. Copies and near copies meet
   here, and their components are formed.
2. A prefix shingle whose sets are all in one component has nothing more to tell. Of the others, each list of sets counts
   once, however many shingles have that list, and the lists in which one component is the commonest, which have nearly
   the same sets, are one tree of all their sets, unless the lists by themselves are less to compare. Trees of the
   prefixes alone look for pairs in different components that may be similar: what the prefixes share and what the rest
   could add must suffice. The few pairs that are left are counted in full. A tree that has more of them than MOST_PAIRS
   for each set is grown again from whole sets, which finds links without listing pairs. Only sets outside the commonest
   component walk a tree, so a group of near copies costs its stragglers times its sets, once.

Long lists are dealt in blocks: the sets of the commonest component go to one block each, the others to all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, materialize
from .components import connected_components
from .hashing import groups, mix, text_words, trim, window_hashes
from .repeats import KeyFilter, repeated_items

GRAM = 5
#: Similarity as a fraction: links have 100 * |intersection| >= 80 * |union|.
PART, WHOLE = 80, 100
#: Sets and shingles that one tree takes; longer lists are dealt in blocks.
BLOCK_SETS, BLOCK_SHINGLES = 4096, 1_000_000
#: Trees that each set goes to in the first pass.
SEEDS = 2
#: Pairs to count in full for each set of a tree of prefixes; beyond that, a tree of whole sets finds the links.
MOST_PAIRS = 4
#: Document frequencies count to this; commoner shingles are ordered by their hash alone.
MOST_DOCS = 10_000
HOT_DOCS = 1 / 200
#: Shingles of a row at most, so that the rows follow the shingles and not the number of partitions.
PACKED = 8
COMMON = np.int64(1) << np.int64(62)
#: Sets that look for all others of a tree before it is known which component is the largest.
PIVOTS = 8


def shingle_sets(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
    """(text, sorted distinct shingle hashes) of each text; a text of fewer than GRAM words has one shingle, one without words none."""
    for a, b in groups(texts):
        words, first = text_words(texts[a:b])
        grams = window_hashes(words, GRAM).view(np.int64)
        for i in range(b - a):
            lo, hi = int(first[i]), int(first[i + 1])
            if hi - lo >= GRAM:
                yield a + i, np.unique(grams[lo : hi - GRAM + 1])
            elif hi > lo:
                yield a + i, np.array([xxhash.xxh3_64_intdigest(words[lo:hi].tobytes(), hi - lo)], np.uint64).view(np.int64)
            else:
                yield a + i, np.empty(0, np.int64)


def set_key(shingles: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes()))))


def distinct_sets(texts: list[str | None]) -> dict[int, np.ndarray]:
    """The non-empty sets of a batch by key: copies in the batch count once."""
    return {set_key(s): s for _, s in shingle_sets(texts) if len(s)}


def spans(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers from each begin to before its end, one span after the other."""
    n = end - begin
    return np.repeat(end - n.cumsum(), n) + np.arange(int(n.sum()))


def at_least(n: int | np.ndarray) -> int | np.ndarray:
    """Shingles of a set of n that a similar set must have too: ceil(0.8 n)."""
    return -(-n * PART // WHOLE)


def profile(docs: DataFrame) -> DataFrame:
    """docs(doc, text, more longs) -> rows (doc, key, n, more) for each document and (token, docs) for shingles that are
    common in a batch."""
    more = docs.columns[2:]
    names = ["doc", "key", "n", "token", "docs", *more]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = batch.column(1).to_pylist()
        keys, sizes, sets = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), {}
        for i, s in shingle_sets(texts):
            sizes[i] = len(s)
            if len(s):
                keys[i] = set_key(s)
                sets[keys[i]] = s
        empty = pa.nulls(len(texts), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64(), mask=sizes == 0), pa.array(sizes, pa.int64()), empty, empty, *batch.columns[2:]], names=names)
        if sets:
            token, docs_with = np.unique(np.concatenate(list(sets.values())), return_counts=True)
            heavy = docs_with >= max(8, int(len(texts) * HOT_DOCS / 2))
            empty = pa.nulls(int(heavy.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays([empty, empty, empty, pa.array(token[heavy], pa.int64()), pa.array(docs_with[heavy], pa.int64()), *([empty] * len(more))], names=names)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from run(batch)

    return docs.mapInArrow(each, ", ".join(f"{c} long" for c in names))


def frequent_sets(docs: DataFrame, survivors: KeyFilter, hot: np.ndarray) -> DataFrame:
    """(key, n, tokens, prefix, last): sets of which at least 0.8 of the shingles are in another set too.

    ``tokens`` are those shingles, rare first; the first ``prefix`` of them must hold one of any similar set's, and
    ``last`` is the document frequency of the last one of these, which is its place in the order."""
    spark = docs.sparkSession
    passed, common = spark.sparkContext.broadcast(survivors), spark.sparkContext.broadcast(hot)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = distinct_sets(batch.column(1).to_pylist())
            keys = np.array(list(sets), np.int64)
            for key in keys[passed.value.passes(keys)].tolist() if len(keys) else []:
                s = sets[key]
                at = np.minimum(np.searchsorted(common.value, s), max(0, len(common.value) - 1))
                is_hot = common.value[at] == s if len(common.value) else np.zeros(len(s), bool)
                rest = s[~is_hot]
                n = len(rest)
                token = np.concatenate([rest, mix(np.array([key], np.int64).view(np.uint64)).view(np.int64)])
                blob = pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array([s[is_hot].astype("<i8").tobytes()], pa.binary())])
                yield pa.RecordBatch.from_arrays([pa.array(token, pa.int64()), pa.array(np.full(n + 1, key), pa.int64()), pa.array(np.full(n + 1, len(s)), pa.int64()), blob], names=["token", "key", "n", "hot"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in the order of shingles. The sets of the shingle that a batch ends with are carried into the next until
        there are MOST_DOCS of them."""

        def out(key: np.ndarray, n: np.ndarray, blobs: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(n, pa.int64()), pa.array(blobs, pa.binary())], names=["key", "n", "packed"])

        def counted(token: np.ndarray, key: np.ndarray, n: np.ndarray, many: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Sets of whole shingles, those in ``many`` with MOST_DOCS sets or more."""
            order = np.lexsort((key, token))
            token, key, n = token[order], key[order], n[order]
            new = np.ones(len(token), bool)
            new[1:] = token[1:] != token[:-1]
            keep = new.copy()
            keep[1:] |= key[1:] != key[:-1]
            token, key, n, new = token[keep], key[keep], n[keep], new[keep]
            if not len(token):
                return
            group = np.cumsum(new) - 1
            df = np.minimum(np.bincount(group)[group], MOST_DOCS)
            df[np.isin(token, many)] = MOST_DOCS
            token, key, n, df = (x[df > 1] for x in (token, key, n, df))
            order = np.argsort(key, kind="stable")
            token, key, n, df = token[order], key[order], n[order], df[order]
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            nth = np.arange(len(key)) - np.flatnonzero(new)[np.cumsum(new) - 1]
            first = np.flatnonzero(nth % PACKED == 0)
            raw, cut = np.stack([df, token], axis=1).astype("<i8").tobytes(), [*(first * 16).tolist(), len(key) * 16]
            yield out(key[first], n[first], [raw[x:y] for x, y in zip(cut, cut[1:], strict=False)])

        held = tuple(np.empty(0, np.int64) for _ in range(3))
        many = np.empty(0, np.int64)  # the held shingle, once it has many sets
        for batch in batches:
            whole = batch.column(3).is_valid().to_numpy(zero_copy_only=False)
            if whole.any():
                some = batch.filter(pa.array(whole))
                blobs = []
                for x in some.column(3).to_pylist():
                    t = np.frombuffer(x, "<i8")
                    blobs.append(np.stack([np.full(len(t), COMMON), t], axis=1).astype("<i8").tobytes())
                yield out(some.column(1), some.column(2), blobs)
            token, key, n = (np.concatenate([h, batch.column(k).to_numpy()[~whole]]) for k, h in enumerate(held))
            if not len(token):
                continue
            last = int(np.searchsorted(token, token[-1]))
            if len(token) - last >= MOST_DOCS or token[-1] in many:
                many = np.union1d(many, token[-1:])
                last = len(token)
            yield from counted(token[:last], key[:last], n[:last], many)
            many = many[many == token[-1]]
            held = token[last:], key[last:], n[last:]
        yield from counted(*held, many)
        trim()

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, n, packed in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2)), strict=True):
                pairs = np.frombuffer(b"".join(packed), "<i8").reshape(-1, 2)
                order = np.lexsort((pairs[:, 1], pairs[:, 0]))
                df, token = pairs[order, 0], pairs[order, 1]
                if len(token):
                    once = np.concatenate([[True], (token[1:] != token[:-1]) | (df[1:] != df[:-1])])
                    token, df = token[once], df[once]
                need = at_least(n)
                if len(token) >= need:
                    prefix = n - need + 1 - (n - len(token))
                    rows.append((key, n, token.astype("<i8").tobytes(), prefix, int(df[prefix - 1])))
            if rows:
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()), strict=True)], names=["key", "n", "tokens", "prefix", "last"])

    spread_rows = docs.mapInArrow(spread, "token long, key long, n long, hot binary")
    settled = spread_rows.repartition(F.col("token")).sortWithinPartitions("token").mapInArrow(settle, "key long, n long, packed binary")
    by_key = settled.groupBy("key").agg(F.max("n").alias("n"), F.collect_list("packed").alias("packed"))  # a set's own shingles
    return by_key.mapInArrow(choose, "key long, n long, tokens binary, prefix long, last long")


class PrefixTree:
    """Sets in one global order (commonest first), stored by common prefixes; nodes hold runs of shingles.

    Nodes stand level by level, a node's children in a row, so that a set walks a whole level at once."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        token, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        rank = np.empty(len(token), np.int64)
        rank[np.lexsort((token, -count))] = np.arange(len(token))
        cut = np.cumsum([len(s) for s in sets])[:-1]
        ranked = [np.sort(r) for r in np.split(rank[inverse], cut)]
        self.order = sorted(range(len(sets)), key=lambda i: ranked[i].astype(">u4").tobytes())
        self.sets = [ranked[i] for i in self.order]
        self.sizes = sizes[self.order]
        self.alphabet = len(token)
        self._grow(np.array([len(s) for s in self.sets], np.int64))

    def _grow(self, lengths: np.ndarray) -> None:
        """Of each node: its run, the first set, the first that does not end here, the end of sets, smallest and largest
        size, most ranks below the run, the last rank up to its end, children."""
        nodes, runs, todo = [], [], [(0, len(self.sets), 0)]
        for lo, hi, depth in todo:  # children are added while it goes
            a, b = self.sets[lo], self.sets[hi - 1]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[depth:m] != b[depth:m])
            end = depth + int(differ[0]) if len(differ) else m
            runs.append(a[depth:end])
            at = lo
            while at < hi and lengths[at] == end:
                at += 1  # sets that end here are the node's own
            own, first = at, len(todo)
            while at < hi:
                head, stop = self.sets[at][end], at + 1
                while stop < hi and self.sets[stop][end] == head:
                    stop += 1
                todo.append((at, stop, end))
                at = stop
            nodes.append((lo, own, hi, int(self.sizes[lo:hi].min()), int(self.sizes[lo:hi].max()), int(lengths[lo:hi].max()) - end, int(a[end - 1]) if end else -1, first, len(todo)))
        self.lo, self.own, self.hi, self.low, self.high, self.longest, self.last, self.child, self.children = np.array(nodes, np.int64).T
        self.runs = np.concatenate(runs)
        self.run_end = np.cumsum([len(r) for r in runs])
        self.run = self.run_end - [len(r) for r in runs]

    def meets(self, x: int, other: np.ndarray, mine: np.ndarray, more: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(set, overlap) of the sets that may be similar to set ``x``, among them all similar ones that ``other`` marks.

        Subtrees are left as soon as sizes, or what may still be shared, keep them below the threshold; ``more`` is what a
        node's sets and x may share beside the tree. ``mine`` has a 0 for each rank, and is given back so."""
        s, n = self.sets[x], int(self.sizes[x])
        marked = np.concatenate([[0], other.cumsum()])
        mine[s] = 1
        at, overlap, found = np.zeros(1, np.int64), np.zeros(1, np.int64), []
        while len(at):
            keep = (PART * self.low[at] <= WHOLE * n) & (WHOLE * self.high[at] >= PART * n) & (marked[self.hi[at]] > marked[self.lo[at]])
            at, overlap = at[keep], overlap[keep]
            if not len(at):
                break
            if self.run_end[at[0]] > self.run[at[0]]:  # only the root's run may be empty
                begin = (self.run_end[at] - self.run[at]).cumsum() - (self.run_end[at] - self.run[at])
                overlap = overlap + np.add.reduceat(mine[np.concatenate([self.runs[a:b] for a, b in zip(self.run[at].tolist(), self.run_end[at].tolist(), strict=True)])], begin)
            left = len(s) - np.searchsorted(s, self.last[at], "right")
            beside = more[at] if isinstance(more, np.ndarray) else more
            keep = (PART + WHOLE) * (overlap + np.minimum(left, self.longest[at]) + beside) >= PART * (n + self.low[at])
            at, overlap = at[keep], overlap[keep]
            found.append((spans(self.lo[at], self.own[at]), np.repeat(overlap, self.own[at] - self.lo[at])))
            at, overlap = spans(self.child[at], self.children[at]), np.repeat(overlap, self.children[at] - self.child[at])
        mine[s] = 0
        return tuple(np.concatenate([np.empty(0, np.int64), *(f[k] for f in found)]) for k in (0, 1))

    def links(self, label: np.ndarray | None = None) -> list[tuple[int, int]]:
        """Links that join all linked sets (not those whose ends other links join already).

        Sets of one ``label`` count as joined. A few sets find most of a group of near copies; then only sets outside the
        commonest label have to look for others, and of them only those that no link has joined to it meanwhile."""
        label = np.arange(len(self.sets)) if label is None else np.unique(label[self.order], return_inverse=True)[1]
        found, mine, done = [], np.zeros(self.alphabet, np.int32), np.zeros(len(self.sets), bool)

        def join(x: int) -> None:
            other = (label != label[x]) & ~done
            done[x] = True
            if not other.any():
                return
            y, overlap = self.meets(x, other, mine)
            y = y[other[y] & ((PART + WHOLE) * overlap >= PART * (int(self.sizes[x]) + self.sizes[y]))]
            if len(y):
                met, first = np.unique(label[y], return_index=True)
                found.extend((k, x) for k in y[first].tolist())
                label[np.isin(label, met)] = label[x]

        for x in range(0, len(self.sets), -(-len(self.sets) // PIVOTS)):
            join(x)
        within = label == np.bincount(label).argmax()
        seat = int(within.argmax())
        for x in np.flatnonzero(~within).tolist():
            if label[x] != label[seat]:
                join(x)
        return [(self.order[a], self.order[b]) for a, b in found]

    def pairs(self, label: np.ndarray, size: np.ndarray, place: list[tuple[int, int]], most: int) -> list[tuple[int, int]] | None:
        """For a tree of prefixes: pairs of sets of different ``label`` that may be similar; None if there are more than ``most``.

        ``size`` has all frequent shingles of a set, ``place`` its last prefix shingle in the order of all. Whatever two
        sets share up to the earlier of their last prefix shingles stands in both prefixes; beyond it the set that ends
        earlier has its rest, and the other one no more than it has not shared yet. Prefixes of similar sets meet."""
        label, size = np.unique(label[self.order], return_inverse=True)[1], size[self.order]
        rest = size - np.array([len(s) for s in self.sets])
        rest_below = np.array([rest[a:b].max() for a, b in zip(self.lo.tolist(), self.hi.tolist(), strict=True)])
        turn = {p: k for k, p in enumerate(sorted(set(place)))}
        ends = np.array([turn[place[i]] for i in self.order])
        found, mine = [], np.zeros(self.alphabet, np.int32)
        outside = label != np.bincount(label).argmax()
        for x in np.flatnonzero(outside).tolist():
            other = label != label[x]
            other[x + 1 :] &= ~outside[x + 1 :]  # of two outside the second one looks for the first
            y, overlap = self.meets(x, other, mine, np.maximum(rest_below, rest[x]))
            y, overlap = (v[other[y] & (overlap > 0)] for v in (y, overlap))
            more = np.where(ends[x] <= ends[y], np.minimum(rest[x], size[y] - overlap), np.minimum(rest[y], size[x] - overlap))
            y = y[(PART + WHOLE) * (overlap + more) >= PART * (int(self.sizes[x]) + self.sizes[y])]
            found += [(k, x) for k in y.tolist()]
            if len(found) > most:
                return None
        return [(self.order[a], self.order[b]) for a, b in found]


def trees(rows: DataFrame, columns: list[str], found, schema: str) -> DataFrame:
    """rows(token, i, j, columns): ``found`` makes a batch, or None, of the rows of each (token, i, j).

    Trees of a task follow each other; only one is in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            token, i, j = (batch.column(k).to_numpy() for k in range(3))
            cut = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])) if len(token) else ()
            for a, b in zip(cut, [*cut[1:], len(token)], strict=True):
                if current != (token[a], i[a], j[a]):
                    if held and (out := found(pa.Table.from_batches(held))) is not None:
                        yield out
                    current, held = (token[a], i[a], j[a]), []
                held.append(batch.slice(a, b - a))
        if held and (out := found(pa.Table.from_batches(held))) is not None:
            yield out

    key = ["token", "i", "j"]
    return rows.select(*key, *columns).repartition(*key).sortWithinPartitions(*key).mapInArrow(run, schema)


def tree_links(rows: DataFrame) -> DataFrame:
    """rows(token, i, j, n, tokens, root): links (u, v) between roots, from trees of whole sets."""

    def found(rows: pa.Table) -> pa.RecordBatch | None:
        n, root = rows["n"].to_numpy(), rows["root"].to_numpy()
        if len(n) < 2 or (root == root[0]).all():
            return None
        a, b = np.array(PrefixTree([np.frombuffer(t, "<i8") for t in rows["tokens"].to_pylist()], n).links(root), np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(root[a], pa.int64()), pa.array(root[b], pa.int64())], names=["u", "v"])

    return trees(rows, ["n", "tokens", "root"], found, "u long, v long")


def tree_pairs(rows: DataFrame) -> DataFrame:
    """rows(token, i, j, key, n, size, last, head, root): pairs (a, b) of keys to count in full, from trees of prefixes;
    for a tree with too many of them one row that names it."""

    def found(rows: pa.Table) -> pa.RecordBatch | None:
        key, n, size, last, root = (rows[c].to_numpy() for c in ("key", "n", "size", "last", "root"))
        if len(n) < 2 or (root == root[0]).all():
            return None
        heads = [np.frombuffer(t, "<i8") for t in rows["head"].to_pylist()]
        place = [(df, int(h[-1])) for df, h in zip(last.tolist(), heads, strict=True)]
        got = PrefixTree(heads, n).pairs(root, size, place, MOST_PAIRS * len(n))
        a, b = np.array(got or [], np.int64).reshape(-1, 2).T
        whole = [[rows[c][0].as_py()] for c in ("token", "i", "j")] if got is None else [[None] * len(a)] * 3
        pairs = [[None]] * 2 if got is None else [key[a], key[b]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([*pairs, *whole], (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["a", "b", "token", "i", "j"])

    return trees(rows, ["key", "n", "size", "last", "head", "root"], found, "a long, b long, token long, i int, j int")


def counted_links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs(a, b) of sets(key, n, tokens, root): links (u, v) between roots of those that are similar."""
    one, other = (sets.select(F.col("key").alias(k), F.struct("n", "tokens", "root").alias(f"set_{k}")) for k in ("a", "b"))
    both = pairs.join(one, "a").join(other, "b").select("set_a.root", F.col("set_b.root").alias("v"), "set_a.n", F.col("set_b.n").alias("m"), "set_a.tokens", F.col("set_b.tokens").alias("more"))

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            shared = [len(np.intersect1d(np.frombuffer(x, "<i8"), np.frombuffer(y, "<i8"), assume_unique=True)) for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)]
            ok = pa.array((PART + WHOLE) * np.array(shared, np.int64) >= PART * n)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["u", "v"])

    return both.mapInArrow(similar, "u long, v long")


def blocks_of(sets, shingles):
    """How many blocks a list of so many sets and shingles has."""
    return F.greatest(F.ceil(sets / F.lit(BLOCK_SETS)), F.ceil(shingles / F.lit(BLOCK_SHINGLES)), F.lit(1)).cast("int")


def similar_sets(docs: DataFrame, profiled: DataFrame) -> DataFrame:
    """(node, root): classes of equal sets (by key) that links join, under the smallest key."""
    spark = docs.sparkSession
    known = profiled.where(F.col("key").isNotNull())
    classes = known.groupBy("key").agg(F.max("n").alias("n"))
    total = profiled.where(F.col("n").isNotNull()).count()
    hot_rows = profiled.where(F.col("token").isNotNull()).groupBy("token").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= max(8, int(total * HOT_DOCS)))
    # shingles in 1/200 of all documents: at most 200 times the mean size of a set
    hot = np.sort(np.array([r["token"] for r in hot_rows.select("token").collect()], np.int64))

    def prefixes(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The lowest hashes of each set: 0.2 n + 0.1 n of them."""
        items, owners = [], []
        for key, s in distinct_sets(batch.column(1).to_pylist()).items():
            n = len(s)
            part = s[: n - at_least(n) + max(1, n // 10)]
            items.append(part)
            owners.append(np.full(len(part), key, np.int64))
        if items:
            yield np.concatenate(items), np.concatenate(owners)

    # of two similar sets the prefixes share as many shingles as the smaller one's extra tenth; a partner has 0.8 n at least
    shared = repeated_items(docs, prefixes).groupBy(F.col("owner").alias("key")).agg(F.sum(F.octet_length("packed") / 8).alias("shared"))
    need = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * PART / WHOLE) / 10))
    survivors = materialize(classes.join(shared, "key").where(F.col("shared") >= need).select("key"), "jaccard-survivors")
    frequent = materialize(frequent_sets(docs, KeyFilter.build(survivors), hot), "jaccard-sets")

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The prefix shingles with the lowest hashes, for as many hashes as there are SEEDS."""
        for batch in batches:
            prefix = np.minimum(batch.column(3).to_numpy(), [len(t) // 8 for t in batch.column(2).to_pylist()])
            token, row = [], []
            for k, (t, p) in enumerate(zip(batch.column(2).to_pylist(), prefix.tolist(), strict=True)):
                own = np.frombuffer(t, "<i8", p).view(np.uint64)
                for x in {int(own[mix(own + np.uint64(seed)).argmin()].view(np.int64)) for seed in range(SEEDS)} if p else ():
                    token.append(x)
                    row.append(k)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(token, pa.int64()), *(batch.column(k).take(at) for k in (0, 1, 2))], names=["token", "key", "n", "tokens"])

    # first pass: near copies meet
    picks = materialize(frequent.mapInArrow(chosen, "token long, key long, n long, tokens binary"), "jaccard-picks")
    lists = picks.groupBy("token").agg(F.count("*").alias("sets"), F.sum(F.octet_length("tokens") / 8).alias("shingles")).where("sets > 1")
    lists = materialize(lists.select("token", "sets", blocks_of(F.col("sets"), F.col("shingles")).alias("blocks")), "jaccard-lists")
    placed = attach(picks, "token", lists, "sets", picks.count())
    first = tree_links(placed.select("token", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("i"), F.lit(0).alias("j"), "key", "n", "tokens", F.col("key").alias("root")))
    known_roots = materialize(connected_components(first), "jaccard-first")

    # second pass: prefix shingles that sets of different components have
    rooted = frequent.join(known_roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    rooted = materialize(rooted, "jaccard-rooted")

    def prefix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = np.minimum(batch.column(2).to_numpy(), [len(t) // 8 for t in batch.column(1).to_pylist()])
            token = np.frombuffer(b"".join([t[: 8 * p] for t, p in zip(batch.column(1).to_pylist(), prefix.tolist(), strict=True)]), "<i8")
            cols = [pa.array(token, pa.int64()), *(pa.array(np.repeat(batch.column(k).to_numpy(), prefix), pa.int64()) for k in (0, 3, 4)), pa.array(np.repeat([len(t) // 8 for t in batch.column(1).to_pylist()], prefix), pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["token", "key", "root", "n", "n_shingles"])

    entries = materialize(rooted.select("key", "tokens", "prefix", "root", "n").mapInArrow(prefix_rows, "token long, key long, root long, n long, n_shingles long"), "jaccard-prefixes")
    by_root = entries.groupBy("token", "root").agg(F.count("*").alias("sets"), F.sum("n_shingles").alias("shingles"), F.min("n").alias("low"), F.max("n").alias("high"), F.bit_xor(F.xxhash64("key")).alias("one"), F.bit_xor(F.xxhash64("key", F.lit(1))).alias("other"))
    open_lists = by_root.groupBy("token").agg(F.sum("sets").alias("sets"), F.sum("shingles").alias("shingles"), F.max_by("root", "sets").alias("commonest"), F.max("sets").alias("most"), F.bit_xor("one").alias("one"), F.bit_xor("other").alias("other"), F.min("low").alias("low"), F.max("high").alias("high"), F.count("*").alias("roots")).where("roots > 1")
    open_lists = open_lists.where((F.col("sets") > 2) | (F.col("high") * PART <= F.col("low") * WHOLE))  # two sets of one size, or more
    # one shingle for each list of sets
    once = open_lists.groupBy("one", "other", "sets").agg(F.min_by(F.struct("token", "shingles", "commonest", "most"), "token").alias("l"))
    once = materialize(once.select("l.token", "sets", "l.shingles", "l.commonest", (F.col("sets") - F.col("l.most")).alias("others")), "jaccard-open")
    listed = materialize(attach(entries.select("token", "key", "root", "n_shingles"), "token", once, "sets", entries.count()), "jaccard-open-sets")
    # near copies of one component have many lists, of nearly the same sets: one tree of all of them, where that is less to compare
    united = listed.select("commonest", "key", "root", "n_shingles").distinct()
    around = united.groupBy("commonest").agg(F.count("*").alias("sets"), F.sum("n_shingles").alias("shingles"), F.count_if(F.col("root") != F.col("commonest")).alias("others"))
    apart = once.groupBy("commonest").agg(F.sum("sets").alias("rows"), F.sum(F.col("sets") * F.col("others")).alias("work"))
    around = materialize(around.join(apart, "commonest").withColumn("one", F.col("sets") * F.col("others") <= F.col("work")), "jaccard-around")
    of_one = attach(united, "commonest", around.where("one").select("commonest", "sets", "shingles", "others"), "sets", around.agg(F.coalesce(F.sum("sets"), F.lit(0))).first()[0])
    of_lists = attach(listed, "commonest", around.where("NOT one").select("commonest", "rows"), "rows", listed.count())
    columns = ["key", "root", "commonest", "others", blocks_of(F.col("sets"), F.col("shingles")).alias("blocks")]
    members = of_one.select(F.col("commonest").alias("token"), *columns).unionByName(of_lists.select("token", *columns))
    block, all_blocks = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"), F.sequence(F.lit(0), F.col("blocks") - 1)
    # few outside the commonest component: they go to all its blocks; else blocks meet by pairs
    spread = F.when((F.col("others") <= BLOCK_SETS) & (F.col("root") == F.col("commonest")), F.array(F.struct(block.alias("i"), F.lit(-1).alias("j"))))
    spread = spread.when(F.col("others") <= BLOCK_SETS, F.transform(all_blocks, lambda k: F.struct(k.alias("i"), F.lit(-1).alias("j"))))
    spread = spread.otherwise(F.transform(all_blocks, lambda k: F.struct(F.least(k, block).alias("i"), F.greatest(k, block).alias("j"))))
    places = materialize(members.select("token", "key", F.explode(spread).alias("at")).select("token", "at.i", "at.j", "key"), "jaccard-places")
    heads = rooted.select("key", "n", (F.octet_length("tokens") / 8).cast("long").alias("size"), "last", F.substring(F.col("tokens"), F.lit(1), (8 * F.col("prefix")).cast("int")).alias("head"), "root")
    tried = materialize(tree_pairs(places.join(heads, "key")), "jaccard-pairs")
    second = counted_links(tried.where("a IS NOT NULL").select("a", "b").distinct(), rooted)
    crowded = materialize(tried.where("a IS NULL").select("token", "i", "j"), "jaccard-crowded")
    if not crowded.isEmpty():
        second = second.unionByName(tree_links(places.join(crowded, ["token", "i", "j"]).join(rooted.select("key", "n", "tokens", "root"), "key")))
    merged = materialize(connected_components(second), "jaccard-second").select(F.col("node").alias("root"), F.col("root").alias("top"))
    grouped = known_roots.join(merged, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    # components of one set that the second pass joined
    alone = merged.join(known_roots.select(F.col("node").alias("root")), "root", "left_anti").select(F.col("root").alias("node"), F.col("top").alias("root"))
    return grouped.unionByName(alone)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_key: list[str] | None = None) -> DataFrame:
    """One row per input row: id, ``n_shingles`` long, ``component_id`` long (the smallest id reachable by links).

    Null texts and texts without words have no shingle, link with nothing and are their own component. A row with a
    null id links as others do but is never a component's name; a component of null ids alone has a null name.
    Repeated rows are equal sets, so they share a component.

    With ``row_key``, long columns that tell rows apart, these and ``leads`` follow: true in the row of each component
    that has the smallest id (null ids last), of equals the smallest key, and in rows without a shingle."""
    keys = row_key or []
    docs = df.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"), *[F.col(c).cast("long").alias(f"row_{k}") for k, c in enumerate(keys)])
    more = docs.columns[2:]
    profiled = materialize(profile(docs), "jaccard-profile")
    roots = similar_sets(docs.select("doc", "text"), profiled)
    rows = profiled.where(F.col("n").isNotNull()).select("doc", "key", "n", *more)
    own = F.struct(F.col("doc").isNull().alias("last"), "doc", *more)
    classes = rows.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("doc").alias("first"), F.min(own).alias("lead"), F.count("*").alias("copies"))
    rooted = classes.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    rooted = materialize(rooted, "jaccard-roots")
    names = materialize(rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.min("lead").alias("lead"), F.count("*").alias("classes")), "jaccard-names")
    named = materialize(attach(rooted.drop("lead"), "root", names, "classes", rooted.count()).select("key", "copies", "component_id", "lead"), "jaccard-named")
    placed = attach(rows.where(F.col("key").isNotNull()), "key", named, "copies", rows.count()).withColumn("leads", own.eqNullSafe(F.col("lead")))
    alone = rows.where(F.col("key").isNull()).withColumns({"component_id": F.col("doc"), "leads": F.lit(True)})
    columns = ["doc", "n", "component_id", *more, "leads"]
    both = placed.select(*columns).unionByName(alone.select(*columns))
    out = both.select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), "component_id", *[F.col(f"row_{k}").alias(c) for k, c in enumerate(keys)], "leads")
    return out if keys else out.drop("leads")
