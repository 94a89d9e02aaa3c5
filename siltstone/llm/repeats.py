"""Items (64-bit hashes) that several owners have, found with one shuffle and no hot group."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import mix, trim

#: Items of a row at most, so that the rows follow the items and not the number of partitions.
PACKED = 4
SCHEMA = "item long, owner long, known boolean, packed binary"


def pack(owners: np.ndarray, items: np.ndarray, most: int = PACKED) -> tuple[np.ndarray, list[bytes]]:
    """Each owner with its items as little-endian 64-bit integers; an owner of more than ``most`` items comes again."""
    order = np.argsort(owners, kind="stable")
    owners, items = owners[order], items[order].astype("<i8")
    new = np.ones(len(owners), bool)
    new[1:] = owners[1:] != owners[:-1]
    begin = np.flatnonzero(new)
    nth = np.arange(len(owners)) - begin[np.cumsum(new) - 1]
    first = np.flatnonzero(nth % most == 0)
    raw, cut = items.tobytes(), [*(first * 8).tolist(), len(items) * 8]
    return owners[first], [raw[a:b] for a, b in zip(cut, cut[1:], strict=False)]


def distinct_pairs(items: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs in the order of items, each once, and where a new item begins."""
    order = np.lexsort((owners, items))
    items, owners = items[order], owners[order]
    new_item = np.ones(len(items), bool)
    new_item[1:] = items[1:] != items[:-1]
    keep = new_item.copy()
    keep[1:] |= owners[1:] != owners[:-1]
    return items[keep], owners[keep], new_item[keep]


def rows(item: np.ndarray, owner: np.ndarray, known: bool, packed: list[bytes] | None) -> pa.RecordBatch:
    n = len(owner)
    blob = pa.nulls(n, pa.binary()) if packed is None else pa.array(packed, pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(owner, pa.int64()), pa.array(np.full(n, known)), blob], names=["item", "owner", "known", "packed"])


def repeated_items(df: DataFrame, extract: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]]) -> DataFrame:
    """(owner long, packed binary): the items of an owner that another owner has too; several rows may share an owner.

    ``extract`` yields (items int64, owners int64) of a batch. Before the shuffle each batch settles the items that
    several of its owners have: all these owners learn it at once and one row informs the rest of the world, so an item
    that a third of all owners has costs one row a batch, not one an owner."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(extract(batch))
            if not found:
                continue
            items, owners, new = distinct_pairs(np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]))
            del found
            if not len(items):
                continue
            group = np.cumsum(new) - 1
            many = np.bincount(group)[group] > 1
            single = ~many
            for a in range(0, len(items), 500_000):
                s = single[a : a + 500_000]
                yield rows(items[a : a + 500_000][s], owners[a : a + 500_000][s], False, None)
            first = many & new
            if first.any():
                yield rows(items[first], owners[first], True, None)
                who, packed = pack(owners[many], items[many], 1 << 30)
                yield rows(mix(who.view(np.uint64)).view(np.int64), who, True, packed)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in the order of items. Of the item that a batch ends with one row is carried into the next: its owner
        while there is only one, and then that it has several, so that a common item is never held."""
        carry = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))
        for batch in batches:
            direct = batch.column(3).is_valid().to_numpy(zero_copy_only=False)
            if direct.any():
                mask = pa.array(direct)
                yield pa.RecordBatch.from_arrays([batch.column(1).filter(mask), batch.column(3).filter(mask)], names=["owner", "packed"])
            own = tuple(batch.column(k).to_numpy(zero_copy_only=False)[~direct] for k in (0, 1, 2))
            items, owners, known = (np.concatenate([c, o]) for c, o in zip(carry, own, strict=True))
            known = known.astype(bool)
            if not len(items):
                continue
            new = np.ones(len(items), bool)
            new[1:] = items[1:] != items[:-1]
            start = np.flatnonzero(new)
            several = (np.minimum.reduceat(owners, start) != np.maximum.reduceat(owners, start)) | np.logical_or.reduceat(known, start)
            tell = several[np.cumsum(new) - 1] & ~known
            if tell.any():
                who, packed = pack(owners[tell], items[tell])
                for a in range(0, len(who), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(who[a : a + 100_000], pa.int64()), pa.array(packed[a : a + 100_000], pa.binary())], names=["owner", "packed"])
            carry = (items[-1:], owners[-1:], several[-1:])
        trim()

    return df.mapInArrow(spread, SCHEMA).repartition(F.col("item")).sortWithinPartitions("item").mapInArrow(settle, "owner long, packed binary")


class KeyFilter:
    """A Bloom filter: passes all keys it was built from, and few others.

    Its size follows the number of keys, BITS_PER_KEY for each, up to MOST_BITS (16 MB). Beyond what fits it is no filter
    any more: ``bitmap`` is None and all keys pass, so that whoever uses it joins all rows. Results never depend on it."""

    LEAST_BITS, MOST_BITS, BITS_PER_KEY, HASHES = 20, 27, 8, 3
    BLOCK = 17

    def __init__(self, bitmap: np.ndarray | None, bits: int = LEAST_BITS):
        self.bitmap, self.bits = bitmap, bits

    @classmethod
    def places(cls, keys: np.ndarray, bits: int) -> np.ndarray:
        """(hash, key): where the bits of each key are."""
        h = mix(np.ascontiguousarray(keys).view(np.uint64))
        step = mix(h ^ np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        return np.stack([((h + np.uint64(k) * step) >> np.uint64(64 - bits)).astype(np.int64) for k in range(cls.HASHES)])

    def passes(self, keys: np.ndarray) -> np.ndarray:
        if self.bitmap is None:
            return np.ones(len(keys), bool)
        at = self.places(keys, self.bits)
        return ((self.bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1).all(axis=0)

    @classmethod
    def build(cls, keys: DataFrame) -> KeyFilter:
        """From a DataFrame with one long column, which is read twice. Places are deduplicated before they meet by block of bits."""
        n = keys.agg(F.approx_count_distinct(keys.columns[0], 0.05)).first()[0]
        bits = max(cls.LEAST_BITS, int(1.2 * n * cls.BITS_PER_KEY).bit_length())
        if bits > cls.MOST_BITS:
            return cls(None)

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = np.unique(cls.places(np.unique(batch.column(0).drop_null().to_numpy()), bits))
                yield pa.RecordBatch.from_arrays([pa.array(at >> cls.BLOCK, pa.int64()), pa.array(at, pa.int64())], names=["block", "at"])

        def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks: dict[int, np.ndarray] = {}
            for batch in batches:
                block, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                for b in np.unique(block).tolist():
                    inside = at[block == b] & ((1 << cls.BLOCK) - 1)
                    own = blocks.setdefault(b, np.zeros(1 << (cls.BLOCK - 3), np.uint8))
                    np.bitwise_or.at(own, inside >> 3, np.left_shift(1, inside & 7).astype(np.uint8))
            if blocks:
                yield pa.RecordBatch.from_arrays([pa.array(list(blocks), pa.int64()), pa.array([x.tobytes() for x in blocks.values()], pa.binary())], names=["block", "bits"])

        found = keys.mapInArrow(spread, "block long, at long").distinct().repartition(F.col("block")).mapInArrow(collect, "block long, bits binary").collect()
        bitmap = np.zeros(1 << (bits - 3), np.uint8)
        for r in found:  # 2 ** (MOST_BITS - BLOCK) blocks at most
            a = r["block"] << (cls.BLOCK - 3)
            bitmap[a : a + (1 << (cls.BLOCK - 3))] |= np.frombuffer(r["bits"], np.uint8)
        return cls(bitmap, bits)


def split_by_filter(
    df: DataFrame, id_col: str, keys: KeyFilter, then: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None, schema: str = ""
) -> tuple[DataFrame, DataFrame]:
    """(rows whose id may be among the keys, rows whose id is not); a null id is not. All columns pass through.

    ``then`` makes rows of ``schema`` of the second half, in the same worker: a ``mapInArrow`` after this one would be a second
    process for each task.
    Without a filter (there were too many keys for one) the first half is all rows with an id, and no Python is run."""
    if keys.bitmap is None:
        clear = df.where(F.col(id_col).isNull())
        return df.where(F.col(id_col).isNotNull()), clear.mapInArrow(then, schema) if then else clear
    shared = df.sparkSession.sparkContext.broadcast(keys)
    at = df.columns.index(id_col)

    def side(through: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(at)
                ok = shared.value.passes(ids.fill_null(0).cast(pa.int64()).to_numpy(zero_copy_only=False)) & ids.is_valid().to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array(ok == through))

        if then and not through:
            return df.mapInArrow(lambda batches: then(run(batches)), schema)
        return df.mapInArrow(run, df.schema)

    return side(True), side(False)


def without(df: DataFrame, keys: list[str], dropped: DataFrame) -> DataFrame:
    """Rows of ``df`` whose long ``keys`` are not together in ``dropped``. Rows with a null in the first key stay.

    Only rows that a filter of the first key cannot clear are shuffled for the exact anti-join."""
    gone = dropped.toDF(*keys).distinct()
    doubtful, clear = split_by_filter(df, keys[0], KeyFilter.build(dropped.toDF(*keys).select(keys[0])))
    return clear.unionByName(doubtful.join(gone, keys, "left_anti").select(*df.columns))


def once(df: DataFrame, keys: list[str], repeated: DataFrame, dropped: DataFrame) -> DataFrame:
    """``df`` (without a column ``again``) with one row for each of the long ``keys`` that ``repeated`` holds, and without the rows
    whose keys are in ``dropped``; all other rows stay. Rows of one key in ``repeated`` must be equal; only what one filter of
    both cannot clear is shuffled, and cut to one row before that."""
    found = repeated.select(*keys, F.lit(True).alias("again")).unionByName(dropped.select(*keys, F.lit(False).alias("again")))
    doubtful, clear = split_by_filter(df, keys[0], KeyFilter.build(found.select(keys[0])))
    wanted = found.groupBy(*keys).agg(F.min("again").alias("again"))  # what is dropped stays dropped
    marked = doubtful.join(wanted, keys, "left").select(*df.columns, "again")
    others = [c for c in df.columns if c not in keys]
    one = marked.where("again").groupBy(*keys).agg(F.first(F.struct(*others)).alias("row")).select(*[F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in df.columns])
    return clear.unionByName(marked.where("again IS NULL").drop("again")).unionByName(one)
