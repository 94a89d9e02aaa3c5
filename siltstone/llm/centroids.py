"""Centroid clustering (Lloyd's rounds on integer vectors) with heap-ordered bounds.

Vectors lie in blocks, one row of a table for each block, and never leave them. For each cluster a block keeps a heap of its
vectors by gap: the distance to the second nearest centroid less that to the nearest, raised by the drift that the cluster
had accumulated when the gap was measured. A round adds to a cluster's drift how far its own centroid has moved and the
farthest that any other has. While a heap's top is above the drift, no vector below it can have got another nearest
centroid; only vectors at or under it are popped, measured against all centroids and pushed again. A block reports what
moved between clusters as sums, so new centroids are exact integers and need no pass over the vectors.

A round is one narrow job that writes the next table of blocks; of the reports the driver gets one sum for each component of
each centroid.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, discard, written

#: Vectors of a block.
BLOCK_ROWS = 4096
#: Components are held between -LARGEST and LARGEST, so that squared distances of up to 256 components fit a long.
LARGEST = 1 << 26
#: Components that are this small at most are multiplied in floating point, without rounding.
EXACT = 1 << 21
#: Relative error that square roots and sums of bounds may have; vectors within it are measured again.
SLACK = 1e-9
LONGEST = (1 << 63) - 1

BLOCK = "ids binary, null_ids binary, vectors binary, clusters binary, keys binary, members binary, sizes array<int>"
REPORT = "moved array<struct<cluster: int, n: long, sums: array<long>>>, spread array<struct<cluster: int, total: decimal(38,0)>>, scanned long"


def whole(df: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    """(vec_id, v array of long): floor(scale * x) of vectors with ``dim`` components, none null or not finite."""
    v = F.transform(F.col(vector_col), lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(float(-LARGEST))), F.lit(float(LARGEST)))))
    good = (F.size(vector_col) == dim) & F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return df.select(F.col(id_col).cast("long").alias("vec_id"), F.when(good, v).alias("v")).where("v IS NOT NULL")


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """Those of the ``k`` vectors with the smallest SHA-256 of ``seed:id``, in the order of hashes; of equal ids the smaller vector first."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    return [list(r["v"]) for r in vectors.select(F.sha2(name.cast("binary"), 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()]


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, int64."""
    if max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0)) <= EXACT // 4:
        a, b = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]).astype(np.int64)
    return np.stack([((vectors - c) ** 2).sum(axis=1) for c in centroids], axis=1)


class Block:
    """Vectors with their clusters and the heaps of their gaps."""

    def __init__(self, row: dict, dim: int, k: int):
        n = len(row["ids"]) // 8
        self.ids = [None if null else i for i, null in zip(np.frombuffer(row["ids"], "<i8").tolist(), np.unpackbits(np.frombuffer(row["null_ids"], np.uint8), count=n).tolist(), strict=True)]
        self.vectors = np.frombuffer(row["vectors"], f"<i{len(row['vectors']) // (n * dim)}").reshape(n, dim)
        self.clusters = np.frombuffer(row["clusters"], "<i4").copy()
        pairs = zip(np.frombuffer(row["keys"], "<f8").tolist(), np.frombuffer(row["members"], "<i4").tolist(), strict=True)
        self.heaps = [[next(pairs) for _ in range(m)] for m in row["sizes"]] or [[] for _ in range(k)]

    def expired(self, drift: list[float]) -> list[int]:
        """Vectors whose gap the drift has used up; they leave their heaps."""
        out = []
        for heap, limit in zip(self.heaps, drift, strict=True):
            while heap and heap[0][0] <= limit:
                out.append(heapq.heappop(heap)[1])
        return out

    def scan(self, some: np.ndarray, centroids: np.ndarray, drift: list[float]) -> None:
        """Measure vectors against all centroids and push them on the heaps of their nearest ones, the first of equals."""
        d = distances(self.vectors[some].astype(np.int64), centroids)
        near = d.argmin(axis=1)
        self.clusters[some] = near
        root = np.sqrt(d.astype(np.float64))
        own = root[np.arange(len(some)), near]
        root[np.arange(len(some)), near] = np.inf
        other = root.min(axis=1)  # infinite where there is one centroid
        gap = other - own - SLACK * (1 + own + np.where(np.isinf(other), 0, other))
        for i, c, g in zip(some.tolist(), near.tolist(), gap.tolist(), strict=True):
            heapq.heappush(self.heaps[c], (g + drift[c], i))

    def own_distances(self, centroids: np.ndarray) -> np.ndarray:
        return ((self.vectors.astype(np.int64) - centroids[self.clusters]) ** 2).sum(axis=1)

    def state(self) -> dict:
        flat = [x for h in self.heaps for x in h]
        keys, members = np.array([x[0] for x in flat], "<f8"), np.array([x[1] for x in flat], "<i4")
        return {"clusters": self.clusters.tobytes(), "keys": keys.tobytes(), "members": members.tobytes(), "sizes": [len(h) for h in self.heaps]}


def narrow(v: np.ndarray) -> bytes:
    """In the smallest integers that hold all of them."""
    low, high = v.min(initial=0), v.max(initial=0)
    return v.astype(next(t for t in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)).tobytes()


def blocks_of(vectors: DataFrame, dim: int) -> DataFrame:
    """Blocks of a partition's vectors in the order in which they come; nothing is measured yet."""
    kind = arrow_schema(BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(i, BLOCK_ROWS)
                ids = part.column(0)
                v = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                row = {"ids": ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(), "null_ids": np.packbits(ids.is_null().to_numpy(zero_copy_only=False)).tobytes()}
                row |= {"vectors": narrow(v), "clusters": np.full(len(v), -1, "<i4").tobytes(), "keys": b"", "members": b"", "sizes": []}
                yield pa.RecordBatch.from_pylist([row], schema=kind)

    return vectors.mapInArrow(run, BLOCK)


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T._parse_datatype_string(ddl))


def each_block(blocks: DataFrame, work: Callable[[dict], list[dict]], schema: str) -> DataFrame:
    kind = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield pa.RecordBatch.from_pylist(work(batch.slice(i, 1).to_pylist()[0]), schema=kind)

    return blocks.mapInArrow(run, schema)


def one_round(blocks: DataFrame, centroids: list[list[int]], drift: list[float], last: bool) -> DataFrame:
    """The next table of blocks, with their reports; ``last`` adds each cluster's distances as they are then."""
    k, dim, points = len(centroids), len(centroids[0]), np.array(centroids, np.int64)

    def work(row: dict) -> list[dict]:
        block = Block(row, dim, k)
        before = block.clusters.copy()
        some = np.array(block.expired(drift) if row["sizes"] else range(len(before)), np.int64)
        if len(some):
            block.scan(some, points, drift)
        now = block.clusters
        changed = np.flatnonzero(before != now)
        moved = []
        for c in np.union1d(before[changed], now[changed]).tolist():
            come, gone = changed[now[changed] == c], changed[before[changed] == c]
            if c >= 0:
                sums = block.vectors[come].sum(axis=0, dtype=np.int64) - block.vectors[gone].sum(axis=0, dtype=np.int64)
                moved.append({"cluster": c, "n": len(come) - len(gone), "sums": sums.tolist()})
        spread = []
        if last:
            d = block.own_distances(points)
            spread = [{"cluster": c, "total": Decimal(sum(d[now == c].tolist()))} for c in np.unique(now).tolist()]
        return [{x: row[x] for x in ("ids", "null_ids", "vectors")} | block.state() | {"moved": moved, "spread": spread, "scanned": len(some)}]

    return each_block(blocks, work, f"{BLOCK}, {REPORT}")


def moved_center(total: list[int], n: int, old: list[int]) -> list[int]:
    return [s // n for s in total] if n else old


def cluster_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 16, dim: int = 64, scale: int = 64, rounds: int = 3, seed: int = 1) -> DataFrame:
    """One row per vector that counts: id, ``cluster`` int, ``distance`` long, ``cluster_inertia`` long, ``inertia`` long, ``centroid_sha256``.

    Vectors of ``dim`` components, none null or not finite, count, each component x as floor(``scale`` * x); others give no
    row. The centroids begin as the ``k`` vectors (fewer if there are fewer) that ``first_centroids`` names; in each round
    all vectors go to the nearest one by squared distance, of several to the first, and each centroid that has vectors
    becomes the floor of their mean in each component. At the end vectors are assigned once more.

    Null ids stay null and count as empty when centroids are named; repeated rows are vectors of their own; equal centroids
    are allowed, and the later one stays empty; an empty table gives no row. Components beyond 2**26 count as 2**26, so that
    a distance fits a long; sums that don't are given as the largest long. At most 256 components."""
    if dim > 256:
        raise ValueError("at most 256 components")
    spark = df.sparkSession
    bound_batches(spark)
    result = f"{id_col} long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    vectors = whole(df, id_col, vector_col, dim, scale)
    centroids = first_centroids(vectors, k, seed)
    if not centroids:
        return spark.createDataFrame([], result)
    k = len(centroids)
    sums, sizes, drift = [[0] * dim for _ in range(k)], [0] * k, [0.0] * k
    blocks, path = written(blocks_of(vectors, dim), "vectors")
    for r in range(rounds + 1):
        following, new_path = written(one_round(blocks, centroids, drift, r == rounds), "vectors")
        discard(spark, path)
        blocks, path = following, new_path
        if r == rounds:
            break
        change = blocks.select(F.explode("moved").alias("m")).select("m.cluster", "m.n", F.posexplode("m.sums").alias("at", "x"))
        for c, at, n, x in change.groupBy("cluster", "at").agg(F.sum("n"), F.sum(F.col("x").cast("decimal(38,0)"))).collect():  # k * dim rows
            sums[c][at] += int(x)
            sizes[c] += n if at == 0 else 0
        old, centroids = centroids, [moved_center(s, n, c) for s, n, c in zip(sums, sizes, centroids, strict=True)]
        way = [float(np.sqrt(float(sum((a - b) ** 2 for a, b in zip(x, y, strict=True))))) for x, y in zip(old, centroids, strict=True)]
        farthest = sorted(range(k), key=lambda c: -way[c])[:2]
        drift = [d + (1 + SLACK) * (way[c] + max([way[j] for j in farthest if j != c], default=0.0)) for c, d in enumerate(drift)]
    spread = {r["cluster"]: int(r["total"]) for r in blocks.select(F.explode("spread").alias("s")).select("s.*").groupBy("cluster").agg(F.sum("total").alias("total")).collect()}
    inertia = min(sum(spread.values()), LONGEST)
    named = [(c, min(spread.get(c, 0), LONGEST), inertia, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c in range(k)]
    points = np.array(centroids, np.int64)

    def rows(row: dict) -> list[dict]:
        block = Block(row, dim, k)
        return [{"id": i, "cluster": c, "distance": d} for i, c, d in zip(block.ids, block.clusters.tolist(), block.own_distances(points).tolist(), strict=True)]

    found = each_block(blocks.select(*[x.split(" ")[0] for x in BLOCK.split(", ")]), rows, "id long, cluster int, distance long")
    return found.join(F.broadcast(spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
