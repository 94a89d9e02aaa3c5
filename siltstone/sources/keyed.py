"""A table with one row for each key, changed by merging rows into it: buckets by hash, versions by manifest.

``folder``/data/<run>/bucket=<k> holds rows, ``folder``/versions/<n>.json says which folder each bucket is in. A merge looks
up the buckets of its own keys, reads those alone, writes them anew beside the old ones and claims the next version: a file
whose name only one of several writers gets. Who comes second sees what the first has changed. Buckets that both have
changed are merged again on top of the other's, all others are taken over, and the version after that is claimed, so no
saver undoes another. Readers see one version or the next, never a part of one.

The number of buckets is a power of two and grows with the rows, so a bucket stays small, and a merge costs what its own
keys' buckets hold. A merge that makes the buckets too full rewrites all of them once, into more.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.delta import insert_absent, upsert
from ..tables import discard, materialize
from .files import children, claim, exists, read_bytes, resolve

#: Rows of a bucket, on average, beyond which there are more buckets; and buckets at most.
MOST_ROWS, MOST_BUCKETS = 200_000, 1 << 14
#: Times that a merge is done again because others were faster.
TRIES = 20
KEEPS = {"first": insert_absent, "last": upsert}


@dataclass
class Version:
    number: int = 0
    buckets: int = 1
    #: For each bucket that has rows its folder and how many rows it has.
    places: dict[int, tuple[str, int]] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(n for _, n in self.places.values())


def name_of(number: int) -> str:
    return f"{number:012d}.json"


def newest(folder: str) -> Version:
    store, root = resolve(folder)
    found = [f.base_name for f in children(store, f"{root}/versions") if re.fullmatch(r"\d{12}\.json", f.base_name)]
    return read_version(folder, int(found[-1][:12])) if found else Version()


def read_version(folder: str, number: int) -> Version:
    store, root = resolve(folder)
    v = json.loads(read_bytes(store, f"{root}/versions/{name_of(number)}"))
    return Version(number, v["buckets"], {int(k): (run, n) for k, (run, n) in v["places"].items()})


def read_buckets(spark: SparkSession, folder: str, version: Version, schema: T.StructType, some: list[int] | None = None) -> DataFrame:
    paths = [f"{folder}/data/{run}/bucket={k}" for k, (run, _) in sorted(version.places.items()) if some is None or k in some]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def load(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The rows of the newest version; none if there is none."""
    return read_buckets(spark, folder, newest(folder), schema)


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def wanted_buckets(rows: int, now: int) -> int:
    n = now
    while n < MOST_BUCKETS and rows > n * MOST_ROWS:
        n *= 2
    return n


def write_buckets(merged: DataFrame, folder: str, key: str, buckets: int, schema: T.StructType) -> dict[int, tuple[str, int]]:
    """Rows by bucket in a folder of this run's own, and how many there are in each."""
    run, spark = uuid.uuid4().hex, merged.sparkSession
    placed = merged.select(*schema.fieldNames(), bucket_of(key, buckets).alias("bucket")).repartition("bucket")
    placed.write.partitionBy("bucket").parquet(f"{folder}/data/{run}")
    written = spark.read.schema(T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(f"{folder}/data/{run}")
    return {r["bucket"]: (run, r["n"]) for r in written.groupBy("bucket").agg(F.count("*").alias("n")).collect()}  # MOST_BUCKETS rows at most


def merge(new: DataFrame, folder: str, schema: T.StructType, key: str, keep: str) -> Version:
    """Merge rows, one for each key, into the store. ``keep``: 'first' leaves keys that are there alone, 'last' replaces them.

    Null keys are left out. Without rows nothing is written. Returns the version that has the rows."""
    spark = new.sparkSession
    new = materialize(new.where(F.col(key).isNotNull()).select(*schema.fieldNames()), "merged-rows")
    store, root = resolve(folder)
    store.create_dir(f"{root}/versions", recursive=True)
    places: dict[int, tuple[str, int]] = {}
    base = None  # the version on which ``places`` stand
    for _ in range(TRIES):
        now = newest(folder)
        counts = {r["b"]: r["n"] for r in new.groupBy(bucket_of(key, now.buckets).alias("b")).agg(F.count("*").alias("n")).collect()}  # a row for each bucket
        if not counts:
            return now
        buckets = wanted_buckets(now.rows + sum(counts.values()), now.buckets)
        if buckets != now.buckets:
            again, places = None, {}
        else:
            # what was merged before still holds where no one else has changed a bucket since
            if base is None or base.buckets != now.buckets:
                places = {}
            again = [k for k in counts if k not in places or base.places.get(k) != now.places.get(k)]
        if again is None or again:
            some = new if again is None else new.where(bucket_of(key, now.buckets).isin(again))
            merged = KEEPS[keep](read_buckets(spark, folder, now, schema, again), some, key)
            places = {**places, **write_buckets(merged, folder, key, buckets, schema)}
        base = now
        following = Version(now.number + 1, buckets, places if again is None else now.places | places)
        manifest = {"buckets": buckets, "places": {str(k): list(p) for k, p in following.places.items()}}
        if claim(store, f"{root}/versions/{name_of(following.number)}", manifest):
            return following
        if again is None:
            places, base = {}, None
    raise RuntimeError(f"{TRIES} times another writer was faster: {folder}")


def vacuum(spark: SparkSession, folder: str, keep: int = 3) -> int:
    """Delete all but the newest ``keep`` versions, and data that only these had; returns how many versions went.

    Data of runs that no version names are left alone, as a saver may be about to name them."""
    store, root = resolve(folder)
    numbers = [int(f.base_name[:12]) for f in children(store, f"{root}/versions") if re.fullmatch(r"\d{12}\.json", f.base_name)]
    old, kept = numbers[:-keep], numbers[-keep:]
    used = {(run, k) for n in kept for k, (run, _) in read_version(folder, n).places.items()}
    for n in old:
        for k, (run, _) in read_version(folder, n).places.items():
            if (run, k) not in used and exists(store, f"{root}/data/{run}/bucket={k}"):
                discard(spark, f"{folder}/data/{run}/bucket={k}")
        store.delete_file(f"{root}/versions/{name_of(n)}")
    return len(old)
