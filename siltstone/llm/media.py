"""Media columns: payloads stored as chunks whose borders the content itself defines.

A payload becomes a medium (8-bit mono PCM in a WAV container). A rolling gear hash cuts its bytes into chunks, so an
inserted byte changes the chunks around it and no others. Chunk digests are counted by a Spark join: chunks that occur
more than once are stored once in a shared table, all others stand in their medium's own row. The ordered chunk list of
a medium rebuilds its bytes, which are checked against the SHA-256 of the medium.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, materialize
from .repeats import KeyFilter

FRAME = 192
RATE = 8000
HEADER = 44
#: A chunk has at least LEAST and at most MOST bytes, about 1 << MASK_BITS more than LEAST on average.
LEAST, MASK_BITS, MOST = 1024, 12, 32768
WINDOW = 32
GEAR = np.array([int.from_bytes(hashlib.sha256(bytes([b])).digest()[:4], "little") for b in range(256)], np.uint32)


def payload_of(text: str | None) -> tuple[bytes, int]:
    """UTF-8 with spaces up to a positive multiple of FRAME, and the length without them."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b" " * (-len(raw) % FRAME if raw else FRAME), len(raw)


def to_wav(samples: bytes) -> bytes:
    n = len(samples)
    head = b"RIFF" + (HEADER - 8 + n + n % 2).to_bytes(4, "little") + b"WAVEfmt " + (16).to_bytes(4, "little") + (1).to_bytes(2, "little") + (1).to_bytes(2, "little") + RATE.to_bytes(4, "little") * 2 + (1).to_bytes(2, "little") + (8).to_bytes(2, "little")
    return head + b"data" + n.to_bytes(4, "little") + samples + b"\0" * (n % 2)


def from_wav(medium: bytes) -> bytes:
    if medium[:4] != b"RIFF" or medium[8:16] != b"WAVEfmt " or medium[36:40] != b"data":
        raise ValueError("not a WAV file as written here")
    return medium[HEADER : HEADER + int.from_bytes(medium[40:44], "little")]


def gear_cuts(data: bytes) -> list[int]:
    """Ends of the chunks. The gear hash of the last WINDOW bytes is built by doubling: numpy handles all places at once."""
    n = len(data)
    if n <= LEAST:
        return [n]
    cuts, begin = [], 0
    found: list[np.ndarray] = []
    step = 1 << 20
    raw = np.frombuffer(data, np.uint8)
    for a in range(0, n, step):
        lo = max(0, a - WINDOW)
        h = GEAR[raw[lo : a + step]]
        width = 1
        while width < WINDOW:
            h[width:] += h[:-width] << np.uint32(width)
            width *= 2
        at = np.flatnonzero(h >> np.uint32(32 - MASK_BITS) == 0) + lo + 1
        found.append(at[at > a])
    marks = np.concatenate(found)
    while n - begin > LEAST:
        k = int(np.searchsorted(marks, begin + LEAST))
        end = min(int(marks[k]) if k < len(marks) else n, begin + MOST, n)
        cuts.append(end)
        begin = end
    if begin < n:
        cuts.append(n)
    return cuts


def digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def chunks_of(text: str | None) -> tuple[list[bytes], bytes, int]:
    payload, n = payload_of(text)
    medium = to_wav(payload)
    cuts = gear_cuts(medium)
    return [medium[a:b] for a, b in zip([0, *cuts], cuts, strict=False)], medium, n


def key_of(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(x[:8] for x in digests), "<i8")


def feature(samples: bytes, n_chunks: int) -> str:
    """Counts and moments of the samples read back, all from exact integers."""
    x = np.frombuffer(samples, np.uint8)
    total, square = int(x.sum(dtype=np.int64)), int(np.dot(x.astype(np.float64), x.astype(np.float64)))
    crossings = int(np.count_nonzero((x[1:] >= 128) != (x[:-1] >= 128)))
    return f"samples={len(x)};sum={total};squares={square};min={int(x.min())};max={int(x.max())};crossings={crossings};chunks={n_chunks}"


def store_media(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Write the media. Returns (media table, shared chunk table).

    media(id, n_bytes, media_sha256, digests array, own array): ``own`` holds the bytes of each chunk, null where the
    shared table (digest, data) has them. A null text is an empty text, whose medium is one block of spaces; a null id stays
    null; repeated rows are repeated media; very long texts are stored whole; an empty table gives empty tables."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                found = [digest(c) for t in batch.column(0).slice(i, 1024).to_pylist() for c in chunks_of(t)[0]]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["digest"])

    counted = rows.select("text").mapInArrow(digests, "digest binary").groupBy("digest").agg(F.count("*").alias("n")).where("n > 1")
    counted = materialize(counted, "chunk-counts")

    @F.pandas_udf("long")
    def as_key(d):
        return pd.Series(key_of(list(d)))

    # a filter tells which chunks may occur again; a chunk it is wrong about is shared by one medium only
    maybe = df.sparkSession.sparkContext.broadcast(KeyFilter.build(counted.select(as_key("digest").alias("key"))))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Media, and beside the first medium of a batch that has it each chunk that may occur again."""
        chunk = pa.struct([("digest", pa.binary()), ("data", pa.binary())])
        names = ["id", "n_bytes", "media_sha256", "digests", "own", "again"]
        for batch in batches:
            seen: set[bytes] = set()
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                n_bytes, sha, lists, own, again = [], [], [], [], []
                for text in part.column(1).to_pylist():
                    parts, medium, n = chunks_of(text)
                    found = [digest(c) for c in parts]
                    ok = maybe.value.passes(key_of(found)).tolist()
                    new = {d: c for c, d, k in zip(parts, found, ok, strict=True) if k and d not in seen}
                    seen.update(new)
                    n_bytes.append(n)
                    sha.append(hashlib.sha256(medium).hexdigest())
                    lists.append(found)
                    own.append([None if k else c for c, k in zip(parts, ok, strict=True)])
                    again.append([{"digest": d, "data": c} for d, c in new.items()])
                kinds = (pa.int64(), pa.string(), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.list_(chunk))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip((n_bytes, sha, lists, own, again), kinds, strict=True))], names=names)

    packed = materialize(rows.mapInArrow(pack, "id long, n_bytes long, media_sha256 string, digests array<binary>, own array<binary>, again array<struct<digest:binary,data:binary>>"), "media")
    shared = packed.select(F.explode("again").alias("c")).groupBy("c.digest").agg(F.first("c.data").alias("data"))
    shared, media = materialize(shared, "shared-chunks"), packed.drop("again")
    return media.withColumnRenamed("id", id_col), shared


def read_media(media: DataFrame, shared: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rebuild each medium from its chunk list, check it, and describe its payload. A wrong byte fails the task.

    One row for each row of ``media``: null ids and repeated rows come back as they are, media of equal content are rebuilt
    once, and empty tables give no row."""
    # media with shared chunks are told apart by what they hold: equal lists need one and the same rebuilding
    lacking = F.exists("own", lambda x: x.isNull())
    whole = media.where(~lacking).select(id_col, "n_bytes", "media_sha256", "digests", "own", F.lit(None).cast("array<struct<at:int,data:binary>>").alias("fetched"))
    wants = media.where(lacking)
    kinds = wants.groupBy("media_sha256").agg(F.first("digests").alias("digests"), F.first("own").alias("own"), F.count("*").alias("copies"))
    kinds = materialize(kinds, "media-kinds")
    refs = kinds.select("media_sha256", F.posexplode("digests").alias("at", "digest"), "own").where(F.col("own")[F.col("at")].isNull()).select("media_sha256", "at", "digest")
    uses = refs.groupBy("digest").agg(F.count("*").alias("uses"))
    chunks = shared.join(uses, "digest")
    fetched = attach(refs, "digest", chunks, "uses", refs.count()).groupBy("media_sha256").agg(F.collect_list(F.struct("at", "data")).alias("fetched"))
    rebuilt = kinds.join(fetched, "media_sha256")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                rows = []
                for sha, names, own, more in zip(*(part.column(k).to_pylist() for k in (1, 2, 3, 4)), strict=True):
                    parts = list(own)
                    for x in more or []:
                        parts[x["at"]] = x["data"]
                    if any(digest(c) != d for c, d in zip(parts, names, strict=True)):
                        raise ValueError(f"a chunk of medium {sha} is not what its digest says")
                    medium = b"".join(parts)
                    if hashlib.sha256(medium).hexdigest() != sha:
                        raise ValueError(f"medium {sha} is not what was stored")
                    samples = from_wav(medium)
                    rows.append((len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-16:]), len(medium), sha, feature(samples, len(parts))))
                cols = list(zip(*rows, strict=True))
                types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=["key", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    schema = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    columns = [id_col, "n_bytes", *(x.split()[0] for x in schema.split(", "))]
    id_kind = whole.schema[id_col].dataType.simpleString()
    key = F.struct(F.col(id_col).alias("id"), "n_bytes").alias("key")
    alone = whole.select(key, "media_sha256", "digests", "own", "fetched").mapInArrow(describe, f"key struct<id:{id_kind},n_bytes:bigint>, {schema}")
    alone = alone.select(F.col("key.id").alias(id_col), F.col("key.n_bytes").alias("n_bytes"), *columns[2:])
    described = rebuilt.select("copies", "media_sha256", "digests", "own", "fetched").mapInArrow(describe, f"key long, {schema}").withColumnRenamed("key", "copies")
    described = materialize(described, "media-described")
    copies = attach(wants.select(id_col, "n_bytes", "media_sha256"), "media_sha256", described, "copies", wants.count())
    return alone.unionByName(copies.select(*columns))
