"""WARC archives written and read as a table of record chunks.

A payload larger than ``chunk_bytes`` is streamed: rows (record, chunk number, bytes) with the SHA-1 of the payload up
to and including the chunk, and the last chunk's digest is the payload's. Right after the scan, which has to hold a value
whole, payloads become chunk rows; from there on neither writer nor reader holds a whole record. Records are gzip members of their own, as archive tools expect. Records with a payload that
an earlier record (the smallest id) holds become revisits without a payload.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_SHARE, materialize, new_path
from .files import attempt_suffix, reading, writing
from .repeats import without

CHUNK = 1 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode("ascii")


def record_urn(record_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'record-{record_id}')}>"


CHUNK_ROWS = "row long, id long, url string, bytes long, n_chunks long, chunk_no long, data binary, sha1 string"


def chunk_rows(df: DataFrame, id_col: str, url_col: str, payload_col: str, chunk_bytes: int) -> DataFrame:
    """The payloads in chunks, at least one each; ``row`` tells records apart, ``sha1`` is that up to and including the chunk."""
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("n_chunks", F.greatest(F.lit(1), F.ceil(F.col("bytes") / chunk_bytes)).cast("long"))
    each = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_chunks") - 1)).alias("chunk_no"))
    data = F.substring(F.col("payload"), (F.col("chunk_no") * chunk_bytes + 1).cast("int"), F.lit(chunk_bytes)).alias("data")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha1 = hashlib.sha1()
        for batch in batches:  # chunks of a record follow each other
            running = []
            for k, chunk_no in enumerate(batch.column(5).to_pylist()):
                if chunk_no == 0:
                    sha1 = hashlib.sha1()
                sha1.update(batch.column(6)[k].as_buffer())
                running.append(base32(sha1.digest()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(running, pa.string())], names=[x.split()[0] for x in CHUNK_ROWS.split(", ")])

    return materialize(each.select("row", "id", "url", "bytes", "n_chunks", "chunk_no", data).mapInArrow(digests, CHUNK_ROWS), "warc-chunks")


def mark_revisits(rows: DataFrame, least_bytes: int) -> DataFrame:
    """rows(row, id, url, bytes, n_chunks, sha1) with refers_to: the smallest id with the same payload, null for that record itself."""
    groups = materialize(rows.where(F.col("bytes") >= least_bytes).groupBy("sha1").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1"), "warc-groups")
    total = rows.count()
    # only digests with several records are joined: the others keep refers_to null
    hot = F.col("n") >= max(2, int(total * HOT_SHARE))
    few = F.broadcast(groups.where(hot).select("sha1", F.col("first").alias("first_hot")))
    many = groups.where(~hot).select("sha1", F.col("first").alias("first_cold"))
    marked = rows.join(few, "sha1", "left")
    hot_rows = marked.where("first_hot IS NOT NULL").withColumnRenamed("first_hot", "first")
    others = marked.where("first_hot IS NULL").drop("first_hot").join(many, "sha1", "left").withColumnRenamed("first_cold", "first")
    both = hot_rows.unionByName(others)
    return both.select(*rows.columns, F.when(F.col("first") != F.col("id"), F.col("first")).alias("refers_to"))


def write_warc(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0, chunk_bytes: int = CHUNK, bytes_per_file: int = 64 << 20) -> DataFrame:
    """Write one record per row; returns the manifest (file, records), in Parquet written by Spark's commit protocol.

    Null payloads are empty payloads. Payloads of fewer than ``least_bytes`` bytes are never deduplicated. A null url
    is written as an empty one, and white space in a url as one blank, as a head has lines. Rows with a null id are
    responses and never referred to. Repeated ids write repeated records with one WARC-Record-ID, which names the row's
    id; of equal payloads, each record that has not the smallest id is a revisit. An empty table writes no file."""
    folder = new_path(df.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, done = 0, []
        out = opened = at = zipper = None
        records = 0
        for batch in batches:
            for k in range(batch.num_rows):
                record_id, url, n, n_chunks, chunk_no, sha1, refers_to = (batch.column(i)[k].as_py() for i in (1, 2, 3, 4, 5, 7, 8))
                if out is None:
                    at, records = f"{folder}/{attempt_suffix()}-{seq:05d}.warc.gz", 0
                    opened = writing(at)
                    out = opened.__enter__()
                    seq += 1
                if chunk_no < 0 or n_chunks == 1:
                    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
                    kind = "response" if refers_to is None else "revisit"
                    head = [
                        "WARC/1.1",
                        f"WARC-Type: {kind}",
                        f"WARC-Record-ID: {record_urn(record_id)}",
                        f"WARC-Target-URI: {' '.join((url or '').split())}",
                        f"WARC-Date: {DATE}",
                        f"WARC-Payload-Digest: sha1:{sha1}",
                        f"X-Row-Id: {'' if record_id is None else record_id}",
                        "Content-Type: application/http; msgtype=response",
                        f"Content-Length: {len(http) + (n if refers_to is None else 0)}",
                    ]
                    if refers_to is not None:
                        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_urn(refers_to)}", f"X-Refers-To-Row-Id: {refers_to}"]
                    zipper = zlib.compressobj(3, zlib.DEFLATED, 31)
                    out.write(zipper.compress("\r\n".join(head).encode() + b"\r\n\r\n" + http))
                out.write(zipper.compress(batch.column(6)[k].as_buffer()))
                if chunk_no < n_chunks - 1:
                    continue
                out.write(zipper.compress(b"\r\n\r\n") + zipper.flush())
                records += 1
                if out.tell() >= bytes_per_file:
                    opened.__exit__(None, None, None)
                    done.append((at, records))
                    out = None
        if out is not None:
            opened.__exit__(None, None, None)
            done.append((at, records))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64())], names=["file", "records"])

    chunks = chunk_rows(df, id_col, url_col, payload_col, chunk_bytes)
    marked = mark_revisits(chunks.where("chunk_no = n_chunks - 1").select("row", "id", "url", "bytes", "n_chunks", "sha1"), least_bytes)
    marked = materialize(marked, "warc-records")
    columns = [*chunks.columns, "refers_to"]
    none = F.lit(None).cast("long").alias("refers_to")
    again = marked.where("refers_to IS NOT NULL")
    # revisits need no payload; records of one chunk are not shuffled; those of several are led by a row with the digest
    revisits = again.withColumns({"n_chunks": F.lit(1).cast("long"), "chunk_no": F.lit(0).cast("long"), "data": F.lit(b"")}).select(*columns)
    small = without(chunks.where("n_chunks = 1"), ["row"], again.where("n_chunks = 1").select("row")).select("*", none)
    leads = marked.where("refers_to IS NULL AND n_chunks > 1").withColumns({"chunk_no": F.lit(-1).cast("long"), "data": F.lit(b"")}).select(*columns)
    large = chunks.where("n_chunks > 1").join(again.where("n_chunks > 1").select("row"), "row", "left_anti").select("*", none)
    large = large.select(*columns).unionByName(leads).repartition(F.col("row")).sortWithinPartitions("row", "chunk_no")
    rows = small.select(*columns).unionByName(revisits).unionByName(large)
    return materialize(rows.mapInArrow(write, "file string, records long"), "warc-manifest")


#: Bytes of a record's head at most; addresses are the longest part.
MOST_HEAD = 1 << 24


class GzipText:
    """Bytes of a file of gzip members, a bounded piece at a time."""

    def __init__(self, raw, step: int = 1 << 18):
        self.raw, self.step, self.held, self.zipped = raw, step, b"", b""
        self.unzip = zlib.decompressobj(31)

    def more(self) -> bool:
        if not self.zipped:
            self.zipped = self.raw.read(self.step)
            if not self.zipped:
                return False
        if self.unzip.eof:
            self.unzip = zlib.decompressobj(31)
        self.held += self.unzip.decompress(self.zipped, self.step)
        self.zipped = self.unzip.unused_data if self.unzip.eof else self.unzip.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes | None:
        """What stands before the mark, which has to come within MOST_HEAD bytes; None at the end of the file."""
        seen = 0
        while (at := self.held.find(mark, max(0, seen - len(mark) + 1))) < 0:
            seen = len(self.held)
            if seen > MOST_HEAD:
                raise ValueError("not a record's head")
            if not self.more():
                return None
        got, self.held = self.held[:at], self.held[at + len(mark) :]
        return got

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self.more():
            pass
        if len(self.held) < n:
            raise ValueError("the archive ends inside a record")
        got, self.held = self.held[:n], self.held[n:]
        return got


def fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


CHUNK_SCHEMA = "record_id long, record_type string, refers_to long, url string, payload_bytes long, payload_digest string, chunk_no long, n_chunks long, data binary, running_digest string"


def read_warc(manifest: DataFrame, chunk_bytes: int = CHUNK) -> DataFrame:
    """The chunk table of all archives: a row for each chunk, chunk 0 also for empty payloads and revisits.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload (for a revisit, of the record it refers to);
    ``running_digest`` is the SHA-1 of the payload up to and including the chunk. A stored payload that does not match
    its record's digest fails the task. Repeated and null ids come back as they were written; an empty manifest gives no
    row. A record's head is read up to 16 MB: a longer address is written, but its record cannot be read back."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def pack() -> pa.RecordBatch:
            nonlocal held, size
            cols = list(zip(*held, strict=True))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
            held, size = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in CHUNK_SCHEMA.split(", ")])

        for batch in batches:
            for at in batch.column(0).to_pylist():
                with reading(at) as raw:
                    text = GzipText(raw)
                    while (head := text.until(b"\r\n\r\n")) is not None:
                        warc = fields(head)
                        http_head = text.until(b"\r\n\r\n") or b""
                        http = fields(http_head)
                        left = int(warc["content-length"]) - len(http_head) - 4
                        n, kind = int(http["content-length"]), warc["warc-type"]
                        digest = warc["warc-payload-digest"].removeprefix("sha1:")
                        record = int(warc["x-row-id"]) if warc["x-row-id"] else None
                        refers = int(warc["x-refers-to-row-id"]) if "x-refers-to-row-id" in warc else None
                        sha1, chunks = hashlib.sha1(), max(1, -(-left // chunk_bytes))
                        for k in range(chunks):
                            data = text.take(min(chunk_bytes, left))
                            left -= len(data)
                            sha1.update(data)
                            running = base32(sha1.digest())
                            if k == chunks - 1 and kind == "response" and running != digest:
                                raise ValueError(f"digest of record {record} in {at}: {running}, not {digest}")
                            held.append((record, kind, refers, warc["warc-target-uri"], n, digest, k, chunks, data, running))
                            size += len(data) + 200
                            if size >= 4 << 20:
                                yield pack()
                        if text.take(4) != b"\r\n\r\n":
                            raise ValueError(f"record {record} in {at} does not end where its length says")
        if held:
            yield pack()

    spark = manifest.sparkSession
    n = max(1, manifest.count())
    return manifest.select("file").repartition(min(n, 8 * spark.sparkContext.defaultParallelism) if n < 10_000 else n // 20).mapInArrow(read, CHUNK_SCHEMA)
