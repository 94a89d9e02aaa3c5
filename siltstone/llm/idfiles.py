"""Token-id files: ids by falling frequency in byte-aligned variable-length coding with separate control bytes.

Ids are replaced by their rank in the corpus (0 is the commonest), so that most need one byte. Four ranks share a
control byte (two bits each: bytes used less one); control bytes and data bytes are kept apart, so a table with 256
rows gives all lengths of four ranks at once and decoding is a few numpy gathers.

File: magic, then little-endian 64-bit counts (documents, control bytes, data bytes), then for each document its id
(64-bit), whether it is null (8-bit) and its number of ids (64-bit), then control bytes, then data bytes. Each document begins a new
control byte. A manifest and the table of ranks, in Parquet written by Spark's commit protocol, stand beside the files; only files that
the manifest names count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import default_path, forget_library, worker_library
from .common import bound_batches, materialize, new_path
from .files import attempt_suffix, reading, writing

MAGIC = b"RANKVB1\n"
CONTROL = np.arange(256, dtype=np.uint8)
#: Bytes of each of the four ranks of a control byte, and of all four.
LENGTHS = np.stack([((CONTROL >> (2 * k)) & 3) + 1 for k in range(4)], axis=1).astype(np.uint8)
TOTALS = LENGTHS.sum(axis=1).astype(np.int64)
HEADER = 8 + 3 * 8


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of one document; unused places of the last control byte count as one zero byte each."""
    n = -(-len(ranks) // 4) * 4
    full = np.zeros(n, "<u4")
    full[: len(ranks)] = ranks
    size = 1 + (full > 0xFF).astype(np.uint8) + (full > 0xFFFF) + (full > 0xFFFFFF)
    control = ((size.reshape(-1, 4) - 1) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    used = np.arange(4) < size[:, None]
    return control.tobytes(), full.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_ranks(control: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Ranks of any number of documents in a row, with the unused places of their last control bytes."""
    size = LENGTHS[control].reshape(-1)
    at = np.zeros(len(size), np.int64)
    np.cumsum(size[:-1], out=at[1:])
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    out = padded[at].astype(np.uint32)
    for k in range(1, 4):
        more = size > k
        out[more] |= padded[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def encoded_rows(batches: Iterator[pa.RecordBatch], path: str, end_id: int, kind: str) -> Iterator[pa.RecordBatch]:
    """Rows of ids, and at the end of the task one row that says how often each id occurred.

    The worker's table of words stays for its next task: most words are new to a table that begins with the task, but not to
    the worker. ``forget_library`` gives its memory back when the next stage begins."""
    columns = ["id", "ids", "counts"]
    end = end_id.to_bytes(np.dtype(kind).itemsize, "little")
    library, total = worker_library(path), np.zeros(end_id + 1, np.int64)
    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            part = batch.slice(i, 512)
            ids = [x + end for x in library.encode(part.column(1).to_pylist(), kind)]
            found = np.bincount(np.frombuffer(b"".join(ids), kind))
            if len(found) > len(total):
                total = np.concatenate([total, np.zeros(len(found) - len(total), np.int64)])
            total[: len(found)] += found
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.nulls(len(ids), pa.binary())], names=columns)
    yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([total.astype("<i8").tobytes()], pa.binary())], names=columns)


def write_token_files(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int = 2, ids_per_file: int = 4_000_000) -> str:
    """Encode whole texts, append ``end_id`` to each and write files in ascending id order.

    Returns the folder that holds all a reader needs: the files, ``manifest`` (file, part, seq, docs, ids, start: ids in
    all files before it) and ``ranks`` (the id of each rank). Null texts hold ``end_id`` alone; null ids come first; rows
    with equal ids follow each other in the order of a hash of their ids. Ranks come from the counts of all documents;
    their table is bounded by the vocabulary. An empty table has an empty manifest."""
    spark, path = df.sparkSession, path or default_path()
    kind = "<u2" if max(worker_library(path).library.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
    width = np.dtype(kind).itemsize
    bound_batches(spark)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    written = materialize(rows.mapInArrow(lambda batches: encoded_rows(batches, path, end_id, kind), "id long, ids binary, counts binary"), "token-ids")
    encoded = written.where("ids IS NOT NULL").select("id", "ids")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                found = np.frombuffer(x, "<i8")
                if len(found) > len(total):
                    total = np.concatenate([total, np.zeros(len(found) - len(total), np.int64)])
                total[: len(found)] += found
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"])

    counts = written.where("counts IS NOT NULL").select("counts").mapInArrow(add_up, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    by_rank = np.array([r["id"] for r in sorted(counts, key=lambda r: (-r["n"], r["id"]))], np.uint32)
    rank_of = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank))
    shared = spark.sparkContext.broadcast(rank_of)

    folder = new_path(spark, "token-files")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        forget_library(path)
        seq, size = 0, 0
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            nonlocal seq, size, held
            at = f"{folder}/{attempt_suffix()}-{seq:05d}.bin"
            n_docs = sum(b.num_rows for b in held)
            coded = [encode_ranks(shared.value[np.frombuffer(x, kind)]) for b in held for x in b.column(1).to_pylist()]
            control, data = [c for c, _ in coded], [d for _, d in coded]
            with writing(at) as out:
                out.write(MAGIC + np.array([n_docs, sum(map(len, control)), sum(map(len, data))], "<i8").tobytes())
                ids = np.concatenate([b.column(0).fill_null(0).to_numpy(zero_copy_only=False) for b in held])
                nulls = np.concatenate([b.column(0).is_null().to_numpy(zero_copy_only=False) for b in held])
                lengths = np.concatenate([b.column(2).to_numpy() for b in held]) // width
                out.write(ids.astype("<i8").tobytes() + nulls.astype(np.uint8).tobytes() + lengths.astype("<i8").tobytes())
                for x in (*control, *data):
                    out.write(x)
            row = [[at], [task.partitionId()], [seq], [n_docs], [int(lengths.sum())]]
            seq, size, held = seq + 1, 0, []
            return pa.RecordBatch.from_arrays([pa.array(row[0], pa.string()), *(pa.array(x, pa.int64()) for x in row[1:])], names=["file", "part", "seq", "docs", "ids"])

        for batch in batches:
            lengths, i = batch.column(2).to_numpy() // width, 0
            while i < batch.num_rows:  # up to the document that fills the file
                reach = np.cumsum(lengths[i:])
                k = min(int(np.searchsorted(reach, ids_per_file - size)) + 1, len(reach))
                held.append(batch.slice(i, k))
                size, i = size + int(reach[k - 1]), i + k
                if size >= ids_per_file:
                    yield flush()
        if held:
            yield flush()

    ordered = encoded.repartitionByRange(F.col("id").asc_nulls_first()).withColumn("tie", F.xxhash64("ids")).sortWithinPartitions(F.col("id").asc_nulls_first(), "tie")
    coded = ordered.select("id", "ids", F.octet_length("ids").cast("long").alias("n"))
    files = materialize(coded.mapInArrow(write, "file string, part long, seq long, docs long, ids long"), "token-file-list")
    # ids before a part: a sum over one row for each task of the writing stage; then before each file of a part
    parts = files.groupBy("part").agg(F.sum("ids").alias("of_part"))
    before = parts.select("part", (F.sum("of_part").over(Window.orderBy("part")) - F.col("of_part")).alias("before"))
    in_part = F.sum("ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("ids")
    manifest = files.withColumn("start", in_part).join(before, "part").select("file", "part", "seq", "docs", "ids", (F.col("start") + F.col("before")).alias("start"))
    manifest.write.parquet(f"{folder}/manifest")
    ranks = spark.createDataFrame(list(enumerate(by_rank.tolist())), "rank long, id long")
    ranks.coalesce(1).write.parquet(f"{folder}/ranks")
    return folder


MANIFEST = "file string, part long, seq long, docs long, ids long, start long"


def read_token_files(spark: SparkSession, folder: str, id_col: str = "doc_id", ids_at_once: int = 500_000) -> DataFrame:
    """Per document: id, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids`` (little-endian unsigned
    32-bit integers), decoded from what ``write_token_files`` left in the folder. Documents without tokens of their own have
    the end id alone; null ids and repeated ids come back as they were written; a folder of no document gives no row."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    ranks = spark.read.schema("rank long, id long").parquet(f"{folder}/ranks").collect()  # bounded by the vocabulary
    shared = spark.sparkContext.broadcast(np.array([r["id"] for r in sorted(ranks)], np.uint32))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with reading(at) as f:
                    if f.read(8) != MAGIC:
                        raise ValueError(f"not a token-id file: {at}")
                    docs, n_control, _ = np.frombuffer(f.read(24), "<i8").tolist()
                    ids = np.frombuffer(f.read(8 * docs), "<i8")
                    nulls = np.frombuffer(f.read(docs), np.uint8).astype(bool)
                    lengths = np.frombuffer(f.read(8 * docs), "<i8")
                    c_at = HEADER + 17 * docs
                    d_at = c_at + n_control
                    begin = start + np.concatenate([[0], np.cumsum(lengths)])
                    quads = -(-lengths // 4)
                    lo = 0
                    while lo < docs:
                        hi = max(lo + 1, int(np.searchsorted(begin, begin[lo] + ids_at_once, "right")) - 1)
                        f.seek(c_at)
                        control = np.frombuffer(f.read(int(quads[lo:hi].sum())), np.uint8)
                        size = int(TOTALS[control].sum())
                        f.seek(d_at)
                        ranks = decode_ranks(control, np.frombuffer(f.read(size), np.uint8))
                        c_at, d_at = c_at + len(control), d_at + size
                        first = 4 * np.concatenate([[0], np.cumsum(quads[lo:hi])])
                        found = shared.value[ranks].astype("<u4")
                        each = [found[a : a + n].tobytes() for a, n in zip(first.tolist(), lengths[lo:hi].tolist(), strict=False)]
                        yield pa.RecordBatch.from_arrays([pa.array(ids[lo:hi], pa.int64(), mask=nulls[lo:hi]), pa.array(begin[lo:hi], pa.int64()), pa.array(lengths[lo:hi], pa.int64()), pa.array(each, pa.binary())], names=["id", "start", "n_tokens", "ids"])
                        lo = hi

    n = max(1, manifest.count())
    files = manifest.select("file", "start").repartition(min(n, 4 * spark.sparkContext.defaultParallelism) if n < 10_000 else n // 100)
    return files.mapInArrow(read, "id long, start long, n_tokens long, ids binary").withColumnRenamed("id", id_col)
