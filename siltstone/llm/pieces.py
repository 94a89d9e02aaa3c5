"""SentencePiece (BPE) encoding of whole texts with a public model file, and decoding.

Method: a table of distinct chunks. Where no piece of the model has a white space marker after another character, a text
in which every space has become a marker falls into chunks (markers, then other characters) that no piece can cross. Each
distinct chunk is segmented once, by the library, and kept in a table of bounded size, a worker's own; the ids of a text
are those of its chunks, joined back by their places. Texts are neither exploded into rows nor shuffled. For a model with pieces that cross
markers, the text is one chunk.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches
from .hashing import trim

MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
BORDER = re.compile(f"[^{MARK} ][{MARK} ]")
#: Chunks that a table keeps at most (it begins anew then), and the characters of one that is kept.
MOST_CHUNKS, MOST_KEPT = 150_000, 48
#: Characters that are cut into chunks at once.
SPAN = 500_000
ID = np.dtype("i4")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceModel(dict):
    """Pieces and scores of a model file, and the table: ids (32-bit integers) by chunk.

    The model's normaliser must be the identity but for spaces, with a marker put before each text."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(lib.vocab_size())
        if lib.normalize(" ﬁ \tA  ") != f"{MARK}{MARK}ﬁ{MARK}\tA{MARK}{MARK}" or any(lib.is_unused(i) for i in every):
            raise ValueError("models that rewrite more than spaces or have unused pieces are not supported")
        pieces = [lib.id_to_piece(i) for i in every]
        self.mark = np.array([lib.piece_to_id(MARK)], ID).tobytes()
        self.special = np.array([lib.is_control(i) or lib.is_unknown(i) for i in every], bool)
        self.crosses = any(BORDER.search(p) for p in pieces) or bool(self.special[lib.piece_to_id(MARK)])
        self.bytes = [p.replace(MARK, " ").encode() for p in pieces]
        self.marked = np.array([x[:1] == b" " for x in self.bytes], bool)
        for i in every:
            if lib.is_byte(i):
                self.bytes[i] = bytes([int(pieces[i][3:5], 16)])

    def learn(self, chunks: set[str]) -> None:
        """Segment those chunks that the table lacks. The model puts a marker before what it is given: a chunk's own first one."""
        new = chunks.difference(self)
        if len(self) + len(new) > MOST_CHUNKS:
            self.clear()
            new = chunks
        some = [c for c in new if c != MARK]
        self.update(zip(some, [array("i", x).tobytes() for x in self.library.encode([c[1:] for c in some], num_threads=1)], strict=True))
        if MARK in new:  # alone it would be a text without anything, which gets no marker
            self[MARK] = self.mark

    def spans(self, text: str) -> Iterator[str]:
        """The marked text, in parts that end where a chunk ends."""
        text, a = MARK + text, 0
        while len(text) - a > SPAN and not self.crosses and (found := BORDER.search(text, a + SPAN)):
            yield text[a : found.start() + 1].replace(" ", MARK)
            a = found.start() + 1
        yield text[a:].replace(" ", MARK)

    def join_back(self, parts: list[str]) -> list[bytes]:
        """Ids of marked parts: the distinct chunks of all of them are looked up, and ids taken by each chunk's place."""
        lists = [[p] if self.crosses else CHUNK.findall(p) for p in parts]
        distinct = set().union(*lists)
        self.learn(distinct)
        joined = [b"".join(map(self.__getitem__, x)) for x in lists]
        for c in distinct:
            if len(c) > MOST_KEPT:
                del self[c]
        return joined

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, in 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        owners, parts, size = [], [], 0
        for i, t in enumerate(texts):
            for part in self.spans(t) if t else ():
                owners.append(i)
                parts.append(part)
                size += len(part)
                if size >= SPAN:
                    for k, ids in zip(owners, self.join_back(parts), strict=True):
                        out[k].append(ids)
                    owners, parts, size = [], [], 0
        for k, ids in zip(owners, self.join_back(parts), strict=True):
            out[k].append(ids)
        return [b"".join(x) for x in out]

    def decode(self, ids: np.ndarray) -> str:
        """What the library makes of the ids; ids of no piece raise. Bytes that are no UTF-8, and control or unknown pieces, go to it."""
        if len(ids) and not self.special[ids].any():
            raw = b"".join(map(self.bytes.__getitem__, ids.tolist()))
            try:
                return raw[int(self.marked[ids[0]]) :].decode()
            except UnicodeDecodeError:
                pass
        return self.library.decode(ids.tolist())


@lru_cache(maxsize=1)
def worker_model(path: str) -> PieceModel:
    return PieceModel(path)


def id_lists(raw: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, raw)]) // ID.itemsize
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(raw), ID)))


def piece_encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """One row per input row: id, ``n_tokens`` long, ``ids`` array of int, without begin and end ids.

    Null and empty texts have no ids; a null id stays null; repeated rows give repeated rows; very long texts and chunks
    are encoded whole; an empty table gives no row. ``path`` is the model file, which every executor must have."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                raw = model.encode(part.column(1).to_pylist())
                n = pa.array([len(x) // ID.itemsize for x in raw], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), n, id_lists(raw)], names=["id", "n_tokens", "ids"])
        model.clear()  # workers live on, and tables of idle ones add up
        trim()

    bound_batches(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_tokens long, ids array<int>").withColumnRenamed("id", id_col)


def piece_decode(df: DataFrame, ids_col: str = "ids", out_col: str = "decoded", path: str | None = None) -> DataFrame:
    """Adds ``out_col``, the text of the ids; all other columns stay, and null ids give ''.

    Nulls among the ids are left out; repeated rows, null keys and empty tables pass through; very long lists are decoded whole."""
    path = path or default_path()
    at = df.columns.index(ids_col)
    df = df.drop(out_col) if out_col != ids_col else df

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                lists = part.column(at)
                texts = [model.decode(lists[k].values.drop_null().to_numpy().astype(np.int64)) if lists[k].is_valid else "" for k in range(len(lists))]
                columns = [pa.array(texts, pa.string()) if k == at and out_col == ids_col else c for k, c in enumerate(part.columns)]
                yield pa.RecordBatch.from_arrays(columns if out_col == ids_col else [*columns, pa.array(texts, pa.string())], names=names)

    fields = [f for f in df.schema.fields if f.name != out_col]
    if out_col == ids_col:
        fields = [T.StructField(out_col, T.StringType()) if f.name == ids_col else f for f in df.schema.fields]
    else:
        fields.append(T.StructField(out_col, T.StringType()))
    names = [f.name for f in fields]
    bound_batches(df.sparkSession)
    return df.mapInArrow(run, T.StructType(fields))
