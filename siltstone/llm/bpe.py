"""Byte-pair encoding of whole texts with a public vocabulary file, and decoding.

Method: contiguous rank arrays. Each short word is a row of parts with the ranks of adjacent pairs beside it; the
lowest rank of the row is found by a scan, its boundary is deleted and the two neighbouring ranks are refreshed. Rows
of equal width are handled together in numpy; words of more than LONG parts use a heap over a linked list instead,
as a scan for each merge would be quadratic. Words that a worker has encoded are found again by hash in tables of bounded
size, for many texts at once.
"""

from __future__ import annotations

import heapq
import json
import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches
from .hashing import FIRST_BYTES, LOWER, WHITE, eights, groups, joined, mix, trim, word_spans

#: Spark's tasks are the parallelism; threads of the library's own would only contend with them.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
#: ASCII bytes by what the vocabulary's pattern makes of them; other bytes, white space and controls have 0.
LETTERS, DIGITS, SIGNS = 1, 2, 3
KIND = np.array([0 if b >= 0x7F or b <= 0x20 else LETTERS if chr(b).isalpha() else DIGITS if chr(b).isdigit() else SIGNS for b in range(256)], np.uint8)
#: Words that normalisation leaves alone and the pattern does not cut: ASCII and Latin-1 letters in lower case. By bytes: those
#: that may stand in such a word, of them those that must follow 0xC3. (As words are UTF-8, nothing else follows 0xC3 there.)
PLAIN_SECOND = np.array([0x9F <= b <= 0xB6 or 0xB8 <= b <= 0xBF for b in range(256)], bool)
PLAIN_BYTES = np.array([0x61 <= b <= 0x7A or b == 0xC3 for b in range(256)], bool) | PLAIN_SECOND

NONE = np.int32(2**31 - 1)
LONG = 64
#: Two tables of so many words that were encoded before, and ids that these may hold together.
SLOT_BITS, POOL_IDS = 18, 2_000_000
#: The same for encoders that keep their tables from task to task: 100 MB, and twice the slots for the words that fill the pool.
KEPT_SLOT_BITS, KEPT_POOL_IDS = 20, 6_000_000
#: Words that are encoded at once when they are new.
NEW_WORDS = 10_000
GROUP_CHARS = 250_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], extra = chr(256 + extra), extra + 1
    return out


def are_plain(words: list[bytes]) -> np.ndarray:
    """Which words are letters of PLAIN_BYTES only."""
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    odd = ~PLAIN_BYTES[data]
    first = np.cumsum([len(w) + 1 for w in words])
    odd[first - 1] = False  # the blanks between words
    odd[1:] |= PLAIN_SECOND[data[1:]] != (data[:-1] == 0xC3)
    return ~np.logical_or.reduceat(odd, np.concatenate([[0], first[:-1]]))


class WordBpe:
    """Encoder for a vocabulary file with word ends (NFC, white space dropped, lower case, split by a pattern)."""

    def __init__(self, path: str):
        self.path, self.splitter = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(pattern)
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int32)
        self.last = np.array([vocab[s + suffix] for s in symbols], np.int32)
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.pair = dict(zip(keys.tolist(), range(len(keys)), strict=True))
        self._forget(self.table_sizes()[1])

    def table_sizes(self) -> tuple[int, int]:
        """Bits of a slot's number, and ids of the pool."""
        return SLOT_BITS, POOL_IDS

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.ranks[at], NONE)

    def merge_rows(self, parts: np.ndarray) -> np.ndarray:
        """parts: a row for each word, filled up with -1 on the right. Returns the same after all merges."""
        done = np.full_like(parts, -1)
        rows, ids = np.arange(len(parts)), parts
        ranks = np.full(ids.shape, NONE, np.int32)
        ranks[:, :-1] = self.rank(ids[:, :-1], ids[:, 1:])
        cols = np.arange(ids.shape[1])
        while len(rows):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            live = best != NONE
            if not live.all():
                done[rows[~live]] = ids[~live]
                rows, ids, ranks, at, best = rows[live], ids[live], ranks[live], at[live], best[live]
                if not len(rows):
                    break
            r = np.arange(len(rows))
            take = np.minimum(cols + (cols > at[:, None]), len(cols) - 1)  # the boundary after part `at` goes
            ids, ranks = np.take_along_axis(ids, take, 1), np.take_along_axis(ranks, take, 1)
            ids[:, -1], ranks[:, -1] = -1, NONE
            ids[r, at] = self.merged[best]
            right = np.minimum(at + 1, len(cols) - 1)
            ranks[r, at] = np.where(at + 1 < len(cols), self.rank(ids[r, at], ids[r, right]), NONE)
            left = np.maximum(at - 1, 0)
            fresh = self.rank(ids[r, left], ids[r, at])
            ranks[r, left] = np.where(at > 0, fresh, ranks[r, left])
        return done

    def merge_long(self, ids: list[int]) -> list[int]:
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        queue = [(k, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (k := self.pair.get(ids[i] * self.size + ids[i + 1])) is not None]
        heapq.heapify(queue)
        gone = [False] * len(ids)
        while queue:
            k, i, a, b = heapq.heappop(queue)
            j = after[i]
            if gone[i] or ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[i], gone[j], after[i] = int(self.merged[k]), True, after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and (right := after[left]) < len(ids):
                    n = self.pair.get(ids[left] * self.size + ids[right])
                    if n is not None:
                        heapq.heappush(queue, (n, left, ids[left], ids[right]))
        return [x for x, g in zip(ids, gone, strict=True) if not g]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        length = np.array([len(x) for x in raw], np.int64)
        out: list[bytes] = [b""] * len(raw)
        for low, high in ((1, 4), (5, 8), (9, 12), (13, 16), (17, 24), (25, 40), (41, LONG)):
            where = np.flatnonzero((length >= low) & (length <= high))
            for some in np.array_split(where, max(1, len(where) // 5_000)):
                if not len(some):
                    continue
                n = length[some]
                data = np.frombuffer(b"".join([raw[i] for i in some]), np.uint8)
                parts = np.full((len(some), high), -1, np.int32)
                inside = np.arange(high) < n[:, None]
                parts[inside] = self.inner[data]
                parts[np.arange(len(some)), n - 1] = self.last[data[np.cumsum(n) - 1]]
                parts = self.merge_rows(parts)
                used = parts >= 0
                flat, ends = parts[used].astype("<u4").tobytes(), np.cumsum(used.sum(axis=1)) * 4
                begin = 0
                for i, end in zip(some.tolist(), ends.tolist(), strict=True):
                    out[i], begin = flat[begin:end], end
        for i in np.flatnonzero(length > LONG).tolist():
            data = np.frombuffer(raw[i], np.uint8)
            ids = self.inner[data].tolist()
            ids[-1] = int(self.last[data[-1]])
            out[i] = np.array(self.merge_long(ids), "<u4").tobytes()
        return out

    def pieces_of_new_characters(self, word: str) -> list[str]:
        """Characters that Python does not know yet are cut as the vocabulary's own library knows them."""
        from tokenizers import Tokenizer

        if self.splitter is None:
            self.splitter = Tokenizer.from_file(self.path)
        text = self.splitter.normalizer.normalize_str(word)
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenizer.pre_tokenize_str(text)]

    def word_pieces(self, word: str) -> list[str | int]:
        """Pieces of a word; an int is the id of a special token that stands in the word."""
        if "<|" in word and self.at_special.search(word):
            out: list[str | int] = []
            for part in self.at_special.split(word):
                if part in self.special:
                    out.append(self.special[part])
                elif part:
                    out.extend(self.word_pieces(part))
            return out
        if not word.isascii():
            word = unicodedata.normalize("NFC", word).replace("Σ", "σ")
        if not word.isascii() and any(unicodedata.category(c) == "Cn" for c in word):
            return self.pieces_of_new_characters(word)
        return self.pieces.findall(word.lower())

    def forget(self) -> None:
        """At the end of a task: words come back in the next one soon enough, and tables of idle workers add up."""
        self.pool = None
        self.keys_of, self.at, self.length = [], None, None
        trim()

    def _forget(self, room: int) -> None:
        shape = (2, 1 << self.table_sizes()[0])
        self.keys_of = [np.zeros(shape, np.uint64) for _ in range(3)]  # head, tail, length of the word in each slot
        self.at, self.length = np.zeros(shape, np.int64), np.zeros(shape, np.int32)
        self.pool, self.used = np.empty(room, np.uint32), 0

    def new_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are in no table, in a row, and how many each has."""
        split = [self.word_pieces(w.decode("utf-8", "surrogatepass")) for w in words]
        pieces = list({p for x in split for p in x if isinstance(p, str)})
        known: dict[str | int, bytes] = dict(zip(pieces, self.encode_pieces(pieces), strict=True))
        raw = [known[x[0]] if len(x) == 1 and isinstance(x[0], str) else b"".join([known[p] if isinstance(p, str) else p.to_bytes(4, "little") for p in x]) for x in split]
        return np.frombuffer(b"".join(raw), "<u4"), np.array([len(x) // 4 for x in raw], np.int32)

    def _words(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes, begins and ends of words, and the index of each text's first word.

        Words lie between ASCII white space (other white space stays in words, where the pattern drops it). Two
        rewritings leave the ids as they are and make fewer different words: ASCII letters in lower case, and borders
        where the pattern cuts anyway: between ASCII letters, digits and signs, and between digits. There is none after
        an apostrophe, which may begin a contraction."""
        data, offsets = joined(texts)
        low = LOWER[data]
        kind = KIND[low]
        for i, t in enumerate(texts):
            if t and "<|" in t:  # special tokens are told by case, and stay in one word
                low[offsets[i] : offsets[i + 1]] = data[offsets[i] : offsets[i + 1]]
                kind[offsets[i] : offsets[i + 1]] = 0
        before, here = kind[:-1], kind[1:]
        cut = (before != 0) & (here != 0) & ((before != here) | (here == DIGITS)) & ((low[:-1] != 0x27) | (here != LETTERS))
        begin, end = word_spans(low, np.concatenate([offsets[:-1][offsets[:-1] < offsets[1:]], np.flatnonzero(cut) + 1]))
        return low, begin, end, np.searchsorted(begin, offsets)

    @staticmethod
    def _keys(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Head, tail and length of words: the first eight and the last eight bytes, which are all of a word of up to 16;
        a longer word's tail is a hash of all of it."""
        at, size = eights(data), end - begin
        head = at[begin] & FIRST_BYTES[np.minimum(size, 8)]
        tail = at[np.maximum(end - 8, begin)] & FIRST_BYTES[np.minimum(size, 8)]
        long = np.flatnonzero(size > 16)
        if len(long):
            raw = data.tobytes()
            tail[long] = [xxhash.xxh3_64_intdigest(raw[b:e]) for b, e in zip(begin[long].tolist(), end[long].tolist(), strict=True)]
        return head, tail, size.astype(np.uint64)

    def encode_group(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin (one more entry for the end)."""
        slot_bits, pool_ids = self.table_sizes()
        if self.pool is None:
            self._forget(pool_ids)
        data, begin, end, first = self._words(texts)
        if not len(begin):
            return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        keys = self._keys(data, begin, end)
        h = mix(keys[0] + mix(keys[1] + keys[2] * np.uint64(0x9E3779B97F4A7C15)))
        slots = (h >> np.uint64(64 - slot_bits)).astype(np.int64), ((h >> np.uint64(20)) & np.uint64((1 << slot_bits) - 1)).astype(np.int64)
        at, n = np.zeros(len(h), np.int64), np.zeros(len(h), np.int32)
        rest = np.arange(len(h))
        for k in (0, 1):
            slot = slots[k][rest]
            hit = np.ones(len(rest), bool)
            for stored, own in zip(self.keys_of, keys, strict=True):
                hit &= stored[k][slot] == own[rest]
            at[rest[hit]], n[rest[hit]] = self.at[k][slot[hit]], self.length[k][slot[hit]]
            rest = rest[~hit]
        if len(rest):
            _, index, inverse = np.unique(h[rest], return_index=True, return_inverse=True)
            # a word with the hash of another one counts as a word of its own
            odd = np.flatnonzero(np.any([own[rest] != own[rest[index[inverse]]] for own in keys], axis=0))
            inverse[odd] = len(index) + np.arange(len(odd))
            fresh = rest[np.concatenate([index, odd])]
            found = []
            raw = data.tobytes()
            for a in range(0, len(fresh), NEW_WORDS):
                part = fresh[a : a + NEW_WORDS]
                found.append(self.new_ids([raw[b:e] for b, e in zip(begin[part].tolist(), end[part].tolist(), strict=True)]))
            ids, size = np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])
            if self.used + len(ids) > len(self.pool):
                hits = self._gather(at, n)
                self._forget(max(pool_ids, len(ids) + len(hits)))
                # what this group found in the old pool moves to the new one, unnamed
                self.pool[: len(hits)], self.used = hits, len(hits)
                at = np.cumsum(n) - n
            where = self.used + np.cumsum(size) - size
            self.pool[self.used : self.used + len(ids)] = ids
            self.used += len(ids)
            at[rest], n[rest] = where[inverse], size[inverse]
            for k in (0, 1):
                slot = slots[k][fresh]
                free = self.keys_of[2][k][slot] == 0 if k == 0 else np.ones(len(slot), bool)
                # of several words for one slot the last stands there, in each table
                _, last = np.unique(slot[free][::-1], return_index=True)
                put = np.flatnonzero(free)[len(slot[free]) - 1 - last]
                for stored, own in zip(self.keys_of, keys, strict=True):
                    stored[k][slot[put]] = own[fresh[put]]
                self.at[k][slot[put]], self.length[k][slot[put]] = where[put], size[put]
        bounds = np.zeros(len(h) + 1, np.int64)
        np.cumsum(n, out=bounds[1:])
        return self._gather(at, n), bounds[first]

    def _gather(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        total = np.cumsum(n, dtype=np.int64)
        return self.pool[np.repeat(at - (total - n), n) + np.arange(int(total[-1]))]

    def encode(self, texts: list[str | None], kind: str = "<u4") -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned integers, some texts at a time."""
        for a, b in groups(texts, GROUP_CHARS):
            ids, bounds = self.encode_group(texts[a:b])
            raw, width = ids.astype(kind).tobytes(), np.dtype(kind).itemsize
            yield from (raw[x:y] for x, y in zip((bounds[:-1] * width).tolist(), (bounds[1:] * width).tolist(), strict=True))


def decode(ids: bytes, tokens: list[str]) -> str:
    return " ".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class LibraryBpe(WordBpe):
    """The same with the ``tokenizers`` library for words that are in no table.

    Words that the vocabulary's normaliser and pattern leave whole go to the library's model many at a time, parted by
    blanks, in the symbols that stand for their bytes; each ends with a token that has the word end, so the ids tell
    which word they belong to."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = Tokenizer(self.library.model)
        self.model.normalizer, self.model.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        suffix = self.library.model.end_of_word_suffix
        self.ends = np.zeros(self.library.get_vocab_size(), bool)
        for token, i in self.library.get_vocab(with_added_tokens=False).items():
            self.ends[i] = bool(suffix) and token.endswith(suffix)
        self.symbols = [(chr(b), s) for b, s in enumerate(byte_symbols()) if (PLAIN_SECOND[b] or b == 0xC3) and chr(b) != s]
        self.pool = None

    def table_sizes(self) -> tuple[int, int]:
        return KEPT_SLOT_BITS, KEPT_POOL_IDS

    def plain_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """None if the library finds more or fewer word ends than words."""
        lines = [b" ".join(words[i : i + 100]).decode("latin-1") for i in range(0, len(words), 100)]
        for byte, symbol in self.symbols:  # few, as most bytes stand for themselves
            lines = [x.replace(byte, symbol) for x in lines]
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.model.encode_batch_fast(lines, add_special_tokens=False)])
        ends = np.flatnonzero(self.ends[ids])
        return (ids, np.diff(ends, prepend=-1).astype(np.int32)) if len(ends) == len(words) and ends[-1] == len(ids) - 1 else None

    def new_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        plain = are_plain(words)
        found = self.plain_ids([w for w, p in zip(words, plain.tolist(), strict=True) if p]) if plain.any() else None
        if found is None:
            plain[:] = False
        others = [w.decode("utf-8", "surrogatepass") for w, p in zip(words, plain.tolist(), strict=True) if not p]
        lists = [e.ids for e in self.library.encode_batch_fast(others, add_special_tokens=False)]
        ids, size = np.array([i for x in lists for i in x], np.uint32), np.array([len(x) for x in lists], np.int32)
        if found is None:
            return ids, size
        # back into the order of the words
        all_ids, sizes = np.concatenate([found[0], ids]), np.concatenate([found[1], size])
        begin = np.cumsum(sizes) - sizes
        back = np.argsort(np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)]), kind="stable")
        n, at = sizes[back], begin[back]
        return all_ids[np.repeat(at - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))], n


@lru_cache(maxsize=1)
def worker_library(path: str) -> LibraryBpe:
    return LibraryBpe(path)


def forget_library(path: str) -> None:
    """For tasks of a later stage: what a worker's library has kept goes, if there is one."""
    if worker_library.cache_info().currsize:
        worker_library(path).forget()


@lru_cache(maxsize=1)
def worker_tokens(path: str) -> list[str]:
    """The token of each id."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    named = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    out = [""] * (max(named.values()) + 1)
    for token, i in named.items():
        out[i] = token
    return out


@lru_cache(maxsize=1)
def worker_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def bpe_encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, decoded_col: str | None = None) -> DataFrame:
    """One row per input row: id, ``n_tokens`` long, ``ids`` binary (little-endian unsigned 32-bit integers), and what the ids
    decode to, as ``bpe_decode`` does, if ``decoded_col`` names a column for it: decoded by the task that encodes, as a second
    Python step in that task would be a second worker process.

    Null and empty texts have no ids; a null id stays null; repeated rows give repeated rows; very long texts and
    words are encoded whole. ``path`` is the vocabulary file, which every executor must have."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, tokens = worker_bpe(path), worker_tokens(path) if decoded_col else []
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                ids = list(bpe.encode(part.column(1).to_pylist()))
                columns = [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                if decoded_col:
                    columns.append(pa.array([decode(x, tokens) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n_tokens", "ids", "decoded"][: len(columns)])
        bpe.forget()

    bound_batches(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    more = ", decoded string" if decoded_col else ""
    return rows.mapInArrow(run, f"id {kind}, n_tokens long, ids binary{more}").toDF(id_col, "n_tokens", "ids", *([decoded_col] if decoded_col else []))


def bpe_decode(df: DataFrame, ids_col: str = "ids", out_col: str = "decoded", path: str | None = None) -> DataFrame:
    """Adds ``out_col``: the tokens joined by one space, as the vocabulary file names no decoder; null ids give ''.

    All other columns stay, null keys and repeated rows too; very long lists are decoded whole; an empty table gives no row."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_tokens(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = pa.array([decode(x or b"", tokens) for x in part.column(at).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[*part.schema.names, out_col])

    at = df.columns.index(ids_col)
    df = df.drop(out_col) if out_col != ids_col else df
    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out_col, T.StringType())]))
