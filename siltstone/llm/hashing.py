"""Vectorised hashes of words, word windows and character n-grams over concatenated texts."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext


def give_back_memory() -> None:
    """Have freed arrays, numpy's and Arrow's, go back to the system at once: workers live on, and what they keep adds up."""
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 4 << 20)  # M_TRIM_THRESHOLD
    except (OSError, AttributeError):  # another C library
        pass


def trim() -> None:
    """Give freed memory back at the end of a task; the worker goes on to other tasks, perhaps to none."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


if TaskContext.get() is not None:  # in Spark's workers only, never in the user's own process
    give_back_memory()

BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
WORD_BASE_INV = pow(WORD_BASE, -1, 2**64)
#: Characters that are handled at once: temporary arrays have a few times 8 bytes for each.
BLOCK = 300_000

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    if base not in _powers or len(_powers[base]) < n:
        out = np.full(max(n, 1024), base, np.uint64)
        out[0] = 1
        np.cumprod(out, out=out)
        if n > 4 * BLOCK:
            return out
        _powers[base] = out
    return _powers[base][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _table(is_gap) -> np.ndarray:
    return np.array([is_gap(b) for b in range(256)], bool)


#: Bytes between words: white space only, or everything in ASCII but letters and digits.
WHITE = _table(lambda b: b == 0x20 or 9 <= b <= 13)
NOT_ALNUM = _table(lambda b: b < 0x80 and not chr(b).isalnum())
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def word_spans(data: np.ndarray, starts: np.ndarray, gap: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every word; a text that begins at ``starts`` begins a new word."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~gap[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = np.zeros(len(data) + 1, bool)
    cut[starts] = True
    first |= cut & inside
    last = np.zeros(len(data) + 1, bool)
    last[1:] = inside[:-1] & (~inside[1:] | cut[1:])
    return np.flatnonzero(first), np.flatnonzero(last)


#: Masks of the first 0 to 8 bytes of a little-endian 64-bit integer.
FIRST_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on (zeros after the end), as little-endian 64-bit integers."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range. Every eight bytes are mixed with their place before they are added up, so that no
    arrangement of letters has an equal one by construction."""
    at, size = eights(data), end - begin
    out = mix((at[begin] & FIRST_BYTES[np.minimum(size, 8)]) ^ (size.astype(np.uint64) * np.uint64(BASE)))
    long = np.flatnonzero(size > 8)
    if len(long):
        pieces = (size[long] - 1) // 8
        row = np.repeat(np.arange(len(long)), pieces)
        first = np.cumsum(pieces) - pieces
        nth = np.arange(len(row)) - first[row] + 1
        value = at[begin[long][row] + 8 * nth] & FIRST_BYTES[np.minimum(size[long][row] - 8 * nth, 8)]
        out[long] = mix(out[long] + np.add.reduceat(mix(value + nth.astype(np.uint64) * np.uint64(WORD_BASE)), first))
    return out


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` (a small number) consecutive word hashes (also those that cross texts)."""
    if len(words) < size:
        return np.empty(0, np.uint64)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(WORD_BASE, len(words)), out=sums[1:])
    n = len(words) - size + 1
    return mix((sums[size:] - sums[:n]) * powers(WORD_BASE_INV, n))


def groups(texts: list[str | None], limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``limit`` characters together."""
    at = chars = 0
    for i, t in enumerate(texts):
        chars += len(t or "")
        if chars >= limit:
            yield at, i + 1
            at, chars = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def joined(texts: list[str | bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the texts in one array, and where each begins (one more entry for the end)."""
    raw = [t if isinstance(t, bytes) else (t or "").encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(x) for x in raw], out=offsets[1:])
    return np.frombuffer(b"".join(raw), np.uint8), offsets


def text_words(texts: list[str | None], gap: np.ndarray = WHITE, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and the index of each text's first word (one more entry for the end)."""
    data, offsets = joined(texts)
    if lower:
        data = LOWER[data]
    begin, end = word_spans(data, offsets[:-1][offsets[:-1] < offsets[1:]], gap)
    return word_hashes(data, begin, end), np.searchsorted(begin, offsets)


def char_pieces(texts: list[str | None], overlap: int, limit: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Code points of texts in arrays of about ``limit``: (codes, piece begins, n-gram starts in each piece, text of each piece).

    A text of more than ``limit`` characters comes in several pieces that overlap, so that no n-gram is lost."""
    some: list[str] = []
    starts, owner, size = [], [], 0

    def pack():
        offsets = np.zeros(len(some) + 1, np.int64)
        np.cumsum([len(x) for x in some], out=offsets[1:])
        return np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), "<u4"), offsets, np.array(starts, np.int64), np.array(owner, np.int64)

    for i, t in enumerate(texts):
        t = t or ""
        for a in range(0, max(len(t), 1), limit):
            part = t[a : a + limit + overlap]
            some.append(part)
            starts.append(min(limit, len(t) - a))
            owner.append(i)
            size += len(part)
            if size >= limit:
                yield pack()
                some, starts, owner, size = [], [], [], 0
    if some:
        yield pack()


def char_ngrams(codes: np.ndarray, size: int, bits: int) -> np.ndarray:
    """Bucket (0 .. 2**bits - 1) of the n-gram that begins at each code point but the last size - 1."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint32)
    h = np.full(n, size, np.uint32)
    for j in range(size):
        h *= np.uint32(0x01000193)
        h += codes[j : j + n]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    return (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)


def ngram_sums(texts: list[str], sizes: list[int], bits: int, tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each text the sum of table rows over all its n-grams of each size, and how many there are."""
    width = tables[0].shape[1] if tables[0].ndim == 2 else 1
    sums, counts = np.zeros((len(texts), width)), np.zeros(len(texts), np.int64)
    # wide rows are added up for fewer characters at once
    for codes, offsets, starts, owner in char_pieces(texts, max(sizes) - 1, max(1000, BLOCK * 8 // max(8, width))):
        for size, rows in zip(sizes, tables, strict=True):
            at = char_ngrams(codes, size, bits)
            run = np.zeros((len(at) + 1, width))
            np.cumsum(rows[at].reshape(len(at), width), axis=0, dtype=np.float64, out=run[1:])
            first = np.minimum(offsets[:-1], len(at))
            last = np.clip(np.minimum(offsets[1:] - size + 1, offsets[:-1] + starts), first, len(at))
            np.add.at(sums, owner, run[last] - run[first])
            np.add.at(counts, owner, last - first)
    return sums, counts
