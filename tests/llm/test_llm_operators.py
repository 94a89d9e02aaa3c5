"""Training-data operators against brute force, exact round trips and odd rows."""

import base64
import hashlib
import random
import re
import subprocess
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.llm import bpe, centroids, decontam, hashing, idfiles, jaccard, langid, lexical, media, passages, pieces, quality, repeats, sampling, toxicity, warc
from siltstone.llm.common import attach
from siltstone.llm.components import connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, ids string, doc string, score string, n_tokens string, kept string"


def docs(spark, rows, schema=SCHEMA):
    """(doc_id, text) rows with other columns, some of which are called like the operators' own."""
    width = len(schema.split(", ")) - 2
    return spark.createDataFrame([(*r, *[None] * width) for r in rows], schema)


def odd_rows():
    long = " ".join(f"w{k % 977}" for k in range(60_000))
    return [(1, "one two three"), (2, None), (3, ""), (None, "no id at all"), (4, "one two three"), (4, "one two three"), (4, "other text, same id"), (5, " \t\n "), (6, "x" * 400_000), (7, long), (8, "Ünï ©ode 日本語 \U0001f600 \x1c"), (9, "$$$ 123")]


# Hashes and repeats --------------------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB é日\t\n\x1c.", max_size=30), max_size=6))
def test_words_are_what_split_gives(texts):
    hashes, first = hashing.text_words(texts, lower=False)
    assert [b - a for a, b in zip(first, first[1:])] == [len(t.encode().split()) for t in texts]
    words = [w for t in texts for w in t.encode().split()]
    assert len(set(words)) == len(set(hashes.tolist()))
    again = {}
    for w, h in zip(words, hashes.tolist(), strict=True):
        assert again.setdefault(w, h) == h


def test_hashes_do_not_depend_on_blocks(monkeypatch):
    texts = [" ".join(f"w{k}" for k in range(3000)), "y" * 5000, None, ""]
    whole, _ = hashing.text_words(texts)
    grams, counts = hashing.ngram_sums([t or "" for t in texts], [1, 3], 8, [np.arange(256.0), np.arange(256.0)])
    monkeypatch.setattr(hashing, "BLOCK", 700)
    assert (hashing.text_words(texts)[0] == whole).all()
    pieces = list(hashing.char_pieces(["abcdef"], 2, limit=2))
    assert ["".join(map(chr, c)) for c, *_ in pieces] == ["abcd", "cdef", "ef"]
    assert counts.tolist() == [2 * len(texts[0]) - 2, 9998, 0, 0] and grams.shape == (4, 1)


def test_repeated_items_and_filter(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(40), rng.randrange(300)) for _ in range(400)] + [(k, 7_000) for k in range(40)]
    df = spark.createDataFrame(pairs, "owner long, item long").repartition(5)

    def extract(batch):
        yield batch.column(1).to_numpy(), batch.column(0).to_numpy()

    got = defaultdict(set)
    for r in repeats.repeated_items(df, extract).collect():
        got[r["owner"]] |= set(np.frombuffer(r["packed"], "<i8").tolist())
    owners = defaultdict(set)
    for o, i in pairs:
        owners[i].add(o)
    expected = defaultdict(set)
    for o, i in pairs:
        if len(owners[i]) > 1:
            expected[o].add(i)
    assert got == expected
    keys = repeats.KeyFilter.build(spark.range(0, 5000, 5))
    ids = np.arange(20_000)
    assert keys.passes(ids)[:5000:5].all() and keys.passes(ids).sum() < 1100
    assert repeats.KeyFilter.build(spark.range(0)).passes(ids).sum() == 0
    rows = docs(spark, odd_rows())
    left = repeats.without(rows, ["doc_id"], spark.createDataFrame([(4,), (9,), (None,)], "k long"))
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(map(str, [1, 2, 3, None, 5, 6, 7, 8])) and left.columns == rows.columns


def test_once_and_dropped(spark, monkeypatch):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (2, 1, "c"), (3, 3, "d"), (4, 4, "e"), (4, 4, "e"), (None, 1, "f"), (5, None, "g"), (5, None, "g")], "k long, m long, t string")
    repeated = spark.createDataFrame([(1, 1), (1, 1), (4, 4), (9, 9)], "k long, m long")
    dropped = spark.createDataFrame([(2, 1), (4, 4), (4, 4), (3, 1), (None, 1)], "k long, m long")
    for _ in range(2):
        left = repeats.once(rows, ["k", "m"], repeated, dropped)
        # what is in both goes; a key that differs in its second part, or has a null, is another one
        assert sorted(r["t"] for r in left.collect()) == ["a", "b", "d", "f", "g", "g"] and left.columns == rows.columns
        monkeypatch.setattr(repeats.KeyFilter, "MOST_BITS", 10)


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(110)] + [(1000, k) for k in range(1001, 1200)] + [(k, k + 1) for k in range(2000, 2040)] + [(5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in list(parent)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_attach_sends_hot_keys_apart(spark):
    df = spark.createDataFrame([("hot", k) for k in range(900)] + [(f"k{k}", k) for k in range(100)], "k string, v long")
    groups = df.groupBy("k").agg(F.max("v").alias("top"), F.count("*").alias("n"))
    assert {(r["k"], r["top"]) for r in attach(df, "k", groups, "n", 1000).collect()} == {("hot", 899), *((f"k{k}", k) for k in range(100))}


# 7 and 9: tokens -----------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_path())


PIECES = ["the", "Is", "ñandú", "É", "İ", "Σ", "'re", "'LL", "...", "., ", " . ", ", ", "<|endoftext|>", "<|startoftext|>", "<|", "日本", "١٢", "½", "\x1c", "\x85", "\xa0", " ", "\n", "'", "'s", "s", "4", "$$$", "a", "\U0001f600", "́", "ẞ", "K"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=5)), max_size=12).map("".join), min_size=1, max_size=4))
def test_bpe_equals_the_library(library, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    tokens = bpe.worker_tokens(bpe.default_path())
    for encoder in (bpe.worker_bpe(bpe.default_path()), bpe.worker_library(bpe.default_path())):
        for t, got in zip(texts, encoder.encode(texts), strict=True):
            expected = library.encode(t, add_special_tokens=False).ids
            assert np.frombuffer(got, "<u4").tolist() == expected
            assert bpe.decode(got, tokens) == library.decode(expected, skip_special_tokens=False)


def test_bpe_on_every_character(library):
    points = [c for c in range(0x80, 0x110000, 7) if not 0xD800 <= c < 0xE000] + [0x1C89, 0x1E5D0, 0x3D000, 0x2EBF0]
    texts = [f":{chr(c)}a{chr(c)}!" for c in points]
    encoder = bpe.worker_bpe(bpe.default_path())
    wrong = [c for c, e, g in zip(points, library.encode_batch(texts, add_special_tokens=False), encoder.encode(texts), strict=True) if np.frombuffer(g, "<u4").tolist() != e.ids]
    assert not wrong


def test_bpe_long_words_and_small_tables(library, monkeypatch):
    monkeypatch.setattr(bpe, "POOL_IDS", 50)
    encoder = bpe.WordBpe(bpe.default_path())
    rng = random.Random(5)
    texts = ["a" * 3000 + "b" * 500, "ab" * 900, *(" ".join("".join(rng.choices("abcdef", k=rng.randint(1, 9))) for _ in range(80)) for _ in range(30))]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def thue_morse(n):
    """A word over a and b, and the one with a and b exchanged: sums of powers of a base modulo 2**64 are equal for both."""
    word = "".join("ab"[k.bit_count() & 1] for k in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_that_simple_hashes_confuse(library):
    one, other = thue_morse(2048)
    hashes, _ = hashing.text_words([f"{one} {other}"])
    assert hashes[0] != hashes[1]
    for encoder in (bpe.WordBpe(bpe.default_path()), bpe.LibraryBpe(bpe.default_path())):
        for text in (f"{one} {other}", other, one):
            assert np.frombuffer(next(encoder.encode([text])), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_bpe_with_equal_slots(library, monkeypatch):
    """All words share a slot and a hash: they are told apart by their bytes."""
    monkeypatch.setattr(bpe, "mix", lambda h: np.zeros_like(h))
    text = "alpha beta gamma alpha a_rather_long_word_of_many_letters beta another_rather_long_word_of_letters"
    for encoder in (bpe.WordBpe(bpe.default_path()), bpe.LibraryBpe(bpe.default_path())):
        for _ in range(3):
            assert np.frombuffer(next(encoder.encode([text])), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_words_are_kept_from_task_to_task(library, monkeypatch):
    """A worker's next task meets the words of the one before; what was kept is right, and goes when it is told to."""
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)]
    texts = [" ".join(words[k : k + 40]) for k in range(160)] + ["élan ñandú ß àí <|endoftext|> 日本", None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["id", "text"])
    encoder = bpe.worker_library(bpe.default_path())
    encoder.forget()
    new = []
    monkeypatch.setattr(encoder, "new_ids", lambda w, real=encoder.new_ids: (new.append(len(w)), real(w))[1])
    expected = [library.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    for n, last in ((1, False), (1, True), (2, True)):
        *rows, counts = idfiles.encoded_rows(iter([batch]), bpe.default_path(), 2, "<u2")
        assert [np.frombuffer(x, "<u2").tolist() for b in rows for x in b.column(1).to_pylist()] == expected
        assert np.frombuffer(counts.column(2)[0].as_py(), "<i8").sum() == sum(map(len, expected))
        assert len(new) == n
        if last:
            bpe.forget_library(bpe.default_path())
            assert encoder.pool is None


@pytest.mark.parametrize("sizes", [(4, 300), (20, 6_000_000)])
def test_kept_tables_that_fill_up(library, monkeypatch, sizes):
    monkeypatch.setattr(bpe, "KEPT_SLOT_BITS", sizes[0])
    monkeypatch.setattr(bpe, "KEPT_POOL_IDS", sizes[1])
    encoder, rng = bpe.LibraryBpe(bpe.default_path()), random.Random(6)
    for _ in range(3):
        texts = [" ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(60)) for _ in range(40)]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_plain_words():
    plain = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
    words = [w.encode() for w in ["a", "az", "é", "éa", "aß", "÷", "a÷b", "É", "ÿ", "Àa", "a1", "'", "日", "ĸ", "Ãa", "a\u0300", "\u1820", "zzz", "à", "í", "A", "Ÿ", "\xad"]]
    assert bpe.are_plain(words).tolist() == [plain.fullmatch(w) is not None for w in words]
    assert [bpe.are_plain([w])[0] for w in words] == bpe.are_plain(words).tolist()


def test_bpe_operator_on_odd_rows(spark, library):
    rows = odd_rows()
    got = bpe.bpe_decode(bpe.bpe_encode(docs(spark, rows))).collect()
    expected = sorted(((i, library.encode(t or "", add_special_tokens=False).ids) for i, t in rows), key=str)
    assert sorted(((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got), key=str) == expected
    assert all(r["decoded"] == library.decode(np.frombuffer(r["ids"], "<u4").tolist(), skip_special_tokens=False) and r["n_tokens"] == len(r["ids"]) // 4 for r in got)
    assert bpe.bpe_decode(bpe.bpe_encode(docs(spark, []))).count() == 0


def test_bpe_decoded_by_the_task_that_encodes(spark):
    rows = docs(spark, odd_rows())
    both = bpe.bpe_encode(rows, decoded_col="decoded")
    apart = bpe.bpe_decode(bpe.bpe_encode(rows))
    assert both.schema == apart.schema and sorted(map(str, both.collect())) == sorted(map(str, apart.collect()))
    assert bpe.bpe_encode(docs(spark, []), decoded_col="decoded").count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=9), min_size=1, max_size=5))
def test_rank_coding_round_trip(lists):
    coded = [idfiles.encode_ranks(np.array(x, np.uint32)) for x in lists]
    control, data = (np.frombuffer(b"".join(c[k] for c in coded), np.uint8) for k in (0, 1))
    got, at = idfiles.decode_ranks(control, data), 0
    for x in lists:
        assert got[at : at + len(x)].tolist() == x
        at += -(-len(x) // 4) * 4


def test_token_files_on_odd_rows(spark, library):
    rows = odd_rows()
    folder = idfiles.write_token_files(docs(spark, rows).repartition(3), ids_per_file=1000)
    assert spark.read.parquet(f"{folder}/manifest").count() > 1
    got = sorted(idfiles.read_token_files(spark, folder, ids_at_once=500).collect(), key=lambda r: r["start"])
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4
        at += r["n_tokens"]
    expected = sorted((str(i), library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows)
    assert sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in got) == expected
    ids = [r["doc_id"] for r in got]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    assert idfiles.read_token_files(spark, idfiles.write_token_files(docs(spark, []))).count() == 0


def test_token_files_are_read_in_a_fresh_session(spark, tmp_path):
    """All that a reader needs is in the folder: a new process decodes it."""
    folder = idfiles.write_token_files(docs(spark, [(2, "one two"), (1, "three")]))
    code = f"""
from pyspark.sql import SparkSession
from siltstone.llm.idfiles import read_token_files
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.local.dir", "{tmp_path}").getOrCreate()
print([(r["doc_id"], r["start"], r["ids"].hex()) for r in read_token_files(spark, {folder!r}).orderBy("start").collect()])
"""
    said = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2], capture_output=True, text=True, timeout=300)
    expected = [(r["doc_id"], r["start"], r["ids"].hex()) for r in idfiles.read_token_files(spark, folder).orderBy("start").collect()]
    assert said.stdout.strip() == str(expected) and [x[:2] for x in expected] == [(1, 0), (2, len(expected[0][2]) // 8)]


# 2: archives ---------------------------------------------------------------------------------------------------------


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id long, url string, html string, payload string, n long")


def test_archives(spark):
    big = "".join(random.Random(1).choices("abc é\r\n", k=20_000))
    rows = [(5, "https://e.org/a", big), (3, None, big), (1, "https://e.org/ b", ""), (2, "u", None), (7, "u", "x\r\n\r\nWARC/1.1\r\n"), (8, "v", big + "z"), (None, "n", big), (5, "https://e.org/a", big)]
    manifest = warc.write_warc(pages(spark, rows), bytes_per_file=3000)
    assert manifest.count() > 1 and manifest.agg(F.sum("records")).first()[0] == len(rows)
    chunks = warc.read_warc(manifest, chunk_bytes=777).collect()
    by = defaultdict(list)
    for c in chunks:
        by[(c["record_id"], c["record_type"], c["refers_to"])].append(c)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    assert {k[:3] for k in by} == {(i, "response" if first[h or ""] == i else "revisit", None if first[h or ""] == i else first[h or ""]) for i, _, h in rows if i is not None} | {(None, "response", None)}
    for (i, kind, _), cs in by.items():
        raw = next((h or "") for j, _, h in rows if j == i).encode()
        assert {(c["payload_bytes"], c["payload_digest"]) for c in cs} == {(len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())}
        if kind == "response":
            cs.sort(key=lambda c: c["chunk_no"])
            assert b"".join(c["data"] for c in cs) == raw and max(len(c["data"]) for c in cs) <= 777
            assert [c["running_digest"] for c in cs] == [base64.b32encode(hashlib.sha1(raw[: 777 * (k + 1)]).digest()).decode() for k in range(len(cs))]
            assert cs[0]["n_chunks"] == len(cs)
    assert warc.read_warc(warc.write_warc(pages(spark, []))).count() == 0
    kinds = warc.read_warc(warc.write_warc(pages(spark, rows), least_bytes=1)).where("payload_bytes = 0").select("record_type").distinct().collect()
    assert [r[0] for r in kinds] == ["response"]


def test_large_payloads_are_written_from_chunk_rows(spark, monkeypatch):
    rng = random.Random(2)
    big = ["".join(rng.choices("abc é", k=5000 + 777 * k)) for k in range(6)]
    rows = [(k, f"u{k}", big[k % 6]) for k in range(9)] + [(20, "v", "small"), (21, "v", "small"), (22, None, None)]
    kept, whole = {}, warc.materialize
    monkeypatch.setattr(warc, "materialize", lambda df, label: kept.setdefault(label, whole(df, label)))
    got = warc.read_warc(warc.write_warc(pages(spark, rows), chunk_bytes=500), chunk_bytes=500).orderBy("record_id", "chunk_no").collect()
    assert kept["warc-chunks"].agg(F.max(F.octet_length("data"))).first()[0] == 500
    assert {label for label, df in kept.items() if set(df.columns) & {"data", "payload"}} == {"warc-chunks"}
    for i, _, h in rows:
        cs, raw = [c for c in got if c["record_id"] == i], (h or "").encode()
        first = min(j for j, _, x in rows if x == h)
        assert {(c["refers_to"], c["payload_bytes"], c["payload_digest"]) for c in cs} == {(None if first == i else first, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())}
        assert b"".join(c["data"] for c in cs) == (raw if first == i else b"")


def test_a_damaged_archive_fails(spark, tmp_path):
    manifest = warc.write_warc(pages(spark, [(1, "u", "payload " * 50)]))
    path = manifest.first()["file"].removeprefix("file://")
    import gzip

    raw = gzip.decompress(open(path, "rb").read()).replace(b"payload payload", b"payload PAYLOAD", 1)
    (tmp_path / "bad.warc.gz").write_bytes(gzip.compress(raw))
    bad = spark.createDataFrame([(str(tmp_path / "bad.warc.gz"), 1)], "file string, records long")
    with pytest.raises(Exception, match="digest of record 1"):
        warc.read_warc(bad).collect()


# 4: passages ---------------------------------------------------------------------------------------------------------


def brute_passages(rows, size):
    windows = {}
    for i, t in rows:
        w = (t or "").encode().split()
        if i is not None:
            for k in range(len(w) - size + 1):
                windows[tuple(w[k : k + size])] = min(i, windows.get(tuple(w[k : k + size]), i))
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if i is not None and windows[tuple(w[k : k + size])] < i:
                gone[k : k + size] = [True] * size
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(4))
def test_passages_equal_brute_force(spark, monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(passages, "SHARD_WORDS", 60)
    base = [" ".join(rng.choices("abcdefgh", k=60)) for _ in range(4)]
    rows = []
    for i in rng.sample(range(200), 60):
        if rng.random() < 0.3:
            t = rng.choice(base)
        else:
            parts = [" ".join(rng.choices("abcdefgh", k=rng.randint(0, 30)))]
            for _ in range(rng.randint(0, 2)):
                w = rng.choice(base).split()
                a = rng.randint(0, 40)
                parts += [" ".join(w[a : a + rng.randint(8, 30)]), " ".join(rng.choices("xyz", k=rng.randint(0, 9)))]
            t = "\n".join(parts)
        rows.append((i, t))
    rows += [(None, base[0]), (300, None), (301, ""), (302, base[1]), (302, base[1]), (302, base[2] + " tail"), (0, base[3] + " " + base[3])]
    got = passages.remove_repeats(docs(spark, rows).repartition(5), carry=["source"])
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept", "source"]
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got.collect()), key=str) == brute_passages(rows, 13)


def test_a_common_anchor_is_dealt_over_shards(spark, monkeypatch):
    rng, limit, whole = random.Random(5), 2000, passages.locate
    grams = [rng.choices(range(10_000), k=5) for _ in range(20_000)]
    hashes = hashing.window_hashes(hashing.text_words([" ".join(f"w{k}" for g in grams for k in g)], lower=False)[0], 5)[::5]
    anchor = " ".join(f"w{k}" for k in grams[int(hashes.argmin())])
    ends = [" ".join(f"e{rng.randrange(10_000)}" for _ in range(8)) for _ in range(7)]
    rows = [(i, " ".join([*(f"w{rng.randrange(10_000)}" for _ in range(8)), anchor, rng.choice(ends)])) for i in rng.sample(range(10_000), 500)]

    def bounded(texts, *more):
        n = sum(len(t.split()) for t in texts)
        assert n <= limit, f"{n} words in one shard"
        return whole(texts, *more)

    monkeypatch.setattr(passages, "SHARD_WORDS", limit)
    monkeypatch.setattr(passages, "locate", bounded)
    got = passages.remove_repeats(docs(spark, rows).repartition(5)).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=str) == brute_passages(rows, 13)


def test_passages_that_hashes_confuse(spark, monkeypatch):
    """Words with equal upper halves of some hash, Thue-Morse words, and windows whose hashes are all equal."""
    tail = [f"z{k}" for k in range(12)]
    one, other = thue_morse(2048)
    rows = []
    for a, b in (("w153549", "w379826"), (one, other)):
        for k in range(5):
            rows += [(len(rows) + 1, " ".join([*tail[:k], a, *tail[k:]])), (len(rows) + 2, " ".join([*tail[:k], b, *tail[k:]]))]
    rows += [(90, rows[0][1]), (91, rows[3][1])]
    for confused in (False, True):
        if confused:
            monkeypatch.setattr(passages, "window_hashes", lambda words, size: np.full(max(0, len(words) - size + 1), 7, np.uint64))
        got = passages.remove_repeats(docs(spark, rows)).collect()
        assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=str) == brute_passages(rows, 13)


def test_spans_are_merged():
    begin, end = np.array([5, 0, 2, 20]), np.array([9, 3, 5, 21])
    assert passages.merge_spans(begin, end).tolist() == [[0, 9], [20, 21]]
    assert passages.merge_spans(begin[:0], end[:0]).tolist() == []


def test_passages_on_odd_rows(spark):
    rows = odd_rows() + [(10, odd_rows()[9][1]), (11, "x" * 400_000)]
    got = passages.remove_repeats(docs(spark, rows))
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got.collect()), key=str) == brute_passages(rows, 13)
    assert passages.remove_repeats(docs(spark, [])).count() == 0


# 6: similar documents ------------------------------------------------------------------------------------------------


def brute_components(rows):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = []
    for _, t in rows:
        w = (t or "").encode().translate(low).split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    names = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            names[find(k)].append(i)
    return sorted(((i, len(sets[k]), min(names[find(k)], default=None) if sets[k] else i) for k, (i, _) in enumerate(rows)), key=str)


def similar_rows(seed):
    rng = random.Random(seed)
    rows, i = [], 0
    for _ in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randint(3, 120))]
        for _ in range(rng.choice([1, 2, 3, 25])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                w += [f"t{rng.randrange(10**6)}" for _ in range(rng.randint(0, 25))]
            rows.append((i, " ".join(w).upper() if rng.random() < 0.2 else "\n".join(w)))
            i += 1
    rng.shuffle(rows)
    return rows


def chained_rows(seed):
    """Documents that share stretches with their neighbours, so that prefix shingles join all of them; few are similar."""
    rng = random.Random(seed)
    stretch = [" ".join(f"s{k}w{j}" for j in range(10)) for k in range(60)]
    rows = [(k, " ".join(stretch[k : k + 6])) for k in range(54)] + [(100 + k, " ".join(stretch[k : k + 12])) for k in range(0, 48, 5)]
    for k in range(200, 240):
        w = rng.choice(rows[:54])[1].split()
        w[rng.randrange(len(w))] = f"edit{k % 7}"
        rows.append((k, " ".join(w)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("blocks", "pairs"), [(4096, 4), (3, 4), (4096, 0)])
def test_one_group_of_prefixes(spark, monkeypatch, blocks, pairs):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", blocks)
    monkeypatch.setattr(jaccard, "MOST_PAIRS", pairs)
    monkeypatch.setattr(jaccard, "MOST_DOCS", 6)
    rows = chained_rows(blocks)
    got = jaccard.near_duplicates(docs(spark, rows).repartition(4))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_components(rows)


def test_lists_of_near_copies_are_one_tree(spark, monkeypatch):
    rng = random.Random(5)
    base, rows = [f"w{k}" for k in range(200)], []
    for k in range(80):
        w = list(base)
        for j in rng.sample(range(200), rng.choice([1, 2, 9, 12])):
            w[j] = f"e{rng.randrange(4)}"
        rows.append((k, " ".join(w)))
    compared, trees = [], jaccard.tree_pairs

    def counted(rows):
        compared.append(rows.count())
        return trees(rows)

    monkeypatch.setattr(jaccard, "tree_pairs", counted)
    got = jaccard.near_duplicates(docs(spark, rows).repartition(4))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_components(rows)
    assert 0 < compared[0] <= 2 * len(rows)  # they were 968 when each list was a tree of its own


def test_words_that_hashes_confuse_are_not_similar(spark):
    one, other = thue_morse(2048)
    rows = [(1, one), (2, other), (3, f"a b c {one} d e"), (4, f"a b c {other} d e"), (5, f"a b c {other} d e")]
    got = jaccard.near_duplicates(docs(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_components(rows)


@pytest.mark.parametrize("blocks", [4096, 5])
def test_components_equal_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", blocks)
    rows = similar_rows(blocks) + [(None, "a b c d e f"), (None, "a b c d e f"), (900, None), (901, ""), (902, "a b"), (903, "A B"), (904, "a")]
    got = jaccard.near_duplicates(docs(spark, rows).repartition(4))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_components(rows)


def test_components_on_odd_rows(spark):
    got = jaccard.near_duplicates(docs(spark, odd_rows()))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_components(odd_rows())
    assert jaccard.near_duplicates(docs(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 12), min_size=1, max_size=10), min_size=2, max_size=12))
def test_prefix_tree_joins_what_is_linked(sets):
    arrays = [np.array(sorted(s), np.int64) for s in sets]
    found = jaccard.PrefixTree(arrays, np.array([len(s) for s in sets])).links()

    def classes(links):
        label = list(range(len(sets)))
        for a, b in links:
            label = [label[a] if x == label[b] else x for x in label]
        return sorted(sorted(k for k, x in enumerate(label) if x == y) for y in set(label))

    linked = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert all((max(p), min(p)) in linked for p in found)
    assert classes(found) == classes(linked)
    label = np.array([k % 3 for k in range(len(sets))])
    across = jaccard.PrefixTree(arrays, np.array([len(s) for s in sets])).links(label)
    same = [(a, b) for a in range(len(sets)) for b in range(a) if label[a] == label[b]]
    assert all(label[a] != label[b] for a, b in across) and classes(across + same) == classes(linked + same)
    # prefixes in the order of numbers: all linked pairs are among the pairs to count, if their prefixes meet at all
    heads = [a[: len(a) - jaccard.at_least(len(a)) + 1] for a in arrays]
    size = np.array([len(a) for a in arrays])
    tree = jaccard.PrefixTree(heads, size)
    pairs = tree.pairs(label, size, [(0, int(h[-1])) for h in heads], 10**6)
    wanted = {p for p in linked if label[p[0]] != label[p[1]]}
    assert wanted <= {(max(p), min(p)) for p in pairs} and len(pairs) == len(set(pairs))


# 5: benchmark items --------------------------------------------------------------------------------------------------


def brute_leaks(rows, items):
    import re

    words = lambda t: re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().lower() if (t or "").isascii() else re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
    out = []
    for i, t in rows:
        w = words(t)
        for j, q in items:
            x = words(q)
            width = min(5, len(x))
            if not width:
                continue
            need = {tuple(x[k : k + width]) for k in range(len(x) - width + 1)}
            have = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}
            if 100 * len(need & have) >= 80 * len(need):
                out.append((i, j, len(need), len(need & have)))
    return sorted(out, key=str)


def test_leaks_equal_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    items = [(k, " ".join(f"w{rng.randrange(200)}" for _ in range(n))) for k, n in enumerate([1, 3, 4, 5, 6, 9, 30, 31, 64, 200])] + [(50, None), (51, " .. "), (None, "lone item of six plain words"), (9, "w1 w2 w3 w4 w5 w6 w7")]
    rows = odd_rows() + [(60, "lone item of six plain words"), (61, "Lone, ITEM: of (six) plain words!")]
    for i in range(100, 160):
        w = [f"w{rng.randrange(200)}" for _ in range(rng.randint(0, 400))]
        q = (rng.choice(items)[1] or "").split()
        for _ in range(rng.randint(0, 2)):
            if q:
                q[rng.randrange(len(q))] = "edit"
        at = rng.randint(0, len(w))
        rows.append((i, " ".join(w[:at] + q + w[at:])))
    table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, id int")
    for chars in (8_000_000, 500):
        monkeypatch.setattr(decontam, "BLOCK_CHARS", chars)
        got = decontam.find_leaks(docs(spark, rows), table).collect()
        assert sorted(((r["doc_id"], r["item_id"], r["n_shingles"], r["n_shared"]) for r in got), key=str) == brute_leaks(rows, items)
        assert all(r["containment"] == r["n_shared"] / r["n_shingles"] for r in got)
    assert decontam.find_leaks(docs(spark, []), table).count() == 0
    assert decontam.find_leaks(docs(spark, rows), table.where("false")).count() == 0


# 8: media ------------------------------------------------------------------------------------------------------------


def test_gear_cuts_equal_a_rolling_hash():
    data = random.Random(3).randbytes(300_000)
    cuts, begin, h = [], 0, 0
    for k, b in enumerate(data):
        h = ((h << 1) + int(media.GEAR[b])) & 0xFFFFFFFF
        n = k + 1 - begin
        if (n >= media.LEAST and h >> (32 - media.MASK_BITS) == 0) or n == media.MOST:
            cuts.append(k + 1)
            begin = k + 1
    if begin < len(data):
        cuts.append(len(data))
    own = media.gear_cuts(data)
    assert own == cuts and len(own) > 40
    moved = media.gear_cuts(data[:50_000] + b"!" + data[50_000:])
    assert len({c - 1 for c in moved} & set(own)) > 20
    assert media.gear_cuts(b"") == [0] and media.gear_cuts(b"x" * 100_000)[0] == media.MOST


def test_media_round_trip(spark):
    rng = random.Random(8)
    shared = "".join(rng.choices("abcdefghij ", k=60_000))
    rows = odd_rows() + [(20 + k, shared) for k in range(30)] + [(60, shared[:20_000] + "new" + shared[20_000:]), (61, "q" * 192), (62, "é" * 96)]
    store, chunks = media.store_media(docs(spark, rows))
    assert chunks.count() == chunks.select("digest").distinct().count() > 0
    got = media.read_media(store, chunks).collect()
    expected = []
    for i, t in rows:
        raw = (t or "").encode()
        p = raw + b" " * (-len(raw) % 192 if raw else 192)
        wav = media.to_wav(p)
        expected.append((i, len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]), len(wav), hashlib.sha256(wav).hexdigest()))
    assert sorted((tuple(r)[:7] for r in got), key=str) == sorted(expected, key=str)
    by = defaultdict(set)
    for r in got:
        by[r["payload_sha256"]].add(r["feature"])
    assert all(len(f) == 1 for f in by.values())
    inline = store.select(F.sum(F.aggregate("own", F.lit(0), lambda a, c: a + F.coalesce(F.length(c), F.lit(0))))).first()[0]
    assert inline < sum(e[5] for e in expected) - 29 * 60_000
    assert media.read_media(*media.store_media(docs(spark, []))).count() == 0


# 1, 3 and 10: classifiers --------------------------------------------------------------------------------------------


def labelled(spark, name, label, sf="/root/testdata/sf0.01"):
    d = spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("doc_id", "id")
    rows = spark.read.parquet(f"{sf}/labels.parquet").select(F.col("doc_id").alias("id"), F.col(label).alias("label"))
    return d.select("id", "text"), d.select("id", F.col("lang").alias("group")).join(rows, "id").select("id", "label", "group")


def test_language_id(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    known = d.where(~held).select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("label"))
    model = langid.fit_language_model(known.select("id", "text"), known.select("id", "label"))
    got = langid.predict_languages(d.where(held), model).join(d, "doc_id")
    assert got.where("lang_pred = lang").count() > 0.97 * got.count()
    odd = {str(r["doc_id"]): r for r in langid.predict_languages(docs(spark, odd_rows()), model).collect()}
    assert all(odd[k]["lang_pred"] == "und" and odd[k]["score"] == 0 for k in "2359") and odd["8"]["lang_pred"] in model.languages
    assert all(0 <= r["score"] <= 1 for r in odd.values())
    assert langid.predict_languages(docs(spark, []), model).count() == 0
    kept = langid.keep_identified(docs(spark, odd_rows()), model)
    assert {r["doc_id"] for r in kept.collect()}.isdisjoint({2, 3, 5, 9}) and kept.columns[:2] == ["doc_id", "text"]
    nothing = langid.fit_language_model(known.select("id", "text").where("false"), known.select("id", "label").where("false"))
    assert {r["lang_pred"] for r in langid.predict_languages(docs(spark, odd_rows()), nothing).collect()} == {"und"}
    whole, parts = model.predict(["la casa " * 50_000])[1], model.predict(["la casa " * 50])[1]
    assert abs(whole[0] - parts[0]) < 0.05


def test_language_scores_equal_a_naive_average():
    rng = np.random.default_rng(2)
    model = langid.LanguageModel(["a", "b"], [rng.normal(size=(1 << langid.BITS, 2)).astype(np.float32) for _ in langid.SIZES], rng.normal(size=2))
    texts = ["Hello wörld", "x", "日本語 text " * 40, "ab"]
    langs, scores = model.predict(texts)
    for t, lang, score in zip(texts, langs, scores, strict=True):
        t = t.lower()
        rows = [model.tables[k][int(hashing.char_ngrams(np.array([ord(c) for c in t[i : i + size]], np.uint32), size, langid.BITS)[0])] for k, size in enumerate(langid.SIZES) for i in range(len(t) - size + 1)]
        e = np.exp(np.mean(rows, axis=0, dtype=np.float64) + model.bias)
        assert lang == model.languages[e.argmax()] and abs(score - e.max() / e.sum()) < 1e-6


def test_ftrl_equals_the_formula():
    """A dense loop over all coordinates, one number at a time."""
    rng, features, classes = np.random.default_rng(3), 6, 3
    alpha, beta, l1, l2 = 0.5, 1.0, 0.05, 0.1
    own = langid.Ftrl(features, classes, alpha, beta, l1, l2)
    z, n = [[0.0] * classes for _ in range(features)], [[0.0] * classes for _ in range(features)]

    def weight(i, c):
        sign = np.sign(z[i][c])
        return 0.0 if abs(z[i][c]) <= l1 else -(z[i][c] - sign * l1) / ((beta + n[i][c] ** 0.5) / alpha + l2)

    for _ in range(60):
        ids = np.sort(rng.choice(features, rng.integers(1, features), replace=False))
        x, y = rng.normal(size=len(ids)), int(rng.integers(classes))
        own.step(ids, x, y)
        w = [[weight(i, c) for c in range(classes)] for i in range(features)]
        s = [sum(v * w[i][c] for i, v in zip(ids, x, strict=True)) for c in range(classes)]
        e = [np.exp(v) for v in s]
        for i, v in zip(ids, x, strict=True):
            for c in range(classes):
                g = v * (e[c] / sum(e) - (c == y))
                z[i][c] += g - ((n[i][c] + g * g) ** 0.5 - n[i][c] ** 0.5) / alpha * w[i][c]
                n[i][c] += g * g
    assert np.allclose(own.z, z) and np.allclose(own.n, n)
    assert np.allclose(own.weights(np.arange(features)), [[weight(i, c) for c in range(classes)] for i in range(features)])


def test_document_frequencies_count_all_texts(spark, monkeypatch):
    texts = [t for _, t in odd_rows()] + ["La casa", "la CASA la casa"]
    n, df = langid.document_frequencies(docs(spark, [(k, t) for k, t in enumerate(texts)]).repartition(3))
    expected = np.zeros(len(langid.SIZES) << langid.BITS)
    for t in texts:
        if t:
            expected[langid.term_frequencies(t)[0]] += 1
    assert n == sum(t is not None for t in texts) and (df == expected).all()


def test_quality_scores_equal_a_naive_average():
    rng = np.random.default_rng(4)
    tables = [rng.normal(size=1 << quality.BITS).astype(np.float32) for _ in range(quality.PAIRS + 1)]
    model = quality.QualityModel(tables, 0.3)
    texts = ["one two two three", "Ünï ©ode words", "x", "", None, "same same same " * 30]
    for t, score in zip(texts, model.score(texts), strict=True):
        t = t or ""
        grams = [tables[k][int(hashing.char_ngrams(np.array([ord(c) for c in t[i : i + size]], np.uint32), size, quality.BITS)[0])] for k, size in enumerate(quality.SIZES) for i in range(len(t) - size + 1)]
        words = [hashing.text_words([w], lower=False)[0] for w in t.split()]
        single = [tables[quality.WORDS][int(quality.word_buckets(w)[0])] for w in words]
        pairs = [tables[quality.PAIRS][int(quality.pair_buckets(np.concatenate(p))[0])] for p in zip(words, words[1:], strict=False)]
        logit = 0.3 + sum(float(np.mean(x, dtype=np.float64)) for x in (grams, single, pairs) if x)
        assert abs(score - 1 / (1 + np.exp(-logit))) < 1e-6
        ids, share = quality.features(t)
        assert abs(np.concatenate(tables)[ids] @ share + 0.3 - logit) < 1e-5


def test_quality(spark):
    texts, labels = labelled(spark, "quality", "quality")
    model = quality.fit_quality_model(texts, labels.where("id % 4 <> 0"))
    got = quality.score_quality(texts.where("id % 4 = 0"), model, "id").join(labels, "id")
    assert got.where((F.col("score") >= 0.7) == (F.col("label") == 1)).count() > 0.9 * got.count()
    odd = quality.score_quality(docs(spark, odd_rows()), model).collect()
    assert len(odd) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in odd)
    assert len({r["score"] for r in odd if r["doc_id"] in (2, 3)}) == 1
    none = quality.fit_quality_model(texts, labels.where("label = 1"))
    assert {0 <= s <= 1 for s in none.score(["a", None, ""])} == {True}
    assert quality.score_quality(docs(spark, []), model).count() == 0


def test_toxicity_scores_equal_a_naive_forward_pass():
    """Word by word, filter by filter, for a model of random weights."""
    import re

    rng, filters, rows = np.random.default_rng(5), 3, 50
    row_of = rng.integers(0, rows, 1 << toxicity.BITS).astype(np.int32)
    responses = [rng.normal(size=(w, rows + 1, filters)).astype(np.float32) for w in toxicity.WIDTHS]
    for r in responses:
        r[:, -1] = 0
    model = toxicity.ToxicityModel(row_of, responses, rng.normal(size=(len(toxicity.WIDTHS), filters)), rng.normal(size=len(toxicity.WIDTHS) * filters), 0.1, rng.normal(size=(rows + 1, 2)).astype(np.float32), np.array([0.5, -0.5]))
    model.languages[-1] = 0
    texts = ["One, two three ñandúes", "", None, "a", "longword_beginnings and übergrößenträger again " * 20]
    got = model.score(texts)

    def mean_of(word):
        whole = word.encode()
        parts = [whole]
        for most in toxicity.PREFIXES:
            cut = min(most, len(whole))
            while 0 < cut < len(whole) and whole[cut] & 0xC0 == 0x80:
                cut -= 1
            parts.append(whole[:cut])
        buckets = []
        for k, x in enumerate(parts):
            data = np.frombuffer(x, np.uint8)
            h = hashing.word_hashes(data, np.array([0]), np.array([len(x)]))
            h = h if not k else hashing.mix(h + np.uint64(toxicity.PREFIXES[k - 1]))
            buckets.append(int(h[0] >> np.uint64(64 - toxicity.BITS)))
        return [int(row_of[b]) for b in buckets]

    for t, score in zip(texts, got, strict=True):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        words = [mean_of(w) for w in re.findall(r"[0-9a-z\u0080-\U0010ffff]+", low)]
        places = words + [[rows] * toxicity.KINDS] * toxicity.PAD
        if not words:
            places = [[rows] * toxicity.KINDS] * (toxicity.PAD + 1)
        hidden = []
        for k, width in enumerate(toxicity.WIDTHS):
            for f in range(filters):
                best = max(sum(float(responses[k][j][r][f]) for j in range(width) for r in places[i + j]) for i in range(max(1, len(words))))
                hidden.append(max(0.0, best + float(model.filter_bias[k][f])))
        logit = sum(h * o for h, o in zip(hidden, model.out.tolist(), strict=True)) + 0.1
        guess = sum((model.languages[w[0]] for w in words), np.zeros(2)).argmax()
        assert abs(score - 1 / (1 + np.exp(-(logit - model.thresholds[guess])))) < 1e-4


def test_samples_do_not_depend_on_how_rows_are_dealt(spark):
    """Repeated ids with different texts and labels; a rare group has rows too."""
    rows = [(k % 900, f"text {k}", int(k % 10 == 0), "rare" if k % 50 == 0 else "common") for k in range(1000)]
    df = spark.createDataFrame(rows, "id long, text string, label int, group string")
    found = []
    for n in (1, 7):
        dealt = df.repartition(n, "text")
        found.append(sampling.labelled_sample(dealt.select("id", "text"), dealt.select("id", "label", "group"), 40, by_group=True))
    assert found[0] == found[1]
    sample, counts = found[0]
    assert counts == {0: 900, 1: 100} and sum(g == "rare" for _, _, g in sample) >= 8 and len(sample) <= 120


def many_languages(spark):
    """2,000 languages of two texts, and one that holds most rows; each text has a word of its language's own."""
    rows = [(k, f"wort{k % 2000:04d}x the text {k}", k % 2, f"l{k % 2000}") for k in range(4000)] + [(10_000 + k, f"plain common words {k}", int(k % 7 == 0), "big") for k in range(3000)]
    return spark.createDataFrame(rows, "id long, text string, label int, group string")


def test_many_languages(spark):
    df = many_languages(spark)
    sample, counts = sampling.labelled_sample(df.select("id", "text"), df.select("id", "label", "group"), 500, by_group=True)
    assert counts == {label: df.where(f"label = {label}").count() for label in (0, 1)} and 400 < len(sample) <= 2 * 1.5 * 1.2 * 500
    model = toxicity.fit_toxicity_model(df.select("id", "text"), df.select("id", "label", "group"), per_label=300, epochs=1, least_steps=0)
    assert model.languages.shape[1] <= 65 and len(model.score(["plain words", None])) == 2
    known = df.select("id", F.col("group").alias("label"))
    few, _ = sampling.labelled_sample(df.select("id", "text"), known.select("id", "label", F.lit("").alias("group")), 400, most_rows=2_000)
    assert 1_000 < len(few) <= 2_500
    model = langid.fit_language_model(df.select("id", "text"), known, most_rows=600, epochs=1)
    assert 300 < len(model.languages) <= 800 and (len(langid.SIZES) * len(model.tables[0])) * len(model.languages) <= langid.MOST_WEIGHTS
    assert langid.predict_languages(docs(spark, odd_rows()), model).count() == len(odd_rows())


def test_quotas_that_are_too_many_to_broadcast(spark, monkeypatch):
    df = many_languages(spark)
    first = sampling.labelled_sample(df.select("id", "text"), df.select("id", "label", "group"), 300, by_group=True)
    monkeypatch.setattr(sampling, "FEW_KINDS", 10)
    assert sampling.labelled_sample(df.select("id", "text"), df.select("id", "label", "group"), 300, by_group=True) == first


def test_toxicity(spark):
    # sf0.01 has 51 toxic rows, too few to learn ten words in four languages from
    texts, labels = labelled(spark, "toxic", "toxic", "/root/testdata/sf0.1")
    model = toxicity.fit_toxicity_model(texts, labels.where("id % 4 <> 0"))
    got = toxicity.score_toxicity(texts.where("id % 4 = 0"), model, "id").join(labels, "id")
    assert got.where((F.col("score") >= 0.5) == (F.col("label") == 1)).count() > 0.96 * got.count()
    odd = toxicity.score_toxicity(docs(spark, odd_rows()), model).collect()
    assert len(odd) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in odd)
    assert toxicity.score_toxicity(docs(spark, []), model).count() == 0
    # one text scores alike alone, in company and convolved in pieces
    text = [t for t, in texts.orderBy("id").select("text").limit(40).collect()]
    whole = model.score(text)
    assert np.allclose(whole, [model.score([t])[0] for t in text], atol=1e-6)
    words, toxicity.WORDS = toxicity.WORDS, 57
    assert np.allclose(whole, model.score(text), atol=1e-6)
    toxicity.WORDS = words
    assert len(toxicity.fit_toxicity_model(texts.where("false"), labels.where("false")).score(["a", None])) == 2


# 11: ranked search ---------------------------------------------------------------------------------------------------


def plain_search(rows, items, best):
    """(item, rank, id, score) from words in Python dictionaries."""
    import math
    import re

    def terms(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", low)

    bags = [(i, terms(t)) for i, t in rows]
    n, total = sum(bool(b) for _, b in bags), sum(len(b) for _, b in bags)
    out = []
    for item, text in items:
        found = []
        for i, bag in bags:
            score = 0
            for w in terms(text):
                if w in bag:
                    df = sum(w in b for _, b in bags)
                    m = 75 + 25 * len(bag) * n // total
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * (1_000_000_000 * bag.count(w) // (1000 * bag.count(w) + 12 * m))
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(found)[:best])]
    return sorted(out, key=str)


def test_ranked_search(spark, monkeypatch):
    rng = random.Random(11)
    vocabulary = [*"abcdefgh", "Été", "日本", "x1", "averylongtermofmorethaneight", "averylongtermofmorethaneighT2"]
    rows = [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 30)))) for k in range(150)] + [(1000 + k, "a b, same-text é") for k in range(40)]
    rows += [(None, "a b c"), (None, "a b c"), (7, "h h h"), (7, "h h h"), (3000, None), (3001, ""), (3002, "--- ..."), (3003, "a " * 5000 + "unique\x01end")]
    items = [(1, "a B"), (2, "h h é x1"), (3, "averylongtermofmorethaneight 日本!"), (4, "nowhere"), (5, None), (6, "..."), (None, "unique END b"), (2, "z larger text that does not count")]
    expected = plain_search(rows, [(i, t) for i, t in items if t != "z larger text that does not count"], 20)
    queries = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    for limits in ({}, {"SPAN": 50, "CELLS": 16, "ENTRIES": 3, "BLOCK_CHARS": 300}):
        for name, value in limits.items():
            monkeypatch.setattr(lexical, name, value)
        got = lexical.ranked_search(docs(spark, rows).repartition(5), queries)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=str) == expected
    odd = lexical.ranked_search(docs(spark, odd_rows()), spark.createDataFrame([(1, "one"), (2, "w5 日本語")], "item_id long, text string")).collect()
    assert {(r["item_id"], r["doc_id"]) for r in odd} == {(1, 1), (1, 4), (2, 7), (2, 8)} and sum(r["item_id"] == 1 for r in odd) == 3
    assert lexical.ranked_search(docs(spark, []), queries).count() == 0
    assert lexical.ranked_search(docs(spark, rows), queries.where("false")).count() == 0


def test_search_compares_terms_of_equal_hash(spark, monkeypatch):
    """Words are told apart by their bytes, also where hashes say that they are equal."""
    index = lexical.Index.of([1], ["abcdefghijkl"])
    monkeypatch.setattr(lexical, "word_hashes", lambda data, begin, end: np.full(len(begin), index.hashes[0]))
    doc, _, n, length = index.counts(["abcdefghijkl abcdefghijkm abcdefgh other abcdefghijkl"])
    assert n.tolist() == [2] and doc.tolist() == [0] and length.tolist() == [5]


# 12: pieces ----------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def piece_model():
    return pieces.PieceModel(pieces.default_path())


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.one_of(st.text(max_size=40), st.text(alphabet="ab \n▁é日<0x41>.,  ", max_size=60)), max_size=4))
def test_pieces_equal_the_library(piece_model, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    for t, ids in zip(texts, piece_model.encode(texts), strict=True):
        ids = np.frombuffer(ids, pieces.ID)
        assert ids.tolist() == piece_model.library.encode(t)
        assert piece_model.decode(ids) == piece_model.library.decode(ids.tolist())


def test_pieces_of_long_texts_and_small_tables(piece_model, monkeypatch):
    texts = [" " * 3000, "ab" * 2000, "日本語" * 900, " " * 777 + "x" + " " * 9000 + "the end", "a b" * 4000, "the cat " * 30 + "\x00\ufeff", "", None]
    expected = [piece_model.library.encode(t or "") for t in texts]
    for span, most, kept in ((500_000, 150_000, 48), (100, 5, 3)):
        monkeypatch.setattr(pieces, "SPAN", span)
        monkeypatch.setattr(pieces, "MOST_CHUNKS", most)
        monkeypatch.setattr(pieces, "MOST_KEPT", kept)
        piece_model.clear()
        assert [np.frombuffer(x, pieces.ID).tolist() for x in piece_model.encode(texts)] == expected
        assert all(len(c) <= kept for c in piece_model)


@settings(max_examples=200, deadline=None)
@given(ids=st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 300)), max_size=8))
def test_any_ids_decode_as_in_the_library(piece_model, ids):
    assert piece_model.decode(np.array(ids, np.int64)) == piece_model.library.decode(ids)


def test_a_model_whose_pieces_cross_markers(piece_model, monkeypatch):
    monkeypatch.setattr(piece_model, "crosses", True)
    piece_model.clear()
    for t in ("a b  c", " ", "x" * 100 + " y"):
        assert np.frombuffer(piece_model.encode([t])[0], pieces.ID).tolist() == piece_model.library.encode(t)
    piece_model.clear()


def test_piece_rows(spark, piece_model):
    rows = odd_rows()
    encoded = pieces.piece_encode(docs(spark, rows))
    assert encoded.columns == ["doc_id", "n_tokens", "ids"]
    found = pieces.piece_decode(encoded).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["decoded"]) for r in found) == sorted((str(i), len(piece_model.library.encode(t or "")), t or "") for i, t in rows)
    own = spark.createDataFrame([(1, [264, None, 287], "clash"), (2, None, "x"), (3, [], None)], "k long, ids array<int>, decoded string")
    assert {r["k"]: r["decoded"] for r in pieces.piece_decode(own).collect()} == {1: "a b", 2: "", 3: ""}
    assert {r["k"]: r["ids"] for r in pieces.piece_decode(own, out_col="ids").collect()} == {1: "a b", 2: "", 3: ""}
    assert pieces.piece_encode(docs(spark, [])).count() == 0


# 13: centroids -------------------------------------------------------------------------------------------------------


def plain_clusters(rows, k, dim, rounds):
    """(id, cluster, distance, inertia of the cluster, inertia, hash) by scanning all centroids each time."""
    import math

    kept = [(i, [max(-centroids.LARGEST, min(centroids.LARGEST, math.floor(64.0 * x))) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    points = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(points))

    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        points = [[sum(x) // len(own) for x in zip(*own, strict=True)] if (own := [v for (_, v), a in zip(kept, at, strict=True) if a == n]) else c for n, c in enumerate(points)]
    found = [(i, *nearest(v)) for i, v in kept]
    total = {n: sum(d for _, d, m in found if m == n) for n in range(len(points))}
    return sorted(((i, n, d, total[n], sum(total.values()), hashlib.sha256(",".join(map(str, points[n])).encode()).hexdigest()) for i, d, n in found), key=str)


@pytest.mark.parametrize("rounds", [0, 1, 6])
def test_clusters_equal_a_plain_computation(spark, monkeypatch, rounds):
    rng = random.Random(13)
    nan, inf = float("nan"), float("inf")
    rows = [(k, [rng.choice([-1.0, 0.0, 0.26]) + rng.gauss(0, 0.2) for _ in range(4)]) for k in range(300)]
    rows += [(1000 + k, [0.5, 0.5, -0.5, 0.25]) for k in range(60)]  # ties and equal vectors, centroids among them
    rows += [(5, [0.1] * 4), (5, [0.1] * 4), (None, [0.2] * 4), (None, [0.3] * 4), (400, None), (401, []), (402, [0.1] * 3), (403, [0.1] * 5), (404, [nan, 0.0, 0.0, 0.0]), (405, [0.0, inf, 0.0, 0.0]), (406, [0.0, None, 0.0, 0.0]), (407, [3e6, -3e6, 0.0, -0.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, cluster string, distance int").repartition(3)
    expected = plain_clusters(rows, 12, 4, rounds)
    for size in (4096, 7):
        monkeypatch.setattr(centroids, "BLOCK_ROWS", size)
        got = centroids.cluster_vectors(df, k=12, dim=4, rounds=rounds)
        assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert sorted(map(tuple, got.collect()), key=str) == expected
    for some in (rows[:1], rows[:5], [(400, None)], []):
        few = spark.createDataFrame(some, "vec_id long, embedding array<float>")
        exact = [(i, [float(np.float32(x)) for x in v] if v else v) for i, v in some]
        assert sorted(map(tuple, centroids.cluster_vectors(few, k=12, dim=4, rounds=rounds).collect()), key=str) == plain_clusters(exact, 12, 4, rounds)


def test_heaps_spare_vectors_whose_gap_holds():
    """Only vectors whose gap the drift has used up are measured; all others are as a full scan would have them."""
    rng = np.random.default_rng(4)
    v = np.concatenate([rng.normal(m, 3, (200, 8)) for m in (-40, 0, 40)]).astype(np.int64)
    row = {"ids": np.arange(600, dtype="<i8").tobytes(), "null_ids": np.packbits(np.zeros(600, bool)).tobytes(), "vectors": centroids.narrow(v), "clusters": np.full(600, -1, "<i4").tobytes(), "keys": b"", "members": b"", "sizes": []}
    block, points, drift = centroids.Block(row, 8, 3), np.array([[-38] * 8, [1] * 8, [41] * 8]), [0.0, 0.0, 0.0]
    block.scan(np.arange(600), points, drift)
    again = centroids.Block(row | block.state(), 8, 3)
    assert all(h[k] <= min(h[2 * k + 1 : 2 * k + 3], default=h[k]) for h in again.heaps for k in range(len(h)))
    assert again.expired([1.0, 1.0, 1.0]) == [] and len(again.expired([200.0, 0.0, 0.0])) == len(np.flatnonzero(again.clusters == 0))
