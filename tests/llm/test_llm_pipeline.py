"""The corpus pipeline and the registered queries."""

import hashlib
import struct
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from siltstone.llm import bpe, media, pieces, queries, repeats

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in docs.orderBy("doc_id").collect()]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    base = rows[3][1].split()
    passage = " ".join(f"planted{k}" for k in range(60))
    own, other = (" ".join(f"{w}{k}" for k in range(40)) for w in ("own", "other"))
    planted = [(9001, rows[3][1]), (9002, " ".join([*base[:-1], "edited"])), (9003, None), (9004, ""), (9005, "12 34 $$"), (9006, f"clean start here {item} and the end of it"), (9007, f"{own} {passage} with its own end"), (9008, f"another opening {passage} quite {other} tail"), (9009, "a clean and simple document of the language that is known here")]
    before = spark.createDataFrame([*rows, *((i, t, "en", "src0", len(t or "")) for i, t in planted)], docs.schema)
    stages = dict(corpus_pipeline.STAGES)
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        before = corpus_pipeline.materialize(stage(spark, before, SF), name)
        after[name] = {r["doc_id"]: r for r in before.collect()}
        if name != "bpe":
            assert before.columns == corpus_pipeline.COLUMNS
    assert len(stages) == 5
    assert not {9003, 9004, 9005} & set(after["language_id"]) and {9001, 9006, 9009} <= set(after["language_id"])
    assert not {9001, 9002} & set(after["jaccard_join"]) and {3, 9007, 9008} <= set(after["jaccard_join"])
    assert after["substring_dedup"][9007]["text"] == f"{own} {passage} with its own end"
    assert after["substring_dedup"][9008]["text"] == f"another opening quite {other} tail"
    assert after["substring_dedup"][9008]["n_chars"] == len(f"another opening quite {other} tail")
    assert 9006 not in after["decontamination"] and {9007, 9009} <= set(after["decontamination"])
    assert set(after["bpe"]) == set(after["decontamination"]) and after["bpe"][9009]["n_tokens"] > 5


def python_steps(plan, above: int = 0) -> int:
    """The most Python steps that one task of the plan runs at once: each is a worker process."""
    name, children = plan.nodeName(), plan.children()
    if name == "AdaptiveSparkPlan":
        return python_steps(plan.executedPlan(), above)
    here = 0 if "Exchange" in name else above + (name in ("MapInArrow", "ArrowEvalPython"))
    return max([here, *(python_steps(children.apply(i), here) for i in range(children.size()))])


def test_a_task_of_the_pipeline_has_one_python_worker(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert python_steps(docs._jdf.queryExecution().executedPlan()) == 1, name
        docs = corpus_pipeline.materialize(docs, name)
    assert python_steps(queries.op7_bpe(spark, SF)._jdf.queryExecution().executedPlan()) == 1


def test_stages_on_odd_rows(spark):
    """Ids that repeat or are null, equal rows, long texts, nulls in all columns, and columns with names of the operators' own."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    good = "this is the text of a document that has its own words and stays " + " ".join(f"stay{k}" for k in range(30))
    copy = "these are other words of a text that several rows have in common here " + " ".join(f"copy{k}" for k in range(60))
    long = " ".join(f"the{k % 977}" for k in range(60_000))
    rows = [(1, good), (1, copy), (2, copy), (2, copy), (None, copy), (3, good.replace("stay", "other")), (3, f"leak {item} leak"), (None, "some words without an id that are no copy"), (None, None), (4, None), (5, ""), (6, long), (6, long), (7, "one two"), (7, "three four")]
    df = spark.createDataFrame([(i, t, None, None, None, 1, 1, "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, row_key int, key int, doc string")
    stages = dict(corpus_pipeline.STAGES)
    once = stages["jaccard_join"](spark, df, SF)
    assert once.columns == corpus_pipeline.COLUMNS
    kept = sorted(((r["doc_id"], r["text"]) for r in once.collect()), key=str)
    # equal texts: the row with the smallest id stays, once; texts without words are in no group
    assert kept == sorted([(1, good), (1, copy), (3, good.replace("stay", "other")), (3, f"leak {item} leak"), (None, "some words without an id that are no copy"), (None, None), (4, None), (5, ""), (6, long), (7, "one two"), (7, "three four")], key=str)
    left = stages["decontamination"](spark, df, SF).collect()
    assert len(left) == len(rows) - 1 and not any("leak" in (r["text"] or "") for r in left)
    cut = stages["substring_dedup"](spark, df, SF)
    assert cut.columns == corpus_pipeline.COLUMNS and cut.count() == len(rows)
    assert stages["bpe"](spark, df, SF).count() == len(rows)
    # without rows to learn from, no language is known and nothing is identified
    assert stages["language_id"](spark, df, SF).count() == 0


def test_stages_without_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), name)
        assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    found = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    expected = sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in found.fetchall())
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == expected


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))  # rows of documents, all of them
def test_query_has_a_row_for_each_document(spark, name):
    df = queries.queries()[name](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert df.count() == df.select("doc_id").distinct().count() == docs.count()


@pytest.mark.parametrize("name", ["op4_passages", "op6_jaccard_join", "op8_media"])
def test_results_do_not_depend_on_the_filter(spark, name, monkeypatch):
    """Beyond what a filter can hold there is none, and all rows are joined: the same rows come out."""
    row = lambda df: sorted(repr(r) for r in df.collect())
    first = row(queries.queries()[name](spark, SF))
    built = []

    def none(cls, keys):
        built.append(keys.columns)
        return cls(None)

    monkeypatch.setattr(repeats.KeyFilter, "build", classmethod(none))
    assert row(queries.queries()[name](spark, SF)) == first and built


def test_stages_do_not_depend_on_the_filter(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    found = []
    for off in (False, True):
        if off:
            monkeypatch.setattr(repeats.KeyFilter, "build", classmethod(lambda cls, keys: cls(None)))
        found.append([sorted(repr(r) for r in stages[name](spark, docs, SF).collect()) for name in ("jaccard_join", "decontamination")])
    assert found[0] == found[1]


def rows_of(spark, name, *columns):
    return sorted((tuple(r[c] for c in columns) for r in queries.queries()[name](spark, SF).collect()), key=str)


def test_tokens_equal_the_library(spark):
    """op7 and op9 row by row, from the library alone."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_path())
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    seven, nine, at = [], [], 0
    for r in docs:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        seven.append((r["doc_id"], len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
        nine.append((r["doc_id"], at, len(ids) + 1, zlib.crc32(raw + np.array([2], "<u4").tobytes())))
        at += len(ids) + 1
    assert rows_of(spark, "op7_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(seven, key=str)
    assert rows_of(spark, "op9_token_files", "doc_id", "start", "n_tokens", "ids_crc32") == sorted(nine, key=str)


def test_pieces_equal_the_library(spark):
    """op12 row by row, from the library alone."""
    library = pieces.PieceModel(pieces.default_path()).library
    expected = []
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode(r["text"] or "")
        expected.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert rows_of(spark, "op12_pieces", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=str)


@pytest.mark.parametrize(("name", "label", "folds", "fold", "least", "accuracy"), [("op1_toxicity", "toxic", 5, 0, 0.5, 0.96), ("op10_quality", "quality", 4, 2, 0.7, 0.93), ("op3_language_id", "lang", 5, 0, None, 0.97)])
def test_classifiers_on_the_rows_held_out(spark, name, label, folds, fold, least, accuracy):
    """The registered queries on their own split: which rows are held out, what is predicted, and how often it is right."""
    sf = "/root/testdata/sf0.1"
    got = queries.queries()[name](spark, sf).collect()
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    truth = docs if label == "lang" else {r["doc_id"]: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == fold) and 0 <= r["score"] <= 1 for r in got) and len(got) == len(docs)
    if least:
        assert all(r["predicted"] == int(r["score"] >= least) for r in got)
    right = [(r["lang_pred"] if label == "lang" else int(r["score"] >= 0.5)) == truth[r["doc_id"]] for r in got if r["held_out"] and truth.get(r["doc_id"]) is not None]
    assert len(right) > 100 and sum(right) > accuracy * len(right), sum(right) / len(right)


def test_media_equal_a_plain_computation(spark):
    expected = []
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        raw = (r["text"] or "").encode()
        p = raw + b" " * (-len(raw) % 192 or (0 if raw else 192))
        wav = b"RIFF" + struct.pack("<I", 36 + len(p)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 8000, 8000, 1, 8) + b"data" + struct.pack("<I", len(p)) + p
        crossings = sum((a < 128) != (b < 128) for a, b in zip(p, p[1:], strict=False))
        chunks, begin, h = 0, 0, 0
        for k, b in enumerate(wav):
            h = ((h << 1) + int(media.GEAR[b])) & 0xFFFFFFFF
            n = k + 1 - begin
            if (n >= media.LEAST and h >> (32 - media.MASK_BITS) == 0) or n == media.MOST:
                chunks, begin = chunks + 1, k + 1
        chunks += begin < len(wav)
        feature = f"samples={len(p)};sum={sum(p)};squares={sum(x * x for x in p)};min={min(p)};max={max(p)};crossings={crossings};chunks={chunks}"
        expected.append((r["doc_id"], len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]), len(wav), hashlib.sha256(wav).hexdigest(), feature))
    got = rows_of(spark, "op8_media", "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
    assert got == sorted(expected, key=str)
