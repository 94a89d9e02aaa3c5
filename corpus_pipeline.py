"""A training corpus from raw documents: each stage calls one operator and works on all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.bpe import bpe_encode
from siltstone.llm.common import materialize, table
from siltstone.llm.decontam import find_leaks
from siltstone.llm.jaccard import near_duplicates
from siltstone.llm.langid import keep_identified
from siltstone.llm.passages import remove_repeats
from siltstone.llm.queries import language_model
from siltstone.llm.repeats import once, without

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Two hashes of id and text tell rows apart, also where ids repeat or are null.
ROW_KEY = ["row_key", "row_check"]


def with_row_key(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS, F.xxhash64("doc_id", "text").alias("row_key"), F.xxhash64("text", "doc_id", F.lit(1)).alias("row_check"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, null and empty texts among them, and those whose best language has a score under 0.3."""
    docs = docs.select(*COLUMNS)
    return keep_identified(docs, language_model(docs))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays: that with the smallest id (null ids last), of rows with one id and
    different texts one of them, of equal rows one. Texts without words are in no group."""
    docs = with_row_key(docs)
    groups = materialize(near_duplicates(docs, row_key=ROW_KEY), "pipeline-groups")
    again = groups.where("leads AND n_shingles > 0").groupBy(*ROW_KEY).agg(F.count("*").alias("n")).where("n > 1")
    return once(docs, ROW_KEY, materialize(again, "pipeline-repeated"), groups.where("NOT leads").select(*ROW_KEY)).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that a document with a smaller id has go; texts are the words that stay, ``n_chars`` their length.

    Rows without an id neither lose words nor make others lose any; a null text comes out empty."""
    kept = remove_repeats(docs.select(*COLUMNS), carry=["lang", "source"])
    return kept.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold 0.8 or more of a benchmark item go; other rows with the same id stay."""
    docs = with_row_key(docs)
    leaks = materialize(find_leaks(docs, table(spark, sf_dir, "benchmark"), id_col="row_key"), "pipeline-leaks")
    return without(docs, ["row_key"], leaks.select("row_key")).select(*COLUMNS)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers), and the SHA-256 of what they decode to; an empty text has no ids."""
    decoded = bpe_encode(docs.select("doc_id", "text"), decoded_col="decoded")
    return decoded.select("doc_id", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("jaccard_join", jaccard_join),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("bpe", bpe),
]

#: SQL can express neither the language model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
