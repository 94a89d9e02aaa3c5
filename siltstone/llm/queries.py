"""Queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .bpe import bpe_encode
from .centroids import cluster_vectors
from .common import held_out, table
from .decontam import find_leaks
from .idfiles import read_token_files, write_token_files
from .jaccard import near_duplicates
from .langid import fit_language_model, predict_languages
from .lexical import ranked_search
from .media import read_media, store_media
from .passages import remove_repeats
from .pieces import piece_decode, piece_encode
from .quality import fit_quality_model, score_quality
from .toxicity import fit_toxicity_model, score_toxicity
from .warc import read_warc, write_warc


def learnable(spark: SparkSession, sf_dir: str, label: str, folds: int, fold: int) -> tuple[DataFrame, DataFrame]:
    """texts(id, text) and labels(id, label, group) of documents outside the held-out fold. Repeated labels count once."""
    docs = table(spark, sf_dir, "documents").where(~held_out("doc_id", folds, fold)).withColumnRenamed("doc_id", "id")
    labels = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("id")).agg(F.max(label).cast("int").alias("label"))
    return docs.select("id", "text"), docs.select("id", F.col("lang").alias("group")).join(labels, "id").select("id", "label", "group")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fit_toxicity_model(*learnable(spark, sf_dir, "toxic", 5, 0))
    scored = score_toxicity(table(spark, sf_dir, "documents"), model)
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = read_warc(write_warc(table(spark, sf_dir, "pages")))
    last = chunks.where(F.col("chunk_no") == F.col("n_chunks") - 1)
    # for a response, the digest is the one carried along the chunks that were read back
    digest = F.when(F.col("record_type") == "response", F.col("running_digest")).otherwise(F.col("payload_digest"))
    return last.select(F.col("record_id").alias("page_id"), "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to")


def language_model(docs: DataFrame):
    known = docs.where(~held_out("doc_id", 5, 0) & F.col("lang").isNotNull()).select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("label"))
    return fit_language_model(known.select("id", "text"), known.select("id", "label"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = predict_languages(docs, language_model(docs))
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score")


def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe_encode(table(spark, sf_dir, "documents"), decoded_col="decoded")
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_media(*store_media(table(spark, sf_dir, "documents")))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = write_token_files(table(spark, sf_dir, "documents"))
    return read_token_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fit_quality_model(*learnable(spark, sf_dir, "quality", 4, 2))
    scored = score_quality(table(spark, sf_dir, "documents"), model)
    return scored.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = piece_decode(piece_encode(table(spark, sf_dir, "documents")))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary")
    return decoded.select("doc_id", "n_tokens", F.sha2(ids, 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_warc, op3_language_id, op4_passages, op5_decontamination, op6_jaccard_join, op7_bpe, op8_media, op9_token_files, op10_quality, op11_search, op12_pieces, op13_centroids)}


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": oracles.WARC, "op4_passages": oracles.PASSAGES, "op5_decontamination": oracles.LEAKS, "op6_jaccard_join": oracles.JACCARD, "op11_search": oracles.SEARCH, "op13_centroids": oracles.CENTROIDS}
