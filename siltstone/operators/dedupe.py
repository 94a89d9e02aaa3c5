"""Duplicates: first seen, groups, the richest of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import materialize
from .skew import attach, best_row


def first_seen(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key in the order of ``order``; rows with a null key are one key."""
    return best_row(df, key, F.struct(*order))


def duplicate_groups(df: DataFrame, key: str) -> DataFrame:
    """(key, n) of keys with more than one row; null keys don't count."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def path_order(path: Column) -> Column:
    """Paths compare by their components, not by their characters."""
    return F.split(path, "/")


def keep_richest(df: DataFrame, key: str, scores: list[Column], tie: Column) -> DataFrame:
    """The row of each key with the highest scores, compared from the first on; of equals the smallest ``tie``.

    Scores must be numbers or timestamps; a null score is lower than any other."""
    falling = [F.coalesce(-s.cast("double"), F.lit(float("inf"))).alias(f"s{k}") for k, s in enumerate(scores)]
    return best_row(df, key, F.struct(*falling, tie.alias("tie")))


NOTE_SCORES = ["has_enrichment", "has_sidecar", "richness", "bytes", "modified"]


def keep_richest_notes(notes: DataFrame) -> DataFrame:
    """Of notes (``sources.notes.notes_with_sidecars``) with one address the richest."""
    scores = [F.unix_micros(c) if c == "modified" else F.col(c) for c in NOTE_SCORES]
    return keep_richest(notes, "norm_url", scores, path_order(F.col("path")))


def note_score() -> Column:
    """What ranks a note, as one value: enrichment, sidecar, richness, bytes, whole seconds since 1970."""
    return F.struct(*[(F.unix_seconds(c) if c == "modified" else F.col(c).cast("long")).alias(c) for c in NOTE_SCORES])


def dedupe_report(notes: DataFrame) -> DataFrame:
    """(norm_url, kept, kept_score, moved, moved_score), ordered by address and path: a row for each note that has to
    give way to the richest of its address."""
    kept = keep_richest_notes(notes).select("norm_url", F.col("path").alias("kept"), note_score().alias("kept_score"))
    sizes = notes.groupBy("norm_url").agg(F.count("*").alias("rows_of_key")).where("rows_of_key > 1")
    several = attach(notes.select("norm_url", "path", note_score().alias("moved_score")), "norm_url", materialize(sizes.join(kept, "norm_url"), "kept-notes"))
    return several.where(F.col("path") != F.col("kept")).select("norm_url", "kept", "kept_score", F.col("path").alias("moved"), "moved_score").orderBy("norm_url", path_order(F.col("moved")))


def dedupe_summary(notes: DataFrame) -> DataFrame:
    """One row: notes scanned, addresses with several notes, notes to move."""
    groups = notes.groupBy("norm_url").agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("scanned"), F.count_if(F.col("n") > 1).alias("duplicate_groups"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).alias("moved"))
