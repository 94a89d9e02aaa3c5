"""From captured responses to notes: what a run does, and what it would do."""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import normalize_url
from ..tables import materialize
from ..operators.content import with_content
from ..operators.dedupe import first_seen
from ..operators.delta import cap_per_group, new_rows, with_known_flag
from ..operators.enrich import Endpoint, Schedule, counts, dead_letters, enrich
from ..operators.frontier import before_known_sequence
from ..schemas import BOOKMARK
from ..sources.feeds import bookmarks_from_posts, bookmarks_from_statuses, post_elements, posts, statuses
from .render import notes


@dataclass
class Options:
    """What a run is told. ``sources`` not named are never read; without ``most_per_source`` there is no limit."""

    sources: tuple[str, ...] = ("x", "linkedin")
    stop_after_known: int = 0
    most_per_source: int | None = 500


def bookmarks(responses: DataFrame, options: Options, now: Column, columns: list[str] | None = None) -> DataFrame:
    """(norm_url, order, bookmark columns): each address once, as first seen, in the order of the feed.

    With ``columns`` only those bookmark columns are read from the bodies."""
    parts = []
    if "x" in options.sources:
        rows = bookmarks_from_statuses(statuses(responses.where(F.col("source") == "x")), now)
        parts.append(rows.withColumn("place", F.struct(F.col("position.step").alias("step"), F.col("position.place").alias("place"))).drop("position"))
    if "linkedin" in options.sources:
        wanted = columns is None or bool({"external_urls", "image_urls"} & set(columns))
        rows = bookmarks_from_posts(posts(post_elements(responses.where(F.col("source") == "linkedin")), wanted), now)
        parts.append(rows.withColumn("place", F.struct(F.lit(0).alias("step"), F.col("position").alias("place"))).drop("position"))
    if not parts:
        none = responses.sparkSession.createDataFrame([], BOOKMARK)
        return none.select(F.lit("").alias("norm_url"), "*", F.struct(F.lit(0).cast("long").alias("seq"), F.lit(0).alias("step"), F.lit(0).alias("place")).alias("order"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out if columns is None else out.select("seq", "place", *dict.fromkeys(["url", *columns]))
    keyed = out.withColumn("norm_url", normalize_url(F.col("url"))).withColumn("order", F.struct("seq", F.col("place.step").alias("step"), F.col("place.place").alias("place")))
    return first_seen(keyed, "norm_url", "order").drop("seq", "place")


def new_bookmarks(responses: DataFrame, known: DataFrame, options: Options, now: Column, columns: list[str] | None = None) -> DataFrame:
    """Bookmarks that are not in ``known(norm_url)``, before the feed reaches what is known, capped for each source."""
    seen = with_known_flag(bookmarks(responses, options, now, columns), known, "norm_url")
    fresh = before_known_sequence(seen, "source", "order", "is_known", options.stop_after_known).drop("is_known")
    unknown = new_rows(fresh, known, "norm_url")
    return unknown if options.most_per_source is None else cap_per_group(unknown, "source", [F.col("order")], options.most_per_source)


def would_process(responses: DataFrame, known: DataFrame, options: Options, now: Column) -> DataFrame:
    """A dry run: (source, scanned, would_process), nothing is written."""
    scanned = bookmarks(responses, options, now, ["source"]).groupBy("source").agg(F.count("*").alias("scanned"))
    fresh = new_bookmarks(responses, known, options, now, ["source"]).groupBy("source").agg(F.count("*").alias("would_process"))
    return scanned.join(fresh, "source", "left").select("source", "scanned", F.coalesce("would_process", F.lit(0)).alias("would_process"))


class Processed(NamedTuple):
    """What a run made of new bookmarks, and its counts (processed, enriched, dead_letter)."""

    notes: DataFrame
    dead_letters: DataFrame
    addresses: DataFrame
    counts: dict[str, int]


def write_counted(rows: DataFrame, label: str, *metrics: Column) -> tuple[DataFrame, dict[str, int]]:
    """Rows written and read back, and metrics of them that were taken while they were written: no second pass counts them."""
    seen = Observation(label)
    done = materialize(rows.observe(seen, *metrics), label)
    return done, {k: v or 0 for k, v in seen.get.items()}


def process(fresh: DataFrame, pages: DataFrame, endpoints: list[Endpoint], now: Column, schedule: Schedule | None = None) -> Processed:
    """Notes, dead letters and processed addresses of new bookmarks.

    A row whose enrichment fails still gets its note; one whose page broke off gets none. Both are dead letters, and all are
    processed. Endpoints are asked once: their answers are written to the shared folder, and all results read them there."""
    columns = [c for c in fresh.columns if c not in ("norm_url", "order")]
    done, found = write_counted(enrich(with_content(fresh.select(*columns), pages, now), endpoints, schedule), "enriched", *counts())
    processed = done.select(normalize_url(F.col("bookmark.url")).alias("norm_url"), now.alias("first_seen"), F.col("bookmark.source").alias("source"))
    return Processed(notes(done.where("stage IS NULL OR stage <> 'processing'")), dead_letters(done, now), processed, found)


def run_result(spark: SparkSession, found: dict[str, int], cursor_x: str | None = None, cursor_linkedin: str | None = None) -> DataFrame:
    """One row: processed, enriched, dead_letter, and the cursors at which the feeds go on."""
    return spark.createDataFrame([(found["processed"], found["enriched"], found["dead_letter"], cursor_x, cursor_linkedin)], "processed long, enriched long, dead_letter long, new_cursor_x string, new_cursor_linkedin string")
