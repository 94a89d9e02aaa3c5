"""Registered queries of the ingestion operators, and the DuckDB SQL that each must agree with."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.strings import merge_unique
from .functions.strict import normalize_url_strict
from .functions.texts import NOISE_PASSAGES, NOISE_PHRASES, accepted_article, card_text, clean_text, fallback_text, is_noise, redact_tokens, title_of
from .functions.times import epoch_time, relative_time
from .functions.urls import TRACKING_PARAMS, host, normalize_url, note_name, stable_id, status_url, valid_url
from .operators.boundary import before_known_walk
from .operators.content import thread_texts, with_content
from .operators.dedupe import dedupe_report, duplicate_groups, first_seen, keep_richest
from .operators.delta import cap_per_group, counts_with_zeros, insert_absent, known_set, new_rows, upsert, with_known_flag
from .operators.enrich import Schedule, classify_status, dead_letters, enrich, result_counts
from .operators.frontier import before_known_sequence, recent
from .plans.ingest import Options, would_process
from .plans.moves import resolve_duplicates
from .plans.render import notes
from .plans.sinks import append_dead_letters, export_raw, write_manifest, write_notes
from .schemas import CURSORS, ENRICHMENT, FRONTIERS
from .sources.captured import capture, feed_stream, offset_log
from .sources.feeds import at, bookmarks_from_pages, bookmarks_from_posts, bookmarks_from_statuses, bookmarks_from_visible_statuses, last_cursor, post_cursors, post_elements, posts, service_responses, session_holds, statuses, with_nested_links
from .sources.cards import post_rows, status_rows, thread_rows
from .sources.density import extracted_pages, html_dense_text
from .sources.files import list_files
from .sources.html import html_images, html_links, html_status, html_text, page_content
from .sources.notes import head_value, note_urls, notes_with_sidecars, read_dead_letters, read_notes, read_sidecars
from .sources.stores import add_processed, frontier_urls, load, load_processed, save_cursors, save_frontiers
from .streaming.frontier import ROCKSDB, run_in_order, save_state
from .streaming.ingest import once_per_url, run
from .tables import materialize, new_path

def now() -> Column:
    """A fixed time, so that results repeat."""
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Addresses ----------------------------------------------------------------------------------------------------------


def url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", normalize_url(F.col("url")).alias("norm_url"))


def url_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", normalize_url_strict(F.col("url")).alias("norm_url"))


def address_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses with a host in brackets, a port, a line end in the fragment, repeated and tracking parameters."""
    url = F.concat(F.lit("HTTP://me@[2001:DB8::"), "doc_id", F.lit("]:8080/p/?b=1&a="), F.coalesce("lang", F.lit("")), F.lit("&utm_source=x&b=3&c&&b#x\ny"))
    return table(spark, sf_dir, "documents").select("doc_id", normalize_url(url).alias("norm_url"))


def richest_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of pages under one canonical address the longest; of equals the smallest page_id."""
    pages = table(spark, sf_dir, "pages").select("page_id", normalize_url(F.col("url")).alias("norm_url"), F.length("html").alias("n"))
    return keep_richest(pages, "norm_url", [F.col("n")], F.col("page_id"))


def page_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return richest_pages(spark, sf_dir).groupBy(host(F.col("norm_url")).alias("host")).agg(F.count("*").alias("pages"), F.sum("n").cast("long").alias("chars"))


def page_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    source = F.when(F.col("page_id") % 2 == 0, "x").otherwise("linkedin")
    return pages.select("page_id", stable_id(source, F.col("url")).alias("stable_id"))


def note_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    title = title_of(F.col("text"), F.col("source"))
    return docs.select("doc_id", title.alias("title"), note_name(F.col("source"), F.concat(F.lit("https://example.org/"), "doc_id"), title).alias("note_name"))


# Duplicates and deltas ----------------------------------------------------------------------------------------------


def repeated_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(table(spark, sf_dir, "documents").select(F.md5(F.col("text").cast("binary")).alias("text_md5")), "text_md5")


def duplicate_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which page of each canonical address stays and which go, as a run over notes would report it."""
    pages = table(spark, sf_dir, "pages")
    rows = pages.select(
        normalize_url(F.col("url")).alias("norm_url"),
        F.format_string("pages/%08d.md", "page_id").alias("path"),
        F.lit(0).alias("has_enrichment"),
        F.lit(1).alias("has_sidecar"),
        F.length("html").alias("richness"),
        F.octet_length("html").alias("bytes"),
        F.lit("2024-01-01").cast("timestamp").alias("modified"),
    )
    return dedupe_report(rows).select("norm_url", "kept", "moved")


def first_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.concat_ws("/", F.col("user_id").cast("string"), "event_type").alias("key"), "ts", "event_id")
    return first_seen(events, "key", "ts", "event_id").select("key", "event_id")


def delta_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_rows(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


def known_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return with_known_flag(table(spark, sf_dir, "customer").select("c_custkey"), orders, "c_custkey")


def known_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return known_set(labels.select("doc_id"), docs.where("lang = 'fr'").select("doc_id"), docs.where("source = 'src3'").select("doc_id"))


def frontier_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("event_type").isin("view", "click").alias("is_known"))
    return before_known_sequence(events, "user_id", "event_id", "is_known", 2).select("event_id", "user_id")


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as feeds in which addresses come back: (event_id, user_id, url, is_known)."""
    url = F.concat_ws("/", "event_type", (F.col("event_id") * 7 % 11).cast("string"))
    return table(spark, sf_dir, "events").select("event_id", "user_id", url.alias("url"), (F.col("event_type").isin("view", "click") | (F.col("event_id") % 11 < 3)).alias("is_known"))


def frontier_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stop rule where addresses come back: one of the last 5 neither lengthens nor breaks a run."""
    return before_known_walk(event_feed(spark, sf_dir), "user_id", "event_id", "url", "is_known", 3, 5).select("event_id", "user_id")


def frontier_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent(table(spark, sf_dir, "events").select("event_id", "user_id"), "user_id", "event_id", 20)


def frontier_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rule over a stream of the events, with state in the state store; the stream ends when all is read."""
    folder = new_path(spark, "frontier")
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        rows = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("source"), F.col("event_id").alias("seq"), F.col("event_id").cast("string").alias("url"), F.col("event_type").isin("view", "click").alias("is_known"))
        run_in_order(rows, 2, folder)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    return spark.read.schema("source string, seq long, url string").parquet(f"{folder}/rows").select(F.col("seq").alias("event_id"), F.col("source").cast("long").alias("user_id"))


def frontier_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frontiers of a batch run in the store, taken over by a stream, and read back from its state into the store."""
    events, folder, store = table(spark, sf_dir, "events"), new_path(spark, "frontier"), new_path(spark, "frontiers")
    rows = events.select(F.concat(F.lit("u"), "user_id").alias("source"), F.col("event_id").alias("seq"), F.concat(F.lit("https://example.org/e/"), "event_id").alias("url"), (F.col("event_id") % 3 == 0).alias("is_known"))
    first = (F.col("user_id") % 4 == 0) | (F.col("event_id") % 2 == 0)  # the stream brings nothing of every fourth feed
    save_frontiers(rows.where(first), store, 20, now())
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        run_in_order(rows.where(~first), 2, folder, initial=load(spark, store, FRONTIERS))
        save_state(spark, f"{folder}/state", store, now())
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    return load(spark, store, FRONTIERS).select("source", F.array_join("recent_urls", " ").alias("urls"))


def rows_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return cap_per_group(docs, "source", [F.col("doc_id")], 500)


def nation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n_nationkey"))
    return counts_with_zeros(customers, "n_nationkey", table(spark, sf_dir, "nation").select("n_nationkey"))


def source_cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store of cursors after a second run: sources that it saw are replaced, others (one here) stay."""
    docs = table(spark, sf_dir, "documents")
    first = (F.col("doc_id") % 2 == 0) | (F.col("source") == "src0")
    old = docs.where(first).groupBy("source").agg(F.max("doc_id").alias("cursor"))
    new = docs.where(~first).groupBy("source").agg(F.max("doc_id").alias("cursor"))
    return upsert(old, new, "source")


def processed_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store of processed addresses after a second run: an address keeps its first entry."""
    pages = table(spark, sf_dir, "pages").select("page_id", normalize_url(F.col("url")).alias("norm_url"))
    first = pages.where("page_id % 2 = 0").groupBy("norm_url").agg(F.min("page_id").alias("first_seen"))
    second = pages.where("page_id % 2 = 1").groupBy("norm_url").agg(F.min("page_id").alias("first_seen"))
    return insert_absent(first, second, "norm_url")


# Text ---------------------------------------------------------------------------------------------------------------


def cleaned_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(clean_text(F.col("text")).cast("binary")).alias("text_md5"))


def noise_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document has a consent page's sentence put in."""
    text = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" Aceptar todas las cookies "))).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", is_noise(text).alias("is_noise"))


def chosen_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a failing first extractor leaves: the second one's text where the first has little."""
    docs = table(spark, sf_dir, "documents")
    primary = F.when(F.col("doc_id") % 4 != 0, F.substring(F.col("text"), F.lit(1), (F.col("doc_id") % 90).cast("int")))
    text = fallback_text(primary, F.col("text"))
    return docs.select("doc_id", F.length(text).alias("chars"), F.length(accepted_article(text)).alias("article_chars"))


def threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("ord"), F.col("role").alias("author"), "text")
    return thread_texts(turns, "conv_id").select("conv_id", F.md5(F.col("thread_text").cast("binary")).alias("thread_md5"))


def page_href_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    hrefs = F.regexp_extract_all("html", F.lit('href="([^"]+)"'), 1)
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(hrefs, " ").alias("hrefs"), F.size(merge_unique(hrefs)).alias("n_different"))


# Times and JSON -----------------------------------------------------------------------------------------------------


def event_ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = F.element_at(F.array(*map(F.lit, ("s", "min", "hr", "days", "wk", "months", "y"))), (F.col("event_id") % 7 + 1).cast("int"))
    text = F.concat(F.lit("seen "), F.col("event_id") % 50, F.lit(" "), unit, F.lit(" ago"))
    return table(spark, sf_dir, "events").select("event_id", F.date_format(relative_time(text, now()), "yyyy-MM-dd HH:mm:ss").alias("seen_at"))


def event_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.when(F.col("event_id") % 2 == 0, 1_700_000_000_000 + F.col("event_id") * 1000).otherwise(1_700_000_000 + F.col("event_id"))
    return table(spark, sf_dir, "events").select("event_id", F.date_format(epoch_time(number), "yyyy-MM-dd HH:mm:ss").alias("at"))


def event_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = at(F.try_parse_json("props"), ".k", "long")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.sum(k).alias("total"), F.count("*").alias("n"))


# Feeds: bodies that Spark builds from documents, read back -----------------------------------------------------------


def status_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty documents to a body, with a cursor; the address of every document is told by its source and id."""
    docs = table(spark, sf_dir, "documents")
    user = F.struct(F.struct(F.struct(F.struct(F.col("source").alias("screen_name")).alias("core")).alias("result")).alias("user_results")).alias("core")
    link = F.struct(F.concat(F.lit("https://example.org/"), "lang", F.lit("/"), "doc_id").alias("expanded_url"))
    legacy = F.struct(F.col("text").alias("full_text"), F.lit("Wed May 13 01:00:00 +0000 2026").alias("created_at"), F.struct(F.array(link).alias("urls")).alias("entities")).alias("legacy")
    result = F.struct(F.col("doc_id").cast("string").alias("rest_id"), user, legacy).alias("result")
    entry = F.struct(F.concat(F.lit("tweet-"), "doc_id").alias("entryId"), F.struct(F.struct(F.struct(result).alias("tweet_results")).alias("itemContent")).alias("content"))
    pages = docs.groupBy(F.floor(F.col("doc_id") / 20).alias("seq")).agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("entries"))
    body = F.concat(F.lit('{"data":{"user":{"bookmark_timeline":{"timeline":{"instructions":[{"type":"TimelineAddEntries","entries":'), "entries", F.lit('},{"entries":[{"entryId":"cursor-bottom-0","content":{"value":"c'), "seq", F.lit('"}}]}]}}}}}'))
    return pages.select("seq", F.lit("x").alias("source"), F.lit("https://x.com/i/api").alias("url"), F.lit(200).alias("status"), body.alias("body"))


def post_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    address = F.concat(F.lit("https://www.linkedin.com/posts/"), "source", F.lit("-activity-"), F.col("doc_id") + 1, F.lit("-abcd?utm_source=share"))
    item = F.struct(address.alias("navigationUrl"), F.struct(F.col("text").alias("text")).alias("commentary"), F.struct(F.col("source").alias("name")).alias("actor"), (1_700_000_000_000 + F.col("doc_id") * 1000).alias("createdAt"))
    pages = docs.groupBy(F.floor(F.col("doc_id") / 20).alias("seq")).agg(F.to_json(F.array_sort(F.collect_list(item))).alias("items"))
    body = F.concat(F.lit('{"data":{"data":{"cluster":{"elements":[{"items":'), "items", F.lit('}],"metadata":{"paginationToken":"t'), "seq", F.lit('"}}}}}'))
    return pages.select("seq", F.lit("linkedin").alias("source"), F.lit("https://www.linkedin.com/voyager/api").alias("url"), F.lit(200).alias("status"), body.alias("body"))


def parsed_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bookmarks_from_statuses(statuses(status_bodies(spark, sf_dir)), now())
    return rows.select("url", "title", F.md5(F.col("post_text").cast("binary")).alias("text_md5"), F.array_join("external_urls", " ").alias("links"), F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published"))


def parsed_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bookmarks_from_posts(posts(post_elements(post_bodies(spark, sf_dir))), now())
    return rows.select("url", "title", F.md5(F.col("post_text").cast("binary")).alias("text_md5"), F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published"))


def feed_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_cursor(status_bodies(spark, sf_dir))


def captured(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """What a stream over both feeds made of their pages, which came in two lots, and its checkpoint."""
    folder, out = new_path(spark, "captured"), new_path(spark, "from-feeds")
    bodies = status_bodies(spark, sf_dir).unionByName(post_bodies(spark, sf_dir))  # a lot's bodies are made when it is captured
    middle = bodies.agg(F.floor(F.max("seq") / 2)).first()[0] or 0
    for lot in (F.col("seq") <= middle, F.col("seq") > middle):
        capture(bodies.where(lot), folder)
        run(feed_stream(spark, folder), lambda pages: (bookmarks_from_pages(pages, now()), pages.where("status >= 400").select("url")), f"{out}/good", f"{out}/bad", f"{out}/log").awaitTermination()
    return spark.read.parquet(f"{out}/good"), f"{out}/log"


def streamed_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts of both feeds, read as a stream from pages that were captured."""
    rows = captured(spark, sf_dir)[0]
    return rows.select("source", "url", F.md5(F.col("post_text").cast("binary")).alias("text_md5"))


def feed_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where that stream stands: the last page and cursor of each feed."""
    return offset_log(spark, captured(spark, sf_dir)[1])


def nested_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses at several depths of a JSON object."""
    pages = table(spark, sf_dir, "pages")
    inner = F.struct(F.array(F.struct(F.col("url").alias("href")), F.struct(F.lit("https://www.linkedin.com/in/a").alias("href"))).alias("refs"))
    post = F.struct(F.concat(F.lit("see https://example.org/p/"), "page_id", F.lit(" there")).alias("text"), F.struct(inner.alias("inner")).alias("outer"))
    rows = with_nested_links(pages.select("page_id", F.parse_json(F.to_json(post)).alias("post")))
    return rows.select("page_id", F.array_join("external_urls", " ").alias("links"))


def dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run over both feeds would process if labelled documents were known."""
    bodies = status_bodies(spark, sf_dir).unionByName(post_bodies(spark, sf_dir))
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id")
    known = docs.join(labels, "doc_id").select(F.concat(F.lit("https://x.com/"), "source", F.lit("/status/"), "doc_id").alias("norm_url"))
    return would_process(bodies, known, Options(most_per_source=None), now())


# Pages and notes ----------------------------------------------------------------------------------------------------


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", clean_text(html_text(F.col("html"))).alias("text"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(html_links(F.col("html")), " ").alias("links"))


def page_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(html_images(F.col("html")), " ").alias("images"))


def page_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    counts = post_rows(pages, ["page_id"]).groupBy("page_id").agg(F.count("*").cast("int").alias("cards"))
    return pages.select("page_id").join(counts, "page_id", "left").select("page_id", F.coalesce("cards", F.lit(0)).alias("cards"))


def page_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", page_content(F.col("url"), F.col("html")).alias("c"))
    return rows.select("page_id", "c.url", "c.full_text")


def bookmark_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(bookmark, content) of documents, with texts as far as they go."""
    docs = table(spark, sf_dir, "documents")
    none = F.lit(None).cast("array<string>")
    source = F.when(F.col("doc_id") % 2 == 0, "x").otherwise("linkedin")
    url = F.concat(F.lit("https://example.org/"), "source", F.lit("/"), "doc_id")
    bookmark = F.struct(source.alias("source"), url.alias("url"), title_of(F.col("text"), F.col("source")).alias("title"), F.col("text").alias("post_text"), none.alias("external_urls"), none.alias("referenced_tweet_urls"), none.alias("image_urls"), now().alias("published_at"), F.lit(None).cast("timestamp").alias("saved_at"), now().alias("retrieved_at"))
    content = F.struct(url.alias("url"), F.col("text").alias("full_text"), F.concat(F.lit("> "), "text").alias("post_text"), F.lit("trafilatura").alias("extraction_method"), none.alias("external_urls"), none.alias("referenced_tweet_urls"), F.lit(None).cast("array<struct<url:string,text:string,image_urls:array<string>,extraction_method:string>>").alias("external_articles"), none.alias("image_urls"), now().alias("extracted_at"))
    return docs.select(bookmark.alias("bookmark"), content.alias("content"))


#: The stand-in needs no waits between tries.
AT_ONCE = Schedule(wait=0)


def answer_or_fail(prompt: str) -> str:
    """A stand-in for a model: it answers from the prompt alone and fails on one in ten."""
    import hashlib

    n = int(hashlib.md5(prompt.encode()).hexdigest()[:6], 16)
    if n % 10 == 0:
        raise ValueError("refused")
    return f"SUMMARY:\n- characters {len(prompt)}\n- code {n}\n\nTAKEAWAY: takes {n % 7}\nTAGS: A{n % 3}, b"


def enrichment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result_counts(enrich(bookmark_rows(spark, sf_dir), [("first", answer_or_fail)], AT_ONCE))


def rendered_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrich(bookmark_rows(spark, sf_dir), [("first", answer_or_fail)], AT_ONCE)
    side = F.try_parse_json("sidecar")
    return notes(rows).select("path", F.md5(F.col("text").cast("binary")).alias("text_md5"), at(side, ".enrichment.takeaway").alias("takeaway"), F.md5(at(side, ".content.full_text").cast("binary")).alias("content_md5"))


def dead_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose enrichment failed, written as JSON lines with a broken one among them, and read back."""
    rows = materialize(enrich(bookmark_rows(spark, sf_dir), [("first", answer_or_fail)], AT_ONCE), "enriched")
    path = new_path(spark, "dead")
    append_dead_letters(dead_letters(rows, now()), path)
    spark.range(1).select(F.lit('{"error": broken').alias("value")).write.mode("append").text(path)
    back = read_dead_letters(spark, path)
    return back.select("bookmark.url", "bookmark.source", F.md5(F.col("bookmark.post_text").cast("binary")).alias("text_md5"), "error", "stage", F.date_format("timestamp", "yyyy-MM-dd").alias("day"))


# Cards and pages whose HTML Spark builds from documents ----------------------------------------------------------------


def escaped(c: Column) -> Column:
    return F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def built(spark: SparkSession, sf_dir: str, *parts: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, html), with the columns ``keep`` between them: in the parts, {text}, {lang}, {source} and {id} stand for the document's values."""
    values = {"text": escaped(F.col("text")), "lang": F.col("lang"), "source": F.col("source"), "id": F.col("doc_id").cast("string")}
    pieces = re.split(r"\{(text|lang|source|id)\}", "".join(parts))
    html = F.concat(*[F.coalesce(values[x], F.lit("")) if k % 2 else F.lit(x) for k, x in enumerate(pieces)])
    return table(spark, sf_dir, "documents").select("doc_id", *keep, html.alias("html"))


def status_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = built(
        spark, sf_dir, '<main><article data-testid="tweet"><a href="/{source}/status/{id}">at</a><div data-testid="tweetText">{text}</div><time datetime="2026-05-13T01:00:00.000Z">May</time>',
        '<a href="https://example.org/{lang}/{id}">out</a><a href="https://x.com/other/status/9{id}">quoted</a><img src="https://pbs.twimg.com/media/{id}.jpg"><img src="https://a.example/profile_images/1.jpg"></article>',
        '<article><a href="/{source}/status/{id}">again</a></article><article><p>no address</p></article></main>',
    )
    rows = bookmarks_from_visible_statuses(status_rows(pages.withColumnRenamed("doc_id", "seq"), ["seq"]), now())
    lists = [F.array_join(c, " ").alias(c) for c in ("external_urls", "referenced_tweet_urls", "image_urls")]
    return rows.select("url", "title", F.md5(F.col("post_text").cast("binary")).alias("text_md5"), *lists, F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published"))


def post_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three kinds of cards: around a link to a post, an element named as an activity, a saved card without much text."""
    filler = "enough words to make of this element a card of its own, as cards have more than a few of them"
    pages = built(
        spark, sf_dir, '<body><div class="feed"><div class="one"><a href="/feed/update/urn:li:activity:7{id}">at</a><span class="update-actor"><p>{source}</p><p>View {source} profile</p></span><p>{text}</p>',
        f'<p>{filler}</p><p>3d • edited</p><img src="https://media.licdn.com/{{id}}.png"><img src="https://media.licdn.com/profile-displayphoto/1.png"></div>',
        '<div data-urn="urn:li:activity:8{id}"><a href="https://example.org/8{id}">x</a><p>named</p></div></div></body>',
    )
    cards = post_rows(pages, ["doc_id"])
    return cards.select("doc_id", "url", "author", F.md5(F.col("text").cast("binary")).alias("text_md5"), "created_text", F.array_join("image_urls", " ").alias("images"))


def dense_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles in blocks that no selector knows, between menus and asides that are longer than they are."""
    menu = '<div class="m">' + "".join(f'<p><a href="/{k}">a menu entry that leads to page number {k}</a></p>' for k in range(30)) + "</div>"
    aside = '<div class="teasers">' + "".join(f"<div><div><p>teaser {k} of others</p></div><div><p>read on</p></div></div>" for k in range(20)) + "</div>"
    body = '<div class="x"><div class="y"><h2>{lang} {id}</h2><p>{text}</p><p>' + "enough words of an article " * 30 + "</p><table><tr><th>source</th><th>id</th></tr><tr><td>{source}</td><td>{id}</td></tr></table>" + menu + "</div></div>"
    pages = built(spark, sf_dir, "<html><body>", menu, aside, body, aside, "</body></html>")
    return pages.select("doc_id", F.md5(html_dense_text(F.col("html")).cast("binary")).alias("text_md5"))


def extracted_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of posts to pages; where the first extractor finds a consent page, the second finds the article; others hold nothing."""
    docs = table(spark, sf_dir, "documents")
    consent = '<div id="c"><p>Aceptar todas las cookies</p></div>'
    body = '<div class="x"><p>{text}</p><p>' + "enough words of an article " * 20 + "</p></div>"
    kinds = [built(spark, sf_dir, "<body>", consent, body, "</body>"), built(spark, sf_dir, "<body><article><p>{text}</p><p>", "words of a known article " * 20, "</p></article></body>"), built(spark, sf_dir, "<body>", consent, "</body>")]
    html = kinds[0].where("doc_id % 3 = 0").unionByName(kinds[1].where("doc_id % 3 = 1")).unionByName(kinds[2].where("doc_id % 3 = 2"))
    address = F.concat(F.lit("https://news.example/"), "doc_id")
    pages = extracted_pages(html.select(address.alias("page_url"), "html"))
    none = F.lit(None).cast("array<string>")
    marks = docs.select(F.lit("x").alias("source"), F.concat(F.lit("https://example.org/"), "doc_id").alias("url"), F.lit("t").alias("title"), F.lit("p").alias("post_text"), F.array(address).alias("external_urls"), none.alias("referenced_tweet_urls"), none.alias("image_urls"))
    first = F.get(F.col("content.external_articles"), F.lit(0))
    return with_content(marks, pages, now()).select(F.col("bookmark.url").alias("url"), first["extraction_method"].alias("method"), F.md5(first["text"].cast("binary")).alias("text_md5"))


def status_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = built(spark, sf_dir, '<article><div data-testid="tweetText">{text}</div><p lang="{lang}">in {lang} as document {id}</p></article>')
    return pages.select("doc_id", F.md5(html_status(F.col("html")).cast("binary")).alias("text_md5"))


def post_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = built(spark, sf_dir, '<body><nav>menu</nav><main><div class="update-components-text"><p>{text}</p><div class="social-share">share</div></div>', '<div class="comments-container">c</div><p>tail words here</p></main></body>')
    rows = pages.select("doc_id", page_content(F.concat(F.lit("https://www.linkedin.com/posts/"), "doc_id"), F.col("html"), of_post=True).alias("c"))
    return rows.select("doc_id", "c.url", F.md5(F.col("c.full_text").cast("binary")).alias("text_md5"))


def post_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and pictures of a page with holders inside holders; each address once."""
    pages = built(
        spark, sf_dir, '<main><article><div dir="ltr"><span class="break-words"><a href="https://example.org/{id}">a</a><a href="https://www.linkedin.com/in/{source}">b</a></span></div><a href="/help/x">h</a>',
        '<a href="https://example.org/{lang}">c</a><a href="https://example.org/hashtag/x">d</a><img src="https://i.example/{id}.webp"><img src="https://i.example/logo.png"></article><a href="https://example.org/outside">e</a></main>',
    )
    return pages.select("doc_id", F.array_join(html_links(F.col("html")), " ").alias("links"), F.array_join(html_images(F.col("html")), " ").alias("images"))


def thread_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards of an author's thread with others between them; only the author's own count, and those that don't tell whose they are."""
    card = '<div data-testid="tweet"><div data-testid="User-Name"><a href="/{who}?s=1">n</a></div><div data-testid="tweetText">{what}</div></div>'
    parts = [card.replace("{who}", "{source}").replace("{what}", "{text}"), card.replace("{who}", "other").replace("{what}", "a reply by another one"), card.replace("{who}", "{source}").replace("{what}", "{text}")]
    pages = built(spark, sf_dir, *parts, card.replace("{who}", "{source}").replace("{what}", "in the end of {id}"), '<div data-testid="tweet"><div data-testid="tweetText">short</div></div>', keep=("source",))
    rows = thread_rows(pages.withColumn("handle", F.upper("source")), ["doc_id", "handle"])
    return thread_texts(rows, "doc_id", handle=F.col("handle")).select("doc_id", F.md5(F.col("thread_text").cast("binary")).alias("thread_md5"))


# Stores and notes ----------------------------------------------------------------------------------------------------


def stored_cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store after two runs: the first saw documents with even ids, the second those of one language or more."""
    docs, folder = table(spark, sf_dir, "documents"), new_path(spark, "cursors")
    for mode, rows in (("bootstrap", docs.where("doc_id % 2 = 0")), ("delta", docs.where("doc_id % 2 = 1"))):
        save_cursors(rows.groupBy("source").agg(F.max("doc_id").cast("string").alias("cursor")).select("source", "cursor", F.lit(mode).alias("mode"), now().alias("last_run")), folder)
    return load(spark, folder, CURSORS).select("source", "cursor", "mode")


def stored_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, folder = table(spark, sf_dir, "pages"), new_path(spark, "processed")
    first = F.timestamp_seconds(1_700_000_000 + F.col("page_id"))
    for k in (0, 1):
        add_processed(pages.where(F.col("page_id") % 2 == k).select(F.col("url").alias("norm_url"), first.alias("first_seen"), F.lit(f"run{k}").alias("source")), folder)
    return load_processed(spark, folder).select("norm_url", F.unix_seconds("first_seen").alias("first_seen"), "source")


def stored_frontiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, folder = table(spark, sf_dir, "events"), new_path(spark, "frontiers")
    rows = events.select(F.col("user_id").cast("string").alias("source"), F.col("event_id").alias("seq"), F.concat(F.lit("https://example.org/"), "event_type", F.lit("/"), "event_id", F.lit("/?utm_source=x")).alias("url"))
    save_frontiers(rows, folder, 20, now())
    return frontier_urls(spark, folder)


def note_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes written as files, with their sidecars, and read back with what ranks them."""
    folder = new_path(spark, "notes")
    rows = bookmark_rows(spark, sf_dir).withColumn("enrichment", F.lit(None).cast(ENRICHMENT))
    write_notes(notes(rows), folder)
    found = read_notes(spark, folder).withColumns({"text_md5": F.md5(F.col("text").cast("binary")), "source": head_value(F.col("text"), "source")})
    read = notes_with_sidecars(found, read_sidecars(spark, folder))
    return read.select("norm_url", F.regexp_extract("path", "([^/]+/[^/]+)$", 1).alias("path"), "has_enrichment", "has_sidecar", "richness", "text_md5", "source")


def vault_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What notes in a folder say is known already."""
    folder = new_path(spark, "vault")
    rows = table(spark, sf_dir, "pages").select(F.concat(F.lit("---\nsource: x\nurl: '"), "url", F.lit("'\n---\n\nbody "), "page_id").alias("text"), F.format_string("x/%d.md", "page_id").alias("path"), F.lit("{}").alias("sidecar"))
    write_notes(rows, folder)
    return note_urls(read_notes(spark, folder))


def duplicate_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole report over documents under their text's hash: what each note that goes scores, and the one that stays."""
    rows = table(spark, sf_dir, "documents").select(
        F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("norm_url"),
        F.concat(F.coalesce("source", F.lit("x")), F.format_string("/%08d.md", "doc_id")).alias("path"),
        (F.col("doc_id") % 3 == 0).cast("int").alias("has_enrichment"),
        F.lit(1).alias("has_sidecar"),
        F.length(F.coalesce("text", F.lit(""))).alias("richness"),
        F.lit(10).alias("bytes"),
        F.timestamp_seconds(1_700_000_000 + F.col("doc_id") % 2).alias("modified"),
    )
    report = dedupe_report(rows)
    score = lambda c: F.concat_ws("/", *[F.col(f"{c}.{x}").cast("string") for x in ("has_enrichment", "has_sidecar", "richness", "bytes", "modified")])
    return report.select("norm_url", "kept", score("kept_score").alias("kept_score"), "moved", score("moved_score").alias("moved_score"))


def moved_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes of documents under their text's hash; duplicates have moved, and the report tells where to."""
    folder = f"{new_path(spark, 'library')}/vault/bookmarks"
    address = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    # the later a document comes under its address, the richer its sidecar, which so does not grow with the table
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", address.alias("address")).withColumn("n", F.row_number().over(Window.partitionBy("address").orderBy("doc_id")))
    n = F.col("n")
    digits = F.struct(F.repeat(F.lit("x"), (n % 100).cast("int")).alias("full_text"), F.array_repeat(F.lit("i"), ((n / 100).cast("long") % 5).cast("int")).alias("image_urls"), F.array_repeat(F.lit("a"), (n / 500).cast("int")).alias("external_articles"))
    text = F.concat(F.lit("---\nurl: https://example.org/"), "address", F.lit("\n---\n"))
    write_notes(docs.select(F.format_string("%s/%08d.md", F.coalesce("source", F.lit("x")), "doc_id").alias("path"), text.alias("text"), F.to_json(F.struct(digits.alias("content"))).alias("sidecar")), folder)
    done = resolve_duplicates(spark, folder, "run")
    stays = list_files(spark, folder, ".md").select(F.regexp_extract("path", "([^/]+/[^/]+)$", 1).alias("note"), F.lit("").alias("kept"))
    if not done.backup:
        return stays
    lines = spark.read.schema("url string, kept string, moved array<struct<`from`:string,`to`:string>>").json(done.report)
    name = lambda path: F.regexp_extract(path, "([^/]+/[^/]+)$", 1)
    gone = lines.select(F.explode("moved.to").alias("to"), name(F.col("kept")).alias("kept")).select(name(F.col("to")).alias("note"), "kept")
    there = list_files(spark, done.backup, ".md").select(name(F.col("path")).alias("note"))
    return stays.unionByName(gone.join(there, "note", "left_semi"))


# Shapes of responses, and what becomes of content ----------------------------------------------------------------------


def author_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The author's handle at four places; a post quoted, media of three kinds, a long text beside a short one."""
    docs = table(spark, sf_dir, "documents")
    user = F.element_at(
        F.array(F.lit('"core":{"user_results":{"result":{"core":{"screen_name":"@"}}}}'), F.lit('"core":{"user_results":{"result":{"screen_name":"@"}}}'), F.lit('"core":{"user_results":{"result":{"legacy":{"screen_name":"@"}}}}'), F.lit('"user_results":{"result":{"legacy":{"screen_name":"@"}}}')),
        (F.col("doc_id") % 4 + 1).cast("int"),
    )
    quoted = F.concat(F.lit('"quoted_status_result":{"result":{"rest_id":"9'), "doc_id", F.lit('","core":{"user_results":{"result":{"core":{"screen_name":"other"}}}}}}'))
    media = F.concat(F.lit('"extended_entities":{"media":[{"type":"photo","media_url_https":"https://pbs.twimg.com/media/'), "doc_id", F.lit('.jpg"},{"type":"audio","media_url_https":"https://a/1.mp3"},{"media_url":"http://pbs.twimg.com/media/v"}]}'))
    long = F.concat(F.lit('"note_tweet":{"note_tweet_results":{"result":{"text":'), F.get_json_object(F.to_json(F.struct(F.to_json(F.array("text")).alias("t"))), "$.t"), F.lit("}}}"))
    long = F.replace(F.replace(long, F.lit('"text":['), F.lit('"text":')), F.lit("]}}}"), F.lit("}}}"))
    tweet = F.concat(F.lit('{"tweet":{"rest_id":"'), "doc_id", F.lit('",'), F.replace(user, F.lit("@"), F.col("source")), F.lit(","), quoted, F.lit(","), long, F.lit(',"legacy":{"full_text":"short",'), media, F.lit("}}}"))
    rows = bookmarks_from_statuses(docs.select(F.col("doc_id").alias("seq"), F.lit(0).alias("position"), F.try_parse_json(tweet).alias("raw")), now())
    return rows.select("url", F.md5(F.col("post_text").cast("binary")).alias("text_md5"), F.array_join("referenced_tweet_urls", " ").alias("references"), F.array_join("image_urls", " ").alias("images"))


def post_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies of four shapes, with pictures deep inside and a token for the next page."""
    docs = table(spark, sf_dir, "documents")
    item = F.concat(F.lit('{"url":"https://www.linkedin.com/feed/update/urn:li:activity:'), F.col("doc_id") + 1, F.lit('","author":"'), "source", F.lit('","createdAt":"'), 1_700_000_000 + F.col("doc_id"), F.lit('","x":{"y":{"z":["https://media.licdn.com/'), "doc_id", F.lit('"]}}}'))
    shapes = [('{"data":{"elements":[', '],"paging":{"nextCursor":"n@"}}}'), ('{"elements":[', '],"paging":{"start":"n@"}}'), ('{"included":[', '],"metadata":{"nextCursor":"n@"}}'), ("[", "]")]
    k = (F.col("doc_id") % 4 + 1).cast("int")
    opening, closing = (F.element_at(F.array(*[F.lit(x[i]) for x in shapes]), k) for i in (0, 1))
    bodies = docs.select(F.col("doc_id").alias("seq"), F.concat(opening, item, F.replace(closing, F.lit("@"), F.col("doc_id").cast("string"))).alias("body"))
    rows = bookmarks_from_posts(posts(post_elements(bodies)), now()).join(post_cursors(bodies), "seq", "left")
    return rows.select(F.col("seq").alias("doc_id"), "url", "title", F.array_join("image_urls", " ").alias("images"), F.unix_seconds("published_at").alias("published"), "cursor")


def service_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all responses those of the feed's services; whether the session holds; and what a status means."""
    pages = table(spark, sf_dir, "pages")
    status = F.element_at(F.array(*map(F.lit, (200, 302, 404, 503))), (F.col("page_id") % 4 + 1).cast("int"))
    rows = pages.select("page_id", F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://a/voyager/api/"), "page_id")).otherwise(F.col("url")).alias("url"), status.alias("status"))
    ours = service_responses(rows).select("page_id", F.lit(True).alias("ours"))
    meaning = classify_status(F.col("status"), F.col("page_id") % 7 == 0, F.col("page_id") % 30)
    return rows.join(ours, "page_id", "left").crossJoin(F.broadcast(session_holds(rows))).select("page_id", F.coalesce("ours", F.lit(False)).alias("ours"), "holds", meaning.alias("meaning"))


def content_of_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with a link each, pages for two in three: the text that is chosen, its method, and the article."""
    docs = table(spark, sf_dir, "documents").withColumn("url", F.concat(F.lit("https://example.org/"), "doc_id"))
    link = F.concat(F.lit("https://news.example/"), F.col("doc_id") % 50)
    source = F.when(F.col("doc_id") % 2 == 0, "x").otherwise("linkedin")
    none = F.lit(None).cast("array<string>")
    marks = docs.select(source.alias("source"), "url", F.lit("title").alias("title"), F.concat(F.lit("post "), "doc_id").alias("post_text"), F.array(link).alias("external_urls"), none.alias("referenced_tweet_urls"), none.alias("image_urls"))
    own = docs.where("doc_id % 3 > 0").select(F.col("url").alias("page_url"), F.col("text").alias("full_text"), F.lit(None).cast("string").alias("fallback_text"), none.alias("image_urls"), F.col("text").alias("thread_text"))
    linked = docs.groupBy(link.alias("page_url")).agg(F.max("text").alias("full_text")).select("page_url", "full_text", F.lit(None).cast("string").alias("fallback_text"), none.alias("image_urls"), F.lit(None).cast("string").alias("thread_text"))
    c = F.col("content")
    first = F.get(c["external_articles"], F.lit(0))
    rows = with_content(marks, own.unionByName(linked), now())
    return rows.select(c["url"].alias("url"), c["extraction_method"].alias("method"), F.md5(c["full_text"].cast("binary")).alias("text_md5"), first["url"].alias("article"), F.md5(first["text"].cast("binary")).alias("article_md5"), first["extraction_method"].alias("article_method"))


def linked_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with five posts that they refer to and four links: three of each count; extraction found, broke off or found nothing."""
    docs = table(spark, sf_dir, "documents")
    at = lambda k: ((F.col("doc_id") + k) % 30).cast("string")
    refs, links = (F.array(*[F.concat(F.lit(site), at(k)) for k in range(n)]) for site, n in (("https://x.com/v/status/", 5), ("https://news.example/", 4)))
    marks = docs.select(F.lit("x").alias("source"), F.concat(F.lit("https://example.org/"), "doc_id").alias("url"), F.lit("t").alias("title"), F.lit("p").alias("post_text"), links.alias("external_urls"), refs.alias("referenced_tweet_urls"), F.lit(None).cast("array<string>").alias("image_urls"))
    numbers = docs.select((F.col("doc_id") % 30).alias("n")).distinct().where("n % 3 < 2")
    error = F.when(F.col("n") % 3 == 1, F.lit("timeout"))
    none, words = F.lit(None).cast("string"), F.concat(F.repeat(F.lit("words "), 50), "n")
    kinds = [(("https://x.com/v/status/"), none, words), (("https://news.example/"), words, none)]
    found = [numbers.select(F.concat(F.lit(site), "n").alias("page_url"), text.alias("full_text"), none.alias("fallback_text"), F.array(F.lit("i")).alias("image_urls"), thread.alias("thread_text"), error.alias("error")) for site, text, thread in kinds]
    rows = with_content(marks, found[0].unionByName(found[1]), now())
    told = F.transform("content.external_articles", lambda a: F.concat_ws(" ", a["url"], a["extraction_method"], F.length(a["text"]).cast("string"), F.size(a["image_urls"]).cast("string")))
    return rows.select("bookmark.url", F.array_join(told, "; ").alias("articles"))


def page_pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page with 25 pictures, one of them twice: the first 20 count, once each."""
    pictures = "".join(f'<img src="https://i.example/{{id}}-{k}.png">' for k in (0, 0, *range(1, 25)))
    pages = built(spark, sf_dir, f"<article><p>{{lang}}</p>{pictures}</article>")
    return pages.select("doc_id", F.array_join(html_images(F.col("html")), " ").alias("images"))


def address_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which addresses are valid, statuses' addresses in running text, a bot's address without its token, a card on one line."""
    docs = table(spark, sf_dir, "documents")
    url = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("https://twitter.com/"), "source", F.lit("/status/"), "doc_id", F.lit("?s=20"))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("ftp://e.org/"), "doc_id")).otherwise(F.concat(F.lit("no address "), "doc_id"))
    bot = F.concat(F.lit("https://api.example/bot"), "doc_id", F.lit(":token/sendMessage?x="), "lang")
    return docs.select("doc_id", valid_url(url).alias("valid"), status_url(url).alias("status"), redact_tokens(bot).alias("bot"), F.md5(card_text(F.coalesce("text", F.lit(""))).cast("binary")).alias("card_md5"))


def once_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of pages as a stream in two runs, with good rows and dead letters by batch; each address comes once."""
    pages, folder = table(spark, sf_dir, "pages").select("page_id", "url"), new_path(spark, "once")
    for k in (0, 1):
        pages.where(F.col("page_id") % 2 == k).select("url").write.mode("append").parquet(f"{folder}/in")
        stream = once_per_url(spark.readStream.schema("url string").parquet(f"{folder}/in")).select("norm_url")
        run(stream, lambda rows: (rows.where("norm_url NOT LIKE '%/de/%'"), rows.where("norm_url LIKE '%/de/%'")), f"{folder}/good", f"{folder}/bad", f"{folder}/state").awaitTermination()
    bad = spark.read.schema("norm_url string").option("recursiveFileLookup", "true").json(f"{folder}/bad").select("norm_url", F.lit(False).alias("good"))
    good = spark.read.schema("norm_url string").option("recursiveFileLookup", "true").parquet(f"{folder}/good").select("norm_url", F.lit(True).alias("good"))
    return good.unionByName(bad)


def source_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of an export, read back: a source without a bookmark counts 0."""
    folder = new_path(spark, "export")
    rows = table(spark, sf_dir, "documents").select("source", "doc_id")
    sources = [f"src{k}" for k in range(8)] + ["none"]
    write_manifest(rows, sources, folder, None, now())
    export_raw(rows, folder)
    one = spark.read.schema("total long, by_source map<string,long>").json(f"{folder}/manifest.json")
    exported = spark.read.schema("doc_id long, source string").json(f"{folder}/raw").groupBy("source").agg(F.count("*").alias("exported"))
    counts = one.select("total", F.explode("by_source").alias("source", "n"))
    return counts.join(exported, "source", "left").select("source", "n", F.coalesce("exported", F.lit(0)).alias("exported"))


QUERIES = [
    url_canonical, url_strict, address_forms, richest_pages, page_hosts, page_ids, note_names, repeated_texts, duplicate_pages, first_events,
    delta_documents, known_customers, known_ids, frontier_stop, frontier_repeats, frontier_recent, frontier_stream, frontier_store, rows_per_source, nation_counts,
    source_cursors, processed_urls, cleaned_texts, noise_flags, chosen_texts, threads, page_href_heads, event_ages, event_epochs,
    event_fields, parsed_statuses, parsed_posts, feed_cursor, streamed_feeds, feed_offsets, nested_links, dry_run, page_texts, page_links, page_images, page_cards,
    page_contents, enrichment_counts, rendered_notes, dead_rows, status_cards, post_cards, dense_pages, extracted_articles, status_pages, post_pages, post_links,
    thread_pages, stored_cursors, stored_urls, stored_frontiers, note_files, vault_urls, duplicate_scores, moved_notes, author_places, post_shapes,
    service_bodies, content_of_posts, linked_articles, page_pictures, address_parts, once_seen, source_manifest,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


URL_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:]*)(?::\d*)?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
_QUERY = f"array_to_string(list_filter(string_split(u.q, '&'), lambda x: x <> '' AND NOT list_contains([{', '.join(map(_quoted, TRACKING_PARAMS))}], string_split(x, '=')[1])), '&')"
PAGES = f"""
WITH split AS (SELECT *, regexp_extract(url, {_quoted(URL_PARTS)}, ['s', 'h', 'p', 'q']) AS u FROM pages),
parts AS (SELECT *, {_QUERY} AS kept, regexp_replace(u.p, '/+$', '') AS path FROM split),
normal AS (
  SELECT page_id, url, html, lower(u.h) AS host,
         lower(u.s) || '://' || lower(u.h) || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN kept = '' THEN '' ELSE '?' || kept END AS norm_url
  FROM parts),
ranked AS (SELECT *, length(html) AS n, row_number() OVER (PARTITION BY norm_url ORDER BY length(html) DESC, page_id) AS place FROM normal)
"""
WHITE = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^{WHITE}|{WHITE}$', '', 'g')"


def _cleaned(text: str) -> str:
    for pattern in NOISE_PASSAGES:
        text = f"regexp_replace({text}, {_quoted('(?ism)' + pattern)}, '', 'g')"
    return _strip(f"regexp_replace(regexp_replace({text}, '\\n{{3,}}', chr(10) || chr(10), 'g'), '[ \\t]+', ' ', 'g')")


def _noise(text: str) -> str:
    found = " OR ".join(f"regexp_matches(lower({text}), {_quoted(p)})" for p in NOISE_PHRASES)
    return f"(coalesce(length({text}) = 0, true) OR coalesce({found}, false))"


SLUG = "trim(regexp_replace(regexp_replace(regexp_replace(lower(title), '[^a-zA-Z0-9 _-]', '', 'g'), '[ _]+', '-', 'g'), '-{2,}', '-', 'g'), '-')"
TITLE = "CASE WHEN coalesce(text, '') <> '' THEN substring(text, 1, 120) ELSE 'Post by ' || source END"
TIDY = _strip(f"regexp_replace(coalesce(text, ''), '{WHITE}', ' ', 'g')")
_LINES = r"regexp_replace(regexp_replace(regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '[\r\n]', ' ', 'g'), '</?(?:h1|p|br|article)>', chr(10), 'g'), '<[^>]*>', '', 'g')"
_PLAIN = _LINES
for _name, _sign in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#x27", "''"), ("#39", "''"), ("amp", "&")):
    _PLAIN = f"regexp_replace({_PLAIN}, '&{_name};?', '{_sign}', 'g')"
PAGE_TEXTS = rf"""
WITH t AS (SELECT page_id, url, {_strip(rf"regexp_replace(regexp_replace({_PLAIN}, '[ \t\x{{0b}}\x{{85}}\x{{a0}}]+', ' ', 'g'), ' *\n[\s]*', chr(10), 'g')")} AS text FROM pages)
"""
# The prompt of a row, what the stand-in answers, and the note that comes of both.
_PROMPT = """'Summarise this ' || CASE WHEN b = 'x' THEN 'short post, perhaps of a thread; tell what it says itself, not what error pages or controls around it say, and invent nothing about pages that it links to' ELSE 'saved article or post' END || ': three bullets, one takeaway, three to five lower-case tags.'
  || chr(10) || 'Title: ' || title || chr(10) || 'URL: ' || url || chr(10)
  || CASE WHEN text <> '' THEN chr(10) || 'Content:' || chr(10) || text ELSE chr(10) || '(No additional content available)' END
  || chr(10) || chr(10) || 'Answer in this form:' || chr(10) || 'SUMMARY:' || chr(10) || '- bullet 1' || chr(10) || '- bullet 2' || chr(10) || '- bullet 3' || chr(10) || 'TAKEAWAY: one sentence' || chr(10) || 'TAGS: tag1, tag2, tag3'"""
ANSWERS = f"""
WITH marks AS (SELECT *, CASE WHEN doc_id % 2 = 0 THEN 'x' ELSE 'linkedin' END AS b, 'https://example.org/' || source || '/' || doc_id AS url, {TITLE} AS title FROM documents),
asked AS (SELECT *, {_PROMPT} AS prompt FROM marks),
code AS (SELECT *, ('0x' || substr(md5(prompt), 1, 6))::BIGINT AS n FROM asked),
answers AS (SELECT *, n % 10 <> 0 AS ok, 'takes ' || (n % 7) AS takeaway FROM code)
"""
NOTE_NAME = f"CASE WHEN {SLUG} = '' THEN 'untitled' ELSE {SLUG} END || '-' || substring(sha1(url), 1, 10) || '.md'"
NOTE = f"""'---' || chr(10) || 'title: ' || to_json(title)::VARCHAR || chr(10) || 'source: ' || b || chr(10) || 'url: "' || url || '"' || chr(10)
  || 'published: ''2024-06-01T00:00:00+00:00''' || chr(10) || 'retrieved: ''2024-06-01T00:00:00+00:00''' || chr(10)
  || CASE WHEN ok THEN 'tags:' || chr(10) || '- "a' || (n % 3) || '"' || chr(10) || '- "b"' || chr(10) || 'model: "first"' ELSE 'tags: []' || chr(10) || 'model: none' END || chr(10) || '---' || chr(10) || chr(10)
  || CASE WHEN ok THEN '## Summary' || chr(10) || chr(10) || '- characters ' || length(prompt) || chr(10) || '- code ' || n || chr(10) || '- Key point from ' || b || ': ' || substring(title, 1, 80) || chr(10) || chr(10) || '## Takeaway' || chr(10) || chr(10) || takeaway || chr(10) || chr(10) ELSE '' END
  || '## Original' || chr(10) || chr(10) || '> ' || text || chr(10) || CASE WHEN text <> '' AND {_strip('text')} <> {_strip("('> ' || text)")} THEN chr(10) || '## Article Text' || chr(10) || chr(10) || text || chr(10) ELSE '' END"""
FRONTIER = """
WITH flags AS (SELECT event_id, user_id, event_type IN ('view', 'click') AS k FROM events),
gaps AS (SELECT *, sum(CASE WHEN k THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM flags),
runs AS (SELECT *, sum(CASE WHEN k THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, g ORDER BY event_id) AS run FROM gaps),
stops AS (SELECT user_id, min(CASE WHEN k AND run >= 2 THEN event_id END) AS stop FROM runs GROUP BY user_id)
SELECT event_id, user_id FROM runs JOIN stops USING (user_id) WHERE NOT k AND (stop IS NULL OR event_id < stop)
"""
# A walk of each feed, a row of all feeds at a step.
WALKS = """
WITH RECURSIVE rows AS (
  SELECT event_id, user_id, event_type || '/' || (event_id * 7 % 11) AS url, event_type IN ('view', 'click') OR event_id % 11 < 3 AS known,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
walk AS (
  SELECT DISTINCT user_id, 0::BIGINT AS rn, []::VARCHAR[] AS recent, 0 AS streak, false AS stopped, NULL::BIGINT AS event_id, false AS kept FROM rows
  UNION ALL
  SELECT user_id, rn, CASE WHEN held THEN recent ELSE list_append(recent, url)[-5:] END, run, stopped OR run >= 3, event_id, NOT known AND NOT (stopped OR run >= 3)
  FROM (SELECT r.user_id, r.rn, r.event_id, r.url, r.known, recent, stopped, list_contains(recent, url) AS held, CASE WHEN list_contains(recent, url) THEN streak WHEN known THEN streak + 1 ELSE 0 END AS run
        FROM walk w JOIN rows r ON r.user_id = w.user_id AND r.rn = w.rn + 1))
SELECT event_id, user_id FROM walk WHERE kept
"""


def oracle_sql() -> dict[str, str]:
    chosen_primary = "CASE WHEN doc_id % 4 <> 0 THEN substring(text, 1, (doc_id % 90)::INTEGER) END"
    return {
        "url_canonical": PAGES + "SELECT page_id, norm_url FROM normal",
        "address_forms": "SELECT doc_id, 'http://[2001:db8::' || doc_id || ']/p?b=1&b=3&b=&a=' || coalesce(lang, '') || '&c=' AS norm_url FROM documents",
        "richest_pages": PAGES + "SELECT page_id, norm_url, n::INTEGER AS n FROM ranked WHERE place = 1",
        "page_hosts": PAGES + "SELECT host, count(*) AS pages, sum(n)::BIGINT AS chars FROM ranked WHERE place = 1 GROUP BY host",
        "page_ids": r"""
            SELECT page_id, coalesce(
              CASE WHEN page_id % 2 = 0 THEN nullif(regexp_extract(url, '/status/(\d+)', 1), '') ELSE nullif(regexp_extract(url, '(?:activity:|activity-)(\d+)', 1), '') END,
              substring(sha1(regexp_replace(url, '/+$', '')), 1, 10)) AS stable_id FROM pages""",
        "note_names": f"""
            WITH titled AS (SELECT doc_id, {TITLE} AS title FROM documents)
            SELECT doc_id, title, CASE WHEN {SLUG} = '' THEN 'untitled' ELSE {SLUG} END || '-' || substring(sha1('https://example.org/' || doc_id), 1, 10) || '.md' AS note_name FROM titled""",
        "repeated_texts": "SELECT md5(text) AS text_md5, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
        "duplicate_pages": PAGES + """, ordered AS (SELECT norm_url, 'pages/' || lpad(page_id::VARCHAR, 8, '0') || '.md' AS path, row_number() OVER (PARTITION BY norm_url ORDER BY length(html) DESC, strlen(html) DESC, page_id) AS k FROM normal)
            SELECT a.norm_url, b.path AS kept, a.path AS moved FROM ordered a JOIN ordered b ON a.norm_url = b.norm_url AND b.k = 1 WHERE a.k > 1""",
        "first_events": "SELECT user_id || '/' || event_type AS key, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1",
        "delta_documents": "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
        "known_customers": "SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders) AS is_known FROM customer",
        "known_ids": "SELECT doc_id FROM labels UNION SELECT doc_id FROM documents WHERE lang = 'fr' UNION SELECT doc_id FROM documents WHERE source = 'src3'",
        "frontier_stop": FRONTIER,
        "frontier_stream": FRONTIER,
        "frontier_repeats": WALKS,
        "frontier_store": """
            WITH seen AS (SELECT *, user_id % 4 = 0 OR event_id % 2 = 0 AS first FROM events),
            placed AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY first, event_id DESC) AS k FROM seen)
            SELECT 'u' || user_id AS source, string_agg('https://example.org/e/' || event_id, ' ' ORDER BY k DESC) AS urls FROM placed WHERE k <= 20 GROUP BY user_id""",
        "frontier_recent": "SELECT event_id, user_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) <= 20",
        "rows_per_source": "SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 500",
        "nation_counts": "SELECT n_nationkey, count(c_custkey) AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey",
        "source_cursors": """
            WITH old AS (SELECT source, max(doc_id) AS cursor FROM documents WHERE doc_id % 2 = 0 OR source = 'src0' GROUP BY source),
            new AS (SELECT source, max(doc_id) AS cursor FROM documents WHERE doc_id % 2 = 1 AND source <> 'src0' GROUP BY source)
            SELECT source, coalesce(new.cursor, old.cursor) AS cursor FROM old FULL JOIN new USING (source)""",
        "processed_urls": PAGES + """, first AS (SELECT norm_url, min(page_id) AS p FROM normal WHERE page_id % 2 = 0 GROUP BY 1), second AS (SELECT norm_url, min(page_id) AS p FROM normal WHERE page_id % 2 = 1 GROUP BY 1)
            SELECT norm_url, coalesce(first.p, second.p) AS first_seen FROM first FULL JOIN second USING (norm_url)""",
        "cleaned_texts": f"SELECT doc_id, md5({_cleaned("coalesce(text, '')")}) AS text_md5 FROM documents",
        "noise_flags": f"WITH t AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || ' Aceptar todas las cookies ' ELSE text END AS text FROM documents) SELECT doc_id, {_noise('text')} AS is_noise FROM t",
        "chosen_texts": f"""
            WITH p AS (SELECT doc_id, text, {chosen_primary} AS first FROM documents),
            c AS (SELECT doc_id, CASE WHEN (coalesce(length({_strip('first')}) < 50, true) OR {_noise('first')}) AND NOT {_noise('text')} AND length(text) > length(coalesce(first, '')) THEN text ELSE first END AS text FROM p)
            SELECT doc_id, length(text)::INTEGER AS chars, CASE WHEN NOT {_noise('text')} AND length({_strip('text')}) >= 200 THEN least(length(text), 8000)::INTEGER END AS article_chars FROM c""",
        "threads": f"""
            WITH shown AS (SELECT conv_id, turn, {_strip('text')} AS text FROM conversations WHERE length({_strip('text')}) > 10),
            once AS (SELECT conv_id, substring(text, 1, 100) AS head, arg_min((turn, text), (turn, text)) AS f FROM shown GROUP BY 1, 2),
            placed AS (SELECT conv_id, f, row_number() OVER (PARTITION BY conv_id ORDER BY f) AS k FROM once)
            SELECT conv_id, md5(string_agg(f[2], chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY k)) AS thread_md5 FROM placed GROUP BY conv_id""",
        "page_href_heads": """
            WITH h AS (SELECT page_id, regexp_extract_all(html, 'href="([^"]+)"', 1) AS l FROM pages)
            SELECT page_id, array_to_string(l, ' ') AS hrefs, len(list_distinct(list_filter(l, lambda x: x <> '')))::INTEGER AS n_different FROM h""",
        "event_ages": """
            SELECT event_id, strftime(TIMESTAMP '2024-06-01' - to_seconds((event_id % 50) * [1, 60, 3600, 86400, 604800, 2592000, 31536000][(event_id % 7 + 1)::INTEGER]), '%Y-%m-%d %H:%M:%S') AS seen_at FROM events""",
        "event_epochs": "SELECT event_id, strftime(make_timestamp((1700000000 + event_id) * 1000000), '%Y-%m-%d %H:%M:%S') AS at FROM events",
        "event_fields": "SELECT event_type, sum((props::JSON ->> '$.k')::BIGINT)::BIGINT AS total, count(*) AS n FROM events GROUP BY event_type",
        "parsed_statuses": f"SELECT 'https://x.com/' || source || '/status/' || doc_id AS url, {TITLE.replace("'Post by '", "'Post by @'")} AS title, md5(nullif(text, '')) AS text_md5, 'https://example.org/' || lang || '/' || doc_id AS links, '2026-05-13 01:00:00' AS published FROM documents",
        "parsed_posts": f"SELECT 'https://www.linkedin.com/feed/update/urn:li:activity:' || (doc_id + 1) AS url, {TITLE} AS title, md5(nullif(text, '')) AS text_md5, strftime(make_timestamp((1700000000 + doc_id) * 1000000), '%Y-%m-%d %H:%M:%S') AS published FROM documents",
        "feed_cursor": "SELECT 'c' || max(floor(doc_id / 20))::BIGINT AS cursor FROM documents",
        "streamed_feeds": "SELECT 'x' AS source, 'https://x.com/' || source || '/status/' || doc_id AS url, md5(nullif(text, '')) AS text_md5 FROM documents UNION ALL SELECT 'linkedin', 'https://www.linkedin.com/feed/update/urn:li:activity:' || (doc_id + 1), md5(nullif(text, '')) FROM documents",
        "feed_offsets": "SELECT s AS source, max(doc_id) // 20 AS seq, p || (max(doc_id) // 20) AS cursor FROM documents, (VALUES ('x', 'c'), ('linkedin', 't')) v(s, p) GROUP BY s, p",
        "nested_links": "SELECT page_id, url || ' https://example.org/p/' || page_id AS links FROM pages",
        "url_strict": PAGES + "SELECT page_id, norm_url FROM normal",
        "page_texts": PAGE_TEXTS + f"SELECT page_id, {_cleaned('text')} AS text FROM t",
        "page_contents": PAGE_TEXTS + f"SELECT page_id, url, CASE WHEN length(c) >= 50 THEN substring(c, 1, 50000) END AS full_text FROM (SELECT *, {_cleaned('text')} AS c FROM t)",
        "page_links": "SELECT page_id, '' AS links FROM pages",
        "page_images": "SELECT page_id, '' AS images FROM pages",
        "page_cards": "SELECT page_id, 0 AS cards FROM pages",
        "enrichment_counts": ANSWERS + "SELECT count(*) AS processed, count(*) FILTER (WHERE ok) AS enriched, count(*) FILTER (WHERE NOT ok) AS dead_letter FROM answers",
        "rendered_notes": ANSWERS + f"""
            SELECT b || '/' || {NOTE_NAME} AS path, md5({NOTE}) AS text_md5, CASE WHEN ok THEN takeaway END AS takeaway, md5(text) AS content_md5 FROM answers""",
        "dead_rows": ANSWERS + "SELECT url, b AS source, md5(text) AS text_md5, 'All models exhausted. Last error: refused' AS error, 'llm' AS stage, '2024-06-01' AS day FROM answers WHERE NOT ok",
        "status_cards": f"""
            WITH d AS (SELECT *, {TIDY} AS t FROM documents)
            SELECT 'https://x.com/' || source || '/status/' || doc_id AS url, CASE WHEN t <> '' THEN substring(t, 1, 120) ELSE 'Post by @' || source END AS title, md5(nullif(t, '')) AS text_md5,
                   'https://example.org/' || lang || '/' || doc_id AS external_urls, 'https://x.com/other/status/9' || doc_id AS referenced_tweet_urls, 'https://pbs.twimg.com/media/' || doc_id || '.jpg' AS image_urls, '2026-05-13 01:00:00' AS published FROM d""",
        "post_cards": f"""
            WITH d AS (SELECT *, {TIDY} AS t FROM documents)
            SELECT doc_id, 'https://www.linkedin.com/feed/update/urn:li:activity:7' || doc_id AS url, source AS author,
                   md5('at' || chr(10) || source || chr(10) || 'View ' || source || ' profile' || CASE WHEN t = '' THEN '' ELSE chr(10) || t END || chr(10) || 'enough words to make of this element a card of its own, as cards have more than a few of them' || chr(10) || '3d • edited') AS text_md5,
                   '3d' AS created_text, 'https://media.licdn.com/' || doc_id || '.png' AS images FROM d
            UNION ALL SELECT doc_id, 'https://example.org/8' || doc_id, 'unknown', md5('x' || chr(10) || 'named'), '3d', '' FROM d""",
        "dense_pages": f"""
            SELECT doc_id, md5(trim(coalesce(lang, '') || ' ' || doc_id) || chr(10) || CASE WHEN {TIDY} = '' THEN '' ELSE {TIDY} || chr(10) END || rtrim(repeat('enough words of an article ', 30)) || chr(10)
              || 'source | id' || chr(10) || CASE WHEN coalesce(source, '') = '' THEN '' ELSE source || ' | ' END || doc_id) AS text_md5 FROM documents""",
        "extracted_articles": f"""
            WITH d AS (SELECT doc_id, CASE WHEN {TIDY} = '' THEN '' ELSE {TIDY} || chr(10) END || rtrim(repeat(CASE doc_id % 3 WHEN 0 THEN 'enough words of an article ' ELSE 'words of a known article ' END, 20)) AS x FROM documents)
            SELECT 'https://example.org/' || doc_id AS url, CASE doc_id % 3 WHEN 0 THEN 'trafilatura' WHEN 1 THEN 'playwright' ELSE 'failed' END AS method,
                   CASE WHEN doc_id % 3 < 2 THEN md5(substring({_cleaned('x')}, 1, 8000)) END AS text_md5 FROM d""",
        "status_pages": f"SELECT doc_id, md5(CASE WHEN length({TIDY}) > 10 THEN {TIDY} ELSE 'in ' || lang || ' as document ' || doc_id END) AS text_md5 FROM documents",
        "post_pages": f"""
            WITH d AS (SELECT doc_id, {TIDY} AS t FROM documents), e AS (SELECT *, CASE WHEN t = '' THEN '' ELSE t || chr(10) END AS h FROM d),
            f AS (SELECT doc_id, CASE WHEN length(t) > 50 THEN t WHEN length(h) + 15 >= 50 THEN h || 'tail words here' ELSE h || 'c' || chr(10) || 'tail words here' END AS x FROM e),
            g AS (SELECT doc_id, {_cleaned('x')} AS x FROM f)
            SELECT doc_id, 'https://www.linkedin.com/posts/' || doc_id AS url, CASE WHEN length(x) >= 50 THEN md5(substring(x, 1, 50000)) END AS text_md5 FROM g""",
        "post_links": "SELECT doc_id, 'https://example.org/' || doc_id || ' https://example.org/' || lang AS links, 'https://i.example/' || doc_id || '.webp' AS images FROM documents",
        "thread_pages": f"""
            WITH d AS (SELECT *, {TIDY} AS t FROM documents)
            SELECT doc_id, md5(CASE WHEN length(t) > 10 AND substring(t, 1, 100) <> 'in the end of ' || doc_id THEN t || chr(10) || chr(10) || '---' || chr(10) || chr(10) ELSE '' END || 'in the end of ' || doc_id) AS thread_md5 FROM d""",
        "stored_cursors": """
            WITH r AS (SELECT source, CASE WHEN bool_or(doc_id % 2 = 1) THEN 1 ELSE 0 END AS k FROM documents GROUP BY source)
            SELECT source, max(doc_id)::VARCHAR AS cursor, CASE WHEN any_value(k) = 1 THEN 'delta' ELSE 'bootstrap' END AS mode FROM documents JOIN r USING (source) WHERE doc_id % 2 = k GROUP BY source""",
        "stored_urls": PAGES + """SELECT norm_url, 1700000000 + min(page_id) FILTER (WHERE page_id % 2 = k) AS first_seen, 'run' || any_value(k) AS source
            FROM normal JOIN (SELECT norm_url, min(page_id % 2) AS k FROM normal GROUP BY 1) USING (norm_url) GROUP BY norm_url""",
        "stored_frontiers": "SELECT user_id::VARCHAR AS source, 'https://example.org/' || event_type || '/' || event_id AS norm_url FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) <= 20",
        "note_files": ANSWERS.replace("FROM code", "FROM (SELECT *, false AS no FROM code)") + f"""
            , plain AS (SELECT * REPLACE (false AS ok) FROM answers)
            SELECT url AS norm_url, b || '/' || {NOTE_NAME} AS path, 0 AS has_enrichment, 1 AS has_sidecar, (2 * length(text) + 2)::INTEGER AS richness, md5({NOTE}) AS text_md5, b AS source FROM plain""",
        "vault_urls": PAGES + "SELECT DISTINCT norm_url FROM normal",
        "duplicate_scores": """
            WITH d AS (SELECT md5(coalesce(text, '')) AS norm_url, coalesce(source, 'x') || '/' || lpad(doc_id::VARCHAR, 8, '0') || '.md' AS path, (doc_id % 3 = 0)::INTEGER AS e, length(coalesce(text, '')) AS r, 1700000000 + doc_id % 2 AS m FROM documents),
            s AS (SELECT *, e || '/1/' || r || '/10/' || m AS score, row_number() OVER (PARTITION BY norm_url ORDER BY e DESC, r DESC, m DESC, path) AS k FROM d)
            SELECT a.norm_url, b.path AS kept, b.score AS kept_score, a.path AS moved, a.score AS moved_score FROM s a JOIN s b ON a.norm_url = b.norm_url AND b.k = 1 WHERE a.k > 1""",
        "linked_articles": """
            WITH w AS (SELECT doc_id, s.site, k, (doc_id + k) % 30 AS n, s.post FROM documents, range(3) r(k), (VALUES ('https://x.com/v/status/', true), ('https://news.example/', false)) s(site, post)),
            t AS (SELECT *, CASE n % 3 WHEN 0 THEN ' playwright' WHEN 1 THEN ' error' ELSE ' failed' END || CASE WHEN post THEN '_x_thread' ELSE '' END || CASE WHEN n % 3 = 0 THEN ' ' || (300 + length(n::VARCHAR)) || ' 1' ELSE '' END AS told FROM w)
            SELECT 'https://example.org/' || doc_id AS url, string_agg(site || n || told, '; ' ORDER BY post DESC, k) AS articles FROM t GROUP BY doc_id""",
        "page_pictures": "SELECT doc_id, string_agg('https://i.example/' || doc_id || '-' || k || '.png', ' ' ORDER BY k) AS images FROM documents, range(20) r(k) GROUP BY doc_id",
        "moved_notes": """
            WITH n AS (SELECT coalesce(source, 'x') || '/' || lpad(doc_id::VARCHAR, 8, '0') || '.md' AS note, row_number() OVER w AS k, first_value(coalesce(source, 'x') || '/' || lpad(doc_id::VARCHAR, 8, '0') || '.md') OVER w AS kept
              FROM documents WINDOW w AS (PARTITION BY md5(coalesce(text, '')) ORDER BY doc_id DESC))
            SELECT note, CASE WHEN k = 1 THEN '' ELSE kept END AS kept FROM n""",
        "author_places": "SELECT 'https://x.com/' || source || '/status/' || doc_id AS url, md5(coalesce(nullif(text, ''), 'short')) AS text_md5, 'https://x.com/other/status/9' || doc_id AS references, 'https://pbs.twimg.com/media/' || doc_id || '.jpg http://pbs.twimg.com/media/v' AS images FROM documents",
        "post_shapes": "SELECT doc_id, 'https://www.linkedin.com/feed/update/urn:li:activity:' || (doc_id + 1) AS url, 'Post by ' || source AS title, 'https://media.licdn.com/' || doc_id AS images, 1700000000 + doc_id AS published, CASE WHEN doc_id % 4 < 3 THEN 'n' || doc_id END AS cursor FROM documents",
        "service_bodies": """
            SELECT page_id, page_id % 3 = 0 AND page_id % 4 < 2 AS ours, true AS holds,
                   CASE WHEN page_id % 30 > 20 THEN 'give up' WHEN page_id % 7 = 0 OR page_id % 4 = 3 THEN 'retry' WHEN page_id % 4 = 0 THEN 'ok' ELSE 'give up' END AS meaning FROM pages""",
        "content_of_posts": f"""
            WITH linked AS (SELECT doc_id % 50 AS k, max(text) AS a FROM documents GROUP BY 1),
            d AS (SELECT doc_id, 'post ' || doc_id AS p, CASE WHEN doc_id % 3 > 0 THEN text END AS t, a, 'https://news.example/' || (doc_id % 50) AS link FROM documents JOIN linked ON k = doc_id % 50),
            e AS (SELECT *, coalesce(length({_strip('t')}), 0) > length(p) AS longer, NOT {_noise('a')} AND length({_strip('a')}) >= 200 AS good FROM d)
            SELECT 'https://example.org/' || doc_id AS url,
                   CASE WHEN doc_id % 2 = 0 THEN CASE WHEN longer THEN 'playwright_x_thread' ELSE 'tweet_text' END WHEN t IS NULL THEN 'post_only' ELSE 'playwright_linkedin' END AS method,
                   md5(CASE WHEN doc_id % 2 = 0 THEN CASE WHEN longer THEN t ELSE p END || chr(10) || chr(10) || 'Referenced links:' || chr(10) || '- ' || link ELSE t END) AS text_md5,
                   link AS article, CASE WHEN good THEN md5(substring(a, 1, 8000)) END AS article_md5, CASE WHEN good THEN 'playwright' ELSE 'failed' END AS article_method FROM e""",
        "address_parts": f"""
            SELECT doc_id, doc_id % 3 = 0 AS valid, CASE WHEN doc_id % 3 = 0 THEN 'https://x.com/' || source || '/status/' || doc_id END AS status,
                   'https://api.example/bot<redacted>/sendMessage?x=' || lang AS bot, md5({TIDY}) AS card_md5 FROM documents""",
        "once_seen": PAGES + "SELECT DISTINCT norm_url, norm_url NOT LIKE '%/de/%' AS good FROM normal",
        "source_manifest": """
            SELECT s AS source, count(doc_id) AS n, count(doc_id) AS exported FROM (SELECT unnest(['src0', 'src1', 'src2', 'src3', 'src4', 'src5', 'src6', 'src7', 'none']) AS s) LEFT JOIN documents ON source = s GROUP BY s""",
        "dry_run": """
            SELECT 'x' AS source, count(*) AS scanned, count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS would_process FROM documents
            UNION ALL SELECT 'linkedin', count(*), count(*) FROM documents""",
    }
