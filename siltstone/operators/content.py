"""Content of bookmarks: extracted pages, referenced posts and articles beside the post itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import merge_unique, some, strip
from ..functions.texts import accepted_article, fallback_text, longer_text, with_references
from ..tables import materialize
from .skew import hot_rows

MOST_ARTICLES = 3


def thread_texts(rows: DataFrame, key: str, handle: Column | str | None = None, least: int = 11) -> DataFrame:
    """(key, thread_text) of rows (key, ord, author, text): posts of the thread's author in order, joined by rules.

    Texts are taken without white space around them and count from ``least`` characters on; those whose first 100
    characters repeat count once; an unknown author passes. ``handle``, one for all or a column, names the thread's author. A thread's text is one value, as in a page."""
    if handle is not None:
        rows = rows.where(F.col("author").isNull() | (F.lower("author") == F.lower(handle if isinstance(handle, Column) else F.lit(handle))))
    shown = rows.withColumn("text", strip(F.col("text"))).where(F.length("text") >= least)
    once = shown.groupBy(key, F.substring("text", 1, 100).alias("head")).agg(F.min(F.struct("ord", "text")).alias("first"))
    return once.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list("first")), lambda x: x["text"]), "\n\n---\n\n").alias("thread_text"))


def article(url: Column, primary: Column, fallback: Column, images: Column, error: Column) -> Column:
    """struct ARTICLE from two extractions of a page: the first that holds enough text without noise, else 'failed', or
    'error' where an extraction broke off."""
    first, second = accepted_article(primary), accepted_article(fallback)
    method = F.when(error.isNotNull(), "error").when(first.isNotNull(), "playwright").when(second.isNotNull(), "trafilatura").otherwise("failed")
    good = error.isNull()
    return F.struct(url.alias("url"), F.when(good, F.coalesce(first, second)).alias("text"), F.when(good & first.isNotNull(), some(images)).alias("image_urls"), method.alias("extraction_method"))


def referenced_article(url: Column, text: Column, images: Column, error: Column) -> Column:
    found = (F.coalesce(text, F.lit("")) != "") & error.isNull()
    method = F.when(error.isNotNull(), "error_x_thread").when(found, "playwright_x_thread").otherwise("failed_x_thread")
    return F.struct(url.alias("url"), F.when(found, F.substring(text, 1, 8000)).alias("text"), F.when(found, some(images)).alias("image_urls"), method.alias("extraction_method"))


def articles_of(bookmarks: DataFrame, pages: DataFrame, row: str = "url") -> DataFrame:
    """(row, external_articles): for the first MOST_ARTICLES linked posts and linked pages of each bookmark.

    ``row`` tells bookmarks apart. pages(page_url, full_text, fallback_text, image_urls, thread_text, error), one row for
    each address: what extraction has found, or why it broke off; a page that is missing there has failed."""
    none = F.array().cast("array<string>")
    kinds = F.concat(
        F.transform(F.slice(F.coalesce("referenced_tweet_urls", none), 1, MOST_ARTICLES), lambda u: F.struct(F.lit(True).alias("post"), u.alias("page_url"))),
        F.transform(F.slice(F.coalesce("external_urls", none), 1, MOST_ARTICLES), lambda u: F.struct(F.lit(False).alias("post"), u.alias("page_url"))),
    )
    wanted = bookmarks.select(row, F.posexplode(kinds).alias("place", "page")).where("page.page_url IS NOT NULL")
    # what a page gives is worked out once for each, not for each bookmark that links to it
    sizes = wanted.groupBy("page").agg(F.count("*").alias("rows_of_key"))
    found = sizes.join(with_errors(pages), F.col("page.page_url") == F.col("page_url"), "left")
    address = F.col("page.page_url")
    post = referenced_article(address, F.col("thread_text"), F.col("image_urls"), F.col("error"))
    built = F.when(F.col("page.post"), post).otherwise(article(address, F.col("full_text"), F.col("fallback_text"), F.col("image_urls"), F.col("error")))
    linked = materialize(found.select("page", "rows_of_key", built.alias("article")), "linked-pages")
    # a page that many bookmarks link to is neither one task's group nor shuffled with each of them: there are few, as a map
    hot = hot_rows(linked)
    few, many = linked.where(hot), linked.where(~hot).select("page", "article")
    keys = F.broadcast(few.select("page"))
    none_yet = F.lit(None).cast(linked.schema["article"].dataType)
    rows = wanted.join(keys, "page", "left_anti").join(many, "page").select(row, "place", "page", "article")
    rows = rows.unionByName(wanted.join(keys, "page", "left_semi").select(row, "place", "page", none_yet.alias("article")))
    lists = rows.groupBy(row).agg(F.array_sort(F.collect_list(F.struct("place", "page", "article"))).alias("articles"))
    known = few.agg(F.map_from_entries(F.collect_list(F.struct("page", "article"))).alias("known"))  # at most 1/HOT_SHARE entries
    filled = F.transform("articles", lambda x: F.coalesce(x["article"], F.try_element_at("known", x["page"])))
    return lists.crossJoin(F.broadcast(known)).select(row, filled.alias("external_articles"))


def with_errors(pages: DataFrame) -> DataFrame:
    return pages if "error" in pages.columns else pages.withColumn("error", F.lit(None).cast("string"))


def with_content(bookmarks: DataFrame, pages: DataFrame, now: Column | None = None) -> DataFrame:
    """(bookmark, content, page_error): the struct of each bookmark beside what was extracted for it at ``now``.

    Each row has its own content, also where addresses repeat or are null. Where the extraction of its own page broke off,
    ``page_error`` says why.
    A post of the first feed takes the thread's text if it is longer and lists what it links to. A post of the second
    takes its page's text, or the other extractor's if that is better; without any it keeps its own text alone."""
    own = with_errors(pages).select(F.col("page_url").alias("url"), "full_text", "fallback_text", "thread_text", F.col("image_urls").alias("page_images"), F.col("error").alias("page_error"))
    fields_of = bookmarks.columns
    bookmarks = materialize(bookmarks.withColumn("content_row", F.monotonically_increasing_id()), "bookmarks")
    rows = bookmarks.join(own, "url", "left").join(articles_of(bookmarks, pages, "content_row"), "content_row", "left")
    post = F.coalesce("post_text", "title", F.lit(""))
    thread = longer_text(post, F.col("thread_text"))
    feed_text = with_references(thread, F.col("external_urls"), F.col("referenced_tweet_urls"))
    page_text = fallback_text(F.col("full_text"), F.col("fallback_text"))
    is_feed = F.col("source") == "x"
    method = (
        F.when(is_feed & (thread != post), "playwright_x_thread")
        .when(is_feed, "tweet_text")
        .when(page_text.isNull(), "post_only")
        .when(page_text.eqNullSafe(F.col("full_text")), "playwright_linkedin")
        .otherwise("trafilatura")
    )
    images = some(merge_unique(F.col("image_urls"), F.col("page_images")))
    content = F.struct("url", F.when(is_feed, feed_text).otherwise(page_text).alias("full_text"), "post_text", method.alias("extraction_method"), "external_urls", "referenced_tweet_urls", "external_articles", images.alias("image_urls"), (F.lit(None).cast("timestamp") if now is None else now).alias("extracted_at"))
    fields = [images.alias(c) if c == "image_urls" else F.col(c) for c in fields_of]
    return rows.select(F.struct(*fields).alias("bookmark"), content.alias("content"), "page_error")
