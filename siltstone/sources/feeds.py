"""Captured JSON bodies of two feeds, read as VARIANT, so that shapes may differ from row to row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import filled, find_urls, merge_unique, some, strip
from ..functions.texts import title_of
from ..functions.times import post_time, relative_time, status_time
from ..functions.urls import host, normalize_url, status_url, under
from ..tables import materialize

LIST, STR = "array<variant>", "string"


def at(v: Column, path: str, kind: str = STR) -> Column:
    """A value inside a VARIANT, null if it is missing or of another kind."""
    return F.try_variant_get(v, "$" + path, kind)


def text_at(v: Column, path: str) -> Column:
    """A string; null for '' and for objects and lists."""
    value = F.try_variant_get(v, "$" + path, "variant")
    return F.nullif(F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", STR)), F.lit(""))


def list_at(v: Column, path: str) -> Column:
    return F.coalesce(at(v, path, LIST), F.array().cast(LIST))


def filled_list(v: Column, path: str) -> Column:
    return some(at(v, path, LIST))


def author_handle(tweet: Column) -> Column:
    """The first handle that is not blank among the places where responses have had it, else 'unknown'."""
    user = ".core.user_results.result"
    places = [f"{user}.core.screen_name", f"{user}.screen_name", f"{user}.legacy.screen_name", ".legacy.user.screen_name"]
    direct = F.coalesce(text_at(tweet, ".user_results.result.core.screen_name"), text_at(tweet, ".user_results.result.legacy.screen_name"))
    return F.coalesce(*[strip(filled(text_at(tweet, p))) for p in places], strip(filled(direct)), F.lit("unknown"))


def instructions(v: Column) -> Column:
    """The steps of a timeline body, null if there are none."""
    return F.coalesce(filled_list(v, ".data.bookmark_timeline_v2.timeline.instructions"), filled_list(v, ".data.user.bookmark_timeline.timeline.instructions"))


def status_entries(responses: DataFrame) -> DataFrame:
    """Timeline bodies -> (seq, position, entry): a row for each entry, in the order of the body. Broken JSON has none."""
    body = responses.select("seq", F.try_parse_json("body").alias("v"))
    steps = body.select("seq", F.posexplode(instructions(F.col("v"))).alias("step", "instruction"))
    entries = steps.select("seq", "step", F.posexplode(list_at(F.col("instruction"), ".entries")).alias("place", "entry"))
    return entries.select("seq", F.struct("step", "place").alias("position"), "entry", text_at(F.col("entry"), ".entryId").alias("entry_id"))


def statuses(responses: DataFrame) -> DataFrame:
    """(seq, position, raw): the status of each entry that has one."""
    found = status_entries(responses).where(F.startswith("entry_id", F.lit("tweet-")))
    entry = F.col("entry")
    wrapped, direct = at(entry, ".content.itemContent.tweet_results.result", "variant"), at(entry, ".content.result", "variant")
    empty = lambda v: v.isNull() | F.coalesce(F.cardinality(F.try_variant_get(v, "$", "map<string,variant>")) == 0, F.lit(False))
    raw = F.when(~empty(wrapped), wrapped).when(~empty(direct), direct)
    return found.select("seq", "position", raw.alias("raw")).where(F.col("raw").isNotNull())


def status_cursor(v: Column) -> Column:
    """The bottom cursor of a timeline body; of several, the last."""
    entries = F.flatten(F.transform(instructions(v), lambda step: list_at(step, ".entries")))
    bottom = F.filter(entries, lambda e: F.startswith(text_at(e, ".entryId"), F.lit("cursor-bottom-")))
    values = F.transform(bottom, lambda e: F.coalesce(text_at(e, ".content.value"), text_at(e, ".content.itemContent.value")))
    return F.try_element_at(values, F.lit(-1))


def cursors(responses: DataFrame) -> DataFrame:
    """(seq, cursor): the bottom cursor of each body that has one."""
    return responses.select("seq", status_cursor(F.try_parse_json("body")).alias("cursor")).where(F.col("cursor").isNotNull())


def last_cursor(responses: DataFrame) -> DataFrame:
    """One row: the cursor of the last body that has one."""
    return cursors(responses).where(F.col("cursor").isNotNull()).agg(F.max_by("cursor", "seq").alias("cursor"))


def bookmarks_from_statuses(rows: DataFrame, retrieved_at: Column) -> DataFrame:
    """(seq, position, bookmark columns) of ``statuses``; a status may be wrapped in 'tweet'."""
    raw = F.col("raw")
    rows = rows.withColumn("tweet", F.coalesce(at(raw, ".tweet", "variant"), raw))
    tweet = F.col("tweet")
    expanded = F.transform(list_at(tweet, ".legacy.entities.urls"), lambda u: text_at(u, ".expanded_url"))
    shown = F.transform(list_at(tweet, ".legacy.entities.urls"), lambda u: F.coalesce(text_at(u, ".expanded_url"), text_at(u, ".url")))
    on_site = lambda u: under(host(u), "x.com") | under(host(u), "twitter.com")
    outside = F.filter(expanded, lambda u: u.isNotNull() & ~(F.contains(u, F.lit("/status/")) & on_site(u)) & ~host(u).isin("pic.x.com", "pbs.twimg.com"))
    media = F.concat(list_at(tweet, ".legacy.extended_entities.media"), list_at(tweet, ".legacy.entities.media"))
    shows = F.filter(media, lambda m: F.coalesce(text_at(m, ".type"), F.lit("photo")).isin("photo", "animated_gif", "video"))
    images = F.transform(shows, lambda m: F.coalesce(text_at(m, ".media_url_https"), text_at(m, ".media_url")))
    quoted = at(tweet, ".quoted_status_result.result", "variant")
    quoted_url = F.when((author_handle(quoted) != "unknown") & text_at(quoted, ".rest_id").isNotNull(), F.concat(F.lit("https://x.com/"), author_handle(quoted), F.lit("/status/"), text_at(quoted, ".rest_id")))
    rows = rows.withColumn("author", author_handle(tweet)).withColumn("url", F.concat(F.lit("https://x.com/"), "author", F.lit("/status/"), F.coalesce(text_at(tweet, ".rest_id"), text_at(raw, ".rest_id"), F.lit(""))))
    referenced = F.filter(merge_unique(F.transform(F.concat(shown, F.array(quoted_url)), status_url)), lambda u: u != F.col("url"))
    text = F.coalesce(text_at(tweet, ".note_tweet.note_tweet_results.result.text"), text_at(tweet, ".legacy.full_text"))
    return rows.select(
        "seq",
        "position",
        F.lit("x").alias("source"),
        "url",
        title_of(text, F.concat(F.lit("@"), "author")).alias("title"),
        text.alias("post_text"),
        some(outside).alias("external_urls"),
        some(referenced).alias("referenced_tweet_urls"),
        some(merge_unique(images)).alias("image_urls"),
        status_time(text_at(tweet, ".legacy.created_at")).alias("published_at"),
        F.lit(None).cast("timestamp").alias("saved_at"),
        retrieved_at.alias("retrieved_at"),
    )


def bookmarks_from_visible_statuses(rows: DataFrame, retrieved_at: Column) -> DataFrame:
    """Statuses as seen on a page: rows (seq, url, text, author, published_at, external_urls, referenced_tweet_urls, image_urls).

    Rows without an address go. A link is outside by its host, so hosts that only end like the site's stay."""
    rows = rows.where(F.coalesce("url", F.lit("")) != "").withColumn("url", F.substring_index("url", "?", 1))
    none = F.array().cast("array<string>")
    outside = F.filter(F.coalesce("external_urls", none), lambda u: ~F.contains(u, F.lit("/status/")) & ~under(host(u), "x.com") & (u != ""))
    referenced = F.filter(F.transform(F.coalesce("referenced_tweet_urls", none), status_url), lambda u: u.isNotNull() & (u != F.col("url")))
    images = F.filter(F.coalesce("image_urls", none), lambda u: F.startswith(u, F.lit("http")))
    author = F.concat(F.lit("@"), F.coalesce("author", F.lit("unknown")))
    return rows.select(
        "seq",
        F.lit("x").alias("source"),
        "url",
        title_of(F.col("text"), author).alias("title"),
        F.nullif("text", F.lit("")).alias("post_text"),
        some(outside).alias("external_urls"),
        some(referenced).alias("referenced_tweet_urls"),
        some(images).alias("image_urls"),
        status_time(F.col("published_at")).alias("published_at"),
        F.lit(None).cast("timestamp").alias("saved_at"),
        retrieved_at.alias("retrieved_at"),
    )


def post_elements(responses: DataFrame) -> DataFrame:
    """Bodies with posts -> (seq, position, element), from the first shape that has any:
    clusters of elements with items, a list of elements, a list 'included', or a list at the top."""
    body = responses.select("seq", F.try_parse_json("body").alias("v"))
    whole = F.col("v")
    inner = F.coalesce(at(whole, ".data.data", "map<string,variant>"), at(whole, ".data", "map<string,variant>"))
    clusters = F.filter(F.map_values(F.coalesce(inner, F.create_map().cast("map<string,variant>"))), lambda c: at(c, ".elements", LIST).isNotNull())
    items = lambda e: F.coalesce(filled_list(e, ".items"), F.array(e))
    clustered = F.flatten(F.transform(clusters, lambda c: F.flatten(F.transform(list_at(c, ".elements"), items))))
    elements = F.coalesce(some(clustered), filled_list(whole, ".data.elements"), filled_list(whole, ".elements"), filled_list(whole, ".included"), some(F.try_variant_get(whole, "$", LIST)))
    return body.select("seq", F.posexplode(elements).alias("position", "element"))


def post_cursor(whole: Column) -> Column:
    """The token for the next page that a body gives."""
    inner = F.coalesce(at(whole, ".data.data", "map<string,variant>"), at(whole, ".data", "map<string,variant>"))
    clusters = F.filter(F.map_values(F.coalesce(inner, F.create_map().cast("map<string,variant>"))), lambda c: at(c, ".elements", LIST).isNotNull())
    in_cluster = F.get(F.filter(F.transform(clusters, lambda c: F.coalesce(F.nullif(at(c, ".metadata.paginationToken"), F.lit("")), at(c, ".paging.start"))), lambda x: x.isNotNull()), F.lit(0))
    places = [".data.paging.nextCursor", ".paging.nextCursor", ".data.paging.start", ".paging.start", ".data.metadata.nextCursor", ".metadata.nextCursor"]
    return F.coalesce(in_cluster, *[F.nullif(at(whole, p), F.lit("")) for p in places])


def post_cursors(responses: DataFrame) -> DataFrame:
    """(seq, cursor): the token for the next page."""
    return responses.select("seq", post_cursor(F.try_parse_json("body")).alias("cursor")).where(F.col("cursor").isNotNull())


def post_author(post: Column) -> Column:
    """A name, else first and last name, else an identifier, else 'unknown'; the author may be a plain string."""
    found = []
    for place in (".author", ".actor", ".owner"):
        names = strip(F.concat_ws(" ", F.coalesce(text_at(post, f"{place}.firstName"), F.lit("")), F.coalesce(text_at(post, f"{place}.lastName"), F.lit(""))))
        found.append(F.coalesce(text_at(post, f"{place}.name"), F.nullif(names, F.lit("")), text_at(post, f"{place}.publicIdentifier"), text_at(post, place)))
    return F.coalesce(*found, F.lit("unknown"))


def nested(v: Column, kind: str) -> Column:
    """The values of an object, or an empty list."""
    return F.map_values(F.coalesce(F.try_variant_get(v, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>")))


WALK = """
WITH RECURSIVE walk(id, depth, path, v) MAX RECURSION LEVEL {levels} AS (
  SELECT id, 0, CAST(array() AS ARRAY<INT>), v FROM {{rows}}
  UNION ALL
  SELECT w.id, w.depth + 1, concat(w.path, array(e.pos)), e.value FROM walk w, LATERAL variant_explode(w.v) e WHERE w.depth < {depth})
SELECT id, depth, path, CAST(v AS STRING) AS text FROM walk WHERE schema_of_variant(v) = 'STRING'
"""


def json_strings(rows: DataFrame, depth: int) -> DataFrame:
    """rows(id, v) -> (id, depth, path, text): all strings inside a VARIANT down to ``depth`` levels, each where it stands.

    One recursive query: a step is the members of the objects and lists that the step before it found, for all rows at once,
    so the plan is the same for any depth. Paths order strings as they stand in the body (keys of an object by name)."""
    return rows.sparkSession.sql(WALK.format(levels=depth + 2, depth=depth), rows=rows.select("id", "v"))


TEXT_PLACES = (".text", ".commentary", ".description", ".text.text", ".commentary.text", ".description.text", ".commentary.value", ".commentary.value.text")


# What marks an address as a picture's.
IMAGE_MARKS = [".jpg", ".jpeg", ".png", ".webp", "media.licdn.com", "image"]


def with_nested_links(rows: DataFrame, post: str = "post", own_domain: str = "linkedin.com", depth: int = 6, image_depth: int = 8) -> DataFrame:
    """Rows with ``external_urls`` and ``image_urls``, in the order in which they stand in the VARIANT ``post``; null where there are none.

    External are addresses down to ``depth`` levels that don't lead back to the site, once each without query, and those in
    the post's texts that are none of these. Rows may repeat. Addresses of a row are brought together by one shuffle of
    addresses, not of bodies; the rows are written once, as they are read twice."""
    spark = rows.sparkSession
    if "row_id" in rows.columns:
        raise ValueError("row_id is a name of the walk's own")
    rows = materialize(rows.withColumn("row_id", F.monotonically_increasing_id()), "posts")
    text = F.col("text")
    strings = json_strings(rows.select(F.col("row_id").alias("id"), F.col(post).alias("v")), max(depth, image_depth)).where(F.startswith(text, F.lit("http")))
    marked = reduce(lambda a, b: a | b, [F.contains(F.lower(text), F.lit(m)) for m in IMAGE_MARKS])
    place = lambda kind, path, at: F.struct(F.lit(kind).alias("kind"), path.alias("path"), at.alias("at"))
    outside = F.when((F.col("depth") <= depth) & ~F.contains(text, F.lit(own_domain)), F.struct(F.lit("link").alias("sort"), F.substring_index(text, "?", 1).alias("key")))
    picture = F.when((F.col("depth") <= image_depth) & marked, F.struct(F.lit("image").alias("sort"), text.alias("key")))
    walked = strings.select("id", F.explode(F.array_compact(F.array(outside, picture))).alias("as"), place(0, F.col("path"), F.lit(0)).alias("place"), text.alias("url"))
    texts = F.concat_ws(" ", *[text_at(F.col(post), p) for p in TEXT_PLACES])
    written = rows.select(F.col("row_id").alias("id"), F.posexplode(find_urls(texts)).alias("at", "url")).where(~F.contains("url", F.lit(own_domain)))
    written = written.select("id", F.struct(F.lit("link").alias("sort"), F.col("url").alias("key")).alias("as"), place(1, F.array().cast("array<int>"), F.col("at")).alias("place"), "url")
    once = walked.unionByName(written).groupBy("id", "as").agg(F.min_by("url", "place").alias("url"), F.min("place").alias("place"))
    of = lambda sort: some(F.transform(F.array_sort(F.collect_list(F.when(F.col("as.sort") == sort, F.struct("place", "url")))), lambda x: x["url"]))
    name = "spark.sql.cteRecursionRowLimit"
    most = spark.conf.get(name)
    spark.conf.set(name, "-1")  # else a step may have a million rows at most
    try:
        found = materialize(once.groupBy("id").agg(of("link").alias("external_urls"), of("image").alias("image_urls")), "post-links")
    finally:
        spark.conf.set(name, most)
    return rows.join(found, rows["row_id"] == found["id"], "left").drop("row_id", "id")


def posts(elements: DataFrame, with_links: bool = True) -> DataFrame:
    """(seq, position, url, text, author, created_at, created_text, saved_at, external_urls, image_urls) of elements with an address.

    Links and pictures are looked for by ``with_nested_links``; without ``with_links`` they are null, and nothing is written."""
    none = F.lit(None).cast("array<string>")
    element = F.col("element")
    card_url = F.coalesce(text_at(element, ".navigationUrl"), text_at(element, ".trackableAction.navigationUrl"))
    content = F.coalesce(at(element, ".content.data", "variant"), at(element, ".content", "variant"), element)
    typed = F.get(F.filter(F.map_entries(F.coalesce(at(content, ".value", "map<string,variant>"), F.create_map().cast("map<string,variant>"))), lambda e: F.contains(e["key"], F.lit("com.linkedin"))), F.lit(0))["value"]
    rows = elements.withColumn("card_url", card_url).withColumn("post", F.when(card_url.isNotNull(), element).otherwise(F.coalesce(typed, content)))
    post, card = F.col("post"), F.col("card_url").isNotNull()
    inside = F.get(F.filter(F.transform(nested(post, "object"), lambda v: F.coalesce(text_at(v, ".url"), text_at(v, ".permalink"), text_at(v, ".shareUrl"))), lambda u: F.startswith(u, F.lit("http"))), F.lit(0))
    url = F.coalesce("card_url", *[text_at(post, p) for p in (".url", ".permalink", ".shareUrl", ".activity.url", ".activity.permalink", ".navigationUrl", ".canonicalUrl")], inside)
    absolute = F.when(card | F.startswith(url, F.lit("http")), url).otherwise(F.concat(F.lit("https://www.linkedin.com"), url))
    card_body = F.coalesce(text_at(post, ".commentary.text"), text_at(post, ".commentary"), text_at(post, ".description.text"), text_at(post, ".description"))
    body = F.coalesce(text_at(post, ".text"), text_at(post, ".text.text"), text_at(post, ".commentary"), text_at(post, ".commentary.text"), text_at(post, ".commentary.value.text"), text_at(post, ".commentary.value"), text_at(post, ".content.text"))
    time = lambda *names: F.coalesce(*[F.nullif(at(post, n), F.lit("")) for n in names])
    out = rows.select(
        "seq",
        "position",
        absolute.alias("url"),
        F.when(card, card_body).otherwise(body).alias("text"),
        post_author(post).alias("author"),
        time(".createdAt", ".time", ".createdTime").alias("created_at"),
        time(".createdAtText").alias("created_text"),
        time(".savedAt", ".savedTime", ".saved_at").alias("saved_at"),
        "post",
    ).where(F.coalesce("url", F.lit("")) != "")
    return with_nested_links(out).drop("post") if with_links else out.drop("post").withColumns({"external_urls": none, "image_urls": none})


def bookmarks_from_posts(rows: DataFrame, retrieved_at: Column) -> DataFrame:
    """Rows of ``posts`` -> (seq, position, bookmark columns), under canonical addresses.

    A text that is the printed form of an object, {'text': '...'}, gives the text inside."""
    printed = F.startswith("text", F.lit("{")) & F.contains("text", F.lit("'text'"))
    inner = F.regexp_extract("text", r"'text':\s*(?:'((?:[^'\\]|\\.)*)'|\"((?:[^\"\\]|\\.)*)\")", 1)
    text = F.nullif(F.when(printed, inner).otherwise(F.col("text")), F.lit(""))
    none = F.array().cast("array<string>")
    return rows.select(
        "seq",
        "position",
        F.lit("linkedin").alias("source"),
        normalize_url(F.col("url")).alias("url"),
        title_of(text, F.col("author")).alias("title"),
        text.alias("post_text"),
        some(F.coalesce("external_urls", none)).alias("external_urls"),
        F.lit(None).cast("array<string>").alias("referenced_tweet_urls"),
        some(F.coalesce("image_urls", none)).alias("image_urls"),
        F.coalesce(post_time(F.col("created_at")), relative_time(F.coalesce("created_text", "created_at"), retrieved_at)).alias("published_at"),
        post_time(F.col("saved_at")).alias("saved_at"),
        retrieved_at.alias("retrieved_at"),
    )


def bookmarks_from_pages(pages: DataFrame, retrieved_at: Column) -> DataFrame:
    """Bookmarks of pages(source, seq, body) of both feeds."""
    from_x = bookmarks_from_statuses(statuses(pages.where("source = 'x'")), retrieved_at).drop("position")
    return from_x.unionByName(bookmarks_from_posts(posts(post_elements(pages.where("source = 'linkedin'"))), retrieved_at).drop("position"))


# What marks an address as one of the feed's services.
SERVICE_MARKS = ["/voyager/", "/feed/recommendedEntities", "/saved-items"]


def service_responses(responses: DataFrame) -> DataFrame:
    """Bodies of the feed's services with a status that says that the session holds."""
    ours = reduce(lambda a, b: a | b, [F.contains("url", F.lit(m)) for m in SERVICE_MARKS])
    return responses.where(ours & F.col("status").between(200, 399))


def session_holds(responses: DataFrame) -> DataFrame:
    """One row: whether any response has a status from 200 to 399."""
    return responses.agg(F.coalesce(F.bool_or(F.col("status").between(200, 399)), F.lit(False)).alias("holds"))
