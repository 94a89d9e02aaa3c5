"""Prompt and answer of the enrichment step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import strip

def found(answer: Column, pattern: str) -> Column:
    return strip(F.regexp_extract(answer, "(?i)" + pattern, 1))


def parse_answer(answer: Column) -> Column:
    """struct(summary_bullets, takeaway, tags).

    Bullets are the lines after 'SUMMARY:' that begin with a hyphen, up to the first other line; the takeaway is the
    rest of its line, tags are comma-separated and lower-cased. Headers are found in any case; what is missing is empty."""
    lines = F.transform(F.split(F.regexp_extract(answer, r"(?i)SUMMARY:\s*\n((?:\s*-.*\n?)+)", 1), "\n"), strip)
    bullets = F.transform(F.filter(lines, lambda x: F.startswith(x, F.lit("-"))), lambda x: strip(F.regexp_replace(x, "^[- ]+", "")))
    tags = F.filter(F.transform(F.split(F.regexp_extract(answer, r"(?i)TAGS:\s*(.+)", 1), ","), lambda x: F.lower(strip(x))), lambda x: x != "")
    return F.struct(bullets.alias("summary_bullets"), found(answer, r"TAKEAWAY:[ \t]*([^\n]+)").alias("takeaway"), tags.alias("tags"))


def three_bullets(bullets: Column, source: Column, title: Column) -> Column:
    """Exactly three: cut, or filled up with a line that names source and title."""
    filler = F.concat(F.lit("Key point from "), source, F.lit(": "), F.substring(title, 1, 80))
    return F.slice(F.concat(bullets, F.array_repeat(filler, 3)), 1, 3)


def takeaway_of(takeaway: Column, answer: Column) -> Column:
    """The takeaway, or the answer's text up to its first full stop."""
    return F.when(takeaway != "", takeaway).otherwise(F.substring(strip(F.substring_index(answer, ".", 1)), 1, 200))


def word_count(text: Column) -> Column:
    return F.when(F.length(strip(text)) > 0, F.size(F.split(strip(text), r"(?U)\s+"))).otherwise(F.lit(0))


def prompt(source: Column, title: Column, url: Column, post_text: Column, full_text: Column, method: Column, external_urls: Column) -> Column:
    """The request for a row: what to do, what is known, and the form of the answer.

    Only text of the article extractor goes in whole; otherwise the post's own text does."""
    kind = F.when(source == "x", F.lit("short post, perhaps of a thread; tell what it says itself, not what error pages or controls around it say, and invent nothing about pages that it links to")).otherwise(F.lit("saved article or post"))
    body = (
        F.when((method == "trafilatura") & (F.coalesce(full_text, F.lit("")) != ""), F.concat(F.lit("\nContent:\n"), full_text))
        .when(F.coalesce(post_text, F.lit("")) != "", F.concat(F.lit("\nText: "), post_text))
        .otherwise(F.lit("\n(No additional content available)"))
    )
    links = F.when(F.coalesce(F.size(external_urls), F.lit(0)) > 0, F.concat(F.lit("\nLinks:\n"), F.array_join(F.transform(external_urls, lambda u: F.concat(F.lit("- "), u)), "\n")))
    form = "\nAnswer in this form:\nSUMMARY:\n- bullet 1\n- bullet 2\n- bullet 3\nTAKEAWAY: one sentence\nTAGS: tag1, tag2, tag3"
    head = F.concat(F.lit("Summarise this "), kind, F.lit(": three bullets, one takeaway, three to five lower-case tags."))
    return F.concat_ws("\n", head, F.concat(F.lit("Title: "), title), F.concat(F.lit("URL: "), url), body, links, F.lit(form))
