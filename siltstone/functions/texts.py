"""Text of posts and pages: noise, cleaning, choice between candidates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import any_match, remove_all, strip

# What consent and error pages say (looked for in lower-cased text).
NOISE_PHRASES = [
    r"privacy related extensions",
    r"something went wrong, but don'?t fret",
    r"select accept to consent",
    r"linkedin and 3rd parties use.*cookie",
    r"manage settings.*cookie policy",
    r"¿alguien dijo.*?cookies",
    r"aceptar todas las cookies",
    r"x y sus socios utilizan cookies",
    r"rechazar cookies no necesarias",
    r"nosotros y nuestros socios.*?cookies",
]

# Passages of consent pages and page controls that are cut out of extracted text, in this order.
NOISE_PASSAGES = [
    r"Privacy related extensions.*?try again\.",
    r"Something went wrong, but don't fret.*?try again\.",
    r"LinkedIn and 3rd parties use.*?Cookie Policy\.",
    r"Select Accept to consent.*?choices at any time\.",
    r"Manage settings.*?Read more in our Cookie Policy\.",
    r"We and our partners use cookies.*?privacy policy\.",
    r"By clicking Accept.*?continue\.",
    r"Suscribirse\n.*?(?:\n|$)",
    r"Haz clic para [Ss]uscribirse \S+\n?",
    r"Mostrar traducción\n?",
    r"Show translation\n?",
    r"^Subscribe\n.*?(?:\n|$)",
    r"^Follow\n.*?(?:\n|$)",
    r"¿Alguien dijo[^\n]*cookies\?[\s\S]*?(?:Rechazar cookies no necesarias|Aceptar todas las cookies)\n?",
    r"Para ver los atajos del teclado[^\n]*\n?",
    r"Ver atajos (?:del teclado|de teclado)\n?",
    r"Ver posts nuevos\n?",
]


def is_noise(text: Column) -> Column:
    """Nothing, or the text of a consent or error page."""
    return F.coalesce(F.length(text) == 0, F.lit(True)) | F.coalesce(any_match(F.lower(text), NOISE_PHRASES), F.lit(False))


def clean_text(text: Column) -> Column:
    """Noise passages cut out, three or more line ends made two, runs of blanks made one; '' for null."""
    cut = remove_all(F.coalesce(text, F.lit("")), NOISE_PASSAGES, "ismud")
    return strip(F.regexp_replace(F.regexp_replace(cut, r"\n{3,}", "\n\n"), r"[ \t]+", " "))


def long_enough(text: Column, least: int) -> Column:
    return F.coalesce(F.length(strip(text)) >= least, F.lit(False))


def title_of(text: Column, author: Column, most: int = 120) -> Column:
    """The beginning of the text, or 'Post by' its author."""
    return F.when(F.coalesce(text, F.lit("")) != "", F.substring(text, 1, most)).otherwise(F.concat(F.lit("Post by "), author))


def longer_text(now: Column, other: Column) -> Column:
    """``other`` if it is strictly longer without white space around it."""
    size = lambda c: F.length(strip(F.coalesce(c, F.lit(""))))
    return F.when(size(other) > size(now), other).otherwise(now)


def fallback_text(primary: Column, fallback: Column, least: int = 50) -> Column:
    """The fallback if the primary text is missing, short or noise, and the fallback is neither noise nor shorter."""
    weak = ~long_enough(primary, least) | is_noise(primary)
    better = ~is_noise(fallback) & (F.length(fallback) > F.length(F.coalesce(primary, F.lit(""))))
    return F.when(weak & better, fallback).otherwise(primary)


def with_references(text: Column, links: Column, posts: Column) -> Column:
    """The text followed by lists of linked addresses and posts, as far as there are any; null if nothing is there."""
    listed = lambda head, urls: F.when(F.coalesce(F.size(urls), F.lit(0)) > 0, F.concat(F.lit(f"\n\n{head}:\n"), F.array_join(F.transform(urls, lambda u: F.concat(F.lit("- "), u)), "\n"))).otherwise(F.lit(""))
    return F.nullif(F.concat(F.coalesce(text, F.lit("")), listed("Referenced links", links), listed("Referenced tweets", posts)), F.lit(""))


def accepted_article(text: Column, least: int = 200, most: int = 8000) -> Column:
    """Article text without noise and with ``least`` characters, cut to ``most``; else null."""
    return F.when(~is_noise(text) & long_enough(text, least), F.substring(text, 1, most))


def redact_tokens(text: Column) -> Column:
    """Addresses of a bot without its token."""
    return F.regexp_replace(text, r"/bot[^/\s]+/sendMessage", "/bot<redacted>/sendMessage")


def card_text(text: Column) -> Column:
    """Visible text of a card on one line."""
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))
