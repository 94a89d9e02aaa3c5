"""Addresses: one canonical form for each post or page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that only track where a reader came from.
TRACKING_PARAMS = [
    "utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term",
    "fbclid", "gclid", "irclickid", "ref", "ref_src", "ref_url", "source",
]

PARTS = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)(?::\d*)?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
POST_HOSTS = ["linkedin.com", "www.linkedin.com"]
POST_BASE = "https://www.linkedin.com/feed/update/urn:li:"


def part(url: Column, k: int) -> Column:
    return F.regexp_extract(url, PARTS, k)


def host(url: Column) -> Column:
    return F.lower(part(url, 2))


def decoded(text: Column) -> Column:
    """Percent escapes decoded; the text itself where they are broken."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def kept_query(query: Column) -> Column:
    """Parameters that don't track, those of one name together where the first of them stands. A parameter without '='
    gains one; empty parameters go."""
    name = lambda p: F.substring_index(p, "=", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    full = F.transform(pairs, lambda p: F.when(F.contains(p, F.lit("=")), p).otherwise(F.concat(p, F.lit("="))))
    kept = F.filter(full, lambda p: ~name(p).isin(TRACKING_PARAMS))
    names = F.array_distinct(F.transform(kept, name))
    together = F.flatten(F.transform(names, lambda n: F.filter(kept, lambda p: name(p) == n)))
    return F.array_join(F.when(F.size(names) < F.size(kept), together).otherwise(kept), "&")


def canonical_post(url: Column) -> Column:
    """The form with the post's number, for the hosts in POST_HOSTS; null for all other addresses."""
    whole, path = decoded(url), decoded(part(url, 3))
    urn = r"urn:li:(activity|article):(\d+)"
    kind, number = F.regexp_extract(whole, urn, 1), F.regexp_extract(whole, urn, 2)
    in_path = F.regexp_extract(path, r"(?:activity-|/activity/|/activity:)(\d+)", 1)
    found = F.when(number != "", F.concat(F.lit(POST_BASE), kind, F.lit(":"), number)).when(in_path != "", F.concat(F.lit(POST_BASE + "activity:"), in_path))
    return F.when(host(url).isin(POST_HOSTS), found)


def normalize_url(url: Column) -> Column:
    """Lower-case scheme and host without port and user, no fragment, no tail of slashes, no tracking parameters.

    A host in brackets keeps them; parameters keep their escapes, and their order but for repeated names. Text that is no address with a scheme stays as it is; null stays null."""
    path = F.regexp_replace(part(url, 3), "/+$", "")
    query = kept_query(part(url, 4))
    plain = F.concat(F.lower(part(url, 1)), F.lit("://"), host(url), F.when(path == "", F.lit("/")).otherwise(path), F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)))
    return F.coalesce(canonical_post(url), F.when(part(url, 1) == "", url).otherwise(plain))


def valid_url(url: Column) -> Column:
    return F.coalesce(host(url) != "", F.lit(False)) & F.lower(part(url, 1)).isin("http", "https")


STATUS = r"https?://(?:www\.)?(?:x|twitter)\.com/([^/?#]+)/status/(\d+)"


def status_url(url: Column) -> Column:
    """The canonical address of a status, null for anything else."""
    number = F.regexp_extract(url, STATUS, 2)
    return F.when(number != "", F.concat(F.lit("https://x.com/"), F.regexp_extract(url, STATUS, 1), F.lit("/status/"), number))


def under(name: Column, domain: str) -> Column:
    """Whether a host is a domain or lies under it."""
    return (name == domain) | F.endswith(name, F.lit("." + domain))


def stable_id(source: Column, url: Column) -> Column:
    """The number of a status or post, else ten hex digits of the address's SHA-1."""
    bare = F.regexp_replace(url, "/+$", "")
    status = F.when(source == "x", F.nullif(F.regexp_extract(bare, r"/status/(\d+)", 1), F.lit("")))
    activity = F.when(source == "linkedin", F.nullif(F.regexp_extract(bare, r"(?:activity:|activity-)(\d+)", 1), F.lit("")))
    return F.coalesce(status, activity, F.substring(F.sha1(bare.cast("binary")), 1, 10))


def slug(title: Column) -> Column:
    """Lower case; ASCII letters, digits and hyphens alone; 'untitled' if nothing is left."""
    name = F.regexp_replace(F.lower(title), r"[^a-zA-Z0-9 _-]", "")
    name = F.regexp_replace(F.regexp_replace(name, r"[ _]+", "-"), "-{2,}", "-")
    name = F.regexp_replace(name, "^-+|-+$", "")
    return F.when(F.coalesce(name, F.lit("")) == "", F.lit("untitled")).otherwise(name)


def note_name(source: Column, url: Column, title: Column) -> Column:
    return F.concat(slug(title), F.lit("-"), stable_id(source, url), F.lit(".md"))
