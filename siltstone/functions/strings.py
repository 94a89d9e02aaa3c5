"""Small string and array helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends (Spark's own trim takes spaces alone)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def filled(c: Column) -> Column:
    """Null instead of a blank string."""
    return F.when(F.length(strip(c)) > 0, c)


def first_filled(*columns: Column) -> Column:
    """The first column that is neither null nor ''."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def some(c: Column) -> Column:
    """Null instead of an empty array."""
    return F.when(F.size(c) > 0, c)


def merge_unique(*arrays: Column) -> Column:
    """All elements in the order of their first appearance, without nulls and ''."""
    parts = [F.coalesce(a, F.array().cast("array<string>")) for a in arrays]
    return F.array_distinct(F.filter(F.concat(*parts), lambda x: x.isNotNull() & (x != "")))


def any_match(c: Column, patterns: list[str], flags: str = "iud") -> Column:
    """Whether one of the patterns is found."""
    return c.rlike(f"(?{flags})" + "|".join(f"(?:{p})" for p in patterns))


def remove_all(c: Column, patterns: list[str], flags: str) -> Column:
    """The patterns removed one after the other."""
    return reduce(lambda text, p: F.regexp_replace(text, f"(?{flags})" + p, ""), patterns, c)


def find_urls(text: Column) -> Column:
    """http and https addresses in running text."""
    return F.regexp_extract_all(text, F.lit(r"(https?://[^\s<\"\)\}\]]+)"), 1)
