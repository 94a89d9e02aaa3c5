"""Timestamps as the sources write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import strip


def status_time(text: Column) -> Column:
    """ISO with a final Z, or 'Wed May 13 01:00:00 +0000 2026'; null for anything else."""
    iso = F.when(F.endswith(text, F.lit("Z")), F.try_to_timestamp(text))
    return F.coalesce(iso, F.try_to_timestamp(F.substring(text, 5, 100), F.lit("MMM dd HH:mm:ss Z yyyy")))


def epoch_time(number: Column) -> Column:
    """Seconds or, above ten thousand million, milliseconds since 1970; null for null and 0."""
    n = number.cast("double")
    return F.when(n != 0, F.timestamp_micros(F.when(n > 1e10, n * 1e3).otherwise(n * 1e6).cast("long")))


def post_time(text: Column) -> Column:
    """Digits as an epoch, or ISO; null for anything else."""
    bare = strip(text)
    return F.when(bare.rlike(r"^\d+(\.\d+)?$"), epoch_time(F.try_to_number(bare, F.lit("99999999999999999.999999")))).otherwise(F.try_to_timestamp(bare))


RELATIVE = r"(?i)\b(\d+)\s*(s|sec|secs|m|min|mins|h|hr|hrs|d|day|days|w|wk|wks|mo|mos|month|months|y|yr|yrs|year|years)\b"


def relative_time(text: Column, now: Column) -> Column:
    """``now`` less an age such as '3h' or '2 days' (months have 30 days, years 365); null if there is none."""
    amount = F.try_to_number(F.nullif(F.regexp_extract(text, RELATIVE, 1), F.lit("")), F.lit("999999999999")).cast("long")
    unit = F.lower(F.regexp_extract(text, RELATIVE, 2))
    head = F.substring(unit, 1, 1)
    seconds = (
        F.when(F.startswith(unit, F.lit("mo")), 30 * 86400)
        .when(head == "s", 1)
        .when(head == "m", 60)
        .when(head == "h", 3600)
        .when(head == "d", 86400)
        .when(head == "w", 7 * 86400)
        .when(head == "y", 365 * 86400)
    )
    return F.timestamp_micros(F.unix_micros(now) - amount * seconds * 1_000_000)
