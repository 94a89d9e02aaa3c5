"""The canonical address as Python's urllib would write it: repeated parameters stand together, escapes are rewritten.

An address that urllib cannot read stays as it is. Slower than ``urls.normalize_url``; for stores whose keys were written that way."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .urls import TRACKING_PARAMS, canonical_post


def rewrite(url: str | None) -> str | None:
    from urllib.parse import parse_qsl, urlencode, urlsplit

    if url is None:
        return None
    try:
        parts = urlsplit(url)
        name = parts.hostname
    except ValueError:  # brackets that hold no address, for one: no rows to lose over it
        return url
    values: dict[str, list[str]] = {}
    for key, value in parse_qsl(parts.query, keep_blank_values=True):
        if key not in TRACKING_PARAMS:
            values.setdefault(key, []).append(value)
    query = urlencode(values, doseq=True)
    host = (name or parts.netloc).lower()
    return f"{parts.scheme}://{host}{parts.path.rstrip('/') or '/'}{'?' + query if query else ''}" if parts.scheme else url


def normalize_url_strict(url: Column) -> Column:
    @F.pandas_udf("string")
    def run(urls: pd.Series) -> pd.Series:
        return urls.map(rewrite)

    return F.coalesce(canonical_post(url), run(url))
