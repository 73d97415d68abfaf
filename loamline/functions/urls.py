"""Addresses: normal forms and parts, as Catalyst expressions that never throw."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query parameters that only track the reader.
TRACKING = ["utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "gclid", "fbclid", "mc_cid", "mc_eid"]

_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def url_part(url: Column | str, part: str) -> Column:
    """``scheme``, ``host`` (lower case, with port), ``path`` or ``query``; an empty text where it is missing."""
    u = F.trim(F.col(url) if isinstance(url, str) else url)
    value = F.regexp_extract(u, _PARTS, {"scheme": 1, "host": 2, "path": 3, "query": 4}[part])
    return F.lower(value) if part in ("scheme", "host") else value


def bare_host(url: Column | str) -> Column:
    """Host without a leading ``www.``."""
    return F.regexp_replace(url_part(url, "host"), r"^www\.", "")


def _recode(text: Column) -> Column:
    """A query component decoded and encoded again, so that spellings of one value agree; malformed ones stay."""
    return F.coalesce(F.url_encode(F.try_url_decode(text)), text)


def normalise_url(url: Column | str, *, same_scheme: bool = False) -> Column:
    """The address that stands for a page: host in lower case without ``www.``, no fragment, path parameters or tracking
    parameters, single slashes, no slash at the end. Null gives null, a blank address an empty text.

    same_scheme: http and https are one.
    """
    u = F.trim(F.col(url) if isinstance(url, str) else url)
    scheme = url_part(u, "scheme")
    scheme = F.when((scheme == "") | (F.lit(same_scheme) & (scheme == "http")), F.lit("https")).otherwise(scheme)
    path = F.regexp_replace(url_part(u, "path"), r";[^/]*$", "")
    path = F.regexp_replace(F.regexp_replace(path, "/+", "/"), "/$", "")
    pairs = F.filter(F.split(url_part(u, "query"), "&"), lambda p: p != "")
    pairs = F.transform(pairs, lambda p: F.struct(F.split_part(p, F.lit("="), F.lit(1)).alias("k"), F.regexp_extract(p, "^[^=]*=?(.*)$", 1).alias("v")))
    pairs = F.filter(pairs, lambda p: ~F.lower(_recode(p.k)).isin(TRACKING))
    query = F.array_join(F.transform(pairs, lambda p: F.concat(_recode(p.k), F.lit("="), _recode(p.v))), "&")
    whole = F.concat(
        scheme, F.lit("://"), bare_host(u), F.when(path == "", "/").otherwise(path), F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")
    )
    return F.when(u == "", "").otherwise(whole)
