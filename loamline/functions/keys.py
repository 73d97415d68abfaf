"""Keys and hashes: surrogate keys, content hashes, document, chunk and cluster identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CHARS_PER_TOKEN = 4


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def surrogate_key(*parts: Column | str) -> Column:
    """MD5 of the parts joined by a pipe; a null part is an empty one, never left out."""
    texts = [F.coalesce(_c(p).cast("string"), F.lit("")) for p in parts]
    joined = [x for t in texts for x in (F.lit("|"), t)][1:]
    return F.md5(F.concat(*joined))


def collapse(text: Column | str) -> Column:
    """Runs of white space, no-break spaces included, as one space; none at the ends."""
    return F.trim(F.regexp_replace(_c(text), r"(?U)\s+", " "))


def token_estimate(text: Column | str) -> Column:
    """A quarter of the characters, at least 1."""
    return F.greatest(F.lit(1), F.floor(F.length(_c(text)) / CHARS_PER_TOKEN)).cast("int")


def chunk_content_hash(text: Column | str) -> Column:
    """SHA-256 of the collapsed text, case kept."""
    return F.sha2(collapse(F.coalesce(_c(text), F.lit(""))), 256)


def article_content_hash(text: Column | str) -> Column:
    """SHA-256 of the collapsed text in lower case."""
    return F.sha2(collapse(F.lower(F.coalesce(_c(text), F.lit("")))), 256)


def plain_words(text: Column | str) -> Column:
    """Lower case, everything but ASCII letters, digits and spaces as a space, collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(_c(text), F.lit(""))), r"[^a-z0-9\s]", " "), r"\s+", " "))


def dedupe_id(title: Column | str, host: Column | str) -> Column:
    """16 hex digits of the plain title and the host."""
    return F.substring(F.sha2(F.concat(plain_words(title), F.lit("|"), F.lower(F.coalesce(_c(host), F.lit("")))), 256), 1, 16)


def cluster_id(title: Column | str, country: Column | str, domain: Column | str, published: Column | str) -> Column:
    """16 hex digits of the first 120 characters of the plain title, country, domain and UTC day (``unknown`` if null)."""
    day = F.coalesce(F.date_format(_c(published), "yyyy-MM-dd"), F.lit("unknown"))
    low = lambda x: F.lower(F.coalesce(_c(x), F.lit("")))
    return F.substring(
        F.sha2(F.concat(F.substring(plain_words(title), 1, 120), F.lit("|"), low(country), F.lit("|"), low(domain), F.lit("|"), day), 256), 1, 16
    )


def article_id(url: Column | str) -> Column:
    return F.substring(F.sha2(_c(url), 256), 1, 16)


def document_id(known: Column | str, path: Column | str) -> Column:
    """A known id if there is one, else 32 hex digits of the path."""
    return F.coalesce(F.nullif(F.trim(_c(known)), F.lit("")), F.substring(F.sha2(_c(path), 256), 1, 32))


def uuid5(namespace: str, name: Column) -> Column:
    """Name-based UUID (version 5), as an expression: SHA-1 of namespace and name with the version and variant bits set."""
    space = F.unhex(F.lit(namespace.replace("-", "")))
    digest = F.sha1(F.concat(space, name.cast("binary")))
    variant = F.element_at(F.array(*[F.lit(x) for x in "89ab"]), (F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4) + 1)
    return F.concat_ws(
        "-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12),
    )


def chunk_id(namespace: str, corpus: str, document: Column | str, index: Column | str, content: Column | str) -> Column:
    """UUID of corpus, document, index and the first 16 digits of the content hash."""
    return uuid5(namespace, F.concat(F.lit(corpus), F.lit("|"), _c(document), F.lit("|"), _c(index).cast("string"), F.lit("|"), F.substring(chunk_content_hash(content), 1, 16)))


def heading_slug(text: Column | str) -> Column:
    """Heading as a path part: letters and digits in lower case, the rest as single underscores."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(_c(text))), r"[^\p{L}\p{N}]+", "_"), r"^_+|_+$", "")


def country_slug(text: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(_c(text))), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def initcap_words(text: Column | str) -> Column:
    """Every letter after a character that is no letter or digit in upper case, the others in lower case."""
    parts = F.regexp_extract_all(_c(text), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 100000)))), "")
