"""Pages and articles: titles, dates, visible text, gates, binaries, snippets, and addresses within texts."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from loamline.functions.keys import plain_words
from loamline.functions.urls import bare_host, url_part
from loamline.functions.vocabulary import BAD_TITLES, HUB_SLUGS

# Elements whose text is no content, and the meta fields that dates are read from, in order.
SKIPPED = frozenset(["script", "style", "nav", "footer", "header", "aside", "noscript"])
PUBLISHED_META = ["article:published_time", "datePublished", "pubdate", "date"]
UPDATED_META = ["article:modified_time", "dateModified"]


class _Visible(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.parts: list[str] = []
        self.depth = 0

    def handle_starttag(self, tag, attrs) -> None:  # noqa: ANN001
        self.depth += tag in SKIPPED

    def handle_endtag(self, tag) -> None:  # noqa: ANN001
        self.depth = max(0, self.depth - (tag in SKIPPED))

    def handle_data(self, data: str) -> None:
        if not self.depth and data.strip():
            self.parts.append(data)


def visible_text(html: str | None) -> str | None:
    """Text of a page without scripts, styles, navigation, headers, footers and asides."""
    if html is None:
        return None
    parser = _Visible()
    parser.feed(html)
    parser.close()
    return re.sub(r"\s+", " ", " ".join(parser.parts)).strip()


@F.pandas_udf(StringType())
def html_to_text(html: pd.Series) -> pd.Series:
    return html.map(visible_text)


@F.pandas_udf(StringType())
def article_text(html: pd.Series) -> pd.Series:
    """Text of the article element if above 200 characters, else of the main element, else of the page."""

    def pick(x: str | None) -> str | None:
        if x is None:
            return None
        for tag in ("article", "main"):
            m = re.search(rf"<{tag}\b[^>]*>(.*?)</{tag}>", x, flags=re.I | re.S)
            if m and len(t := visible_text(m.group(1)) or "") > 200:
                return t
        return visible_text(x)

    return html.map(pick)


def html_title(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_extract(html, r"(?is)<title[^>]*>([^<]+)</title>", 1), r"\s+", " "))


def _meta(html: Column, name: str) -> Column:
    a = F.regexp_extract(html, rf"(?is)<meta[^>]+(?:property|name|itemprop)=[\"']{name}[\"'][^>]+content=[\"']([^\"']+)[\"']", 1)
    b = F.regexp_extract(html, rf"(?is)<meta[^>]+content=[\"']([^\"']+)[\"'][^>]+(?:property|name|itemprop)=[\"']{name}[\"']", 1)
    return F.coalesce(F.nullif(a, F.lit("")), F.nullif(b, F.lit("")))


def og_title(html: Column) -> Column:
    return F.coalesce(F.trim(F.regexp_replace(_meta(html, "og:title"), r"\s+", " ")), F.lit(""))


def parse_date(text: Column) -> Column:
    """A timestamp of a date text: whole, its first 19, its first 10 characters."""
    t = F.trim(text)
    return F.coalesce(t.try_cast("timestamp"), F.substring(t, 1, 19).try_cast("timestamp"), F.substring(t, 1, 10).try_cast("timestamp"))


def html_date(html: Column, fields: list[str]) -> Column:
    return F.coalesce(*[parse_date(_meta(html, f)) for f in fields])


def pick_published(rss: Column, html: Column, search: Column, inferred: Column, now: Column) -> Column:
    """``struct<published_at, source, confidence>``: the first of feed, page, search and inference that is not in the future
    (two days aside)."""
    fine = lambda c: c.isNotNull() & (c <= now + F.expr("interval 2 days"))
    made = lambda c, s, p: F.struct(c.alias("published_at"), F.lit(s).alias("source"), F.lit(p).alias("confidence"))
    return (
        F.when(fine(rss), made(rss, "rss", 0.95)).when(fine(html), made(html, "html", 0.85)).when(fine(search), made(search, "search", 0.75))
        .when(fine(inferred), made(inferred, "inferred", 0.5)).otherwise(made(F.lit(None).cast("timestamp"), "missing", 0.0))
    )


def is_gate_page(title: Column, body: Column) -> Column:
    """Consent and gate pages, told by their title and the first 1200 characters of their text."""
    t = F.lower(F.trim(F.coalesce(title, F.lit(""))))
    head = F.lower(F.substring(F.coalesce(body, F.lit("")), 1, 1200))
    by_title = t.rlike("before you continue|error 400|bad request")
    consent = head.contains("before you continue") & head.rlike(r"google|g\.co/privacy")
    terms = head.contains("we use cookies and data to") & head.contains("privacy policy") & head.contains("terms of service")
    return by_title | consent | terms


def better_title(page: Column, item: Column) -> Column:
    """The page's title, or the feed item's where the page's is missing, short or that of an error page."""
    p, i = F.trim(F.coalesce(page, F.lit(""))), F.trim(F.coalesce(item, F.lit("")))
    poor = F.lower(p).isin(BAD_TITLES) | (F.length(p) < 12) | F.lower(p).rlike("error 400|bad request")
    return F.when((i != "") & poor, i).otherwise(p)


def adds_little(title: Column, body: Column) -> Column:
    """Whether a text says hardly more than its headline: equal, or one within the other and at most 40 characters longer."""
    t, b = plain_words(title), plain_words(body)
    within = (F.contains(b, t) & (F.length(b) <= F.length(t) + 40)) | (F.contains(t, b) & (F.length(t) <= F.length(b) + 40))
    return F.when(b == "", True).when(t == "", F.length(b) < 120).otherwise(within)


def binary_payload(content: Column) -> Column:
    """Signatures of PDF, image and archive files at the begin of a payload, white space aside."""
    head = F.hex(F.substring(content, 1, 64))
    head = F.regexp_replace(head, "^(?:20|09|0A|0D)+", "")
    return head.rlike("^(?:255044462D|89504E470D0A1A0A|FFD8FF|474946383[79]61|1F8B|504B0304|52494646.{8}57454250)")


def looks_binary(body: Column) -> Column:
    """PDF and office signatures, or many control or replacement characters within the first 800."""
    head = F.substring(body, 1, 800)
    return F.startswith(body, F.lit("%PDF-")) | F.startswith(body, F.lit("PK\u0003\u0004")) | (F.regexp_count(head, F.lit(r"[\x00-\x08\x0e-\x1f]")) >= 10) | (F.regexp_count(head, F.lit("�")) >= 40)


def urls_in_text(text: Column) -> Column:
    """Addresses within a text, without the punctuation that follows them."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?i)(https?://[^\s<>\"'\[\]]+)"), F.lit(1))
    return F.transform(found, lambda u: F.regexp_replace(u, r"[.,;:!?)\]}\"'>\s]+$", ""))


def hrefs(html: Column) -> Column:
    return F.filter(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?i)href\s*=\s*[\"']([^\"']+)[\"']"), F.lit(1)), lambda u: F.startswith(u, F.lit("http")))


def is_site_root_or_hub(url: Column) -> Column:
    parts = F.filter(F.split(url_part(url, "path"), "/"), lambda p: p != "")
    return (F.size(parts) == 0) | ((F.size(parts) == 1) & F.lower(F.get(parts, 0)).isin(HUB_SLUGS))


def best_publisher_url(candidates: Column, gate_hosts: list[str]) -> Column:
    """The candidate with the deepest, then longest address that is an article's: no gate, no root, no section front."""

    def depth(u: Column) -> Column:
        return F.size(F.filter(F.split(url_part(u, "path"), "/"), lambda p: p != ""))

    usable = F.filter(candidates, lambda u: F.startswith(u, F.lit("http")) & ~bare_host(u).isin(gate_hosts) & ~is_site_root_or_hub(u))
    return F.array_max(F.transform(usable, lambda u: F.struct(depth(u).alias("d"), F.length(u).alias("n"), u.alias("u"))))["u"]


def article_url(link: Column, source_href: Column, links: Column, summary: Column, gate_hosts: list[str]) -> Column:
    """Where a feed entry's article is: its link unless that is a gate, else the best of source, links and summary."""
    is_gate = bare_host(link).isin(gate_hosts)
    empty = F.array().cast("array<string>")
    first = F.filter(F.concat(F.array_compact(F.array(source_href)), F.coalesce(links, empty)), lambda u: F.startswith(u, F.lit("http")) & ~bare_host(u).isin(gate_hosts) & ~is_site_root_or_hub(u))
    within = best_publisher_url(F.concat(hrefs(summary), urls_in_text(summary)), gate_hosts)
    return F.when(~is_gate, link).otherwise(F.coalesce(F.get(first, 0), within, link))


def snippet_quality(body: Column, country: Column, title: Column, max_hosts: int, require_match: bool) -> Column:
    """``struct<ok, reason>``: at most ``max_hosts`` hosts in a search snippet, and the country or two words of the title."""
    hosts = F.size(F.array_distinct(F.transform(urls_in_text(body), lambda u: bare_host(u))))
    low = F.lower(F.coalesce(body, F.lit("")))
    named = (F.trim(F.coalesce(country, F.lit(""))) != "") & F.contains(low, F.lower(F.trim(country)))
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(title, F.lit(""))), F.lit(r"([\p{L}\p{N}]{4,})"), F.lit(1)))
    matched = F.coalesce(named, F.lit(False)) | (F.size(F.filter(words, lambda w: F.contains(low, w))) >= 2)
    out = lambda ok, why: F.struct(F.lit(ok).alias("ok"), F.lit(why).alias("reason"))
    return F.when(hosts > max_hosts, out(False, "too many distinct domains")).when(F.lit(require_match) & ~matched, out(False, "neither country nor title")).otherwise(out(True, ""))
