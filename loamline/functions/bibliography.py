"""What a paper says of itself, and how it is cited."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _first(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.trim(F.regexp_extract(text, pattern, group)), F.lit(""))


def bibliographic(text: Column) -> Column:
    """``struct<doi, year, journal, pages, title, authors>`` of a paper's first page; null where it does not say.

    Title: the first line of at least four words that is no heading, address or page mark; authors: a following line of
    names divided by commas or "and".
    """
    head = F.substring(text, 1, 6000)
    doi = F.regexp_replace(_first(head, r"(?i)\b(10\.\d{4,9}/[^\s\"<>]+)"), r"[.,;)\]]+$", "")
    year = F.coalesce(
        _first(head, r"(?i)(?:©|\(c\)|published|accepted|copyright)[^\n]{0,40}?\b((?:19|20)\d{2})\b"), _first(head, r"\(((?:19|20)\d{2})\)"), _first(head, r"\b((?:19|20)\d{2})\b")
    ).try_cast("int")
    journal = F.coalesce(_first(head, r"(?m)\b((?:International |African |European )?Journal of [A-Z][\w&,' -]{2,80}?)(?=\s*[\d(,;.\n]|$)"), _first(head, r"(?mi)^journal:\s*(.+)$"))
    pages = _first(head, r"(?i)\bpp?\.\s*(\d+\s*[-–]\s*\d+)")
    lines = F.filter(F.transform(F.split(head, r"\n"), lambda x: F.trim(x)), lambda x: x != "")
    plain = F.filter(lines, lambda x: (F.size(F.split(x, r"\s+")) >= 4) & (F.length(x) <= 250) & ~x.rlike(r"(?i)^(doi|https?:|www\.|abstract|journal|vol|received|copyright|©|page \d)") & ~x.rlike(r"[.]$"))
    title = F.get(plain, 0)
    authors = F.get(F.filter(lines, lambda x: x.rlike(r"^(?:[A-Z][\w.'’-]*\s+){1,4}[A-Z][\w'’-]+(?:\s*(?:,|and|&)\s*(?:[A-Z][\w.'’-]*\s+){1,4}[A-Z][\w'’-]+)+\W*$")), 0)
    return F.struct(doi.alias("doi"), year.alias("year"), journal.alias("journal"), pages.alias("pages"), title.alias("title"), authors.alias("authors"))


def merged(known: Column, guessed: Column) -> Column:
    """Fields of a record beside the file prevail over guessed ones."""
    return F.struct(*[F.coalesce(known[f], guessed[f]).alias(f) for f in ("doi", "year", "journal", "pages", "title", "authors")])


def citation(b: Column) -> Column:
    """Authors (year). Title. Journal. pp. pages. doi: what is known, in this order."""
    when = lambda c, made: F.when(c.isNotNull() & (c.cast("string") != ""), made)
    return F.concat_ws(
        ". ", F.concat_ws(" ", b["authors"], when(b["year"], F.concat(F.lit("("), b["year"].cast("string"), F.lit(")")))), b["title"], b["journal"],
        when(b["pages"], F.concat(F.lit("pp. "), b["pages"])), when(b["doi"], F.concat(F.lit("doi:"), b["doi"])),
    )
