"""Facets of a question: years, intent, countries, and what news may be filtered by."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamline.functions.vocabulary import INTENTS, PLACES, QUESTION_ALIASES, REGIONS


def year_range(text: Column, today: Column) -> Column:
    """``struct<time_start, time_end>``: "past" or "last" so many years up to today (1 to 50), else the first day of the first
    and the last day of the last year named (1900 to 2099); null where none is. today is a parameter, so that runs repeat."""
    span = F.regexp_extract(F.lower(text), r"\b(?:past|last)\s+(\d{1,2})\s+years?\b", 1).try_cast("int")
    n = F.greatest(F.lit(1), F.least(F.lit(50), span))
    back = F.make_date(F.year(today) - n, F.month(today), F.least(F.day(today), F.lit(28)))
    years = F.regexp_extract_all(text, F.lit(r"\b((?:19|20)\d{2})\b"), F.lit(1))
    start = F.when(span.isNotNull(), back.cast("string")).otherwise(F.concat(F.array_min(years), F.lit("-01-01")))
    end = F.when(span.isNotNull(), today.cast("string")).otherwise(F.concat(F.array_max(years), F.lit("-12-31")))
    return F.struct(start.alias("time_start"), end.alias("time_end"))


def intent(text: Column) -> Column:
    """The first intent whose words occur; ``descriptive`` if none does."""
    low, out = F.lower(text), F
    for name, pattern in INTENTS:
        out = out.when(low.rlike(pattern), name)
    return out.otherwise("descriptive")


def countries(text: Column) -> Column:
    """Countries named, longest names first, each once; names within longer names count too."""
    low = F.lower(text)
    names = {p.lower(): p for p in PLACES} | QUESTION_ALIASES
    names.pop("cote d'ivoire", None)
    found = [F.when(low.rlike(rf"\b\Q{k}\E\b"), F.lit(names[k])) for k in sorted(names, key=lambda k: (-len(k), k))]
    return F.array_distinct(F.array_compact(F.array(*found)))


def news_country(override: Column, geography: Column) -> Column:
    """At most one country to filter news by: the override if it is no region, else the first of the geography that is none."""
    region = lambda x: F.lower(F.trim(x)).isin(REGIONS)
    given = F.nullif(F.trim(F.coalesce(override, F.lit(""))), F.lit(""))
    first = F.get(F.filter(geography, lambda g: (F.trim(g) != "") & ~region(g)), 0)
    return F.when(given.isNotNull(), F.when(~region(given), given)).otherwise(F.trim(first))
