"""Keyword scores, places, sections and document types, as Catalyst expressions over whole texts."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from loamline.functions.vocabulary import (
    AGRICULTURE_TERMS, BOILERPLATE_PATH, DOMAIN_KEYWORDS, GOVERNMENT_MARKERS, PATH_ROLES, PLACE_ALIASES, PLACES, TITLE_ROLES,
)

MAX_PLACES = 12


def padded(text: Column) -> Column:
    """Lower case, every run of other characters as two spaces, one at either end: a word is then found between spaces."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_]+", "  "), F.lit(" "))


def occurrences(text: Column, part: str) -> Column:
    """How often a part occurs, without overlaps; no regular expression."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("int")


class _Counter:
    """Occurrences of keywords in a text: single words by one count of all words, phrases as parts. A text is split once, however
    many keywords are asked for."""

    def __init__(self, groups: list[list[str]], words: set[str], inner: dict[str, str]) -> None:
        self.single = {k: [i for i, ks in enumerate(groups) for x in ks if x == k] for k in {k for ks in groups for k in ks} & words}
        self.padded = [(inner[k], [i for i, ks in enumerate(groups) for x in ks if x == k]) for k in sorted({k for ks in groups for k in ks} & set(inner))]
        self.phrases = [(k, [i for i, ks in enumerate(groups) for x in ks if x == k]) for k in sorted({k for ks in groups for k in ks} - words - set(inner))]
        self.size = len(groups)

    def of(self, words: str, low: str) -> list[int]:
        out = [0] * self.size
        for word in words.split():
            for i in self.single.get(word, ()):
                out[i] += 1
        for text, parts in ((words, self.padded), (low, self.phrases)):
            for part, at in parts:
                n = text.count(part)
                if n:
                    for i in at:
                        out[i] += n
        return out


def _counts(counter: _Counter):  # noqa: ANN202
    @F.pandas_udf(ArrayType(IntegerType()))
    def count(words: pd.Series, low: pd.Series) -> pd.Series:
        return pd.Series([counter.of(w, x) if w is not None else None for w, x in zip(words, low)], dtype=object)

    return count


def domain_scores(words: Column, low: Column, keywords: dict[str, list[str]] = DOMAIN_KEYWORDS) -> Column:
    """Array of ``(domain, score)`` in the taxonomy's order: phrases as substrings of ``low``, words between word boundaries of
    ``words`` (padded), hyphenated ones as two. One pass a text in Arrow batches, instead of one a keyword."""
    every = {k for ks in keywords.values() for k in ks}
    inner = {k: " " + k.replace("-", "  ") + " " for k in every if " " not in k and "-" in k}
    counter = _Counter(list(keywords.values()), {k for k in every if " " not in k and "-" not in k}, inner)
    scores = _counts(counter)(words, low)
    names = F.array(*[F.lit(d) for d in keywords])
    return F.arrays_zip(names.alias("domain"), scores.alias("score"))


def top_domains(scores: Column, most: int = 4, default: str = "agriculture") -> Column:
    """Domains with a score, best first, ties in the taxonomy's order; the default if none has one."""
    ranked = F.array_sort(
        F.filter(F.transform(scores, lambda s, i: F.struct((-s.score).alias("rank"), i.alias("i"), s.domain.alias("domain"))), lambda s: s["rank"] < 0)
    )
    names = F.slice(F.transform(ranked, lambda s: s.domain), 1, most)
    return F.when(F.size(names) > 0, names).otherwise(F.array(F.lit(default)))


def agricultural_hits(words: Column, low: Column) -> Column:
    """Occurrences of the agricultural context's terms: phrases and hyphened ones as substrings, words by themselves."""
    counter = _Counter([AGRICULTURE_TERMS], {k for k in AGRICULTURE_TERMS if " " not in k and "-" not in k}, {})
    return F.get(_counts(counter)(words, low), 0)


def before_references(text: Column) -> Column:
    return F.regexp_extract(text, r"(?is)^(.*?)(?:\n\s*(?:references|bibliography|works cited)\s*\n.*)?$", 1)


_ASKED = [(" " + "  ".join(re.findall(r"\w+", p.lower())) + " ", PLACE_ALIASES.get(p, p)) for p in sorted(PLACES, key=lambda p: -len(p))]


@F.pandas_udf(ArrayType(StringType()))
def places_of_focus(words: pd.Series) -> pd.Series:
    """Countries a padded text speaks of, most first; where more than three are named, only those named twice or more; 12 at
    most. Fifty-six substring counts a text with sums by alias: an Arrow batch is far cheaper here than nested lambdas."""

    def focus(text: str | None) -> list[str]:
        counts: dict[str, int] = {}
        for part, place in _ASKED:
            n = text.count(part) if text else 0
            if n:
                counts[place] = counts.get(place, 0) + n
        ranked = sorted(counts.items(), key=lambda x: -x[1])
        often = [p for p, n in ranked if n >= (2 if len(ranked) > 3 else 1)]
        return (often or [p for p, _ in ranked[:5]])[:MAX_PLACES]

    return pd.Series([focus(x) for x in words], dtype=object)


def info_type(text: Column, file_name: Column) -> Column:
    """``government_report`` where two government markers meet no academic one, else ``academic_article``."""
    body = before_references(text)
    low = F.lower(body)
    academic = body.rlike(r"(?i)\bdoi:\s*10\.") | low.rlike(r"\bjournal of\b") | F.lower(F.coalesce(file_name, F.lit(""))).contains("1-s2.0") | F.substring(low, 1, 8000).rlike(r"\babstract\b")
    markers = sum((low.contains(m).cast("int") for m in GOVERNMENT_MARKERS), F.lit(0))
    return F.when(academic, "academic_article").when(markers >= 2, "government_report").otherwise("academic_article")


def section_role(title: Column, path: Column, is_table: Column) -> Column:
    """Role of a section: tables, boilerplate paths, telling titles, telling paths, else content."""
    p, t = F.lower(F.coalesce(path, F.lit(""))), F.lower(F.trim(F.coalesce(title, F.lit(""))))
    role = F.when(is_table, "table").when(p.rlike(BOILERPLATE_PATH), "boilerplate")
    for name, pattern in TITLE_ROLES:
        role = role.when((t != "") & t.rlike(pattern), name)
    for name, pattern in PATH_ROLES:
        role = role.when(p.rlike(pattern), name)
    return role.otherwise("content")


def semantic_lane(role: Column) -> Column:
    return F.when(role == "table", "table").when(role == "abstract", "abstract").otherwise("content")
