"""What a chunk carries into a collection: its spine of metadata, allow-listed scalars, filters, lanes and embedding inputs."""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from loamline.functions import keys
from loamline.functions.keys import initcap_words
from loamline.functions.vocabulary import CHUNK_NAMESPACE

# Fields that points of each corpus keep, and the kind of source that each kind of document comes from.
PAYLOAD_FIELDS = {
    "news": [
        "content", "doc_kind", "geo_country_primary", "geo_scope", "domains", "published_at", "title", "source", "url", "chunk_index", "total_chunks", "document_id", "content_hash",
        "section_path", "ingest_version",
    ],
    "research": [
        "content", "doc_kind", "strategy", "geo_country_primary", "geo_countries", "domains", "info_type", "section_title", "chunk_index", "total_chunks", "document_id", "content_hash",
        "ingest_version", "hierarchy_path", "parent_chunk_id", "semantic_lane", "section_role", "content_type", "article_title", "authors", "publication_year", "journal", "doi", "volume",
        "issue", "pages", "bibliography_source",
    ],
    "ota": ["content", "insight_text", "metric_text", "recommendation_text", "doc_kind", "geo_country_primary", "geo_scope", "domains", "chunk_index", "total_chunks"],
    "data_description": [
        "content", "doc_kind", "table_name", "bq_table_id", "label", "chunk_index", "total_chunks", "document_id", "content_hash", "section_path", "ingest_version", "type", "source_kind",
        "hierarchy_path", "semantic_lane", "content_type",
    ],
}
SOURCE_KINDS = {
    "bq_table_description": "bq_table_description_docx", "news_article": "web_news_rss_txt", "academic_article": "pdf_text_document", "policy_report": "pdf_policy_report",
}
COUNTRY_ALIASES = {"sierraleone": "Sierra Leone", "cotedivoire": "Cote d'Ivoire", "ivorycoast": "Cote d'Ivoire"}
MAX_SCALAR_CHARS = 1000
SCALARS = ("string", "int", "bigint", "smallint", "tinyint", "double", "float", "boolean")


def _text(x: Column) -> Column:
    return F.trim(F.coalesce(x.cast("string"), F.lit("")))


def clean_list(text: Column) -> Column:
    """A list divided by semicolons, its parts trimmed, each once (case ignored, the first spelling stays), joined by ``; ``."""
    parts = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ";"), lambda p: F.trim(p)), lambda p: p != "")
    low = F.transform(parts, lambda p: F.lower(p))
    return F.array_join(F.filter(parts, lambda p, i: F.array_position(low, F.lower(p)) == i + 1), "; ")


def spine(df: DataFrame) -> DataFrame:
    """Adds ``doc_kind, label, source_kind, geo_countries, geo_country_primary, geo_scope, domains``, as far as they can be told
    from the columns there are; known values stay. Missing columns count as null."""
    has = lambda c: F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
    known = lambda c: F.when(_text(has(c)) != "", _text(has(c)))
    described = F.startswith(F.lower(_text(has("type"))), F.lit("bq "))
    kind = F.coalesce(known("doc_kind"), known("info_type"), F.when(described, "bq_table_description"), F.lit("other"))
    by_type = F.coalesce(known("doc_kind"), known("info_type")).isNull() & described
    sources = F.create_map(*[F.lit(x) for pair in SOURCE_KINDS.items() for x in pair])
    places = F.nullif(clean_list(F.coalesce(known("geo_countries"), known("country"), known("place_of_focus"), known("geo_country_primary"))), F.lit(""))
    # a column of its own first: within one projection, nested lambdas would take the new column of the same name for the old one
    df = df.withColumn("_places", places)
    places = F.col("_places")
    first = F.nullif(F.trim(F.split_part(places, F.lit(";"), F.lit(1))), F.lit(""))
    return df.withColumns({
        "doc_kind": kind, "label": F.coalesce(known("label"), F.when(by_type, _text(has("type")))), "source_kind": F.coalesce(known("source_kind"), F.try_element_at(sources, kind)),
        "geo_countries": places, "geo_country_primary": F.coalesce(known("geo_country_primary"), first),
        "geo_scope": F.coalesce(known("geo_scope"), F.when(places.isNull(), "unknown").when(F.contains(places, F.lit(";")), "multi_country").otherwise("country")),
        "domains": F.coalesce(known("domains"), known("domain")),
    }).drop("_places")


def scalar(df: DataFrame, column: str) -> Column:
    """A payload value as text: scalars as they are, others as JSON of at most MAX_SCALAR_CHARS characters."""
    kind = dict(df.dtypes)[column]
    if kind in SCALARS:
        return F.col(column).cast("string")
    nested = kind.startswith(("array", "struct", "map"))
    return F.substring(F.to_json(column) if nested else F.col(column).cast("string"), 1, MAX_SCALAR_CHARS)


def payload(df: DataFrame, content: str, corpus: str | None = None) -> Column:
    """Map of the fields that a corpus keeps, the content among them; nulls are dropped. All fields without a corpus."""
    allowed = PAYLOAD_FIELDS[corpus] if corpus else df.columns
    fields = [c for c in df.columns if c in allowed and c not in ("content", content)]
    pairs = F.array(F.struct(F.lit("content").alias("key"), F.col(content).alias("value")), *[F.struct(F.lit(c).alias("key"), scalar(df, c).alias("value")) for c in fields])
    return F.map_from_entries(F.filter(pairs, lambda p: p.value.isNotNull()))


def passes(
    df: DataFrame, *, doc_kinds: list[str] | None = None, geo: str | None = None, start: str | None = None, end: str | None = None, domains: str | None = None, excluded_roles: list[str] | None = None
) -> Column:
    """The filter that hits pass after the search. Kinds also match the kind of information and, for table descriptions, the
    type; countries and domains match as parts, case ignored; only dates that begin as a date are compared, others pass."""
    has = lambda *names: F.coalesce(*[F.when(_text(F.col(n)) != "", _text(F.col(n))) for n in names if n in df.columns], F.lit(""))
    ok = F.lit(True)
    kinds = [k.strip() for k in doc_kinds or [] if k.strip()]
    if kinds:
        match = has("doc_kind").isin(kinds) | has("info_type").isin(kinds)
        if "bq_table_description" in kinds:
            match |= F.startswith(F.lower(has("type")), F.lit("bq "))
        ok &= match
    if geo:
        low = F.lit(geo.strip().lower())
        ok &= F.contains(F.lower(has("geo_country_primary", "country")), low) | F.contains(F.lower(has("geo_countries")), low)
    day = F.substring(has("published_at"), 1, 10)
    dated = day.rlike(r"^\d{4}-\d{2}-\d{2}$")
    if start:
        ok &= ~dated | (day >= start)
    if end:
        ok &= ~dated | (day <= end)
    if domains:
        ok &= F.contains(F.lower(has("domains", "domain")), F.lit(domains.lower()))
    if excluded_roles:
        ok &= ~F.lower(has("section_role")).isin([r.lower() for r in excluded_roles])
    return ok


def embedding_input(text: Column, model: str, *, is_query: bool) -> Column:
    """The text as a model wants it: models of the e5 family are told whether it is a query or a passage."""
    body = F.coalesce(text, F.lit(""))
    return F.concat(F.lit("query: " if is_query else "passage: "), body) if "e5" in (model or "").lower() else text


def section_parent(corpus: str, document: Column | str, path: Column | str) -> Column:
    """Identifier of a section, the parent of its chunks: that of a chunk before the first whose text is the path."""
    p = F.col(path) if isinstance(path, str) else path
    return keys.chunk_id(CHUNK_NAMESPACE, corpus, document, F.lit(-1), F.concat(F.lit("section::"), p))


def enrich(df: DataFrame, corpus: str, document: str, index: str, total: str, text: str, version: str) -> DataFrame:
    """Chunks with ``document_id, chunk_index, total_chunks, content_hash, ingest_version, id``; blank optional fields as null."""
    optional = [c for c in ("section_path", "section_title", "hierarchy_path", "parent_chunk_id", "semantic_lane", "section_role", "content_type") if c in df.columns]
    made = {
        "document_id": F.col(document), "chunk_index": F.col(index), "total_chunks": F.col(total), "content_hash": keys.chunk_content_hash(text), "ingest_version": F.lit(version),
        "id": keys.chunk_id(CHUNK_NAMESPACE, corpus, document, index, text), **{c: F.nullif(F.col(c), F.lit("")) for c in optional},
    }
    return df.withColumns(made)


def research_lanes(text: Column, lane: Column, section: Column, abstract: Column) -> Column:
    """``struct<abstract, content>``: what the two vectors of a research chunk are made from."""
    head = lambda body: F.when(_text(section) != "", F.trim(F.concat(_text(section), F.lit("\n\n"), body))).otherwise(body)
    lead = F.regexp_replace(F.substring(text, 1, 700), r"^\s+|\s+$", "")
    first = F.when(F.lower(_text(lane)) == "abstract", head(text)).when(_text(abstract) != "", _text(abstract)).otherwise(head(lead))
    return F.struct(first.alias("abstract"), text.alias("content"))


def table_lanes(text: Column, table: Column, table_id: Column) -> Column:
    """``struct<table, schema, business>``: what the three vectors of a table description are made from."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    is_schema = lambda x: (
        (F.startswith(F.trim(x), F.lit("|")) & (F.regexp_count(x, F.lit(r"\|")) >= 2)) | F.lower(F.trim(x)).startswith("column name")
        | (F.contains(F.trim(x), F.lit(" | ")) & x.rlike(r"(?i)\b(description|data type|example value)\b"))
    )
    pick = lambda rule: F.coalesce(F.nullif(F.regexp_replace(F.array_join(F.filter(lines, rule), "\n"), r"^\s+|\s+$", ""), F.lit("")), text)
    schema, business = pick(is_schema), pick(lambda x: ~is_schema(x))
    name = _text(table)
    full = F.coalesce(F.nullif(_text(table_id), F.lit("")), name)
    header = F.concat(F.lit("Table: "), name, F.when(full != name, F.concat(F.lit("\nBQ table: "), full)).otherwise(""))
    return F.struct(F.regexp_replace(F.concat(header, F.lit("\n\n"), business), r"\s+$", "").alias("table"), schema.alias("schema"), business.alias("business"))


def country_name(raw: Column) -> Column:
    """A country as it is written elsewhere: known run-together spellings, else every word with a capital; empty for null."""
    clean = F.trim(F.regexp_replace(F.coalesce(raw, F.lit("")), r"(?U)\s+", " "))
    key = F.lower(F.regexp_replace(clean, "[ -]", ""))
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in COUNTRY_ALIASES.items() for x in p]), key), initcap_words(clean))


def html_table(html: Column) -> Column:
    """A table's rows as lines, its cells divided by bars; other tags go, blank lines too."""
    t = F.regexp_replace(F.regexp_replace(html, r"(?i)</tr>", "\n"), r"(?i)</t[dh]>", " | ")
    t = F.regexp_replace(F.regexp_replace(t, r"<[^>]+>", ""), r"\r\n?", "\n")
    lines = F.transform(F.split(t, "\n"), lambda x: F.trim(F.regexp_replace(x, r"[ \t]+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def published_day(text: Column) -> Column:
    """``yyyy-mm-dd`` of a written date; an empty text where there is none."""
    s = F.regexp_replace(F.trim(F.coalesce(text, F.lit(""))), r"^['\"]+|['\"]+$", "")
    return F.coalesce(F.nullif(F.regexp_extract(s, r"(\d{4}-\d{2}-\d{2})", 1), F.lit("")), F.date_format(s.try_cast("date"), "yyyy-MM-dd"), F.lit(""))


@F.pandas_udf(DoubleType())
def title_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching blocks of two titles in plain words, 0 to 1: not an edit distance, hence in Python."""
    plain = lambda x: re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s]", " ", (x or "").lower())).strip()
    return pd.Series([difflib.SequenceMatcher(None, plain(x), plain(y)).ratio() for x, y in zip(a, b)], dtype="float64")


def hash_embedding(df: DataFrame, item: str, text: str, slots: int = 64) -> DataFrame:
    """``(item, slot, weight)``: a unit vector of hashed words, in its non-zero places; an embedder without any model, for tests
    and as the default of interfaces that take one."""
    words = F.explode(F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))).alias("w")
    digest = F.md5("w")
    at = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % slots
    sign = F.when(F.conv(F.substring(digest, 9, 1), 16, 10).cast("int") % 2 == 0, 1).otherwise(-1)
    counted = df.select(F.col(item), words).select(item, at.alias("slot"), sign.alias("sign")).groupBy(item, "slot").agg(F.sum("sign").alias("n")).where(F.col("n") != 0)
    norms = counted.groupBy(item).agg(F.sqrt(F.sum(F.col("n") * F.col("n")).cast("double")).alias("norm"))
    return counted.join(norms, item).select(item, "slot", F.round(F.col("n") / F.col("norm"), 6).alias("weight"))


def quantise(vector: Column) -> Column:
    """``struct<scale, codes>``: a vector in whole numbers from -127 to 127, by its own largest size; all 0 for a zero vector."""
    v = F.transform(vector, lambda x: x.cast("double"))
    scale = F.array_max(F.transform(v, lambda x: F.abs(x))) / 127.0
    return F.struct(scale.alias("scale"), F.transform(v, lambda x: F.coalesce(F.round(x / F.nullif(scale, F.lit(0.0))), F.lit(0.0)).cast("int")).alias("codes"))
