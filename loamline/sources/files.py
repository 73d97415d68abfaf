"""Readers: tables, limited scans, chunk and record files, articles, office documents, feeds, registries, snapshots."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

CHUNK_SCHEMA = "id string, text string, metadata map<string,string>, _bad string"
FEED_SCHEMA = StructType([StructField(n, StringType()) for n in ("url", "title", "summary", "published")])


def limited_scan(df: DataFrame, condition: str | None = None, limit: int = 10_000) -> DataFrame:
    """Rows of a table that meet a condition, at most ``limit``: the filter reaches the scan, the limit its tasks."""
    return (df.where(condition) if condition else df).limit(limit)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunk records, one JSON object a line. Blank and malformed lines and records without id or text are left out."""
    rows = spark.read.text(path).where(F.trim("value") != "").select(F.from_json("value", "id string, text string, metadata string", {"mode": "PERMISSIVE"}).alias("r"))
    rows = rows.select("r.id", "r.text", F.from_json("r.metadata", MapType(StringType(), StringType())).alias("metadata"))
    return rows.where((F.trim("id") != "") & (F.trim("text") != "")).withColumn("metadata", F.coalesce("metadata", F.create_map().cast("map<string,string>")))


def read_records(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """Insight records, as lines or as one list or object; malformed input fails."""
    return spark.read.option("mode", "FAILFAST").option("multiLine", not lines).json(path)


_FRONT = r"(?s)^---\r?\n(.*?)\r?\n---\r?\n(.*)$"


def front_matter(text: Column, key: str) -> Column:
    """A value of an article's front matter; null where there is none."""
    head = F.regexp_extract(text, _FRONT, 1)
    return F.nullif(F.regexp_replace(F.regexp_extract(head, rf"(?m)^{re.escape(key)}:[ \t]*(.*?)\s*$", 1), r"^['\"]|['\"]$", ""), F.lit(""))


def read_articles(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Article files, one per row: path, front-matter values, body (the whole text where the front matter is not closed);
    empty bodies and bodies that are PDF files are left out."""
    rows = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.txt").select("_metadata.file_path", "value")
    body = F.when(F.col("value").rlike(_FRONT), F.regexp_extract("value", _FRONT, 2)).otherwise(F.col("value"))
    body = F.regexp_replace(F.replace(body, F.lit("\r\n"), F.lit("\n")), r"^\s+|\s+$", "")
    out = rows.select("file_path", *[front_matter(F.col("value"), k).alias(k) for k in keys], body.alias("body"))
    return out.where((F.col("body") != "") & ~F.startswith(F.col("body"), F.lit("%PDF-")))


def docx_text(content: bytes | None) -> str | None:
    """Paragraphs of a word-processor file, one a line; None for what is none."""
    if content is None:
        return None
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            root = ET.fromstring(archive.read("word/document.xml"))
    except (zipfile.BadZipFile, KeyError, ET.ParseError):
        return None
    space = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    lines = ("".join(t.text or "" for t in p.iter(f"{space}t")) for p in root.iter(f"{space}p"))
    return "\n".join(x for x in lines if x.strip())


def read_docx(spark: SparkSession, path: str) -> DataFrame:
    """Office documents by path and text."""

    @F.pandas_udf(StringType())
    def text(content: pd.Series) -> pd.Series:
        return content.map(docx_text)

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").option("recursiveFileLookup", True).load(path).select("path", text("content").alias("text"))


def read_pdf(spark: SparkSession, path: str) -> DataFrame:
    """PDF files by path and text; needs the pypdf package in the workers, without it the text is null."""

    @F.pandas_udf(StringType())
    def text(content: pd.Series) -> pd.Series:
        try:
            from pypdf import PdfReader
        except ImportError:
            return pd.Series([None] * len(content), dtype=object)
        return content.map(lambda c: "\n".join(p.extract_text() or "" for p in PdfReader(io.BytesIO(c)).pages) if c else None)

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", True).load(path).select("path", text("content").alias("text"))


def feed_entries(xml: str | None) -> list[dict] | None:
    """Entries of an RSS or Atom document; None for malformed ones."""
    if not xml:
        return None
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return None
    bare = lambda e: e.tag.rsplit("}", 1)[-1]
    out = []
    for e in root.iter():
        if bare(e) not in ("item", "entry"):
            continue
        part = {bare(c): c for c in e}
        text = lambda *names: next((part[n].text.strip() for n in names if n in part and part[n].text), None)  # noqa: E731, B023
        link = text("link") or (part["link"].get("href") if "link" in part else None)
        out.append({"url": link, "title": text("title"), "summary": text("description", "summary", "content"), "published": text("pubDate", "published", "updated")})
    return out


def parse_feeds(documents: DataFrame, xml: str) -> DataFrame:
    """One row per entry of feed documents held in a column, with all other columns."""

    @F.pandas_udf(ArrayType(FEED_SCHEMA))
    def entries(texts: pd.Series) -> pd.Series:
        return texts.map(feed_entries)

    return documents.withColumn("_e", F.explode(entries(F.col(xml)))).select(*[c for c in documents.columns if c != xml], "_e.*")


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """``(country, feed_url)`` of a JSON map of countries to lists; keys with an underscore, values that are no lists and blank
    addresses are skipped."""
    text = spark.read.text(path, wholetext=True)
    pairs = text.select(F.explode(F.from_json("value", MapType(StringType(), StringType()))).alias("country", "feeds"))
    feeds = pairs.where(~F.startswith(F.col("country"), F.lit("_"))).select("country", F.explode(F.from_json("feeds", ArrayType(StringType()))).alias("feed_url"))
    return feeds.where(F.trim("feed_url") != "")


def day_slices(base: str, start: date, end: date) -> list[tuple[str, str]]:
    """``(address, label)`` for each day of a span: the search asks after the day and before the next."""
    days = pd.date_range(start, end)
    after = [f"{base}+after:{d:%Y-%m-%d}+before:{d + pd.Timedelta(days=1):%Y-%m-%d}" for d in days]
    return list(zip(after, [f"[{d:%Y-%m-%d}]" for d in days]))


def date_window(published: Column, start: Column | None, end: Column | None) -> Column:
    """Dates within the bounds; missing dates and missing bounds let rows pass."""
    ok = F.lit(True)
    if start is not None:
        ok &= published >= start
    if end is not None:
        ok &= published <= end
    return published.isNull() | ok
