"""The news funnel: every feed item with the first gate that stops it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamline.catalog import Sources
from loamline.functions import keys, taxonomy
from loamline.functions.pages import is_site_root_or_hub
from loamline.functions.urls import bare_host, normalise_url
from loamline.functions.vocabulary import HUB_SLUGS
from loamline.operators.dedup import sequential_duplicates
from loamline.plans.payloads import sql_collapse, sql_url
from loamline.sources.files import date_window

# The vocabulary of the items' own language, since the taxonomy's English words rarely occur in invented headlines.
SUBJECTS = ["maize", "beans", "rice", "wheat", "millet", "sorghum", "cassava", "banana", "potato", "coffee", "tea", "cocoa", "cotton", "sesame", "honey", "milk", "goats", "cattle", "growers", "farmers", "herders"]
MIN_SUMMARY, PER_FEED = 20, 50


def news_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(item_id, feed_name, status)``: date, address, subject, length, duplicate, rank, kept; gates in this order.

    Duplicates are judged among the items that pass the gates before; the rank within a feed is a report of its best items.
    """
    items = Sources(spark, sf_dir).table("rss_items")
    words = taxonomy.padded(F.concat_ws(" ", "title", "summary"))
    hits = sum((taxonomy.occurrences(F.col("words"), f" {w} ") for w in SUBJECTS), F.lit(0))
    rows = items.withColumn("words", words).select(
        "item_id", "feed_name", "published", hits.alias("score"),
        F.when(~date_window(F.col("published"), F.lit("2023-01-01").cast("date"), None), "date").when(is_site_root_or_hub(F.col("url")), "address").when(hits == 0, "subject")
        .when(F.length(F.coalesce("summary", F.lit(""))) < MIN_SUMMARY, "length").alias("gate"),
        normalise_url("url").alias("k1"), keys.dedupe_id("title", bare_host("url")).alias("k2"), keys.article_content_hash(F.concat_ws(" ", "title", "summary")).alias("k3"),
    )
    passed = sequential_duplicates(rows.where("gate is null"), "item_id", ["k1", "k2", "k3"])
    w = Window.partitionBy("feed_name", "is_duplicate").orderBy(F.desc("score"), F.desc_nulls_last("published"), "item_id")
    passed = passed.withColumn("r", F.row_number().over(w))
    status = F.when(F.col("is_duplicate"), "duplicate").when(F.col("r") > PER_FEED, "rank").otherwise("kept")
    return passed.select("item_id", "feed_name", status.alias("status")).unionByName(rows.where("gate is not null").select("item_id", "feed_name", F.col("gate").alias("status")))


def news_funnel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items per status."""
    return news_funnel(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def queries() -> dict:
    return {"news_funnel": news_funnel, "news_funnel_counts": news_funnel_counts}


def sql_first_wins(rows: str, order: str, keys: list[str]) -> str:
    """CTEs after ``rows`` that end in ``s``: ``order`` and is_duplicate, row by row, in DuckDB. Rows keep the keys of all originals
    before them; empty and null keys never match."""
    n = range(1, len(keys) + 1)
    put = lambda i: f"CASE WHEN d OR k{i} IS NULL THEN s{i} ELSE list_append(s{i}, k{i}) END"
    start = lambda i: f"CASE WHEN k{i} IS NULL THEN []::UBIGINT[] ELSE [k{i}] END"
    return f"""k AS (SELECT row_number() OVER (ORDER BY {order}) AS n, {order}, {', '.join(f"CASE WHEN {k} <> '' THEN hash({k}) END AS k{i}" for i, k in zip(n, keys))} FROM {rows}),
 s(n, {order}, is_duplicate, {', '.join(f's{i}' for i in n)}) AS (SELECT n, {order}, false, {', '.join(start(i) for i in n)} FROM k WHERE n = 1 UNION ALL SELECT n, {order}, d, {', '.join(put(i) for i in n)}
 FROM (SELECT k.*, {', '.join(f's{i}' for i in n)}, {' OR '.join(f'coalesce(list_contains(s{i}, k{i}), false)' for i in n)} AS d FROM s JOIN k ON k.n = s.n + 1) x)"""


def sql_item_keys(extra: str = "") -> str:
    """Feed items with their three keys, in DuckDB."""
    plain = "trim(regexp_replace(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
    host = "regexp_replace(lower(regexp_extract(trim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)), '^www\\.', '')"
    return f"SELECT item_id{extra}, {sql_url('url')} AS a1, substr(sha256({plain} || '|' || {host}), 1, 16) AS a2, sha256({sql_collapse("lower(concat_ws(' ', title, summary))")}) AS a3 FROM rss_items"


def oracle_sql() -> dict[str, str]:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    words = "' ' || regexp_replace(lower(concat_ws(' ', title, summary)), '[^\\p{L}\\p{N}_]+', '  ', 'g') || ' '"
    hits = " + ".join(f"(length(w) - length(replace(w, {q(f' {x} ')}, ''))) // {len(x) + 2}" for x in SUBJECTS)
    parts = "list_filter(string_split(regexp_extract(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*:', ''), '^(?://[^/?#]*)?([^?#]*)', 1), '/'), lambda x: x <> '')"
    funnel = f"""WITH RECURSIVE i AS ({sql_item_keys(f", feed_name, published, url, summary, {words} AS w")}), g AS (SELECT *, {hits} AS score, {parts} AS p FROM i),
 f AS (SELECT *, CASE WHEN published < DATE '2023-01-01' THEN 'date' WHEN len(p) = 0 OR (len(p) = 1 AND lower(p[1]) IN ({', '.join(q(h) for h in HUB_SLUGS)})) THEN 'address' WHEN score = 0 THEN 'subject'
 WHEN length(coalesce(summary, '')) < {MIN_SUMMARY} THEN 'length' END AS gate FROM g), passed AS (SELECT * FROM f WHERE gate IS NULL), {sql_first_wins('passed', 'item_id', ['a1', 'a2', 'a3'])},
 r AS (SELECT passed.item_id, feed_name, is_duplicate, row_number() OVER (PARTITION BY feed_name, is_duplicate ORDER BY score DESC, published DESC NULLS LAST, passed.item_id) AS r FROM passed JOIN s ON s.item_id = passed.item_id),
 z AS (SELECT item_id, feed_name, CASE WHEN is_duplicate THEN 'duplicate' WHEN r > {PER_FEED} THEN 'rank' ELSE 'kept' END AS status FROM r UNION ALL SELECT item_id, feed_name, gate FROM f WHERE gate IS NOT NULL)"""
    return {
        "news_dedup": f"WITH RECURSIVE i AS ({sql_item_keys()}), {sql_first_wins('i', 'item_id', ['a1', 'a2', 'a3'])} SELECT item_id, is_duplicate FROM s",
        "news_funnel": f"{funnel} SELECT item_id, feed_name, status FROM z",
        "news_funnel_counts": f"{funnel} SELECT status, count(*) AS n FROM z GROUP BY status",
    }
