"""Chat and question queries; conversations are made from the event stream, a user's events in order."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamline.catalog import Sources
from loamline.functions import facets
from loamline.functions.vocabulary import INTENTS, PLACES, QUESTION_ALIASES
from loamline.operators.chat_memory import compact, complete_pairs, recent_pairs
from loamline.operators.sql_guard import validate_sql


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Sources(spark, sf_dir).table("events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    role = F.when(F.col("event_type").isin("click", "view"), "user").when(F.col("event_type") == "purchase", "assistant").otherwise("system")
    return e.select(F.col("user_id").alias("conv_id"), F.row_number().over(w).alias("turn"), role.alias("role"), F.concat_ws(" ", "event_type", "props").alias("text"))


def chat_recent_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent_pairs(conversations(spark, sf_dir), 3)


def chat_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complete_pairs(conversations(spark, sf_dir))


def chat_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact(conversations(spark, sf_dir), 3, 200)


def query_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years, countries and intent of every held-out question."""
    q = Sources(spark, sf_dir).table("eval_items")
    return q.select("item_id", facets.year_range(F.col("text"), F.lit("2026-01-01").cast("date")).alias("years"), facets.intent(F.col("text")).alias("intent"), facets.countries(F.col("text")).alias("countries")).select(
        "item_id", "years.time_start", "years.time_end", "intent", F.array_join("countries", "; ").alias("countries")
    )


def feed_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One search address per feed and day of its first week."""
    r = Sources(spark, sf_dir).table("rss_items").where("feed_name is not null and published is not null")
    spans = r.groupBy("feed_name").agg(F.min("published").alias("start"))
    days = spans.select("feed_name", F.explode(F.sequence("start", F.date_add("start", 6))).alias("day"))
    text = lambda d: F.date_format(d, "yyyy-MM-dd")
    return days.select("feed_name", "day", F.concat(F.lit("q="), F.url_encode("feed_name"), F.lit("+after:"), text("day"), F.lit("+before:"), text(F.date_add("day", 1))).alias("query"))


STATEMENTS = [
    "SELECT country, avg(value) FROM raw_dev.prices GROUP BY country",
    "SELECT * FROM raw_dev.prices LIMIT 3",
    "SELECT a.x, 0.5 AS half FROM raw_dev.t a JOIN landing.u b ON a.k = b.k",
    "DROP TABLE raw_dev.prices",
    "SELECT 1; DELETE FROM raw_dev.prices",
    "SELECT * FROM secret.prices",
]


def sql_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the guard makes of statements."""
    return spark.createDataFrame([(i, s, validate_sql(spark, s, {"raw_dev", "landing"}, 10)) for i, s in enumerate(STATEMENTS)], "n int, statement string, cleaned string")


def queries() -> dict:
    return {
        "chat_recent_pairs": chat_recent_pairs, "chat_pairs": chat_pairs, "chat_compact": chat_compact, "query_facets": query_facets, "feed_slices": feed_slices, "sql_guard": sql_guard,
    }


_CONV = (
    "WITH c AS (SELECT user_id AS conv_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS turn, CASE WHEN event_type IN ('click', 'view') THEN 'user' "
    "WHEN event_type = 'purchase' THEN 'assistant' ELSE 'system' END AS role, concat_ws(' ', event_type, props) AS text FROM events), u AS (SELECT * FROM c WHERE role IN ('user', 'assistant') AND trim(text) <> '')"
)


def _facets_sql() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    names = {p.lower(): p for p in PLACES if p != "Cote d'Ivoire"} | QUESTION_ALIASES
    listed = ", ".join(f"CASE WHEN regexp_matches(low, {q(rf'\b{re.escape(k)}\b')}) THEN {q(names[k])} END" for k in sorted(names, key=lambda k: (-len(k), k)))
    return (
        "WITH t AS (SELECT item_id, text, lower(text) AS low, TRY_CAST(regexp_extract(lower(text), '\\b(?:past|last)\\s+(\\d{1,2})\\s+years?\\b', 1) AS INTEGER) AS span, regexp_extract_all(text, '\\b((?:19|20)\\d{2})\\b', 1) AS years FROM eval_items), "
        f"c AS (SELECT *, list_filter([{listed}], lambda x: x IS NOT NULL) AS l FROM t) SELECT item_id, CASE WHEN span IS NOT NULL THEN CAST(2026 - least(50, greatest(1, span)) AS VARCHAR) || '-01-01' ELSE list_min(years) || '-01-01' END AS time_start, "
        f"CASE WHEN span IS NOT NULL THEN '2026-01-01' ELSE list_max(years) || '-12-31' END AS time_end, CASE {' '.join(f'WHEN regexp_matches(low, {q(p)}) THEN {q(n)}' for n, p in INTENTS)} ELSE 'descriptive' END AS intent, "
        "array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '; ') AS countries FROM c"
    )


def oracle_sql() -> dict[str, str]:
    kept = "n_users <= 3 AND n_chars <= 200"
    return {
        "chat_compact": (
            # a fold takes turns from the begin, an answer together with its question: what stays is the longest end that begins at no answer and keeps both bounds
            f"{_CONV}, n AS (SELECT conv_id, turn, role, text, role = 'assistant' AND coalesce(lag(role) OVER w = 'user', false) AS answer, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER b AS n_users, sum(length(text)) OVER b AS n_chars FROM u "
            "WINDOW w AS (PARTITION BY conv_id ORDER BY turn), b AS (PARTITION BY conv_id ORDER BY turn DESC ROWS UNBOUNDED PRECEDING)), "
            f"f AS (SELECT conv_id, min(turn) FILTER (WHERE NOT answer AND {kept}) AS first FROM n GROUP BY 1) SELECT n.conv_id, "
            "coalesce(right(string_agg(role || ': ' || trim(regexp_replace(text, '\\s+', ' ', 'g')), chr(10) ORDER BY turn) FILTER (WHERE first IS NULL OR turn < first), 1200), '') AS summary, "
            "CAST(count(*) FILTER (WHERE turn >= first) AS INTEGER) AS kept_turns, CAST(coalesce(sum(length(text)) FILTER (WHERE turn >= first), 0) AS INTEGER) AS kept_chars FROM n JOIN f ON f.conv_id = n.conv_id GROUP BY n.conv_id"
        ),
        "query_facets": _facets_sql(),
        "sql_guard": (
            "SELECT * FROM (VALUES (0, 'SELECT country, avg(value) FROM raw_dev.prices GROUP BY country', 'SELECT country, avg(value) FROM raw_dev.prices GROUP BY country LIMIT 10'), (1, 'SELECT * FROM raw_dev.prices LIMIT 3', 'SELECT * FROM raw_dev.prices LIMIT 3'), "
            "(2, 'SELECT a.x, 0.5 AS half FROM raw_dev.t a JOIN landing.u b ON a.k = b.k', 'SELECT a.x, 0.5 AS half FROM raw_dev.t a JOIN landing.u b ON a.k = b.k LIMIT 10'), (3, 'DROP TABLE raw_dev.prices', NULL), "
            "(4, 'SELECT 1; DELETE FROM raw_dev.prices', NULL), (5, 'SELECT * FROM secret.prices', NULL)) t(n, statement, cleaned)"
        ),
        "chat_recent_pairs": f"{_CONV} SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM u) WHERE r <= 6",
        "chat_pairs": f"{_CONV} SELECT conv_id, count(*) FILTER (WHERE role = 'user' AND nxt = 'assistant') AS pairs FROM (SELECT *, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS nxt FROM u) GROUP BY conv_id",
        "feed_slices": (
            "WITH s AS (SELECT feed_name, min(published) AS a FROM rss_items WHERE feed_name IS NOT NULL AND published IS NOT NULL GROUP BY 1), d AS (SELECT feed_name, CAST(a + CAST(k AS INTEGER) AS DATE) AS day FROM s, range(7) r(k)) "
            "SELECT feed_name, day, 'q=' || replace(url_encode(feed_name), '%20', '+') || '+after:' || strftime(day, '%Y-%m-%d') || '+before:' || strftime(day + 1, '%Y-%m-%d') AS query FROM d"
        ),
    }
