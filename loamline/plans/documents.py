"""Queries over documents, chunks and feed items: hashes, identifiers, statistics, taxonomy, structure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.catalog import Sources
from loamline.functions import keys, taxonomy
from loamline.functions.urls import bare_host, normalise_url, url_part
from loamline.functions.vocabulary import AGRICULTURE_TERMS, BOILERPLATE_PATH, CHUNK_NAMESPACE, DOMAIN_KEYWORDS, EXCLUDED_ROLES, GOVERNMENT_MARKERS, HUB_SLUGS, PATH_ROLES
from loamline.operators.dedup import manifest_new, sequential_duplicates
from loamline.plans.payloads import sql_chunk_id, sql_url

RUN_START = "2024-01-01 00:00:00"  # documents ingested before it are in the manifest


def doc_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Sources(spark, sf_dir).table("documents")
    return d.select("doc_id", keys.chunk_content_hash("text").alias("chunk_hash"), keys.article_content_hash("text").alias("article_hash"), keys.token_estimate("text").alias("tokens"))


def dedupe_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = Sources(spark, sf_dir).table("rss_items")
    return r.select("item_id", keys.dedupe_id("title", bare_host("url")).alias("dedupe_id"), keys.article_id("url").alias("article_id"))


def cluster_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = Sources(spark, sf_dir).table("rss_items")
    return r.select("item_id", keys.cluster_id("title", "feed_name", F.lit("news"), "published").alias("cluster_id"))


def chunk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Sources(spark, sf_dir).table("pdf_chunks").where("text is not null")
    return c.select("id", keys.chunk_id(CHUNK_NAMESPACE, "corpus", F.col("metadata.document_id"), F.col("metadata.chunk_index"), F.col("text")).alias("chunk_id"))


def url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Sources(spark, sf_dir).table("rss_items").select("item_id", normalise_url("url").alias("url"))


def is_hub(url: str) -> Column:
    """Whether an address is a site's root or a section front."""
    parts = F.filter(F.split(url_part(url, "path"), "/"), lambda p: p != "")
    return (F.size(parts) == 0) | ((F.size(parts) == 1) & F.lower(F.get(parts, 0)).isin(HUB_SLUGS))


def url_hub_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = Sources(spark, sf_dir).table("rss_items")
    return r.select("item_id", is_hub("url").alias("is_hub"))


def manifest_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a run, those ingested since a date, whose content is neither in the manifest of the runs before nor
    earlier in this one."""
    d = Sources(spark, sf_dir).table("documents").select("doc_id", "ingested_at", keys.chunk_content_hash("text").alias("content_hash"))
    since = F.lit(RUN_START).cast("timestamp")
    before = d.where(F.col("ingested_at") < since).select("content_hash")
    return manifest_new(d.where(F.coalesce(F.col("ingested_at") >= since, F.lit(True))).drop("ingested_at"), before, "content_hash", "doc_id")


def news_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed items in order of arrival, flagged as duplicates by address, title and host, or content."""
    r = Sources(spark, sf_dir).table("rss_items").select(
        "item_id", normalise_url("url").alias("k1"), keys.dedupe_id("title", bare_host("url")).alias("k2"),
        keys.article_content_hash(F.concat_ws(" ", "title", "summary")).alias("k3"),
    )
    return sequential_duplicates(r, "item_id", ["k1", "k2", "k3"]).select("item_id", "is_duplicate")


def chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, tokens and missing metadata of chunks by kind."""
    c = Sources(spark, sf_dir).table("pdf_chunks").where(F.col("text").isNotNull()).select(
        F.col("metadata.doc_kind").alias("doc_kind"), keys.token_estimate("text").alias("tokens"), F.col("metadata.content_hash").alias("h")
    )
    return c.groupBy("doc_kind").agg(
        F.count(F.lit(1)).alias("n_rows"), F.percentile("tokens", 0.5).alias("median_tokens"), F.round(F.avg("tokens"), 4).alias("mean_tokens"), F.max("tokens").alias("max_tokens"),
        F.count_if(F.col("h").isNull()).alias("n_missing_hash"),
    )


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Sources(spark, sf_dir).table("documents").select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("low")).withColumn("words", taxonomy.padded(F.col("low")))
    return d.select("doc_id", taxonomy.domain_scores(F.col("words"), F.col("low")).alias("scores"))


def domain_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("doc_id", F.explode("scores").alias("s")).select("doc_id", "s.domain", "s.score").where("score > 0")


def infer_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("doc_id", F.array_join(taxonomy.top_domains(F.col("scores")), "; ").alias("domains"))


def agri_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with at least two hits of the agricultural context."""
    d = Sources(spark, sf_dir).table("documents").select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("low")).withColumn("words", taxonomy.padded(F.col("low")))
    scored = d.select("doc_id", taxonomy.agricultural_hits(F.col("words"), F.col("low")).alias("hits"))
    return scored.groupBy("doc_id").agg(F.max("hits").alias("hits")).where("hits >= 2")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Sources(spark, sf_dir).table("pdf_chunks").where("text is not null and id is not null")
    d = d.select("id", F.concat_ws(" ", "text", F.col("metadata.geo_country_primary")).alias("text"))
    found = d.select("id", taxonomy.places_of_focus(taxonomy.padded(taxonomy.before_references(F.col("text")))).alias("places"))
    return found.where(F.size("places") > 0).select("id", F.array_join("places", "; ").alias("places"))


def info_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Sources(spark, sf_dir).table("documents")
    return d.select("doc_id", taxonomy.info_type(F.coalesce("text", F.lit("")), F.col("title")).alias("info_type")).groupBy("info_type").agg(F.count(F.lit(1)).alias("n"))


def section_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Sources(spark, sf_dir).table("pdf_chunks").select(F.col("metadata.section_path").alias("section_path"), F.col("metadata.doc_kind").alias("doc_kind"))
    path = F.regexp_replace(F.lower(F.coalesce("section_path", F.lit(""))), r"[^\p{L}\p{N}/]+", "_")
    role = taxonomy.section_role(F.lit(None).cast("string"), path, F.lit(False))
    rows = c.select("doc_kind", "section_path", role.alias("role")).where(~F.col("role").isin(EXCLUDED_ROLES))
    return rows.withColumn("lane", taxonomy.semantic_lane(F.col("role"))).groupBy("doc_kind", "role", "lane").agg(F.count(F.lit(1)).alias("n"))


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Sources(spark, sf_dir).table("documents").where("text is not null")
    return d.select("doc_id", F.posexplode(F.split("text", r"(?<=[.!?])\s+")).alias("pos", "sentence")).select("doc_id", "pos", F.length("sentence").alias("n_chars"))


def paragraph_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks between blank lines: body, body/p2, ..."""
    d = Sources(spark, sf_dir).table("documents").where("text is not null")
    blocks = F.filter(F.transform(F.split("text", r"\n[ \t\r]*\n"), lambda b: F.regexp_replace(b, r"^\s+|\s+$", "")), lambda b: b != "")
    e = d.select("doc_id", F.posexplode(blocks).alias("pos", "block"))
    return e.select("doc_id", F.when(F.col("pos") == 0, "body").otherwise(F.concat(F.lit("body/p"), (F.col("pos") + 1).cast("string"))).alias("path"), F.length("block").alias("n_chars"))


def queries() -> dict:
    return {
        "doc_hashes": doc_hashes, "dedupe_ids": dedupe_ids, "cluster_ids": cluster_ids, "chunk_ids": chunk_ids, "url_normalize": url_normalize, "url_hub_filter": url_hub_filter,
        "manifest_skip": manifest_skip, "news_dedup": news_dedup, "chunk_stats": chunk_stats, "domain_scores": domain_scores, "infer_domains": infer_domains, "agri_gate": agri_gate,
        "places": places, "info_types": info_types, "section_roles": section_roles, "sentences": sentences, "paragraph_blocks": paragraph_blocks,
    }


def oracle_sql() -> dict[str, str]:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    collapse = lambda x: f"trim(regexp_replace({x}, '[\\s\\p{{Z}}\\x{{85}}\\x0b\\x1c-\\x1f]+', ' ', 'g'))"
    plain = "trim(regexp_replace(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
    host = "regexp_replace(lower(regexp_extract(trim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)), '^www\\.', '')"
    count = lambda s, part: f"CAST((length({s}) - length(replace({s}, {q(part)}, ''))) / {len(part)} AS INTEGER)"
    hit = lambda k: count("low", k) if " " in k else count("words", " " + k.replace("-", "  ") + " ")
    base = "WITH d AS (SELECT doc_id, lower(coalesce(text, '')) AS low, ' ' || regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}_]+', '  ', 'g') || ' ' AS words FROM documents)"
    scored = ", s AS (" + " UNION ALL ".join(
        f"SELECT doc_id, {i} AS i, {q(name)} AS domain, {' + '.join(hit(k) for k in kws)} AS score FROM d" for i, (name, kws) in enumerate(DOMAIN_KEYWORDS.items())
    ) + ")"
    path = "regexp_replace(lower(coalesce(metadata.section_path, '')), '[^\\p{L}\\p{N}/]+', '_', 'g')"
    role = f"CASE WHEN regexp_matches({path}, {q(BOILERPLATE_PATH)}) THEN 'boilerplate' " + " ".join(f"WHEN regexp_matches({path}, {q(p)}) THEN {q(n)}" for n, p in PATH_ROLES) + " ELSE 'content' END"
    asked = ", ".join(f"({i}, {q(part)}, {q(place)})" for i, (part, place) in enumerate(taxonomy._ASKED))
    body = "regexp_extract(text, '(?is)^(.*?)(?:\\n\\s*(?:references|bibliography|works cited)\\s*\\n.*)?$', 1)"
    return {
        "chunk_ids": f"SELECT id, {sql_chunk_id('corpus', 'metadata.document_id', 'metadata.chunk_index', 'text')} AS chunk_id FROM pdf_chunks WHERE text IS NOT NULL",
        "url_normalize": f"SELECT item_id, {sql_url('url')} AS url FROM rss_items",
        "places": (
            f"WITH asked(i, part, place) AS (VALUES {asked}), t AS (SELECT row_number() OVER () AS n, id, concat_ws(' ', text, metadata.geo_country_primary) AS text FROM pdf_chunks WHERE text IS NOT NULL AND id IS NOT NULL), "
            f"w AS (SELECT n, id, ' ' || regexp_replace(lower({body}), '[^\\p{{L}}\\p{{N}}_]+', '  ', 'g') || ' ' AS words FROM t), c AS (SELECT n, id, place, i, (length(words) - length(replace(words, part, ''))) // length(part) AS k FROM w, asked), "
            "p AS (SELECT n, id, place, min(i) FILTER (WHERE k > 0) AS i, sum(k) AS k FROM c GROUP BY 1, 2, 3 HAVING sum(k) > 0), r AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY k DESC, i) AS r, count(*) OVER (PARTITION BY n) AS m, "
            "max(k) OVER (PARTITION BY n) AS best FROM p) SELECT id, string_agg(place, '; ' ORDER BY r) AS places FROM r WHERE r <= 12 AND CASE WHEN m > 3 AND best >= 2 THEN k >= 2 WHEN m > 3 THEN r <= 5 ELSE true END GROUP BY n, id"
        ),
        "info_types": (
            f"WITH d AS (SELECT title, {body.replace('text', "coalesce(text, '')", 1)} AS body FROM documents), l AS (SELECT *, lower(body) AS low FROM d) SELECT CASE WHEN regexp_matches(body, '(?i)\\bdoi:\\s*10\\.') OR regexp_matches(low, '\\bjournal of\\b') "
            f"OR contains(lower(coalesce(title, '')), '1-s2.0') OR regexp_matches(substr(low, 1, 8000), '\\babstract\\b') THEN 'academic_article' WHEN {' + '.join(f'CAST(contains(low, {q(m)}) AS INTEGER)' for m in GOVERNMENT_MARKERS)} >= 2 THEN 'government_report' "
            "ELSE 'academic_article' END AS info_type, count(*) AS n FROM l GROUP BY 1"
        ),
        "doc_hashes": f"SELECT doc_id, sha256({collapse('coalesce(text, {})'.format(q('')))}) AS chunk_hash, sha256({collapse('lower(coalesce(text, {}))'.format(q('')))}) AS article_hash, CAST(greatest(1, length(text) // 4) AS INTEGER) AS tokens FROM documents",
        "dedupe_ids": f"SELECT item_id, substr(sha256({plain} || '|' || {host}), 1, 16) AS dedupe_id, substr(sha256(url), 1, 16) AS article_id FROM rss_items",
        "cluster_ids": f"SELECT item_id, substr(sha256(substr({plain}, 1, 120) || '|' || lower(coalesce(feed_name, '')) || '|news|' || coalesce(strftime(published, '%Y-%m-%d'), 'unknown')), 1, 16) AS cluster_id FROM rss_items",
        "url_hub_filter": (
            "WITH p AS (SELECT item_id, list_filter(string_split(regexp_extract(trim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1), '/'), lambda x: x <> '') AS parts FROM rss_items) "
            f"SELECT item_id, len(parts) = 0 OR (len(parts) = 1 AND lower(parts[1]) IN ({', '.join(q(h) for h in HUB_SLUGS)})) AS is_hub FROM p"
        ),
        "manifest_skip": (
            f"WITH d AS (SELECT doc_id, ingested_at, sha256({collapse('coalesce(text, {})'.format(q('')))}) AS content_hash FROM documents) SELECT min(doc_id) AS doc_id, content_hash FROM d "
            f"WHERE coalesce(ingested_at >= TIMESTAMP '{RUN_START}', true) AND content_hash NOT IN (SELECT content_hash FROM d WHERE ingested_at < TIMESTAMP '{RUN_START}') GROUP BY content_hash"
        ),
        "chunk_stats": (
            "WITH c AS (SELECT metadata.doc_kind AS doc_kind, greatest(1, length(text) // 4) AS tokens, metadata.content_hash AS h FROM pdf_chunks WHERE text IS NOT NULL) SELECT doc_kind, count(*) AS n_rows, "
            "quantile_cont(tokens, 0.5) AS median_tokens, round(avg(tokens), 4) AS mean_tokens, CAST(max(tokens) AS INTEGER) AS max_tokens, count(*) FILTER (WHERE h IS NULL) AS n_missing_hash FROM c GROUP BY doc_kind"
        ),
        "domain_scores": f"{base}{scored} SELECT doc_id, domain, CAST(score AS INTEGER) AS score FROM s WHERE score > 0",
        "infer_domains": (
            f"{base}{scored}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, i) AS k FROM s WHERE score > 0), "
            "t AS (SELECT doc_id, string_agg(domain, '; ' ORDER BY k) AS domains FROM r WHERE k <= 4 GROUP BY doc_id) SELECT d.doc_id, coalesce(domains, 'agriculture') AS domains FROM d LEFT JOIN t ON d.doc_id = t.doc_id"
        ),
        "agri_gate": f"{base}, s AS (SELECT doc_id, {' + '.join(count('low', t) if ' ' in t or '-' in t else count('words', f' {t} ') for t in AGRICULTURE_TERMS)} AS hits FROM d) SELECT doc_id, CAST(hits AS INTEGER) AS hits FROM s WHERE hits >= 2",
        "section_roles": (
            f"WITH c AS (SELECT metadata.doc_kind AS doc_kind, {role} AS role FROM pdf_chunks) SELECT doc_kind, role, CASE WHEN role IN ('table', 'abstract') THEN role ELSE 'content' END AS lane, count(*) AS n FROM c "
            f"WHERE role NOT IN ({', '.join(q(r) for r in EXCLUDED_ROLES)}) GROUP BY 1, 2, 3"
        ),
        "sentences": (
            "WITH s AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS parts FROM documents WHERE text IS NOT NULL) "
            "SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, CAST(length(parts[i]) AS INTEGER) AS n_chars FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM s)"
        ),
        "paragraph_blocks": (
            "WITH s AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '\\n[ \\t\\r]*\\n', chr(1), 'g'), chr(1)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS parts "
            "FROM documents WHERE text IS NOT NULL) SELECT doc_id, CASE WHEN i = 1 THEN 'body' ELSE 'body/p' || CAST(i AS VARCHAR) END AS path, CAST(length(parts[i]) AS INTEGER) AS n_chars "
            "FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM s)"
        ),
    }
