"""Queries over what chunks carry into collections, over search modes, table hints and file listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.catalog import Sources
from loamline.functions import keys, payloads
from loamline.functions.urls import normalise_url
from loamline.functions.vocabulary import CHUNK_NAMESPACE
from loamline.operators import collections as col
from loamline.operators.model_steps import changed_files, first_that_helps
from loamline.operators.retrieval import dense_topk
from loamline.operators.table_hints import with_catalogue
from loamline.sources.sinks import upsert

K = 5
# Two-letter codes of African countries.
COUNTRIES = {
    "AO": "Angola", "BF": "Burkina Faso", "BI": "Burundi", "BJ": "Benin", "BW": "Botswana", "CD": "Congo, The Democratic Republic of the", "CF": "Central African Republic", "CG": "Congo",
    "CI": "Côte d'Ivoire", "CM": "Cameroon", "CV": "Cabo Verde", "DJ": "Djibouti", "DZ": "Algeria", "EG": "Egypt", "ER": "Eritrea", "ET": "Ethiopia", "GA": "Gabon", "GH": "Ghana",
    "GM": "Gambia", "GN": "Guinea", "GQ": "Equatorial Guinea", "GW": "Guinea-Bissau", "KE": "Kenya", "KM": "Comoros", "LR": "Liberia", "LS": "Lesotho", "LY": "Libya", "MA": "Morocco",
    "MG": "Madagascar", "ML": "Mali", "MR": "Mauritania", "MU": "Mauritius", "MW": "Malawi", "MZ": "Mozambique", "NA": "Namibia", "NE": "Niger", "NG": "Nigeria", "RW": "Rwanda",
    "SC": "Seychelles", "SD": "Sudan", "SL": "Sierra Leone", "SN": "Senegal", "SO": "Somalia", "SS": "South Sudan", "ST": "Sao Tome and Principe", "SZ": "Eswatini", "TD": "Chad",
    "TG": "Togo", "TN": "Tunisia", "TZ": "Tanzania, United Republic of", "UG": "Uganda", "ZA": "South Africa", "ZM": "Zambia", "ZW": "Zimbabwe",
}
PRICES = "fews_net_market_prices_time_series_data"
META = ["document_id", "chunk_index", "total_chunks", "content_hash", "ingest_version", "doc_kind", "title", "source", "url", "published_at", "geo_country_primary", "section_path"]


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Sources(spark, sf_dir).table("pdf_chunks").select("id", "text", *[F.col(f"metadata.{m}").alias(m) for m in META])


def payload_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spine of every document's metadata."""
    d = Sources(spark, sf_dir).table("documents").select("doc_id", F.nullif("doc_kind", F.lit("news")).alias("doc_kind"), F.when(F.col("doc_kind") == "news", "bq x").alias("type"), F.concat_ws("; ", "geo_country_primary", F.lower("geo_country_primary"), "lang").alias("geo_countries"))
    return payloads.spine(d).select("doc_id", "doc_kind", "label", "source_kind", "geo_countries", "geo_country_primary", "geo_scope")


def payload_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field that a point of the news collection keeps of its chunk, the content as its hash."""
    c = _chunks(spark, sf_dir).where("doc_kind = 'news' and text is not null")
    rows = c.select("id", F.explode(payloads.payload(c.drop("id"), "text", "news")).alias("field", "value"))
    return rows.select("id", "field", F.when(F.col("field") == "content", F.md5("value")).otherwise(F.col("value")).alias("value"))


def payload_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that pass the filter asked after a search."""
    d = Sources(spark, sf_dir).table("documents").select("doc_id", "doc_kind", "geo_country_primary", "published_at")
    return d.where(payloads.passes(d, doc_kinds=["news", "policy_report"], geo="an", start="2021-06-01", end="2024-03-31")).select("doc_id")


def embedding_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an e5 model is given of held-out questions and of titles."""
    at = Sources(spark, sf_dir)
    q = at.table("eval_items").select(F.lit("query").alias("side"), F.col("item_id").alias("id"), F.md5(payloads.embedding_input(F.col("text"), "multilingual-e5-small", is_query=True)).alias("input_md5"))
    d = at.table("documents").select(F.lit("passage").alias("side"), F.col("doc_id").alias("id"), F.md5(payloads.embedding_input(F.col("title"), "multilingual-e5-small", is_query=False)).alias("input_md5"))
    return q.unionByName(d)


def hash_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed word vectors of every document, in their non-zero places."""
    return payloads.hash_embedding(Sources(spark, sf_dir).table("documents"), "doc_id", "text")


def _vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Points with the named vectors of every layout (parts of 16 of the embedding), and the query set."""
    e = Sources(spark, sf_dir).table("embeddings")
    part = lambda i: F.slice("embedding", 1 + 16 * i, 16)
    named = {"vector": 0, "dense": 1, "sentence": 2, "semantic": 3, "abstract_vector": 0, "content_vector": 1, "insight_vector": 0, "metric_vector": 1, "recommendation_vector": 2, "table_vector": 1, "schema_vector": 2, "business_vector": 3}
    points = e.select("vec_id", "label", *[part(i).alias(n) for n, i in named.items()])
    return points, e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), part(0).alias("qv"))


def search_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest points of every search mode, each by its default variant."""
    points, asked = _vectors(spark, sf_dir)
    out = None
    for mode in col.MODES:
        hits = col.search(points, "vec_id", asked, "query_id", "qv", K, mode=mode).select(F.lit(mode).alias("mode"), "query_id", "vec_id", F.round("score", 5).alias("score"), "rank")
        out = hits if out is None else out.unionByName(hits)
    return out


def overfetch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest points of even labels, asked after a search eight times as deep."""
    points, asked = _vectors(spark, sf_dir)
    hits = lambda n: dense_topk(points, "vec_id", "vector", asked, "query_id", "qv", n)
    return col.filtered_after(hits, points.select("vec_id", "label"), "vec_id", "query_id", F.col("label") % 2 == 0, K).select("query_id", "vec_id", F.round("score", 5).alias("score"), "rank")


def quantised_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector in whole numbers."""
    e = Sources(spark, sf_dir).table("embeddings").select("vec_id", payloads.quantise(F.col("embedding")).alias("q"))
    return e.select("vec_id", F.round("q.scale", 7).alias("scale"), F.array_join(F.transform("q.codes", lambda c: c.cast("string")), ",").alias("codes"))


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version of each chunk that a collection holds after its chunks came in twice."""
    c = _chunks(spark, sf_dir).where("id is not null").select("id", "ingest_version", "text")
    return upsert(c, c, "id", "ingest_version").select("id", "ingest_version")


def catalogue_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits with the description of their table, by bare or by full name."""
    d = Sources(spark, sf_dir).table("documents")
    number = lambda n: (F.col("doc_id") % n).cast("string")
    hits = d.select("doc_id", F.concat(F.lit("t"), number(13)).alias("table_name"), F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit("layer.bronze.t"), number(11))).alias("bq_table_id"))
    catalogue = spark.range(9).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("table_name"), F.concat(F.lit("about "), F.col("id").cast("string")).alias("description"))
    return with_catalogue(hits, catalogue)


def section_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifier of every section of every document."""
    c = _chunks(spark, sf_dir).where("document_id is not null and section_path is not null").select("document_id", "section_path").distinct()
    return c.select("document_id", "section_path", payloads.section_parent("research", "document_id", "section_path").alias("parent_id"))


def chunk_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every chunk is given when it is made."""
    c = _chunks(spark, sf_dir).where("text is not null and document_id is not null").withColumnsRenamed({"chunk_index": "i", "total_chunks": "n", "id": "old"})
    return payloads.enrich(c, "news", "document_id", "i", "n", "text", "v2").select("document_id", "chunk_index", "total_chunks", "content_hash", "ingest_version", "section_path", "id")


def research_lane_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of both vectors of every research chunk, as hashes."""
    c = _chunks(spark, sf_dir).where("doc_kind = 'research_paper' and text is not null")
    none = F.lit(None).cast("string")
    lanes = payloads.research_lanes(F.col("text"), F.when(F.col("chunk_index") == 0, "abstract"), F.col("section_path"), none)
    return c.select("id", "ingest_version", F.md5(lanes["abstract"]).alias("abstract_md5"), F.md5(lanes["content"]).alias("content_md5"))


def table_lane_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of the three vectors of every table description, as hashes."""
    d = Sources(spark, sf_dir).table("documents").where("doc_kind = 'data_description' and text is not null")
    lanes = payloads.table_lanes(F.col("text"), F.lit("t1"), F.lit("layer.bronze.t1"))
    return d.select("doc_id", *[F.md5(lanes[x]).alias(f"{x}_md5") for x in ("table", "schema", "business")])


def country_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings of countries in prices, as they are written elsewhere, with the rows of each."""
    p = Sources(spark, sf_dir).table(PRICES)
    return p.groupBy("country").agg(F.count(F.lit(1)).alias("n")).select("country", payloads.country_name(F.col("country")).alias("name"), "n")


def country_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices per country, the country's name looked up by its code."""
    names = spark.createDataFrame(list(COUNTRIES.items()), "code string, name string")
    p = Sources(spark, sf_dir).table(PRICES).groupBy(F.upper(F.trim("country_code")).alias("code")).agg(F.count(F.lit(1)).alias("n"))
    return p.join(F.broadcast(names), "code", "left")


def html_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in mark-up per nation, as lines of cells."""
    n = Sources(spark, sf_dir).table("nation")
    html = F.concat(F.lit("<table class='x'><TR><th>Nation</th><th>  Key </TH></TR>\r\n<tr><td><b>"), "n_name", F.lit("</b></td>\t<td>"), F.col("n_nationkey").cast("string"), F.lit("</td></tr>\n\n</table>"))
    return n.select("n_nationkey", payloads.html_table(html).alias("table_text"))


def published_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day of publication of every chunk, whatever the notation."""
    c = _chunks(spark, sf_dir).where("id is not null")
    return c.select("id", "ingest_version", payloads.published_day(F.col("published_at")).alias("day"))


def best_per_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed item with the longest summary of every page; ties go to the first."""
    r = Sources(spark, sf_dir).table("rss_items").select(normalise_url("url").alias("page"), F.length(F.coalesce("summary", F.lit(""))).alias("score"), "item_id")
    return r.groupBy("page").agg(F.max_by("item_id", F.struct("score", -F.col("item_id"))).alias("item_id"), F.max("score").alias("score"))


def retrieval_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of tables, news and papers, one stream after the other."""
    d = Sources(spark, sf_dir).table("documents").select("doc_id", "doc_kind")
    streams = [("data_description", "bigquery"), ("news", "news"), ("research_paper", "academic")]
    out = None
    for rank, (kind, name) in enumerate(streams):
        hits = d.where(F.col("doc_kind") == kind).orderBy("doc_id").limit(20).select(F.lit(rank).alias("stream"), F.lit(name).alias("source"), "doc_id")
        out = hits if out is None else out.unionByName(hits)
    return out.orderBy("stream", "doc_id")


def enrichment_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The body of every feed item: its page if that is long enough, else its summary, else its title."""
    at = Sources(spark, sf_dir)
    pages = at.table("pdf_chunks").where("metadata.url is not null and text is not null").groupBy(F.col("metadata.url").alias("url")).agg(F.max("text").alias("page"))
    rows = at.table("rss_items").select("item_id", "url", "title", "summary").join(pages, "url", "left")
    done = first_that_helps(rows, [("page", "page"), ("summary", "summary"), ("title", "title")], 40)
    return done.select("item_id", "body_source", F.md5("body").alias("body_md5"))


def changed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a folder that a cache lacks or holds otherwise."""
    c = Sources(spark, sf_dir).table("documents").select(F.col("doc_id"), F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 4 == 0, ".PDF").otherwise(".txt")).alias("path"), F.md5(F.coalesce("text", F.lit(""))).alias("md5"), F.length("text").cast("long").alias("size"))
    listing = c.select("path", F.when(F.col("doc_id") % 3 != 0, F.col("md5")).alias("md5"), "size")
    cached = c.where("doc_id % 5 <> 0").select("path", F.when(F.col("doc_id") % 7 == 0, "old").otherwise(F.col("md5")).alias("md5"), (F.col("size") + F.when(F.col("doc_id") % 11 == 0, 1).otherwise(0)).alias("size"))
    return changed_files(listing, cached, [".pdf"])


def constant_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of constants, without any table."""
    return spark.sql("SELECT 1 AS id, 'raw' AS layer")


def ordinal_group_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and quantity by the places of the grouping columns."""
    lines = Sources(spark, sf_dir).table("lineitem")
    return spark.sql("SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS n, sum(l_quantity) AS quantity FROM {lines} GROUP BY 1, 2", lines=lines)


def title_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How alike the titles of feed items are that lead to one page, each against the page's first item."""
    r = Sources(spark, sf_dir).table("rss_items").select("item_id", "title", normalise_url("url").alias("page"))
    first = r.groupBy("page").agg(F.min_by(F.struct("item_id", "title"), "item_id").alias("f"))
    both = r.join(first, "page").where(F.col("item_id") != F.col("f.item_id"))
    return both.select("item_id", F.col("f.item_id").alias("first_id"), F.round(payloads.title_similarity(F.col("title"), F.col("f.title")), 6).alias("similarity"))


def queries() -> dict:
    return {
        f.__name__: f for f in (
            payload_spine, payload_fields, payload_residual, embedding_inputs, hash_embeddings, search_modes, overfetch_search, quantised_vectors, upsert_latest, catalogue_hits, section_parents,
            chunk_metadata, research_lane_texts, table_lane_texts, country_names, country_lookup, html_tables, published_days, best_per_page, retrieval_streams, enrichment_cascade,
            changed_pages, constant_row, ordinal_group_by, title_pairs,
        )
    }


# ---------------------------------------------------------------- the same in SQL
def sql_collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '[\\s\\p{{Z}}\\x{{85}}\\x0b\\x1c-\\x1f]+', ' ', 'g'))"


def sql_uuid5(name: str) -> str:
    """Name-based UUID (version 5) in DuckDB."""
    h = f"sha1(from_hex('{CHUNK_NAMESPACE.replace('-', '')}')::BLOB || ({name})::BLOB)"
    return f"(SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab89ab89ab89ab', CAST(('0x' || substr(h, 17, 1)) AS INTEGER) + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) FROM (SELECT {h} AS h))"


def sql_chunk_id(corpus: str, document: str, index: str, text: str) -> str:
    return sql_uuid5(f"'{corpus}|' || {document} || '|' || CAST({index} AS VARCHAR) || '|' || substr(sha256({sql_collapse(text)}), 1, 16)")


def sql_url(url: str) -> str:
    """An address in its normal form, in DuckDB: written from the rules, with its own functions."""
    u = f"trim({url})"
    tracking = "'utm_source','utm_medium','utm_campaign','utm_term','utm_content','gclid','fbclid','mc_cid','mc_eid'"
    recode = lambda x: f"replace(replace(url_encode(url_decode(replace({x}, '+', ' '))), '%20', '+'), '~', '%7E')"
    scheme = f"lower(regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1))"
    rest = f"regexp_replace({u}, '^[A-Za-z][A-Za-z0-9+.-]*:', '')"
    host = f"regexp_replace(lower(regexp_extract({rest}, '^//([^/?#]*)', 1)), '^www[.]', '')"
    path = f"regexp_extract(regexp_replace({rest}, '^//[^/?#]*', ''), '^[^?#]*')"
    path = f"regexp_replace(regexp_replace(regexp_replace({path}, ';[^/]*$', ''), '/+', '/', 'g'), '/$', '')"
    query = f"regexp_extract(regexp_replace({u}, '#.*$', ''), '[?](.*)$', 1)"
    pairs = f"list_filter(list_transform(list_filter(string_split({query}, '&'), lambda p: p <> ''), lambda p: [{recode("split_part(p, '=', 1)")}, {recode("regexp_extract(p, '^[^=]*=?(.*)$', 1)")}]), lambda p: lower(p[1]) NOT IN ({tracking}))"
    joined = f"array_to_string(list_transform({pairs}, lambda p: p[1] || '=' || p[2]), '&')"
    return (
        f"CASE WHEN {u} = '' THEN '' ELSE CASE WHEN {scheme} = '' THEN 'https' ELSE {scheme} END || '://' || {host} || CASE WHEN {path} = '' THEN '/' ELSE {path} END "
        f"|| CASE WHEN {joined} = '' THEN '' ELSE '?' || {joined} END END"
    )


def oracle_sql() -> dict[str, str]:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    meta = ", ".join(f"metadata.{m} AS {m}" for m in META)
    chunks = f"c AS (SELECT id, text, {meta} FROM pdf_chunks)"
    strip = lambda x: f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
    title = lambda x: f"array_to_string(list_transform(regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+'), lambda w: upper(w[1:1]) || lower(w[2:])), '')"
    parts = {n: i for n, i in (("vector", 0), ("dense", 1), ("sentence", 2), ("semantic", 3), ("abstract_vector", 0), ("content_vector", 1), ("insight_vector", 0), ("metric_vector", 1), ("recommendation_vector", 2), ("table_vector", 1), ("schema_vector", 2), ("business_vector", 3))}
    near = lambda i: f"SELECT query_id, vec_id, list_cosine_similarity(qv, CAST(embedding[{1 + 16 * i}:{16 + 16 * i}] AS DOUBLE[])) AS s FROM asked, embeddings"
    deep = lambda i, k: f"SELECT query_id, vec_id, s FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS r FROM ({near(i)})) WHERE r <= {k}"
    asked = "asked AS (SELECT vec_id AS query_id, CAST(embedding[1:16] AS DOUBLE[]) AS qv FROM embeddings WHERE vec_id % 100 = 0)"
    modes = " UNION ALL ".join(
        f"SELECT '{mode}' AS mode, query_id, vec_id, round(s, 5) AS score, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM "
        f"(SELECT query_id, vec_id, max(s) AS s FROM ({' UNION ALL '.join(deep(parts[v], K) for v in next(iter(variants.values())))}) GROUP BY 1, 2)" for mode, variants in col.MODES.items()
    )
    keep = [f for f in META if f in payloads.PAYLOAD_FIELDS["news"]]
    html = "'<table class=''x''><TR><th>Nation</th><th>  Key </TH></TR>' || chr(13) || chr(10) || '<tr><td><b>' || n_name || '</b></td>' || chr(9) || '<td>' || n_nationkey || '</td></tr>' || chr(10) || chr(10) || '</table>'"
    tagged = f"regexp_replace(regexp_replace(regexp_replace({html}, '</tr>', chr(10), 'gi'), '</t[dh]>', ' | ', 'gi'), '<[^>]+>', '', 'g')"
    section = "CASE WHEN trim(coalesce(section_path, '')) <> '' THEN trim(trim(section_path) || chr(10) || chr(10) || {b}) ELSE {b} END"
    is_schema = "((trim(x) LIKE '|%' AND len(regexp_extract_all(x, '[|]')) >= 2) OR lower(trim(x)) LIKE 'column name%' OR (trim(x) LIKE '% | %' AND regexp_matches(x, '\\b(description|data type|example value)\\b', 'i')))"
    picked = lambda rule: f"coalesce(nullif({strip(f"array_to_string(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '' AND {rule}), chr(10))")}, ''), text)"
    return {
        "payload_spine": (
            "WITH d AS (SELECT doc_id, CASE WHEN doc_kind <> 'news' THEN doc_kind END AS k, doc_kind = 'news' AS is_table, list_filter([trim(geo_country_primary), trim(lower(geo_country_primary)), trim(lang)], lambda x: x IS NOT NULL AND x <> '') AS g FROM documents), "
            "p AS (SELECT *, list_transform(g, lambda x: lower(x)) AS low FROM d), u AS (SELECT *, list_filter(g, lambda x, i: list_position(low, lower(x)) = i) AS o FROM p), v AS (SELECT *, coalesce(nullif(trim(k), ''), CASE WHEN is_table THEN 'bq_table_description' ELSE 'other' END) AS doc_kind FROM u) "
            f"SELECT doc_id, doc_kind, CASE WHEN is_table THEN 'bq x' END AS label, CASE doc_kind {' '.join(f'WHEN {q(a)} THEN {q(b)}' for a, b in payloads.SOURCE_KINDS.items())} END AS source_kind, nullif(array_to_string(o, '; '), '') AS geo_countries, "
            "o[1] AS geo_country_primary, CASE WHEN len(o) = 0 THEN 'unknown' WHEN len(o) > 1 THEN 'multi_country' ELSE 'country' END AS geo_scope FROM v"
        ),
        "payload_fields": f"WITH {chunks} " + " UNION ALL ".join(
            [f"SELECT id, '{f}' AS field, CAST({f} AS VARCHAR) AS value FROM c WHERE doc_kind = 'news' AND text IS NOT NULL AND {f} IS NOT NULL" for f in keep]
            + ["SELECT id, 'content', md5(text) FROM c WHERE doc_kind = 'news' AND text IS NOT NULL"]
        ),
        "payload_residual": (
            "SELECT doc_id FROM documents WHERE trim(doc_kind) IN ('news', 'policy_report') AND contains(lower(coalesce(geo_country_primary, '')), 'an') AND (published_at IS NULL OR CAST(published_at AS DATE) BETWEEN DATE '2021-06-01' AND DATE '2024-03-31')"
        ),
        "embedding_inputs": "SELECT 'query' AS side, item_id AS id, md5('query: ' || coalesce(text, '')) AS input_md5 FROM eval_items UNION ALL SELECT 'passage', doc_id, md5('passage: ' || coalesce(title, '')) FROM documents",
        "hash_embeddings": (
            "WITH w AS (SELECT doc_id, md5(unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+'))) AS h FROM documents), n AS (SELECT doc_id, CAST(('0x' || substr(h, 1, 8)) AS BIGINT) % 64 AS slot, "
            "sum(CASE WHEN CAST(('0x' || substr(h, 9, 1)) AS INTEGER) % 2 = 0 THEN 1 ELSE -1 END) AS n FROM w GROUP BY 1, 2 HAVING sum(CASE WHEN CAST(('0x' || substr(h, 9, 1)) AS INTEGER) % 2 = 0 THEN 1 ELSE -1 END) <> 0) "
            "SELECT doc_id, slot, round(CAST(n AS DOUBLE) / sqrt(CAST(sum(n * n) OVER (PARTITION BY doc_id) AS DOUBLE)), 6) AS weight FROM n"
        ),
        "search_modes": f"WITH {asked}, every AS ({modes}) SELECT * FROM every WHERE rank <= {K}",
        "overfetch_search": (
            f"WITH {asked}, h AS ({deep(0, 8 * K)}), r AS (SELECT h.*, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, h.vec_id) AS rank FROM h JOIN embeddings e ON e.vec_id = h.vec_id WHERE label % 2 = 0) "
            f"SELECT query_id, vec_id, round(s, 5) AS score, rank FROM r WHERE rank <= {K}"
        ),
        "quantised_vectors": (
            "WITH s AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, list_max(list_transform(CAST(embedding AS DOUBLE[]), lambda x: abs(x))) / 127.0 AS scale FROM embeddings) "
            "SELECT vec_id, round(scale, 7) AS scale, array_to_string(list_transform(v, lambda x: CAST(coalesce(round(x / nullif(scale, 0)), 0) AS INTEGER)), ',') AS codes FROM s"
        ),
        "upsert_latest": "SELECT id, max(metadata.ingest_version) AS ingest_version FROM pdf_chunks WHERE id IS NOT NULL GROUP BY id",
        "catalogue_hits": (
            "WITH h AS (SELECT doc_id, 't' || (doc_id % 13) AS table_name, CASE WHEN doc_id % 5 <> 0 THEN 'layer.bronze.t' || (doc_id % 11) END AS bq_table_id FROM documents) SELECT *, "
            "CASE WHEN doc_id % 13 < 9 THEN 'about ' || (doc_id % 13) WHEN doc_id % 5 <> 0 AND doc_id % 11 < 9 THEN 'about ' || (doc_id % 11) END AS description FROM h"
        ),
        "section_parents": (
            f"WITH {chunks}, s AS (SELECT DISTINCT document_id, section_path FROM c WHERE document_id IS NOT NULL AND section_path IS NOT NULL) SELECT document_id, section_path, {sql_chunk_id('research', 'document_id', '-1', "'section::' || section_path")} AS parent_id FROM s"
        ),
        "chunk_metadata": (
            f"WITH {chunks} SELECT document_id, chunk_index, total_chunks, sha256({sql_collapse('text')}) AS content_hash, 'v2' AS ingest_version, nullif(section_path, '') AS section_path, "
            f"{sql_chunk_id('news', 'document_id', 'chunk_index', 'text')} AS id FROM c WHERE text IS NOT NULL AND document_id IS NOT NULL"
        ),
        "research_lane_texts": (
            f"WITH {chunks} SELECT id, ingest_version, md5(CASE WHEN chunk_index = 0 THEN {section.format(b='text')} ELSE {section.format(b=strip('substr(text, 1, 700)'))} END) AS abstract_md5, md5(text) AS content_md5 "
            "FROM c WHERE doc_kind = 'research_paper' AND text IS NOT NULL"
        ),
        "table_lane_texts": (
            f"WITH l AS (SELECT doc_id, {picked(is_schema)} AS s, {picked('NOT ' + is_schema)} AS b FROM documents WHERE doc_kind = 'data_description' AND text IS NOT NULL) SELECT doc_id, "
            "md5(regexp_replace('Table: t1' || chr(10) || 'BQ table: layer.bronze.t1' || chr(10) || chr(10) || b, '\\s+$', '')) AS table_md5, md5(s) AS schema_md5, md5(b) AS business_md5 FROM l"
        ),
        "country_names": (
            f"WITH c AS (SELECT country, count(*) AS n FROM {PRICES} GROUP BY 1), s AS (SELECT *, trim(regexp_replace(coalesce(country, ''), '\\s+', ' ', 'g')) AS t FROM c) SELECT country, "
            f"CASE lower(regexp_replace(t, '[ -]', '', 'g')) {' '.join(f'WHEN {q(a)} THEN {q(b)}' for a, b in payloads.COUNTRY_ALIASES.items())} ELSE {title('t')} END AS name, n FROM s"
        ),
        "country_lookup": (
            f"WITH names(code, name) AS (VALUES {', '.join(f'({q(a)}, {q(b)})' for a, b in COUNTRIES.items())}), p AS (SELECT upper(trim(country_code)) AS code, count(*) AS n FROM {PRICES} GROUP BY 1) SELECT p.code, n, name FROM p LEFT JOIN names ON p.code = names.code"
        ),
        "html_tables": (
            f"SELECT n_nationkey, array_to_string(list_filter(list_transform(string_split(regexp_replace({tagged}, chr(13) || chr(10) || '?', chr(10), 'g'), chr(10)), lambda x: trim(regexp_replace(x, '[ \\t]+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS table_text FROM nation"
        ),
        "published_days": f"WITH {chunks} SELECT id, ingest_version, coalesce(nullif(regexp_extract(coalesce(published_at, ''), '([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 1), ''), '') AS day FROM c WHERE id IS NOT NULL",
        "best_per_page": (
            f"WITH r AS (SELECT {sql_url('url')} AS page, length(coalesce(summary, '')) AS score, item_id FROM rss_items) SELECT page, item_id, CAST(score AS INTEGER) AS score FROM r QUALIFY row_number() OVER (PARTITION BY page ORDER BY score DESC, item_id) = 1"
        ),
        "retrieval_streams": (
            "WITH d AS (SELECT CASE doc_kind WHEN 'data_description' THEN 0 WHEN 'news' THEN 1 WHEN 'research_paper' THEN 2 END AS stream, CASE doc_kind WHEN 'data_description' THEN 'bigquery' WHEN 'news' THEN 'news' ELSE 'academic' END AS source, doc_id, "
            "row_number() OVER (PARTITION BY doc_kind ORDER BY doc_id) AS r FROM documents WHERE doc_kind IN ('data_description', 'news', 'research_paper')) SELECT stream, source, doc_id FROM d WHERE r <= 20"
        ),
        "enrichment_cascade": (
            "WITH p AS (SELECT metadata.url AS url, max(text) AS page FROM pdf_chunks WHERE metadata.url IS NOT NULL AND text IS NOT NULL GROUP BY 1), r AS (SELECT item_id, title, summary, page FROM rss_items LEFT JOIN p ON p.url = rss_items.url), "
            "t AS (SELECT *, CASE WHEN length(trim(page, ' ')) >= 40 THEN 'page' WHEN length(trim(summary, ' ')) >= 40 THEN 'summary' WHEN length(trim(title, ' ')) >= 40 THEN 'title' ELSE '' END AS body_source FROM r) "
            "SELECT item_id, body_source, md5(CASE body_source WHEN 'page' THEN page WHEN 'summary' THEN summary WHEN 'title' THEN title END) AS body_md5 FROM t"
        ),
        "changed_pages": (
            "WITH c AS (SELECT doc_id, 'd' || doc_id || CASE WHEN doc_id % 4 = 0 THEN '.PDF' ELSE '.txt' END AS path, md5(coalesce(text, '')) AS h, length(text) AS size FROM documents) SELECT path, CASE WHEN doc_id % 3 <> 0 THEN h END AS md5, size, "
            "CASE WHEN doc_id % 4 = 0 AND (doc_id % 5 = 0 OR (doc_id % 3 <> 0 AND doc_id % 7 = 0) OR (size IS NOT NULL AND doc_id % 11 = 0)) THEN 'download' ELSE 'skip' END AS action FROM c"
        ),
        "constant_row": "SELECT 1 AS id, 'raw' AS layer",
        "ordinal_group_by": "SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2",
    }
