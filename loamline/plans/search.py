"""Retrieval queries over embeddings and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamline.catalog import Sources
from loamline.operators.retrieval import bm25_topk, dense_topk, merge_scored, pack_context, payload_filter, rerank_by_source, rrf
from loamline.operators.table_hints import excerpt

K, PREFETCH = 5, 20


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Sources(spark, sf_dir).table("embeddings")


def _asked(rows: DataFrame) -> DataFrame:
    """The query set of a search: every row whose id is divisible by 100."""
    return rows.where("vec_id % 100 = 0")


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _embeddings(spark, sf_dir)
    q = _asked(e).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("qv"))
    return dense_topk(e, "vec_id", "embedding", q, "query_id", "qv", K).withColumn("score", F.round("score", 5))


def multi_vector_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two named vectors per point (halves of the embedding), best score of either."""
    e = _embeddings(spark, sf_dir)
    lists = None
    for start in (1, 33):
        part = F.slice("embedding", start, 32)
        q = _asked(e).select(F.col("vec_id").alias("query_id"), part.alias("qv"))
        hits = dense_topk(e.select("vec_id", part.alias("v")), "vec_id", "v", q, "query_id", "qv", PREFETCH).select("query_id", "vec_id", F.round("score", 5).alias("score"))
        lists = hits if lists is None else lists.union(hits)
    return merge_scored(lists, "query_id", "vec_id", K)


def bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = Sources(spark, sf_dir)
    q = at.table("eval_items").select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))
    return bm25_topk(at.table("documents"), "doc_id", "text", q, "query_id", "query_text", K)


def hybrid_rrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense and BM25 branches of 20 each over documents with a vector, fused by rank; the language filter is in both."""
    at = Sources(spark, sf_dir)
    docs = at.table("documents").where("lower(lang) = 'en'").select(F.col("doc_id").alias("vec_id"), "text")
    both = docs.join(_embeddings(spark, sf_dir), "vec_id")
    q = _asked(_embeddings(spark, sf_dir)).join(at.table("documents").select(F.col("doc_id").alias("vec_id"), F.coalesce("title", F.lit("")).alias("qt")), "vec_id").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("qv"), F.col("qt").alias("query_text")
    )
    a = dense_topk(both, "vec_id", "embedding", q, "query_id", "qv", PREFETCH)
    b = bm25_topk(both, "vec_id", "text", q, "query_id", "query_text", PREFETCH)
    return rrf([a, b], "query_id", "vec_id", 10)


def filtered_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense search among documents of two kinds since a date."""
    at = Sources(spark, sf_dir)
    cond = payload_filter(doc_kinds=["news", "policy_report"], start="2021-01-01")
    docs = at.table("documents").where(cond).select(F.col("doc_id").alias("vec_id"), "doc_kind")
    e = _embeddings(spark, sf_dir)
    q = _asked(e).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("qv"))
    hits = dense_topk(e.join(docs, "vec_id"), "vec_id", "embedding", q, "query_id", "qv", K)
    return hits.select("query_id", "vec_id", F.round("score", 5).alias("score"), "rank")


def recall_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of queries with another item of their own label among the k nearest others, and the queries. The query itself is
    among the items: one more is fetched, and it does not count."""
    e = _embeddings(spark, sf_dir)
    labels = e.select("vec_id", "label")
    q = _asked(e).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("qv"))
    others = dense_topk(e, "vec_id", "embedding", q, "query_id", "qv", K + 1).where("query_id <> vec_id")
    w = Window.partitionBy("query_id").orderBy("rank")
    hits = others.withColumn("r", F.row_number().over(w)).where(F.col("r") <= K).join(labels, "vec_id").join(labels.withColumnsRenamed({"vec_id": "query_id", "label": "wanted"}), "query_id")
    per = hits.groupBy("query_id").agg(F.max((F.col("label") == F.col("wanted")).cast("int")).alias("hit"))
    return per.agg(F.round(F.avg("hit"), 6).alias("recall"), F.count(F.lit(1)).alias("n_queries"))


def rerank_boost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed items and documents as hits of three sources, by boost and arrival; the top 20."""
    d = Sources(spark, sf_dir).table("documents")
    source = F.when(F.col("doc_kind") == "news", "news").when(F.col("doc_kind") == "research_paper", "academic").when(F.col("doc_kind") == "policy_report", "academic").otherwise("bigquery")
    return rerank_by_source(d.select("doc_id", source.alias("hit_source")), "hit_source", "doc_id").limit(20)


def context_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best BM25 hits of each query as one labelled context."""
    at = Sources(spark, sf_dir)
    hits = bm25(spark, sf_dir).where("rank <= 3").join(at.table("documents").select("doc_id", F.concat(F.lit("["), F.coalesce("doc_kind", F.lit("")), F.lit("] "), F.coalesce("text", F.lit(""))).alias("t")), "doc_id")
    return pack_context(hits, "query_id", [F.col("rank")], "t").select("query_id", F.md5("context").alias("context_md5"), F.length("context").alias("n_chars"))


def table_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BM25 hits grouped by source: the best hit and the runner-up, with an excerpt of its text, of each query and source."""
    at = Sources(spark, sf_dir)
    q = at.table("eval_items").select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))
    hits = bm25_topk(at.table("documents"), "doc_id", "text", q, "query_id", "query_text", PREFETCH).join(at.table("documents").select("doc_id", "source", excerpt(F.col("text")).alias("excerpt")), "doc_id")
    w = Window.partitionBy("query_id", "source").orderBy(F.desc("score"), "doc_id")
    ranked = hits.where("source is not null").withColumn("r", F.row_number().over(w)).where("r <= 2")
    pick = lambda r, c: F.max(F.when(F.col("r") == r, F.col(c)))
    return ranked.groupBy("query_id", "source").agg(pick(1, "doc_id").alias("best_doc"), pick(1, "score").alias("best_score"), pick(2, "doc_id").alias("second_doc"), F.coalesce(pick(2, "excerpt"), F.lit("")).alias("second_excerpt"))


def queries() -> dict:
    return {
        "dense_topk": dense, "multi_vector_merge": multi_vector_merge, "bm25_topk": bm25, "hybrid_rrf": hybrid_rrf, "filtered_search": filtered_search, "recall_at_k": recall_at_k,
        "rerank_boost": rerank_boost, "context_pack": context_pack, "table_match": table_match,
    }


_COS = "list_cosine_similarity(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"
_DENSE = "SELECT q.vec_id AS query_id, e.vec_id AS vec_id, {s} AS s FROM embeddings q, embeddings e WHERE q.vec_id % 100 = 0"
_TERMS = "list_filter(string_split_regex(lower({t}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"


def _bm25_sql(docs: str, asked: str) -> str:
    """CTEs ending in ``scored(q, i, score)``."""
    return f"""docs AS ({docs}), asked AS ({asked}), tok AS (SELECT i, {_TERMS.format(t='t')} AS w FROM docs WHERE t IS NOT NULL),
 st AS (SELECT count(*) AS n_docs, avg(len(w)) AS mean FROM tok), post AS (SELECT i, len(w) AS n, unnest(w) AS term FROM tok), tf AS (SELECT i, n, term, count(*) AS tf FROM post GROUP BY 1, 2, 3),
 dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY 1), qt AS (SELECT DISTINCT q, unnest({_TERMS.format(t='t')}) AS term FROM asked),
 scored AS (SELECT q, i, round(sum(ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * n / mean))), 6) AS score FROM qt JOIN tf USING (term) JOIN dfs USING (term), st GROUP BY q, i)"""


def oracle_sql() -> dict[str, str]:
    cos = _COS.format(a="q.embedding", b="e.embedding")
    dense_sql = f"WITH x AS ({_DENSE.format(s=cos)}), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM x)"
    half = lambda a, b: _DENSE.format(s=_COS.format(a=f"q.embedding[{a}:{b}]", b=f"e.embedding[{a}:{b}]"))
    bm = _bm25_sql("SELECT doc_id AS i, text AS t FROM documents", "SELECT item_id AS q, text AS t FROM eval_items")
    ranked = "r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, i) AS rank FROM scored)"
    return {
        "dense_topk": f"{dense_sql} SELECT query_id, vec_id, round(s, 5) AS score, rank FROM r WHERE rank <= {K}",
        "multi_vector_merge": (
            f"WITH a AS ({half(1, 32)}), b AS ({half(33, 64)}), ra AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS k FROM a), "
            "rb AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS k FROM b), "
            f"m AS (SELECT query_id, vec_id, max(round(s, 5)) AS score FROM (SELECT * FROM ra WHERE k <= {PREFETCH} UNION ALL SELECT * FROM rb WHERE k <= {PREFETCH}) GROUP BY 1, 2), "
            "r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM m) "
            f"SELECT query_id, vec_id, score, rank FROM r WHERE rank <= {K}"
        ),
        "bm25_topk": f"WITH {bm}, {ranked} SELECT q AS query_id, i AS doc_id, score, rank FROM r WHERE rank <= {K}",
        "hybrid_rrf": (
            "WITH both_ AS (SELECT doc_id AS vec_id, text, embedding FROM documents JOIN embeddings ON doc_id = vec_id WHERE lower(lang) = 'en'), "
            "qs AS (SELECT vec_id AS query_id, embedding AS qv, coalesce(title, '') AS qt FROM embeddings JOIN documents ON vec_id = doc_id WHERE vec_id % 100 = 0), "
            + _bm25_sql("SELECT vec_id AS i, text AS t FROM both_", "SELECT query_id AS q, qt AS t FROM qs")
            + f", {ranked}, dd AS (SELECT query_id AS q, vec_id AS i, row_number() OVER (PARTITION BY query_id ORDER BY {_COS.format(a='qv', b='embedding')} DESC, vec_id) AS rank FROM qs, both_), "
            f"f AS (SELECT q, i, round(sum(1.0 / (60 + rank)), 8) AS score FROM (SELECT q, i, rank FROM r WHERE rank <= {PREFETCH} UNION ALL SELECT q, i, rank FROM dd WHERE rank <= {PREFETCH}) GROUP BY 1, 2), "
            "z AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, i) AS rank FROM f) SELECT q AS query_id, i AS vec_id, score, rank FROM z WHERE rank <= 10"
        ),
        "filtered_search": (
            f"WITH x AS ({_DENSE.format(s=cos)} AND e.vec_id IN (SELECT doc_id FROM documents WHERE doc_kind IN ('news', 'policy_report') AND coalesce(CAST(published_at AS VARCHAR) >= '2021-01-01', true))), "
            f"r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM x) SELECT query_id, vec_id, round(s, 5) AS score, rank FROM r WHERE rank <= {K}"
        ),
        "recall_at_k": (
            f"WITH x AS ({_DENSE.format(s=cos)} AND q.vec_id <> e.vec_id), r AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) <= {K}), h AS (SELECT r.query_id, max(CASE WHEN a.label = b.label THEN 1 ELSE 0 END) AS hit FROM r JOIN embeddings a ON r.vec_id = a.vec_id JOIN embeddings b ON r.query_id = b.vec_id "
            f"GROUP BY 1) SELECT round(avg(hit), 6) AS recall, count(*) AS n_queries FROM h"
        ),
        "rerank_boost": (
            "WITH h AS (SELECT doc_id, CASE WHEN doc_kind = 'news' THEN 'news' WHEN doc_kind IN ('research_paper', 'policy_report') THEN 'academic' ELSE 'bigquery' END AS hit_source FROM documents) "
            "SELECT doc_id, hit_source, CASE hit_source WHEN 'bigquery' THEN 0.12 WHEN 'academic' THEN 0.06 WHEN 'news' THEN 0.04 ELSE 0.0 END::DOUBLE AS boost FROM h ORDER BY boost DESC, doc_id LIMIT 20"
        ),
        "context_pack": (
            f"WITH {bm}, {ranked}, p AS (SELECT q, rank, substr('[' || coalesce(doc_kind, '') || '] ' || coalesce(text, ''), 1, 2000) AS t FROM r JOIN documents ON i = doc_id WHERE rank <= 3), "
            "c AS (SELECT q, substr(string_agg(t, chr(10) || chr(10) ORDER BY rank), 1, 6000) AS context FROM p GROUP BY q) SELECT q AS query_id, md5(context) AS context_md5, CAST(length(context) AS INTEGER) AS n_chars FROM c"
        ),
        "table_match": (
            f"WITH {bm}, {ranked}, h AS (SELECT q, i, score, source, coalesce(text, '') AS text, row_number() OVER (PARTITION BY q, source ORDER BY score DESC, i) AS k FROM r JOIN documents ON i = doc_id WHERE rank <= {PREFETCH} AND source IS NOT NULL) "
            "SELECT q AS query_id, source, max(CASE WHEN k = 1 THEN i END) AS best_doc, max(CASE WHEN k = 1 THEN score END) AS best_score, max(CASE WHEN k = 2 THEN i END) AS second_doc, coalesce(max(CASE WHEN k = 2 THEN substr(text, 1, 400) || CASE WHEN length(text) > 400 THEN '…' ELSE '' END END), '') AS second_excerpt FROM h WHERE k <= 2 GROUP BY 1, 2"
        ),
    }
