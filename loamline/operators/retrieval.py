"""Retrieval: dense and BM25 top-k, multi-vector merge, reciprocal-rank fusion, filters, boosts, packing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.session import broadcast_within, cut_lineage

MAX_QUERY_BLOCK = 2_048  # queries that one pass holds against the collection
MAX_TERM_BLOCK = 256  # queries by terms that one pass holds: a matrix of queries and their terms
MAX_TERMS = 200_000  # distinct terms of queries up to which they are broadcast
RRF_K = 60  # constant of the fusion; the store that the design follows does not publish its own


def dense_topk(collection: DataFrame, item: str, vector: str, queries: DataFrame, query: str, query_vector: str, k: int) -> DataFrame:
    """``(query, item, score, rank)``: the k nearest items of every query by cosine, ties by item.

    The queries are the stated set: they are taken in blocks of MAX_QUERY_BLOCK, each block multiplied with every Arrow batch
    of the collection, and every batch gives its own k best, so that only k rows per query and batch are shuffled. Null
    vectors, and vectors of another length than the queries', are skipped; a zero vector scores 0.
    """
    asked = queries.select(F.col(query).cast("long").alias("q"), F.col(query_vector).alias("v")).where("q is not null and v is not null")
    n = asked.count()
    blocks = max(1, -(-n // (MAX_QUERY_BLOCK // 2))) if n > MAX_QUERY_BLOCK else 1
    rows = collection.select(F.col(item).cast("long").alias("i"), F.col(vector).alias("v")).where("i is not null and v is not null")
    out = None
    for b in range(blocks):
        part = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == b)
        held = [(r["q"], r["v"]) for r in part.collect()]
        found = rows.mapInArrow(_nearest_batches(held, k), "q long, i long, score double")
        out = found if out is None else out.union(found)
    w = Window.partitionBy("q").orderBy(F.desc("score"), "i")
    top = out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return top.withColumnsRenamed({"q": query, "i": item})


def _nearest_batches(held: list, k: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = np.array([q for q, _ in held], dtype=np.int64)
        matrix = np.array([v for _, v in held], dtype=np.float64) if held else np.zeros((0, 0))
        norms = np.linalg.norm(matrix, axis=1) if len(held) else np.zeros(0)
        for batch in batches:
            vectors = batch.column(1).to_pylist()
            keep = [j for j, v in enumerate(vectors) if len(held) and len(v) == matrix.shape[1]]
            if not keep:
                continue
            items = batch.column(0).to_numpy()[keep]
            block = np.array([vectors[j] for j in keep], dtype=np.float64)
            with np.errstate(divide="ignore", invalid="ignore"):
                scores = matrix @ block.T / np.outer(norms, np.linalg.norm(block, axis=1))
            scores = np.nan_to_num(scores)
            order = np.lexsort((np.tile(items, (len(ids), 1)), -scores), axis=1)[:, :k]
            at = np.arange(len(ids))[:, None]
            width = order.shape[1]
            yield pa.record_batch(
                [pa.array(np.repeat(ids, width)), pa.array(items[order].reshape(-1)), pa.array(scores[at, order].reshape(-1))], names=["q", "i", "score"]
            )

    return run


def merge_scored(hits: DataFrame, query: str, item: str, k: int) -> DataFrame:
    """Best score of each item over several result lists, the k best per query."""
    best = hits.groupBy(query, item).agg(F.max("score").alias("score"))
    w = Window.partitionBy(query).orderBy(F.desc("score"), item)
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def bm25_topk(
    documents: DataFrame, item: str, text: str, queries: DataFrame, query: str, query_text: str, k: int, *, k1: float = 1.2, b: float = 0.75
) -> DataFrame:
    """``(query, item, score, rank)`` by BM25: distinct query terms, idf = ln(1 + (N - df + 0.5) / (df + 0.5)).

    Only terms that some query asks for are kept of the postings, before any shuffle; term frequencies are pre-aggregated, and
    one row per document holds what is left of it. The queries are the stated set: blocks of them are multiplied with Arrow
    batches of these rows, and every batch gives its own k best, so that a common word never gives a row for each document and
    query. Null items, texts and queries are skipped; ties go to the lower item.
    """
    docs = documents.select(F.col(item).cast("long").alias("i"), terms(F.col(text)).alias("t")).where("i is not null and t is not null")
    asked = queries.select(F.col(query).cast("long").alias("q"), F.explode(F.array_distinct(terms(F.col(query_text)))).alias("term")).where("q is not null")
    asked = cut_lineage(asked.distinct())
    wanted = broadcast_within(asked.select("term").distinct(), MAX_TERMS)
    total = docs.agg(F.count(F.lit(1)).alias("N"), F.avg(F.size("t")).alias("avg")).first()
    n_docs, mean = int(total["N"]), float(total["avg"] or 1.0)
    tf = docs.select("i", F.size("t").alias("n"), F.explode("t").alias("term")).join(wanted, "term", "left_semi").groupBy("i", "n", "term").agg(F.count(F.lit(1)).alias("tf"))
    tf = cut_lineage(tf)
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    number = asked.select("term").distinct().withColumn("x", F.xxhash64("term"))
    idf = F.log1p((F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("n") / mean))
    postings = tf.join(broadcast_within(cut_lineage(df.join(number, "term")), MAX_TERMS), "term").groupBy("i").agg(F.collect_list(F.struct(F.col("x"), weight.alias("w"))).alias("p"))
    postings = postings.select("i", F.col("p.x").alias("x"), F.col("p.w").alias("w"))
    n_queries = asked.select("q").distinct().count()
    blocks = max(1, -(-n_queries // (MAX_TERM_BLOCK // 2))) if n_queries > MAX_TERM_BLOCK else 1
    postings = postings if blocks == 1 else cut_lineage(postings)
    out = None
    for block in range(blocks):
        part = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == block)
        held = part.select("q", F.xxhash64("term").alias("x")).toPandas()
        found = postings.mapInArrow(_bm25_batches(held["q"].to_numpy(np.int64), held["x"].to_numpy(np.int64), k), "q long, i long, score double")
        out = found if out is None else out.union(found)
    w = Window.partitionBy("q").orderBy(F.desc("score"), "i")
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).withColumnsRenamed({"q": query, "i": item})


def _bm25_batches(queries: np.ndarray, asked: np.ndarray, k: int):  # noqa: ANN202
    ids, row = np.unique(queries, return_inverse=True)
    known, column = np.unique(asked, return_inverse=True)
    cells = 2_000_000  # of the matrices that are held at once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not len(ids):
            return
        matrix = np.zeros((len(ids), len(known)))
        matrix[row, column] = 1.0
        for whole in batches:
            step = max(1, cells // max(len(known), len(ids)))
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                items, x, w = batch.column(0).to_numpy(), batch.column(1), batch.column(2)
                lengths = np.diff(np.asarray(x.offsets))
                terms, weights = x.flatten().to_numpy(), w.flatten().to_numpy()
                place = np.minimum(np.searchsorted(known, terms), len(known) - 1)
                mine = known[place] == terms
                block = np.zeros((len(items), len(known)))
                block[np.repeat(np.arange(len(items)), lengths)[mine], place[mine]] = weights[mine]
                scores = np.round(matrix @ block.T, 6)
                order = np.lexsort((np.tile(items, (len(ids), 1)), -scores), axis=1)[:, :k]
                best = scores[np.arange(len(ids))[:, None], order]
                q, j = np.nonzero(best > 0)
                yield pa.record_batch([pa.array(ids[q]), pa.array(items[order[q, j]]), pa.array(best[q, j])], names=["q", "i", "score"])

    return run


def rrf(branches: list[DataFrame], query: str, item: str, k: int) -> DataFrame:
    """Fusion of ranked branches: the sum of 1 / (RRF_K + rank), the k best per query."""
    every = branches[0].select(query, item, "rank")
    for x in branches[1:]:
        every = every.unionByName(x.select(query, item, "rank"))
    fused = every.groupBy(query, item).agg(F.round(F.sum(1.0 / (RRF_K + F.col("rank"))), 8).alias("score"))
    w = Window.partitionBy(query).orderBy(F.desc("score"), item)
    return fused.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def payload_filter(
    *, doc_kinds: list[str] | None = None, geography: list[str] | None = None, start: str | None = None, end: str | None = None, excluded_roles: list[str] | None = None,
    fields: set[str] | None = None,
) -> Column:
    """A predicate from optional arguments. Conditions on fields that the payload lacks are dropped; dates are compared as text
    and a missing date passes; geography matches exactly or as text."""
    has = lambda f: fields is None or f in fields
    cond = F.lit(True)
    if doc_kinds and has("doc_kind"):
        cond &= F.col("doc_kind").isin(doc_kinds)
    if geography and has("geo_country_primary"):
        cond &= F.col("geo_country_primary").isin(geography) | F.lower("geo_country_primary").rlike("|".join(g.lower() for g in geography))
    if start and has("published_at"):
        cond &= F.coalesce(F.col("published_at").cast("string") >= start, F.lit(True))
    if end and has("published_at"):
        cond &= F.coalesce(F.substring(F.col("published_at").cast("string"), 1, 10) <= end, F.lit(True))
    if excluded_roles and has("section_role"):
        cond &= ~F.coalesce(F.col("section_role").isin(excluded_roles), F.lit(False))
    return cond


# What each source adds when hits are ranked by source.
SOURCE_BOOST = {"bigquery": 0.12, "academic": 0.06, "news": 0.04}


def rerank_by_source(hits: DataFrame, source: str, arrival: str) -> DataFrame:
    """Hits by the boost of their source, stable by arrival; scores do not count."""
    boost = F.lit(0.0)
    for name, value in SOURCE_BOOST.items():
        boost = F.when(F.col(source) == name, value).otherwise(boost)
    return hits.withColumn("boost", boost).orderBy(F.desc("boost"), F.col(arrival))


def pack_context(hits: DataFrame, group: str, order: list, text: str, *, each: int = 2_000, total: int = 6_000) -> DataFrame:
    """Texts of each group in order, each cut to ``each`` characters, joined by blank lines, ``total`` characters at most."""
    ranked = F.sort_array(F.collect_list(F.struct(*order, F.substring(text, 1, each).alias("_t"))))
    return hits.groupBy(group).agg(F.substring(F.array_join(F.transform(ranked, lambda h: h["_t"]), "\n\n"), 1, total).alias("context"))
