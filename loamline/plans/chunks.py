"""Chunking queries, one per corpus strategy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.catalog import Sources
from loamline.functions.chunking import chunk_documents


def _of(kind: str, corpus: str):  # noqa: ANN202
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        c = Sources(spark, sf_dir).table("pdf_chunks").where((F.col("metadata.doc_kind") == kind) & F.col("id").isNotNull())
        return chunk_documents(c, "id", "text", corpus).select("document_id", "chunk_index", "total_chunks", "hierarchy_path", "content_type", "tokens", "content_hash", "chunk_id")

    return run


def chunk_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table descriptions, never cut within a row."""
    d = Sources(spark, sf_dir).table("documents").where("source = 'table_descriptions'")
    return chunk_documents(d, "doc_id", "text", "data_description").select("document_id", "chunk_index", "total_chunks", "tokens", "chunk_id")


def queries() -> dict:
    return {"chunk_news": _of("news", "news"), "chunk_research": _of("research_paper", "research"), "chunk_ota": _of("ota_insight", "ota"), "chunk_schema": chunk_schema}
