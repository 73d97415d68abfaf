"""Chunk queries have no SQL: what every chunking must keep, on whole tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loamline.catalog import Sources
from loamline.functions.chunking import PROFILES, chunk_documents, clean_body
from loamline.plans import chunks


@pytest.mark.parametrize(("kind", "corpus"), [("news", "news"), ("research_paper", "research"), ("ota_insight", "ota")])
def test_chunks_are_numbered_bounded_and_lose_no_word(spark, data, kind, corpus):
    c = Sources(spark, data).table("pdf_chunks").where((F.col("metadata.doc_kind") == kind) & F.col("id").isNotNull() & F.col("text").isNotNull())
    c = c.withColumn("key", F.concat_ws("/", "id", "metadata.ingest_version", F.monotonically_increasing_id().cast("string"))).cache()
    rows = chunk_documents(c, "key", "text", corpus).collect()
    texts = {r["key"]: r["t"] for r in c.select("key", clean_body(F.col("text")).alias("t")).collect()}
    held: dict[str, list] = {}
    for r in rows:
        held.setdefault(r["document_id"], []).append(r)
    assert rows and set(held) == {k for k, t in texts.items() if t}
    most = PROFILES[corpus].max_chunks
    for key, parts in held.items():
        parts.sort(key=lambda r: r["chunk_index"])
        assert [r["chunk_index"] for r in parts] == list(range(len(parts))) and all(r["total_chunks"] == len(parts) for r in parts)
        assert most is None or len(parts) <= most
        assert all(r["tokens"] == max(1, len(r["text"]) // 4) for r in parts)
        if most is None or len(parts) < most:
            words = {w for r in parts for w in r["text"].split()} | {w for r in parts for w in (r["section_title"] or "").split()}
            missing = [w for w in texts[key].split() if w not in words and not w.startswith("#")]
            assert len(missing) <= 0.2 * len(texts[key].split()) if corpus == "research" else not missing  # headings become paths
    assert len({r["chunk_id"] for r in rows}) == len(rows)


def test_registered_chunk_queries_give_the_same_chunks(spark, data):
    got = chunks.queries()["chunk_news"](spark, data)
    c = Sources(spark, data).table("pdf_chunks").where("metadata.doc_kind = 'news' and id is not null")
    want = chunk_documents(c, "id", "text", "news").select(*got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and not got.isEmpty()
