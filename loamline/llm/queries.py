"""The queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from loamline.catalog import Sources
from loamline.functions.urls import normalise_url
from loamline.llm.leakage import leaked_items
from loamline.llm.main_content import main_content_lines, main_content_text
from loamline.llm.mixing import mix_sources, tokens_of
from loamline.llm.near_duplicates import near_duplicate_groups, words_of
from loamline.llm.residue import drop_residue, residue_of
from loamline.llm.splitting import split_oversized, token_count
from loamline.llm.subjects import subject_shares

TITLE_ALIKE = 0.6


def _same_story(spark: SparkSession, sf_dir: str, *, alone: bool) -> DataFrame:
    items = Sources(spark, sf_dir).table("rss_items")
    return near_duplicate_groups(
        items, "item_id", words_of("title"), threshold=TITLE_ALIKE, same_key=normalise_url("url", same_scheme=True), alone=alone
    )


def p2_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feed item with its group: the items that carry the same story or page, or the item alone."""
    return _same_story(spark, sf_dir, alone=True)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs within a group."""
    groups = _same_story(spark, sf_dir, alone=False)
    a = groups.select("grp", F.col("item_id").alias("item_id_a"))
    b = groups.select("grp", F.col("item_id").alias("item_id_b"))
    return a.join(b, "grp").where("item_id_a < item_id_b").select("item_id_a", "item_id_b")


def _chunks(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    chunks = Sources(spark, sf_dir).table("pdf_chunks").select("id", "text", F.col("metadata.doc_kind").alias("doc_kind"), F.col("metadata.title").alias("title"))
    return chunks.where(F.col("doc_kind").isin(*kinds)) if kinds else chunks


def p3_residue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every chunk with the reason, if any, to leave it out."""
    return residue_of(_chunks(spark, sf_dir), "id", "text")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks in which residue stands in place of content."""
    return p3_residue(spark, sf_dir).where((F.col("reason") != "") & F.col("id").isNotNull()).select("id").distinct()


def p3_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collection without residue."""
    return drop_residue(_chunks(spark, sf_dir), "text")


def p7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every web page that holds content, and whether it is headline or article."""
    return main_content_lines(_chunks(spark, sf_dir, "news").where(F.col("id").isNotNull()), "id", "text", "title", without_residue=True)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are not headline or article."""
    return p7_lines(spark, sf_dir).where(~F.col("is_main")).select("id", "line_no").distinct()


def p7_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's main content as one text."""
    pages = drop_residue(_chunks(spark, sf_dir, "news"), "text")
    return main_content_text(pages, "text", "title")


def p1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every chunk in pieces within the limit of its kind."""
    at = Sources(spark, sf_dir)
    chunks = at.table("pdf_chunks").select("id", "text", F.col("metadata.doc_kind").alias("doc_kind"), F.col("metadata.ingest_version").alias("ingest_version"))
    return split_oversized(chunks, "text", "doc_kind", at.table("chunk_profiles"), ["id", "ingest_version", "doc_kind"])


def p1_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the pieces of every chunk add up to: its characters, repeated ones aside, and whether all are within the limit."""
    limits = Sources(spark, sf_dir).table("chunk_profiles").select("doc_kind", "max_tokens")
    pieces = p1_pieces(spark, sf_dir).join(F.broadcast(limits), "doc_kind", "left")
    within = F.coalesce(token_count(F.col("piece")) <= F.col("max_tokens"), F.lit(True))
    return pieces.groupBy("id", "ingest_version", "doc_kind").agg(F.sum(F.char_length("piece") - F.col("overlap_chars")).alias("chars"), F.every(within).alias("within"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks that had to be cut."""
    return p1_pieces(spark, sf_dir).where((F.col("n_pieces") > 1) & F.col("id").isNotNull()).select("id").distinct()


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of held-out items, in order or reordered, with the share of the item that they cover."""
    at = Sources(spark, sf_dir)
    return leaked_items(at.table("documents"), "doc_id", "text", at.table("eval_items"), "item_id", "text")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold at least 12 successive words of an item."""
    return p8_leaks(spark, sf_dir).where(F.col("longest") >= 12).select("doc_id", "item_id").distinct()


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document is used so that sources reach their target shares."""
    at = Sources(spark, sf_dir)
    return mix_sources(at.table("documents"), "doc_id", "source", tokens_of(F.col("text")), at.table("mix_targets"))[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares wanted and reached, per source."""
    at = Sources(spark, sf_dir)
    return mix_sources(at.table("documents"), "doc_id", "source", tokens_of(F.col("text")), at.table("mix_targets"))[1]


MAX_SUBJECTS, MAX_HELD_OUT = 1_000, 100_000  # bounds of the tables that are read to the driver


def _bounded(table: DataFrame, most: int) -> list[Row]:
    """All rows of a small table; an error, not a part of them, if there are more than ``most``."""
    rows = table.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows of {', '.join(table.columns)}")
    return rows


def p10_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each subject in each document's sentences."""
    at = Sources(spark, sf_dir)
    subjects = [r["subject"] for r in _bounded(at.table("subject_areas").select("subject").distinct().orderBy("subject"), MAX_SUBJECTS)]
    held_out = [(r["item_id"], r["text"]) for r in _bounded(at.table("eval_items").where("item_id is not null and text is not null").select("item_id", "text"), MAX_HELD_OUT)]
    return subject_shares(
        at.table("documents"), "doc_id", "text", subjects, at.table("document_labels"), held_out, address="publisher", source="source"
    )


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects with which at least a quarter of a document's sentences deal."""
    return p10_shares(spark, sf_dir).where(F.col("share") >= 0.25).select("doc_id", "subject")


def p10_make_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Make-up of the corpus by subject: documents and sentences."""
    return p10_shares(spark, sf_dir).groupBy("subject").agg(
        F.count_if(F.col("share") >= 0.25).alias("documents"), F.sum("sentences").alias("sentences")
    )
