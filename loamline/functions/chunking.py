"""Texts cut into chunks for retrieval: sentence packing with overlap, word windows, rows of schemas, tables, small slices."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from loamline.functions import keys
from loamline.functions.vocabulary import CHUNK_NAMESPACE


@dataclass(frozen=True)
class Profile:
    """How a corpus is cut. overlap: share of the target that the next chunk repeats."""

    target_tokens: int
    overlap: float
    max_chunks: int | None
    min_tokens: int
    strategy: str


# The profile of each corpus.
PROFILES = {
    "news": Profile(400, 0.15, None, 40, "recursive_semantic"),
    "research": Profile(500, 0.10, 400, 80, "hierarchical_semantic"),
    "ota": Profile(500, 0.10, 100, 40, "lane_semantic"),
    "data_description": Profile(480, 0.05, 3, 80, "bq_structured"),
}
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def tokens(text: str) -> int:
    return max(1, len(text) // 4)


def clean_body(text: Column) -> Column:
    """Line ends as line feeds, runs of blanks as one, at most one blank line, no white space at the ends."""
    t = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    t = F.regexp_replace(F.regexp_replace(t, r"[ \t]+", " "), r"\n{3,}", "\n\n")
    return F.regexp_replace(t, r"^\s+|\s+$", "")


def split_words(text: str, target: int, overlap: int) -> list[str]:
    """Windows of words within the target, each beginning with the last words of the one before."""
    pieces, words, at = [], text.split(), 0
    while at < len(words):
        end, size = at, -1
        while end < len(words) and (size + 1 + len(words[end])) // 4 <= target:
            size += 1 + len(words[end])
            end += 1
        end = max(end, at + 1)
        pieces.append(" ".join(words[at:end]))
        if end == len(words):
            break
        back, size = end, 0
        while back > at + 1 and (size + len(words[back - 1]) + 1) // 4 <= overlap:
            back -= 1
            size += len(words[back]) + 1
        at = back
    return pieces


def pack_sentences(text: str, target: int, overlap: int) -> list[str]:
    """Sentences packed up to the target. The overlap is put before the next sentence after the budget check, so that a chunk
    may pass the target; ``within`` mends that."""
    pieces: list[str] = []
    held: list[str] = []
    size = 0
    for sentence in (s for s in _SENTENCE.split(text.strip()) if s):
        n = tokens(sentence)
        if held and size + n > target:
            joined = " ".join(held)
            pieces.append(joined)
            tail = joined[-overlap * 4 :].split(" ", 1)[-1] if overlap else ""
            held = [tail, sentence] if tail else [sentence]
            size = sum(tokens(h) for h in held)
        else:
            held.append(sentence)
            size += n
    if held:
        pieces.append(" ".join(held))
    return pieces


def within(pieces: list[str], target: int, overlap: int) -> list[str]:
    """Pieces above the target cut by words."""
    return [p for piece in pieces for p in ([piece] if tokens(piece) <= target else split_words(piece, target, overlap))]


def split_prose(text: str, profile: Profile) -> list[str]:
    """Prose by sentences, then by words, at most ``max_chunks``."""
    overlap = int(profile.target_tokens * profile.overlap)
    pieces = within(pack_sentences(text, profile.target_tokens, overlap), profile.target_tokens, overlap)
    return pieces[: profile.max_chunks] if profile.max_chunks else pieces


def split_rows(text: str, target: int) -> list[str]:
    """A schema, never cut within a row; the header is repeated. A first row too long leaves the header as a piece."""
    lines = [x for x in text.split("\n") if x.strip()]
    if not lines:
        return []
    header, pieces, held = lines[0], [], [lines[0]]
    for row in lines[1:]:
        if tokens("\n".join([*held, row])) > target:
            pieces.append("\n".join(held))
            held = [header, row]
        else:
            held.append(row)
    return [*pieces, "\n".join(held)]


def split_table(text: str, profile: Profile) -> list[str]:
    """A table stays whole up to twice the target."""
    return [text] if tokens(text) <= 2 * profile.target_tokens else split_rows(text, profile.target_tokens)


def merge_small(pieces: list[str], least: int, target: int) -> list[str]:
    """Pieces below the least joined to the one before, where both stay within the target."""
    out: list[str] = []
    for piece in pieces:
        if out and (tokens(piece) < least or tokens(out[-1]) < least) and tokens(out[-1] + "\n\n" + piece) <= target:
            out[-1] += "\n\n" + piece
        else:
            out.append(piece)
    return out


_HEADING = re.compile(r"^(?:#{1,6}\s+\S.*|\d+(?:\.\d+)*\.?\s+[A-Z][^.!?]{2,90}|SECTION \d+.*|[A-Z][A-Z0-9 ,&/-]{4,80})$")


def blocks(text: str) -> list[tuple[str, str, str, str]]:
    """``(path, title, text, content type)``: headings open sections, up to four deep; rows of bars are tables."""
    stack: list[tuple[int, str]] = []
    out: list[tuple[str, str, list[str], str]] = []

    def slug(x: str) -> str:
        return re.sub(r"^_+|_+$", "", re.sub(r"[^\w]+", "_", x.lower()))

    for line in text.split("\n"):
        s = line.strip()
        if not s:
            continue
        if _HEADING.match(s):
            mark = re.match(r"^(#{1,6})\s+|^(\d+(?:\.\d+)*)\.?\s+", s)
            depth = min(4, len(mark.group(1)) if mark and mark.group(1) else (mark.group(2).count(".") + 1 if mark else 1))
            title = re.sub(r"^#{1,6}\s+", "", s)
            stack = [x for x in stack if x[0] < depth] + [(depth, title)]
            continue
        kind = "table" if s.count("|") >= 2 else "prose"
        path = "/".join(slug(t) for _, t in stack) or "body"
        path += "/table" if kind == "table" else ""
        title = stack[-1][1] if stack else ""
        if out and out[-1][0] == path and out[-1][3] == kind:
            out[-1][2].append(s)
        else:
            out.append((path, title, [s], kind))
    return [(p, t, "\n".join(x), k) for p, t, x, k in out]


def slices(text: str, profile: Profile) -> list[tuple[str, str, str, str]]:
    """Chunks of a text by its corpus's strategy, with path, title and content type."""
    if profile.strategy in ("recursive_semantic", "lane_semantic"):
        made = [("body", "", p, "prose") for p in split_prose(text, profile)]
    elif profile.strategy == "bq_structured":
        made = [("schema", "", p, "prose") for p in merge_small(split_rows(text, profile.target_tokens), profile.min_tokens, profile.target_tokens)]
    else:
        made = []
        for path, title, body, kind in blocks(text):
            for p in split_table(body, profile) if kind == "table" else split_prose(body, profile):
                made.append((path, title, p, kind))
    return made[: profile.max_chunks] if profile.max_chunks else made


_SLICE = StructType([StructField(n, StringType()) for n in ("path", "title", "text", "content_type")])


def slices_of(text: Column, corpus: str) -> Column:
    """Array of slices; null for null, empty for a blank text or one that begins like a PDF file."""
    profile = PROFILES[corpus]

    @F.pandas_udf(ArrayType(_SLICE))
    def cut(texts: pd.Series) -> pd.Series:
        def one(x: str | None) -> list[dict] | None:
            if x is None:
                return None
            if x.startswith("%PDF-"):
                return []
            return [{"path": p, "title": t, "text": y, "content_type": k} for p, t, y, k in slices(x, profile)]

        return pd.Series([one(x) for x in texts], dtype=object)

    return cut(clean_body(text))


def chunk_documents(documents: DataFrame, document: str, text: str, corpus: str) -> DataFrame:
    """One row per chunk: document, chunk_index, total_chunks, path, title, text, content_type, tokens, content_hash, chunk_id."""
    rows = documents.select(F.col(document).cast("string").alias("document_id"), slices_of(F.col(text), corpus).alias("s")).where(F.size("s") > 0)
    rows = rows.select("document_id", F.size("s").alias("total_chunks"), F.posexplode("s").alias("chunk_index", "c")).select(
        "document_id", "chunk_index", "total_chunks", F.col("c.path").alias("hierarchy_path"), F.col("c.title").alias("section_title"), F.col("c.text").alias("text"), "c.content_type"
    )
    return rows.withColumns({
        "tokens": keys.token_estimate("text").cast(IntegerType()), "content_hash": keys.chunk_content_hash("text"),
        "chunk_id": keys.chunk_id(CHUNK_NAMESPACE, corpus, "document_id", "chunk_index", "text"),
    })


def semantic_split(sentences: list[str], vectors: list[list[float]], target: int, percentile: float = 95.0) -> list[str]:
    """Sentences merged up to the target, parted where neighbours are least alike.

    vectors: one per sentence, from any embedder. A gap parts where the cosine of its neighbours is at most the percentile of
    all gaps (linear interpolation), which at 95 is nearly every gap; the greedy merge then packs parts to the target with
    blank lines between them, separators not counted.
    """
    if len(sentences) < 2:
        return list(sentences)
    unit = np.array(vectors, dtype=float)
    norms = np.linalg.norm(unit, axis=1, keepdims=True)
    unit = unit / np.where(norms == 0, 1, norms)
    alike = (unit[1:] * unit[:-1]).sum(axis=1)
    cut = np.percentile(alike, percentile)
    parts = [[sentences[0]]]
    for sentence, a in zip(sentences[1:], alike):
        if a <= cut:
            parts.append([sentence])
        else:
            parts[-1].append(sentence)
    out: list[str] = []
    size = 0
    for part in (" ".join(p) for p in parts):
        if out and size + tokens(part) <= target:
            out[-1] += "\n\n" + part
            size += tokens(part)
        else:
            out.append(part)
            size = tokens(part)
    return out


LANES = ["overview", "schema", "insights"]


def lane_of(title: Column, text: Column) -> Column:
    """Lane of a part of a table description: schema, insights or overview."""
    t = F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.substring(text, 1, 200)))
    return F.when(t.rlike(r"\b(schema|columns?|data type|fields?)\b"), "schema").when(t.rlike(r"\b(insight|usage|example|question|interpret)"), "insights").otherwise("overview")


def consolidate_lanes(parts: DataFrame, document: str, order: str, lane: str, text: str) -> DataFrame:
    """One row per document and lane, its parts joined in order; lanes in their fixed order."""
    joined = parts.groupBy(document, lane).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, text))), lambda p: p[text]), "\n\n").alias("lane_text"))
    rank = F.array_position(F.array(*[F.lit(x) for x in LANES]), F.col(lane)) - 1
    return joined.withColumn("lane_index", rank.cast("int"))


def explode_lanes(records: DataFrame, record: str, lanes: list[str]) -> DataFrame:
    """Up to one row per lane of a record whose text is not blank, numbered anew."""
    held = F.filter(F.array(*[F.struct(F.lit(x).alias("lane"), F.col(x).alias("text")) for x in lanes]), lambda s: F.trim(F.coalesce(s.text, F.lit(""))) != "")
    return records.select(record, F.posexplode(held).alias("chunk_index", "l")).select(record, "chunk_index", F.col("l.lane").alias("lane"), F.col("l.text").alias("text"))
