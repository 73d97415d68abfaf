"""Oversized texts cut into overlapping pieces at their own seams, by content-defined chunking."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHARS_PER_TOKEN = 4
WINDOW = 32  # characters that the rolling hash sees
_BASE = 0x5DEECE66D | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_ABBREVIATION = re.compile(r"(?:\b(?:Dr|Mr|Mrs|Ms|Prof|St|No|Nos|Fig|Figs|Tab|Eq|vs|cf|approx|ca|pers|comm|al|etc|e\.g|i\.e|p|pp|vol|ed)|\b[A-Z])\.$")
_PARAGRAPH = re.compile(r"\n[ \t\r]*\n\s*")
_LINE = re.compile(r"\r?\n\s*")
_SENTENCE = re.compile(r"[.!?…][\"”’'»)\]]*\s+(?=[^a-z\s])")
_CLAUSE = re.compile(r"[;:,]\s+|\s[–—|]\s+")
_SPACE = re.compile(r"\s+")


def token_count(text: Column) -> Column:
    """Whole part of characters / 4, at least 1; characters are code points. Null for null."""
    return F.greatest(F.floor(F.char_length(text) / CHARS_PER_TOKEN), F.lit(1))


def landmarks(text: str, spacing: int) -> np.ndarray:
    """Positions whose window of WINDOW characters hashes to a landmark, one in about ``spacing``; a matter of content only."""
    code = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    if len(code) < WINDOW:
        return np.zeros(0, dtype=np.int64)
    with np.errstate(over="ignore"):
        n = len(code)
        power = np.cumprod(np.full(n, _INVERSE, dtype=np.uint64))
        back = np.cumprod(np.full(n, _BASE, dtype=np.uint64))
        total = np.cumsum((code + np.uint64(1)) * power)
        window = total[WINDOW - 1 :].copy()
        window[1:] -= total[: n - WINDOW]
        value = window * back[WINDOW - 1 :]  # the polynomial of the window, whatever precedes it
        value ^= value >> np.uint64(31)
        value *= np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    return np.flatnonzero((value >> np.uint64(11)).astype(np.float64) * 2.0**-53 < 1.0 / spacing) + WINDOW


def seams(text: str) -> list[np.ndarray]:
    """Places where a piece may begin, by level: paragraphs, lines, sentences, clauses, words."""
    found = []
    for pattern in (_PARAGRAPH, _LINE, _SENTENCE, _CLAUSE, _SPACE):
        if pattern is _SENTENCE:
            places = [m.end() for m in pattern.finditer(text) if not _ABBREVIATION.search(text[max(0, m.start() - 8) : m.start() + 1])]
        else:
            places = [m.end() for m in pattern.finditer(text)]
        found.append(np.array(places, dtype=np.int64))
    return found


def _nearest(places: np.ndarray, to: int, low: int, high: int) -> int:
    """The place in [low, high] nearest to ``to``, or -1."""
    i = np.searchsorted(places, to)
    best = -1
    for j in (i - 1, i):
        if 0 <= j < len(places) and low <= places[j] <= high and (best < 0 or abs(places[j] - to) < abs(best - to)):
            best = int(places[j])
    return best


def shape(max_tokens: int, overlap_tokens: int, min_tokens: int) -> tuple[int, int, int, int, int, bool]:
    """``(limit, overlap, slack, most, least, possible)`` of a profile, in characters.

    slack: how far the overlap's begin may move to a seam; most, least: new characters of a piece after the first. possible:
    whether every text can be cut so: the overlap leaves room for new text, and two pieces of the least size fit where one is
    too large. Of an impossible profile the nearest possible values are returned.
    """
    limit = max(1, max_tokens) * CHARS_PER_TOKEN + CHARS_PER_TOKEN - 1
    wanted = max(0, overlap_tokens) * CHARS_PER_TOKEN
    overlap = min(wanted, limit - CHARS_PER_TOKEN)
    slack = min(overlap // 2, (limit - overlap) // 4)
    most = max(1, limit - overlap - slack)
    least = max(1, max(0, min_tokens) * CHARS_PER_TOKEN - (overlap - slack))
    return limit, overlap, slack, most, max(1, min(least, most // 2)), overlap == wanted and (least == 1 or 2 * least <= most)


def cut(text: str, max_tokens: int, overlap_tokens: int, min_tokens: int) -> list[tuple[int, int]]:
    """``(start, end)`` of the pieces of a text, ends exclusive, in order and covering it.

    No piece has more than ``max_tokens`` tokens. A cut is a landmark of the rolling hash, moved to the nearest seam of the
    strongest level near it: since landmarks depend on content only, an edit alters the pieces around it and no others.
    Without a landmark in reach the last strong seam before the limit is taken; a text without seams is cut at the limit.
    Every piece after the first begins about ``overlap_tokens`` before the last cut, at a seam if there is one. Pieces have at
    least ``min_tokens``. See ``shape`` for what of a profile is possible.
    """
    limit, overlap, slack, most, least, _ = shape(max_tokens, overlap_tokens, min_tokens)
    n = len(text)
    if n <= limit:
        return [(0, n)]
    usual = max(least, most // 2)
    marks = landmarks(text, max(8, most // 6))
    levels = seams(text)
    pieces, start, at = [], 0, 0
    while True:
        room = limit - (at - start)  # the first piece has no overlap to carry
        if n - at <= room:
            pieces.append((start, n))
            return pieces
        lead = overlap if at == 0 else 0  # the first piece holds what the second repeats
        high = min(at + room, n - least)
        low = min(at + lead + usual, high)
        i = np.searchsorted(marks, low)
        aim = int(marks[i]) if i < len(marks) and marks[i] <= high else high
        end = -1
        for level, places in enumerate(levels):
            reach = most // (4 + 2 * level)
            end = _nearest(places, aim, max(min(at + lead + least, high), aim - reach), min(high, aim + reach))
            if end > at:
                break
        if end <= at:
            end = _nearest(levels[-1], aim, min(at + lead + 1, high), high)
        if end <= at:
            end = max(at + 1, high)
        pieces.append((start, end))
        want = end - overlap
        begin = want if overlap else end
        if overlap:
            for places in (levels[2], levels[4]):
                seam = _nearest(places, want, max(start + 1, want - slack), min(end - 1, want + slack))
                if seam > 0:
                    begin = seam
                    break
            begin = max(begin, start + 1)
        start, at = begin, end


def _piece_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, starts, ends, numbers, counts, over, pieces = [], [], [], [], [], [], []
        texts, limits, overlaps, least = (batch.column(i).to_pylist() for i in range(4))
        for i, text in enumerate(texts):
            made = cut(text, limits[i], overlaps[i] or 0, least[i] or 0)
            for k, (a, b) in enumerate(made):
                rows.append(i)
                numbers.append(k)
                counts.append(len(made))
                starts.append(a)
                ends.append(b)
                over.append(made[k - 1][1] - a if k else 0)
                pieces.append(text[a:b])
        kept = [batch.column(i).take(pa.array(rows, pa.int64())) for i in range(4, batch.num_columns)]
        yield pa.record_batch(
            [
                *kept, pa.array(numbers, pa.int32()), pa.array(counts, pa.int32()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()),
                pa.array(over, pa.int64()), pa.array(pieces, pa.string()),
            ],
            names=[*batch.schema.names[4:], "piece_no", "n_pieces", "start_char", "end_char", "overlap_chars", "piece"],
        )


MAX_PROFILES = 10_000  # more profiles than this are joined by shuffle instead of broadcast


def split_oversized(texts: DataFrame, text: str, kind: str, profiles: DataFrame, keep: list[str]) -> DataFrame:
    """Pieces of every text: ``keep`` and ``piece_no, n_pieces, start_char, end_char, overlap_chars, piece``.

    profiles: ``(doc_kind, max_tokens, overlap_tokens, min_tokens)``, the limits of each ``kind``. A text within its limit, or
    of a kind without a profile, is one piece, as it is. ``piece[overlap_chars:]`` of the pieces in order is the text.

    A profile that no text can meet (see ``shape``) is an error. Null texts give no rows; an empty text is one empty piece; very long texts are cut whole. Repeated rows are cut
    repeatedly; ``keep`` names what tells them apart. Other columns do not matter, whatever their names. Narrow: profiles are
    of bounded size and broadcast, only oversized texts leave the JVM.
    """
    limits = profiles.where(F.col("doc_kind").isNotNull()).groupBy(F.col("doc_kind").alias("_kind")).agg(
        F.min("max_tokens").cast("int").alias("_max"), F.min("overlap_tokens").cast("int").alias("_over"), F.min("min_tokens").cast("int").alias("_min")
    )
    held = limits.limit(MAX_PROFILES + 1).collect()  # a small table: checked here, and the broadcast's bound is proven by it
    for row in held:
        if row["_max"] is not None and not shape(row["_max"], row["_over"] or 0, row["_min"] or 0)[-1]:
            raise ValueError(f"no text can be cut by the profile {row['_kind']}: {row['_max']} tokens at most, {row['_min']} at least, {row['_over']} repeated")
    if len(held) <= MAX_PROFILES:
        limits = F.broadcast(limits)
    rows = texts.select(F.col(text).alias("_text"), F.col(kind).alias("_kind"), *[F.col(c) for c in keep]).where(F.col("_text").isNotNull()).join(limits, "_kind", "left")
    large = F.coalesce(token_count(F.col("_text")) > F.col("_max"), F.lit(False))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.select(*keep).schema)
    schema = f"{kept}, piece_no int, n_pieces int, start_char bigint, end_char bigint, overlap_chars bigint, piece string"
    cut_up = rows.where(large).select("_text", "_max", "_over", "_min", *keep).mapInArrow(_piece_batches, schema)
    whole = rows.where(~large).select(
        *keep, F.lit(0).alias("piece_no"), F.lit(1).alias("n_pieces"), F.lit(0).cast("long").alias("start_char"),
        F.char_length("_text").cast("long").alias("end_char"), F.lit(0).cast("long").alias("overlap_chars"), F.col("_text").alias("piece"),
    )
    return cut_up.unionByName(whole)
