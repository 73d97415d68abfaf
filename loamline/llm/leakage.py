"""Passages of held-out items inside a corpus, by greedy string tiling with running Karp-Rabin hashes."""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.session import cut_lineage

_WORD = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
MAX_BLOCK_ITEMS = 2_000  # items that one pass holds against the corpus; a larger item table is taken in blocks
MAX_BLOCK_CHARS = 20_000_000


def words(text: str) -> list[str]:
    """Runs of letters or digits in lower case; everything else only separates."""
    return _WORD.findall(text.lower())


@dataclass(frozen=True)
class Tiling:
    """longest: words of the longest tile; tiles: their number; covered: share of the item's words that tiles cover."""

    longest: int
    tiles: int
    covered: float


class Items:
    """Words of the items as numbers, and where each run of ``seed`` words stands. Items are told apart by their place in the
    list: an id may stand there with several texts."""

    def __init__(self, items: list[tuple[int, str]], seed: int) -> None:
        self.seed, self.number = seed, {}
        self.ids, self.tokens = [i for i, _ in items], []
        self.runs: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for row, (_, text) in enumerate(items):
            numbers = np.array([self.number.setdefault(w, len(self.number) + 1) for w in words(text)], dtype=np.int64)
            self.tokens.append(numbers)
            for at, value in enumerate(rolling(numbers, seed).tolist()):
                self.runs[value].append((row, at))
        self.known = np.array(sorted(self.runs), dtype=np.uint64)


def rolling(numbers: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of every run of ``size`` numbers."""
    if len(numbers) < size:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        mixed = numbers.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
        mixed ^= mixed >> np.uint64(32)
        value = np.zeros(len(numbers) - size + 1, dtype=np.uint64)
        for k in range(size):
            value = value * _BASE + mixed[k : len(numbers) - size + 1 + k]
    return value


def matches(starts: list[tuple[int, int]], seed: int) -> list[tuple[int, int, int]]:
    """``(place in the text, place in the item, length)`` of the longest matches that seeds add up to: one for each unbroken row
    of seeds on a diagonal."""
    at = np.array(sorted(set(starts), key=lambda s: (s[0] - s[1], s[0])), dtype=np.int64)
    first = np.flatnonzero(np.r_[True, (np.diff(at[:, 0]) != 1) | (np.diff(at[:, 1]) != 1)])
    last = np.r_[first[1:], len(at)] - 1
    return [(int(a), int(b), int(n)) for (a, b), n in zip(at[first], at[last, 0] - at[first, 0] + seed)]


def _free(a: int, b: int, length: int, text: np.ndarray, item: np.ndarray, free_text: np.ndarray, free_item: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """Parts of a match, of at least ``shortest`` words, that are equal word by word and marked on neither side."""
    good = free_text[a : a + length] & free_item[b : b + length] & (text[a : a + length] == item[b : b + length])
    edges = np.flatnonzero(np.diff(np.r_[False, good, False].astype(np.int8)))
    return [(a + int(x), b + int(x), int(y - x)) for x, y in zip(edges[::2], edges[1::2]) if y - x >= shortest]


def tile(text: np.ndarray, item: np.ndarray, starts: list[tuple[int, int]], shortest: int) -> Tiling:
    """Greedy string tiling from seeds ``(place in the text, place in the item)``, each of ``shortest`` words.

    Again and again the longest match of words that are not yet marked, on either side, becomes a tile; matches shorter than
    ``shortest`` do not count. Reordered passages are so found piece by piece. Seeds in a row are one match from the start, and
    a match that a tile cuts goes back in pieces, so that the work grows with the matches, not with their lengths.
    """
    free_text, free_item = np.ones(len(text), dtype=bool), np.ones(len(item), dtype=bool)
    longest = tiles = covered = 0
    found = [part for a, b, n in (matches(starts, shortest) if starts else []) for part in _free(a, b, n, text, item, free_text, free_item, shortest)]
    waiting = [(-n, a, b) for a, b, n in found]
    heapq.heapify(waiting)
    while waiting:
        n, a, b = heapq.heappop(waiting)
        parts = _free(a, b, -n, text, item, free_text, free_item, shortest)
        if parts != [(a, b, -n)]:
            for x, y, k in parts:
                heapq.heappush(waiting, (-k, x, y))
            continue
        free_text[a : a - n] = free_item[b : b - n] = False
        longest, tiles, covered = max(longest, -n), tiles + 1, covered - n
    return Tiling(longest, tiles, covered / len(item) if len(item) else 0.0)


def leaks(text: str, items: Items) -> list[tuple[int, Tiling]]:
    """Ids of the items of which the text holds at least one run of ``items.seed`` words, with their tilings."""
    number = items.number
    numbers = np.array([number.get(w, 0) for w in words(text)], dtype=np.int64)
    if len(numbers) < items.seed or not len(items.known):
        return []
    # a seed holds known words only: look for runs of them before hashing
    known = np.concatenate([[0], np.cumsum(numbers > 0)])
    if not (known[items.seed :] - known[: -items.seed] == items.seed).any():
        return []
    values = rolling(numbers, items.seed)
    at = np.flatnonzero(np.isin(values, items.known))
    seeds: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for place in at.tolist():
        for row, there in items.runs[int(values[place])]:
            seeds[row].append((place, there))
    return [(items.ids[row], tile(numbers, items.tokens[row], starts, items.seed)) for row, starts in seeds.items()]


def _leak_batches(items: list[tuple[int, str]], seed: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Items(items, seed)
        for batch in batches:
            doc, item, longest, tiles, covered = [], [], [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for i, t in leaks(text, index):
                    if t.tiles:
                        doc.append(key)
                        item.append(i)
                        longest.append(t.longest)
                        tiles.append(t.tiles)
                        covered.append(t.covered)
            yield pa.record_batch(
                [pa.array(doc, pa.int64()), pa.array(item, pa.int64()), pa.array(longest, pa.int32()), pa.array(tiles, pa.int32()), pa.array(covered, pa.float64())],
                names=["_doc", "_item", "longest", "tiles", "covered"],
            )

    return run


def leaked_items(
    documents: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, *, min_run: int = 12, seed: int = 6, min_covered: float = 0.5
) -> DataFrame:
    """``(doc_id, item_id, longest, tiles, covered)`` for every document that holds a passage of an item.

    A document leaks an item if a run of ``min_run`` successive words of the item stands in it in order, or if tiles of at
    least ``seed`` words cover ``min_covered`` of the item, in whatever order. Texts are compared whole, word by word, case
    and separators aside.

    Null texts and ids on either side give no rows; items of fewer than ``seed`` words cannot leak. Repeated documents each
    come out; an item id with several texts gives a row for each text that leaks, the same text under one id counts once.
    Empty tables give no rows. Other columns are ignored, whatever their names.

    Plan: the items are the query set. They are taken in blocks of about MAX_BLOCK_ITEMS items and MAX_BLOCK_CHARS characters,
    each block sent to the tasks and held against all documents in one narrow pass: neither side is shuffled. One block is on
    the driver at a time: where there are several, each one's result is written before the next is read.
    """
    asked = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).where(F.col("i").isNotNull() & F.col("t").isNotNull()).distinct()
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("t")).alias("c"), F.max(F.char_length("t")).alias("m")).first()
    n_blocks = max(1, -(-size["n"] // MAX_BLOCK_ITEMS), -(-(size["c"] or 0) // MAX_BLOCK_CHARS))
    if n_blocks > 1:
        n_blocks *= 2  # hashing does not fill blocks evenly
    rows = documents.select(F.col(doc_id).cast("long").alias("_doc"), F.col(text).alias("_text")).where(F.col("_doc").isNotNull() & F.col("_text").isNotNull())
    out = None
    for block in range(n_blocks):
        part = asked if n_blocks == 1 else asked.where(F.pmod(F.xxhash64("i", "t"), F.lit(n_blocks)) == block)
        known = [(r["i"], r["t"]) for r in part.collect()]
        found = rows.mapInArrow(_leak_batches(known, seed), "_doc long, _item long, longest int, tiles int, covered double")
        hit = found.where((F.col("longest") >= min_run) | (F.col("covered") >= min_covered))
        hit = hit if n_blocks == 1 else cut_lineage(hit)
        out = hit if out is None else out.union(hit)
    return out.withColumnsRenamed({"_doc": doc_id, "_item": item_id})
