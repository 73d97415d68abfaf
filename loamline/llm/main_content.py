"""The main body of a web page, without what the site puts around and between it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from loamline.llm.page_cues import ends_sentence, is_furniture, is_heading_like, is_sentence, is_teaser
from loamline.llm.residue import judge

SIGMA, HALF_WIDTH = 1.0, 3  # of the Gaussian that smooths the ratio over neighbouring lines, and how many it sees on either side
OWN_SHARE = 0.7  # weight of a line's own ratio beside the smoothed one: a link within an article stays a link
# Plain text has lost its tags; a line is given those that it had on the page: a separator stands between two elements, a
# line that ends no sentence is a list entry with a link or a heading, furniture is a box with buttons or links.
SEPARATOR_TAGS, LINK_TAGS, FURNITURE_TAGS = 2, 4, 8
# Characters to a tag: fewer than the first are never content, more than the second always are, wherever the page's two clusters meet.
SPARSE, DENSE = 20, 50
TIE = 0.2  # distance of the score from the cut (in logarithms) under which the wording decides
TITLE_ALIKE = 0.6  # share of words that a line and the page's title have in common, for the line to be the headline
_KERNEL = np.exp(-0.5 * (np.arange(-HALF_WIDTH, HALF_WIDTH + 1) / SIGMA) ** 2)
_KERNEL /= _KERNEL.sum()
_MARKUP = re.compile(r"<\s*/?\s*[a-zA-Z][^<>]*>|&[a-zA-Z]{2,8};|&#\d+;")
_RAW = frozenset(["script", "style", "noscript", "template"])
_PROSE = frozenset(["p", "br", "b", "i", "em", "strong"])  # tags that running text has of its own
HEADING_WORDS = 8  # subheadings and fragments have no more words
PARAGRAPH_WORDS = 25  # headings have fewer words: a line of so many is text without any mark at its end
WRAPPED_LINES, WRAPPED_SHARE = 3, 0.8  # lines without an end that fill the width, for a block to be hard-wrapped; their share. Half of them go on in a small letter
_POINTER = re.compile(r"^\W*[▶►▸➤➜→»›]")  # leads to another story
_BULLET = re.compile(r"^(?:[•‣◦▪●*–—-]|\(?\w{1,2}[.)])\s+\S")
_INNER_END = re.compile(r"[^\W\d_]{3,}[.!?…][\"”’'»)\]]*\s+[\"“‘'«(\[]*[^\W\d_a-z]")
_SEPARATOR = re.compile(r"[|·•»›☰©]|\s[/>]\s|\s{2,}\S")


class _Lines(HTMLParser):
    """Text and tag count of each line of a page, from a stream of parser events; nothing of the tree is kept. Tags of
    running text do not count."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.text: list[list[str]] = [[]]
        self.tags = [0]
        self.raw = 0

    def handle_starttag(self, tag, attrs) -> None:  # noqa: ANN001
        self.tags[-1] += tag not in _PROSE
        self.raw += tag in _RAW

    def handle_endtag(self, tag) -> None:  # noqa: ANN001
        self.tags[-1] += tag not in _PROSE
        self.raw = max(0, self.raw - (tag in _RAW))

    def handle_data(self, data: str) -> None:
        first, *rest = data.split("\n")
        if not self.raw:
            self.text[-1].append(first)
        for x in rest:
            self.text.append([] if self.raw else [x])
            self.tags.append(0)


def page_lines(text: str) -> tuple[list[str], list[int] | None]:
    """Visible text and tags of each line; lines end at a line feed, blank ones count. No tags for plain text."""
    if _MARKUP.search(text):
        parser = _Lines()
        parser.feed(text)
        parser.close()
        lines, tags = ["".join(x) for x in parser.text], parser.tags
        wanted = text.count("\n") + 1  # a tag may hold line feeds of its own
        if len(lines) == wanted:
            return lines, tags
    return text.split("\n"), None


def separators(line: str) -> int:
    """Separators between the elements of a line, a bullet at its begin aside."""
    return len(_SEPARATOR.findall(line[2:] if _BULLET.match(line) else line))


def density(chars: np.ndarray, tags: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Score of each line, score of the lines on its denser side, and the cut above which a line is content.

    The text-to-tag ratio of each line (its logarithm) is smoothed by a Gaussian; beyond the page's ends there is no text. The
    score is the ratio and its smoothed value in fixed shares; the cut is where two-means clustering parts the page's scores.
    A side's score is the smoothed ratio of the lines before, or of those after, by the same weights.
    """
    ratio = np.log1p(chars / (tags + 1.0))
    none = np.zeros(HALF_WIDTH)
    padded = np.concatenate([none, ratio, none])
    smooth = np.convolve(padded, _KERNEL, mode="valid")
    side = _KERNEL[:HALF_WIDTH] / _KERNEL[:HALF_WIDTH].sum()
    before, after = np.correlate(padded, side, mode="valid")[: len(ratio)], np.correlate(padded, side[::-1], mode="valid")[-len(ratio) :]
    score = OWN_SHARE * ratio + (1 - OWN_SHARE) * smooth
    low, high = score.min(), score.max()
    for _ in range(20):
        cut = (low + high) / 2
        below, above = score[score < cut], score[score >= cut]
        if not len(below) or not len(above) or (below.mean() == low and above.mean() == high):
            break
        low, high = below.mean(), above.mean()
    sparse, dense = np.log1p(SPARSE), np.log1p(DENSE)  # where even the lower cluster is no furniture, nothing is parted
    return score, np.maximum(before, after), float(sparse if low >= sparse else np.clip((low + high) / 2, sparse, dense))


def _bag(text: str) -> frozenset[str]:
    return frozenset(w.lower() for w in re.findall(r"[^\W_]+", text))


def _paragraphs(kept: list[str], at: list[int], free: list[bool]) -> list[list[int]]:
    """Lines that are one paragraph: each goes on in the next one, by a small letter or since the text is wrapped at its width."""
    n = len(kept)
    open_ = [i + 1 < n and free[i] and free[i + 1] and at[i + 1] == at[i] + 1 and not ends_sentence(kept[i]) for i in range(n)]
    if not any(open_):
        return []
    # a subheading is much shorter than the text under it
    small = [open_[i] and 2 * len(kept[i]) >= len(kept[i + 1]) and (kept[i + 1][0].islower() or kept[i].endswith((",", "-"))) for i in range(n)]
    goes_on = small[:]
    start = 0
    while start < n:  # blocks without blank lines, furniture or teasers
        end = start
        while end + 1 < n and free[end] and free[end + 1] and at[end + 1] == at[end] + 1:
            end += 1
        unended = [i for i in range(start, end) if open_[i]]
        if len(unended) >= WRAPPED_LINES:
            width = max(len(kept[i]) for i in range(start, end + 1))
            full = [i for i in unended if len(kept[i]) + 1 + len(kept[i + 1].split(None, 1)[0]) > width]
            if len(full) >= max(WRAPPED_LINES, WRAPPED_SHARE * len(unended)) and 2 * sum(small[i] for i in full) >= len(full):
                for i in full:
                    goes_on[i] = True
        start = end + 1
    out, i = [], 0
    while i < n:
        end = i
        while goes_on[end]:
            end += 1
        if end > i:
            out.append(list(range(i, end + 1)))
        i = end + 1
    return out


def _long_text(kept: list[str], i: int, furniture: list[bool], teaser: list[bool], within: bool) -> bool:
    """Whether a long line without an end, in a dense region, is text rather than the heading of another story."""
    if _POINTER.match(kept[i]):
        return False
    if len(kept[i].split()) >= PARAGRAPH_WORDS or _INNER_END.search(kept[i]):
        return True
    k = i - 1
    while k >= 0 and not furniture[k] and not teaser[k] and not ends_sentence(kept[k]) and not is_sentence(kept[k]):
        k -= 1  # the line that the list of such lines stands under
    if k < 0 or furniture[k] or teaser[k]:
        return False
    return within or (kept[k].endswith(":") and all(_BULLET.match(x) for x in kept[k + 1 : i + 1]))


def main_lines(text: str, title: str | None = None) -> list[tuple[int, bool]]:
    """``(line number, whether it is headline or article)`` of every line that is not blank; lines count from 1."""
    lines, tags = page_lines(text)
    at = [i for i, x in enumerate(lines) if x.strip()]
    kept = [lines[i].strip() for i in at]
    if not kept:
        return []
    furniture = [is_furniture(x) for x in kept]
    teaser = [is_teaser(x) for x in kept]
    sentence = [not f and not t and is_sentence(x) for x, f, t in zip(kept, furniture, teaser)]
    free = [not f and not t and not _POINTER.match(x) for x, f, t in zip(kept, furniture, teaser)]
    chars = np.array([len(x) for x in kept], dtype=float)
    wrapped = _paragraphs(kept, at, free)
    for lines_of in wrapped:
        whole = " ".join(kept[i] for i in lines_of)
        if is_sentence(whole) or len(whole.split()) >= PARAGRAPH_WORDS:
            chars[lines_of] = len(whole)  # a paragraph is as dense in each of its lines
            for i in lines_of:
                sentence[i] = True
    if tags is not None:
        count = np.array([tags[i] for i in at], dtype=float)
    else:
        listed = [False] * len(kept)  # entries under a line with a colon are text
        for i in range(1, len(kept)):
            listed[i] = bool(_BULLET.match(kept[i])) and (listed[i - 1] or (kept[i - 1].endswith(":") and not furniture[i - 1]))
        count = np.array([SEPARATOR_TAGS * separators(x) + LINK_TAGS * (not s and not e and not is_sentence(x)) for x, s, e in zip(kept, sentence, listed)], dtype=float)
    count += FURNITURE_TAGS * np.array([f or t for f, t in zip(furniture, teaser)])
    score, around, cut = density(chars, count)
    body = [i for i, s in enumerate(sentence) if s]
    first, last = (body[0], body[-1]) if body else (len(kept), -1)
    heading = [not s and not f and not t and is_heading_like(x) for x, s, f, t in zip(kept, sentence, furniture, teaser)]
    headline = -1
    wanted = (title or "").strip()
    if wanted in kept:
        headline = kept.index(wanted)
    elif wanted:
        bag, alike = _bag(wanted), {}
        for i, x in enumerate(kept):
            if not furniture[i] and len(x) <= 3 * len(wanted) + 20:
                alike[i] = len(bag & (b := _bag(x))) / max(1, len(bag | b))
        best = max(alike, key=alike.get, default=-1)
        if best >= 0 and alike[best] >= TITLE_ALIKE:
            headline = best
    if headline < 0:  # no title, or none that is on the page: the last heading before the text
        before = [i for i in range(min(first, len(kept))) if heading[i]]
        headline = before[-1] if before and body else -1
    out = []
    for i, n in enumerate(at):
        if i == headline:
            good = True
        elif sentence[i] or furniture[i] or teaser[i]:
            good = sentence[i] if abs(score[i] - cut) < TIE else bool(score[i] >= cut)
        else:  # subheadings and fragments have hardly any text of their own: the lines around them are asked
            within = first < i < last
            if around[i] < cut:
                good = False
            elif len(kept[i].split()) <= HEADING_WORDS and not (i and kept[i - 1].endswith(":") and _BULLET.match(kept[i])):
                good = within
            else:
                good = _long_text(kept, i, furniture, teaser, within)
        out.append((n + 1, good))
    return out


def _judge_batches(without_residue: bool):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers, flags = [], [], []
            for key, text, title in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if text is None or (without_residue and judge(text).reason):
                    continue
                for n, good in main_lines(text, title):
                    ids.append(key)
                    numbers.append(n)
                    flags.append(good)
            yield pa.record_batch([pa.array(ids, pa.string()), pa.array(numbers, pa.int64()), pa.array(flags, pa.bool_())], names=["_id", "line_no", "is_main"])

    return run


def main_content_lines(pages: DataFrame, page_id: str, text: str, title: str, *, without_residue: bool = False) -> DataFrame:
    """``(page_id, line_no, is_main)`` for each line that is not blank.

    Density decides: the text-to-tag ratio per line, Gaussian-smoothed and split by two-means clustering (see ``density``).
    Tags come from the parser's events where there is markup; a line of plain text counts those it had on the page:
    separators, links (lines that end no sentence), boxes (wording of page furniture). Lines without the end of a sentence are
    judged by the density around them: subheadings within the text stay, longer ones unless they point to another story or
    stand in a list under furniture or outside the text. Wording decides alone only where the score is within TIE of the cut.
    The headline (most like ``title``; without one, the last heading before the text) stays. Lines of one paragraph are judged
    together.

    without_residue: pages in whose text residue stands in place of content give no rows; they are judged in the same pass.
    Null texts give no rows, null titles are no hindrance, a null id stays null; very long texts are read whole, line by line.
    Repeated rows come out repeatedly; an empty table gives none. Narrow: no shuffle, every page on its own.
    """
    picked = pages.select(F.col(page_id).cast("string").alias("_id"), F.col(text).alias("_text"), F.col(title).alias("_title")).where(F.col("_text").isNotNull())
    return picked.mapInArrow(_judge_batches(without_residue), "_id string, line_no long, is_main boolean").withColumnRenamed("_id", page_id)


@F.pandas_udf(StringType())
def _main_text(text: pd.Series, title: pd.Series) -> pd.Series:
    def body(x: str | None, t: str | None) -> str | None:
        if x is None:
            return None
        lines = page_lines(x)[0]
        return "\n".join(lines[n - 1].strip() for n, good in main_lines(x, t) if good)

    return pd.Series([body(x, t) for x, t in zip(text, title)], dtype=object)


def main_content_text(pages: DataFrame, text: str, title: str, out: str = "main_text") -> DataFrame:
    """``pages`` with the main content of each page as one text, lines joined by line feeds; null for null, empty where none."""
    return pages.withColumn(out, _main_text(F.col(text), F.col(title)))
