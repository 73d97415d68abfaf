"""Template residue, filler and error pages where content should be."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from loamline.llm.page_cues import ends_sentence, is_furniture, is_teaser

# ---------------------------------------------------------------- unfilled fields: one grammar for each delimiter
# A field name: words of letters, digits and underscores; no sentence, no list of values.
_NAME = r"[^\W\d_][\w.\-]*(?:[ _][\w.\-]+){0,4}"
_UPPER = r"[A-Z][A-Z0-9_]{1,40}"
# What a bracketed instruction begins with, in the languages of the collection.
_ASK = (
    r"(?:insert|enter|add|your|fill in|fill|put|type|select|choose|to be|tbc|tbd|name of|date of|compléter|à compléter|à remplir|insérer|"
    r"votre|inserir|inserir|preencher|a preencher|por preencher|adicionar|seu|sua|weka|jaza|ingiza|andika)"
)
_SUPPLY = r"(?:to be (?:supplied|completed|added|confirmed|written|inserted|filled(?: in)?|determined)|goes here|here)"
_PLACEHOLDERS = {
    "double brace": r"\{\{\{?\s*[#/^>&!]?\s*[\w.\- ]{1,60}(?:\|[^{}\n]{0,40})?\s*\}\}\}?",
    "single brace": r"(?<![\w{$])\{\s*[A-Za-z_][A-Za-z_]*(?:[ _.][A-Za-z_]+){0,3}\s*\}(?!\})",
    "double square": r"\[\[\s*[A-Za-z_][\w. -]{0,40}\s*\]\]",
    "bars": r"\*\|[A-Za-z_:]{2,40}\|\*",
    "hashes": r"##[A-Za-z_]{2,40}##|(?<![\w#])#[A-Z][A-Z_]{2,40}#(?![\w#])",
    "dollars": r"(?<![\w$])\$[A-Z][A-Z_]{2,40}\$",
    "brace percent": r"\{%-?\s*\w+[^%\n]{0,80}-?%\}",
    "dollar brace": r"\$\{\s*[A-Za-z_][\w.\- ]{0,60}\s*\}",
    "angle percent": r"<%[=\-]?\s*[^%<>\n]{1,80}%>",
    "php": r"<\?(?:php\b|=)[^<>\n]{0,120}\?>|<\?php\b",
    "percent": r"%%?[A-Za-z_][A-Za-z0-9_]{2,40}%%?",
    "at signs": r"@@?[A-Za-z_][\w.\-]{1,40}@@",
    "double underscore": rf"(?<!\w)__{_UPPER}__(?!\w)",
    "angle": r"<(?!/?(?:a|b|i|p|u|em|strong|div|span|br|hr|li|ul|ol|td|tr|th|h[1-6]|img|table|sub|sup|code|pre)\b)[A-Za-z]+(?:[_ ][A-Za-z]+){0,4}>",
    "square request": rf"\[\s*{_ASK}\b[^\[\]\n]{{0,60}}\]",
    "square supply": rf"\[[^\[\]\n]{{0,60}}\b{_SUPPLY}\s*\]",
    "square name": r"\[\s*(?:[A-Z][A-Z0-9]+(?:[_ ][A-Z0-9]+){0,4}|[A-Za-z]+(?:[_ ][A-Za-z]+){0,3})\s*\]",
    "spreadsheet": r"#(?:REF|NAME|VALUE|DIV/0|N/A|NUM|NULL)[!?]",
    "blank": r"(?<![\w_])_{4,}(?![\w_])|(?<!\.)\.{6,}(?!\.)",
    "stand-in": r"(?<![\w'])(?:TBD|TBC|TBA|XX+(?:\.X+)?|xxx+|N\.N\.|undefined(?! (?:variable|index|function|offset|method|symbol|reference|behaviou?r))|\[object Object\])(?![\w'])",
}
# Brackets and words that a finished text may hold by chance: two of them make residue, one does not.
_WEAK = ("square name", "stand-in")
_FIELD = re.compile("|".join(f"(?P<f{i}>{p})" for i, p in enumerate(_PLACEHOLDERS.values())))
_WEAK_GROUPS = frozenset(f"f{i}" for i, name in enumerate(_PLACEHOLDERS) if name in _WEAK)
_HINTS = ("{", "}", "%", "@@", "<", "[", "#", "$", "__", "*|", "TBA", "TBC", "TBD", "XX", "xxx", "undefined", "......", "N.N")


def _hinted(text: str) -> bool:
    """Whether any grammar could match: each needs one of the hints."""
    return any(h in text for h in _HINTS)


# A text about such fields: it names them as fields, prints them, or explains a template.
_ABOUT = re.compile(
    r"\b(?:field names?|placeholders?|template prints|prints? \S+ as|as a field|variables? named|syntax|tutorial|"
    r"example|for instance|documentation|such as|sets? such|called|labelled|marked|column|box|of the form|stands for|nom de champ|nome de campo)\b", re.I
)
_CODE = re.compile(r"```.*?(?:```|\Z)|~~~.*?(?:~~~|\Z)|<(pre|code)\b.*?</\1>|`[^`\n]+`|^(?: {4}|\t)\S.*$", re.S | re.M)

# ---------------------------------------------------------------- filler
_LATIN = frozenset(
    "lorem ipsum dolor sit amet consectetur adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua "
    "enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit "
    "voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt "
    "mollit anim id est laborum vestibulum pellentesque curabitur vivamus praesent aenean maecenas phasellus".split()
)
_FILLER_LINE = re.compile(
    r"\b(?:your|my|some|the|add|put|enter|insert|type|sample|dummy)\b[^.\n]{0,30}\b(?:text|content|title|heading|abstract|caption|summary|description|paragraph)s?\b"
    r"[^.\n]{0,20}\b(?:goes? here|here|in this (?:box|field|space))\b|"
    r"\b(?:heading|title|text|content|caption|subtitle|headline) goes here\b|"
    r"\bthis is (?:a )?(?:sample|dummy|placeholder|filler|test) (?:content|text|page|paragraph)\b|"
    r"\breplace (?:it|this)(?: text)? before publishing\b|"
    r"\bplaceholder (?:text|content|image|caption)\b|\b(?:caption|image|text|title|figure|section) placeholder\b|"
    r"\bleft (?:intentionally |deliberately )?blank (?:on purpose|intentionally|by the)\b|\bintentionally left blank\b|"
    r"\b(?:TODO|FIXME)\b\s*:|\bcoming soon\b|"
    r"\b(?:ajoutez|saisissez|insérez|écrivez|votre)\b[^.\n]{0,20}\btexte\b[^.\n]{0,12}\bici\b|\btexte? (?:ici|provisoire|de remplissage)\b|"
    r"\b(?:insira|adicione|escreva|coloque|seu|o seu)\b[^.\n]{0,20}\btexto\b[^.\n]{0,12}\baqui\b|\btexto (?:aqui|provisório|de exemplo)\b|"
    r"\b(?:weka|andika|ingiza)\b[^.\n]{0,20}\bmaandishi\b[^.\n]{0,12}\bhapa\b|\bmaandishi (?:hapa|ya mfano)\b",
    re.I,
)

_EMPTY_LINE = re.compile(
    r"^\W*(?:coming soon|under construction|contenu à venir|à venir|en construction|em breve|conteúdo em breve|em construção|inakuja (?:hivi karibuni|karibuni)|"
    r"TB[ACD]|N/A|null|none|nan|undefined|xxx+|untitled|no (?:title|content)|sans titre|sem título)\W*$",
    re.I,
)

# ---------------------------------------------------------------- errors, refusals, demands
_DEMAND = re.compile(
    r"\b(?:enable|turn on|activate|allow|switch on|requires?|needs?|without|support)\b[^.\n]{0,40}\b(?:java ?scripts?|scripts?|scripting)\b|"
    r"\b(?:activer|activez|autoriser|nécessite)\b[^.\n]{0,30}\bjava ?script\b|\b(?:ative|habilite|ativar|habilitar|requer)\b[^.\n]{0,30}\bjava ?script\b|"
    r"\b(?:washa|wezesha|ruhusu)\b[^.\n]{0,30}\bjava ?script\b|^\s*noscript\s*$|\bdoes not support scripting\b|"
    r"\benable cookies\b|\bscripts and cookies\b|\bswitch them on\b",
    re.I,
)
_ERROR = re.compile(
    r"^\W*(?:error|erreur|erro|hitilafu|http)?\W*(?:4\d\d|5\d\d)\b\W*(?:error|not found|forbidden|unauthori[sz]ed|bad gateway|gateway time-?out|gone|too many requests|"
    r"service unavailable|internal server error|bad request|request timeout|page|la page|a página|ukurasa)|"
    r"\"(?:status|code|error)\"\s*:\s*\"?[45]\d\d|\"error\"\s*:|"
    r"\b(?:page|url|document|resource|article|file|site|record)\b[^.\n]{0,40}\b(?:not found|cannot be found|could not be found|can't be found|was not found|no longer exists?|"
    r"does not exist|is missing|has moved|has been removed|was removed|is damaged|is down|is unavailable|could not be (?:loaded|displayed|opened|repaired))\b|"
    r"\b(?:access|permission) (?:is )?denied\b|\bnot (?:allowed|authori[sz]ed|permitted) to (?:view|access|see)\b|\bforbidden\b|"
    r"\b(?:internal )?server error\b|\berreur interne\b|\berro interno\b|\bpage (?:demandée|introuvable)\b|\bpágina não (?:foi )?encontrada\b|"
    r"\b(?:ukurasa|hati)\b[^.\n]{0,30}\b(?:haupo|haukupatikana|haijapatikana)\b|\bhitilafu\b|"
    r"\b(?:bad gateway|gateway time-?out|service (?:temporarily )?unavailable|too many requests|rate limit(?:ed)?)\b|"
    r"\b(?:fatal|parse|syntax|runtime) error\b|\bstack ?trace\b|\btraceback \(most recent\b|\bundefined (?:variable|index|function|offset)\b|"
    r"\bwarning: [^\n]{0,80}\bon line \d+|\bexception in thread\b|\bnull ?pointer\b|\bsegmentation fault\b|\bout of memory\b|"
    r"\berror establishing\b|\b(?:database|query|connection) (?:error|failed|refused|timed out)\b|\b(?:query|request|connection) (?:failed|timed out)\b|"
    r"\btimeout after\b|\b(?:request|reference|ray|incident|trace|error) (?:id|code|#)|\bcontact the administrator\b|"
    r"\b(?:text )?extraction failed\b|\b(?:could not|unable to|failed to|cannot) (?:be )?(?:extract|load|open|read|render|decode|parse|display|repair)\w*\b|"
    r"\b(?:could not|unable to|failed to|cannot) (?:complete|process|fulfil|handle|serve) (?:the|this|your) request\b|"
    r"\b(?:down|closed) for maintenance\b|\bunder maintenance\b|\ben maintenance\b|\bem manutenção\b|\bcome back later\b|\btry again (?:later|in)\b|\breload to try\b|"
    r"\bconfirm that you are (?:a )?human\b|\b(?:you are|are you) (?:not )?a (?:ro)?bot\b|\bverify (?:that )?you(?:'re| are)\b|\bchecking your browser\b|\bcaptcha\b|"
    r"\bsession (?:has |is )?(?:expired|timed out|ended)\b|\b(?:sign|log) in again\b|\b(?:could|can) ?not be (?:shown|displayed|viewed|found|loaded|rendered)\b|\bplease upgrade\b|"
    r"\bonyesho\b|\bhaujapatikana\b|\bsession expirée\b|\bsessão expir\w+|\b(?:not|aren't) supported by your (?:viewer|browser)\b|\bone more step\b|\bwrong address\b",
    re.I,
)
# A notice about the comments under an article is furniture, not a demand in place of it.
_ABOUT_COMMENTS = re.compile(r"\b(?:comments?|commentaires|comentários|maoni)\b", re.I)
# Real data: rows of a table with numbers, lists of numbers, long sequences of capitals.
_DATA = re.compile(r"\|[^|\n]*\d[^|\n]*(?:\||$)|^[\d.,;:\s+\-eE]{15,}$|^[A-Z]{30,}$")
_TAG_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"(?<=[.!?…;])\s+|\n")
_VOWEL = re.compile(r"[aeiouyàâäéèêëíîïóôöúûüãõ]", re.I)
MIN_WORDS = 6  # a sentence of content has at least so many words
MIN_CONTENT = 2  # sentences that make content
STRETCH = 60  # words that are asked at once whether they are a language
MESSAGE_WORDS = 13  # a message is shorter; a sentence that tells of one is a story
SHARE_OF_FIELDS = 0.05  # unfilled fields among words from which a text that explains fields is residue all the same


@dataclass(frozen=True)
class Verdict:
    """reason: '' for content, else fields, filler, error or demand. fields: unfilled ones; content, residue: sentences seen."""

    reason: str
    fields: int
    content: int
    residue: int


def _mash(words: list[str]) -> bool:
    """Keys struck at random, or one word over and over; a long text in each stretch, since any text repeats its words at length."""
    n = STRETCH
    if len(words) > n:
        return all(_mash(words[i : i + n]) for i in range(0, len(words) - n, n)) and _mash(words[-n:])
    if len(words) >= 3 and len(set(words)) == 1:
        return True
    if len(words) < 4:
        return len(words) >= 2 and _struck("".join(words))
    if len(set(words)) <= max(1, len(words) // 4):
        return True
    return _struck("".join(words))


def _struck(letters: str) -> bool:
    """Few vowels, or few different letters: no language."""
    return len(letters) >= 15 and (len(_VOWEL.findall(letters)) < 0.22 * len(letters) or len(set(letters)) <= 7)


def unfilled_fields(text: str) -> int:
    """Unfilled fields of a text: those in code, and those it explains rather than leaves open, do not count."""
    if not _hinted(text):
        return 0
    bare = _CODE.sub(" ", text) if "`" in text or "~~~" in text or "<code" in text or "<pre" in text or "\n    " in text or "\n\t" in text else text
    strong = weak = said = 0
    for part in _SENTENCE.split(bare):
        if not _hinted(part):
            continue
        found = [m.lastgroup for m in _FIELD.finditer(part)]
        if not found:
            continue
        if _ABOUT.search(part):
            said += len(found)
        else:
            lower = sum(g in _WEAK_GROUPS for g in found)
            weak += lower
            strong += len(found) - lower
    if said >= 3 and said > SHARE_OF_FIELDS * len(bare.split()):
        strong += said
    return strong + (weak if strong or weak >= 2 else 0)


def judge(text: str | None) -> Verdict:
    """Whether residue stands in place of content; null and blank text are content-free, not residue.

    Unfilled fields are residue wherever they stand. Filler, errors and demands are residue only where they stand in place of
    content: where fewer than MIN_CONTENT sentences of content remain. Page furniture is neither.
    """
    if text is None or not text.strip():
        return Verdict("", 0, 0, 0)
    fields = unfilled_fields(text)
    if fields:
        return Verdict("fields", fields, 0, 0)
    latin = content = errors = demands = filler = 0
    for line in text.split("\n"):
        line = line.strip()
        if not line:
            continue
        whole = [w.lower() for w in _TAG_WORD.findall(line)]
        if len(line) < 160 and _DEMAND.search(line) and not _ABOUT_COMMENTS.search(line):
            demands += 1
            continue
        if _EMPTY_LINE.match(line):
            filler += 1
            continue
        if _DATA.search(line):
            content += 1
            if content >= MIN_CONTENT:
                return Verdict("", 0, content, latin + filler + errors + demands)
            continue
        if is_furniture(line) or is_teaser(line):
            continue
        if whole and not line.isupper() and _mash(whole):
            filler += 1
            continue
        for part in _SENTENCE.split(line):
            words = [w.lower() for w in _TAG_WORD.findall(part)]
            if not words:
                continue
            if len(words) >= 3 and sum(w in _LATIN for w in words) >= 0.6 * len(words):
                latin += 1
            elif _EMPTY_LINE.match(part) or _FILLER_LINE.search(part) or (not part.isupper() and _mash(words)):
                filler += 1
            elif (len(words) < MESSAGE_WORDS or "/" in part or "{" in part) and _ERROR.search(part):
                errors += 1
            elif len(words) >= MIN_WORDS and (ends_sentence(part) or len(words) >= 25):
                content += 1
                if content >= MIN_CONTENT:
                    return Verdict("", 0, content, latin + filler + errors + demands)
    residue = latin + filler + errors + demands
    if not residue:
        return Verdict("", 0, content, 0)
    return Verdict("filler" if latin + filler >= errors + demands else "demand" if demands >= errors else "error", 0, content, residue)


def _reasons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [judge(x) for x in batch.column(1).to_pylist()]
        yield pa.record_batch(
            [batch.column(0), pa.array([v.reason for v in found], pa.string()), pa.array([v.fields for v in found], pa.int32())], names=["_id", "reason", "fields"]
        )


def residue_of(texts: DataFrame, text_id: str, text: str) -> DataFrame:
    """``(text_id, reason, fields)`` per row: ``fields``, ``filler``, ``error`` or ``demand`` where such residue stands in place
    of content, else an empty reason. See ``judge``.

    Null and blank texts have an empty reason; null ids stay; very long texts are read whole; repeated rows come out
    repeatedly; an empty table gives none. Narrow: no shuffle.
    """
    picked = texts.select(F.col(text_id).cast("string").alias("_id"), F.col(text).alias("_text"))
    return picked.mapInArrow(_reasons, "_id string, reason string, fields int").withColumnRenamed("_id", text_id)


@F.pandas_udf(BooleanType())
def _is_content(text: pd.Series) -> pd.Series:
    return pd.Series([not judge(x).reason for x in text], dtype=bool)


def drop_residue(texts: DataFrame, text: str) -> DataFrame:
    """The rows in whose text no residue stands in place of content, with all their columns; null and blank texts stay."""
    return texts.where(_is_content(F.col(text)))
