"""Hints about tables for generated SQL: descriptions found by search, joined to the catalogue, rendered within bounds."""

from __future__ import annotations

import re
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

EXCERPT = 400
MAX_CHARS, MAX_COLUMNS, MAX_LINE, MAX_ITEM = 2_400, 30, 220, 60
# Parts of a table's description in the order of their use, with their labels.
SECTIONS = {
    "description": "Description", "grain": "Grain", "primary_keys": "Primary keys", "relationships": "Relationships", "join_logic": "Join logic", "time_dimensions": "Time dimensions",
    "geography": "Geography columns", "metrics": "Metric columns", "scenario_context": "Scenario context", "semantic_role": "Semantic role",
    "business_questions_supported": "Business questions supported", "aggregation_rules": "Aggregation rules", "filtering_guidance": "Filtering guidance",
    "sql_generation_hints": "SQL generation hints", "data_quality": "Data quality", "temporal_model": "Temporal model",
}


def excerpt(text: Column, most: int = EXCERPT) -> Column:
    """The first characters of a text, with an ellipsis where it goes on; empty for null."""
    t = F.coalesce(text, F.lit(""))
    return F.concat(F.substring(t, 1, most), F.when(F.length(t) > most, "…").otherwise(""))


def with_catalogue(hits: DataFrame, catalogue: DataFrame, name: str = "table_name", full: str = "bq_table_id", described: str = "description") -> DataFrame:
    """Hits with ``described`` of their table: by its bare name, else by the last part of its full name; null where neither is known."""
    known = catalogue.groupBy(F.trim(name).alias("_n")).agg(F.min(described).alias("_d"))
    short = F.element_at(F.split(F.trim(full), r"\."), -1)
    joined = hits.withColumn("_a", F.trim(name)).withColumn("_b", F.when(F.trim(F.coalesce(full, F.lit(""))) != "", short))
    joined = joined.join(known.withColumnsRenamed({"_n": "_a", "_d": "_da"}), "_a", "left").join(known.withColumnsRenamed({"_n": "_b", "_d": "_db"}), "_b", "left")
    return joined.withColumn(described, F.coalesce("_da", "_db")).drop("_a", "_b", "_da", "_db")


def _cut(text: str, most: int) -> str:
    return text if len(text) <= most else text[: max(0, most - 1)].rstrip() + "…"


def _line(value: Any) -> str:
    """A part of a description on one line: lists by commas, maps by semicolons; empty where nothing plain is in it."""
    plain = lambda x: isinstance(x, (str, int, float, bool))
    if plain(value):
        return str(value).strip()
    if isinstance(value, list):
        firsts = [next(iter(x.items()), None) if isinstance(x, dict) else None for x in value]
        items = [str(x).strip() if plain(x) else f"{p[0]}={_cut(str(p[1]), MAX_ITEM)}" if p else "" for x, p in zip(value, firsts)]
        return ", ".join(x for x in items if x)
    if isinstance(value, dict):
        shown = []
        for k, v in value.items():
            if plain(v):
                shown.append(f"{k}={_cut(str(v), MAX_ITEM)}")
            elif isinstance(v, list) and (inner := ", ".join(str(x) for x in v if plain(x))):
                shown.append(f"{k}=[{_cut(inner, 80)}]")
        return "; ".join(shown)
    return ""


def _column(c: dict) -> str:
    about = ", ".join(x for x in (str(c.get("type") or "").strip(), str(c.get("semantic_role") or "").strip()) if x)
    head = str(c["name"]).strip() + (f" ({about})" if about else "")
    example = f"[ex: {_cut(str(c['example']), 40)}]" if c.get("example") not in (None, "") else ""
    tail = " ".join(x for x in (str(c.get("description") or "").strip(), example) if x)
    return f"  - {head}" + (f": {_cut(tail, MAX_LINE - len(head) - 4)}" if tail else "")


def render_schema(table: str, about: dict | None, *, max_chars: int = MAX_CHARS, max_columns: int = MAX_COLUMNS) -> str:
    """A table's description as compact text: its parts one a line, then its columns; cut to ``max_chars``. Empty for none."""
    if not about:
        return ""
    parts = [f"Table: {str(about.get('table_name') or table).strip().strip('`') or table}"]
    parts += [f"{label}: {_cut(text, MAX_LINE)}" for key, label in SECTIONS.items() if (text := _line(about.get(key)))]
    columns = about.get("columns")
    if isinstance(columns, list):
        shown = [_column(c) for c in columns[:max_columns] if isinstance(c, dict) and str(c.get("name") or "").strip()]
        if len(columns) > max_columns:
            shown.append(f"  - … {len(columns) - max_columns} more columns")
        parts += ["Columns:", *shown] if shown else []
    return _cut("\n".join(parts), max_chars)


_SUMMARY = re.compile(r"Table Name \(in BigQuery\)", re.I)
_TABLE_ID = re.compile(r"([\w-]+\.(?:bronze|silver|gold)\.\w+)", re.I)
_DETAIL = re.compile(r"^\d+\.\s+.+\((\w+)\)\s*$")
_TABLE = StructType([StructField(n, StringType()) for n in ("table_name", "table_id", "text")])


def logical_tables(text: str | None, fallback: str) -> list[dict[str, str]]:
    """One entry per table of a description: those of its summary rows, each with the section about it; a text without such rows
    describes one table, the first that it names. The first entry of a short name stays."""
    if not text or not text.strip():
        return []
    short = lambda full: full.strip().rstrip(".").split(".")[-1] or "unknown_table"
    out: dict[str, dict[str, str]] = {}
    if _SUMMARY.search(text):
        about: dict[str, list[str]] = {}
        held: list[str] | None = None
        for line in text.split("\n"):
            if m := _DETAIL.match(line.strip()):
                held = about[m.group(1).lower()] = [line.strip()]
            elif held is not None:
                held.append(line)
        for line in text.split("\n"):
            cells = [c.strip() for c in line.split("|")]
            if len(cells) < 4 or not _TABLE_ID.fullmatch(cells[0].rstrip(".")):
                continue
            name = short(cells[0])
            whole = f"Table: {name}\nBQ table: {cells[0].rstrip('.')}\n\nSource title: {cells[1]}\nCategory: {cells[2]}\nWhy it matters: {'|'.join(cells[3:]).strip()}"
            detail = "\n".join(about.get(name.lower(), [])).strip()
            out.setdefault(name, {"table_name": name, "table_id": cells[0].rstrip("."), "text": f"{whole}\n\n{detail}" if detail else whole})
    if not out:
        m = _TABLE_ID.search(text)
        name = short(m.group(1)) if m else fallback
        out[name] = {"table_name": name, "table_id": m.group(1) if m else fallback, "text": text}
    return list(out.values())


def explode_tables(documents: DataFrame, text: str, fallback: str) -> DataFrame:
    """One row per table that each document describes, with all other columns; null and blank texts give none."""

    @F.pandas_udf(ArrayType(_TABLE))
    def tables(texts: pd.Series, names: pd.Series) -> pd.Series:
        return pd.Series([logical_tables(t, n or "unknown_table") for t, n in zip(texts, names)], dtype=object)

    return documents.withColumn("_t", F.explode(tables(F.col(text), F.col(fallback)))).select(*[c for c in documents.columns if c != text], "_t.*")
