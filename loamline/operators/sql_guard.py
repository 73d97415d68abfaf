"""Generated SQL taken from answers and let through only if it reads what it may read."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# Words of statements that change something.
FORBIDDEN = ["INSERT", "UPDATE", "DELETE", "DROP", "CREATE", "MERGE", "TRUNCATE", "ALTER", "GRANT", "REVOKE", "EXEC", "EXECUTE", "CALL"]
_RELATION = re.compile(r"UnresolvedRelation \[([^\]]+)\]")


def extract_statements(answer: str, most: int = 10) -> list[str]:
    """SELECT statements of an answer: fenced or bare, divided by query rules or by lines that begin with SELECT; each once."""
    parts = re.split(r"\n-{3,}\s*(?:QUERY)?\s*-{3,}\n", answer or "", flags=re.I)
    if len(parts) == 1:
        parts = re.split(r"\n(?=SELECT\s)", answer or "", flags=re.I)
    found: dict[str, str] = {}
    for part in parts:
        fenced = [b.strip() for b in re.findall(r"```(?:\w+)?\s*(.*?)```", part, flags=re.S) if b.strip().upper().startswith("SELECT")]
        statement = (fenced[0] if fenced else re.sub(r"```.*?```", "", part, flags=re.S)).strip().rstrip(";").strip()
        if statement.upper().startswith("SELECT"):
            found.setdefault(" ".join(statement.split()), statement)
    return list(found.values())[:most]


def validate_sql(spark: SparkSession, statement: str, databases: set[str], limit: int) -> str | None:
    """The statement with a limit if it had none, or None where it is no single SELECT over the databases.

    The decision is made on Spark's parsed plan, not on the text: column references, numbers, comments and strings that look
    like names do no harm, and a second statement does not parse.
    """
    text = (statement or "").strip().rstrip(";").strip()
    if not re.match(r"(?is)^(select|with)\b", text):
        return None
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except Exception:  # noqa: BLE001
        return None
    tree = plan.toString()
    if re.search(r"(?i)^\s*'?(?:insert|update|delete|drop|create|merge|truncate|alter|grant|revoke|call)\w*", tree):
        return None
    bound = set(re.findall(r"(?im)^\W*(?:CTE|SubqueryAlias) \[?(\w+)", tree)) | set(re.findall(r"(?i)\b(\w+)\s+as\s*\(\s*select\b", text))
    for name in _RELATION.findall(tree):
        parts = [p.strip() for p in name.split(",")]
        if len(parts) == 1 and parts[0] in bound:
            continue
        if len(parts) < 2 or parts[-2].lower() not in {d.lower() for d in databases}:
            return None
    return text if re.search(r"(?m)^\W*'?GlobalLimit", tree) else f"{text} LIMIT {limit}"


def strict_compat(statement: str, datasets: set[str], limit: int) -> str | None:
    """The textual rule that generated SQL used to be held to, for comparison: no word of change, and what stands before the
    last dot of any dotted name is a dataset, be it an alias or a number."""
    text = " ".join((statement or "").split())
    changes = re.search(rf"\b(?:{'|'.join(FORBIDDEN)})\b", text, flags=re.I)
    owners = {m.lower() for m in re.findall(r"(\w+)`?\.`?\w+(?![\w`]*\.)", text)}
    if not text[:6].upper() == "SELECT" or changes or (datasets and owners - {d.lower() for d in datasets}):
        return None
    return text if "LIMIT" in text.upper() else f"{text.rstrip(';')} LIMIT {limit}"


def run_budgeted(spark: SparkSession, statements: list[str], databases: set[str], *, rows_each: int = 10, rows: int = 20, most: int = 10) -> list[tuple[str, DataFrame]]:
    """Statements that pass, each limited, until the row budget is used up."""
    out, left = [], rows
    for statement in statements[:most]:
        clean = validate_sql(spark, statement, databases, rows_each)
        if clean is None or left <= 0:
            continue
        taken = spark.sql(clean).limit(min(rows_each, left))
        left -= min(rows_each, taken.count(), left)
        out.append((clean, taken))
    return out
