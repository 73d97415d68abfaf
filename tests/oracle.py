"""Query and SQL side by side, as the driver compares them: rows, columns and values, order aside."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (float, Decimal)):
        return round(float(value), 5)
    return value if isinstance(value, (int, bool)) else str(value)


def compare(spark, query, sql: str, folder: str) -> None:
    con = duckdb.connect()
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    df = query(spark, folder)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    rel = con.execute(sql)
    columns = [d[0] for d in rel.description]
    assert sorted(columns) == names
    want = sorted((tuple(plain(r[columns.index(c)]) for c in names) for r in rel.fetchall()), key=repr)
    assert len(got) == len(want)
    assert got == want
