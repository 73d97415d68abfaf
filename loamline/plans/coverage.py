"""Indicator coverage: which country and year each source of an indicator group has rows for, and how many."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.catalog import Sources
from loamline.functions.keys import initcap_words

# The countries that the coverage is about.
AFRICAN_COUNTRIES = [
    "Algeria", "Angola", "Benin", "Botswana", "Burkina Faso", "Burundi", "Cameroon", "Cape Verde", "Central African Republic", "Chad", "Comoros", "Congo",
    "Democratic Republic of the Congo", "Djibouti", "Egypt", "Equatorial Guinea", "Eritrea", "Eswatini", "Ethiopia", "Gabon", "Gambia", "Ghana", "Guinea",
    "Guinea-Bissau", "Ivory Coast", "Kenya", "Lesotho", "Liberia", "Libya", "Madagascar", "Malawi", "Mali", "Mauritania", "Mauritius", "Morocco", "Mozambique",
    "Namibia", "Niger", "Nigeria", "Rwanda", "Senegal", "Seychelles", "Sierra Leone", "Somalia", "South Africa", "South Sudan", "Sudan", "Tanzania", "Togo",
    "Tunisia", "Uganda", "Zambia", "Zimbabwe",
]
# Spellings that stand for Ivory Coast, lower case.
IVORY_COAST = ["c™te dÕivoire", "côte d’ivoire", "cote divoire"]
TRIMMED, AS_STORED, INITCAP = "trimmed", "as stored", "initcap"


@dataclass(frozen=True)
class Branch:
    """One table of a group. country, code, year: SQL expressions, None for a null column. keep: how the country is compared
    with the list (None: all rows stay). alias: spellings of Ivory Coast are one. year_duck: the year where DuckDB says it
    otherwise."""

    table: str
    country: str | None = None
    code: str | None = None
    year: str | None = None
    keep: str | None = None
    alias: bool = False
    style: str = TRIMMED
    year_duck: str | None = None


_MARKET, _SERIES, _AIR = "fews_net_market_prices_time_series_data", "fews_net_market_prices_data_series", "nakuru_air_quality_archive"
_MONTH = {"year": "cast(year(cast(try_cast(period_date as timestamp) as date)) as string)", "year_duck": "cast(year(try_cast(period_date as timestamp)) as varchar)"}
_FIRST = {"year": "cast(year(cast(try_cast(first_period_date as timestamp) as date)) as string)", "year_duck": "cast(year(try_cast(first_period_date as timestamp)) as varchar)"}
GROUPS = {
    "climate": (
        [
            Branch(_MARKET, "country", "country_code", keep=TRIMMED, alias=True, **_MONTH),
            Branch(_AIR, year="try_cast(substr(timestamp, 1, 4) as int)", year_duck="CASE WHEN regexp_full_match(substr(timestamp, 1, 4), '[0-9]{4}') THEN cast(cast(substr(timestamp, 1, 4) as integer) as varchar) END"),
            Branch("events", year="cast(year(ts) as string)"),
            Branch("orders", year="cast(year(o_orderdate) as string)"),
        ],
        True,
    ),
    "economic": ([Branch(_MARKET, "country", "country_code", keep=AS_STORED, **_MONTH), Branch(_SERIES, "country", None, keep=AS_STORED, **_FIRST), Branch("nation", "n_name", "cast(n_nationkey as string)")], False),
    "land_use": ([Branch(_SERIES, "country", None, keep=TRIMMED, **_FIRST), Branch("supplier", None, "cast(s_nationkey as string)"), Branch("customer", None, "cast(c_nationkey as string)")], False),
    "nutrition": ([Branch(_MARKET, "country", "country_code", keep=TRIMMED, **_MONTH), Branch(_SERIES, "country", None, keep=TRIMMED, **_FIRST)], False),
    "trade": ([Branch(_MARKET, "country", "country_code", keep=TRIMMED, **_MONTH), Branch("documents", "geo_country_primary", None, keep=TRIMMED, year="cast(year(published_at) as string)")], False),
}


def _branch(at: Sources, group: str, b: Branch) -> DataFrame:
    null = F.lit(None).cast("string")
    raw = F.expr(b.country).cast("string") if b.country else null
    trimmed = F.trim(raw)
    country = F.when(F.lower(trimmed).isin(IVORY_COAST), F.lit("Ivory Coast")).otherwise(trimmed) if b.alias else trimmed
    rows = at.table(b.table)
    if b.keep:
        listed = at.spark.createDataFrame([(c.lower(),) for c in AFRICAN_COUNTRIES], "listed string")
        key = F.lower(country) if b.keep == TRIMMED else F.lower(raw)
        rows = rows.withColumn("_listed", key).join(F.broadcast(listed), F.col("_listed") == F.col("listed"), "left_semi")
    return rows.select(
        F.lit(group).alias("indicator_group"), F.lit(b.table).alias("source_table"), country.alias("country"),
        (F.trim(F.expr(b.code)) if b.code else null).alias("country_code"), (F.expr(b.year).cast("string") if b.year else null).alias("year"),
    )


def coverage(group: str):  # noqa: ANN201
    branches, bounded = GROUPS[group]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        at = Sources(spark, sf_dir)
        parts = [_branch(at, group, b) for b in branches]
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.union(p)
        if bounded:
            rows = rows.where(F.col("year").try_cast("bigint").between(1960, 2026) | F.col("year").isNull())
        return rows.groupBy("indicator_group", "country", "country_code", "year").agg(F.count(F.lit(1)).alias("n_rows"))

    return run


def coverage_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group that writes countries with initials and does not group by code."""
    at = Sources(spark, sf_dir)
    a = at.table(_MARKET).select(F.trim(initcap_words("country")).alias("country"), F.expr(_MONTH["year"]).alias("year"))
    b = at.table(_SERIES).select(F.trim(initcap_words("country")).alias("country"), F.expr(_FIRST["year"]).alias("year"))
    return a.union(b).groupBy(F.lit("yield").alias("indicator_group"), "country", "year").agg(F.count(F.lit(1)).alias("n_rows"))


def queries() -> dict:
    return {**{f"indicator_coverage_{g}": coverage(g) for g in GROUPS}, "indicator_coverage_yield": coverage_yield}


def oracle_sql() -> dict[str, str]:
    quoted = lambda xs: ", ".join("'" + x.replace("'", "''") + "'" for x in xs)
    listed = quoted(c.lower() for c in AFRICAN_COUNTRIES)
    out = {}
    for group, (branches, bounded) in GROUPS.items():
        parts = []
        for b in branches:
            raw = f"CAST({b.country} AS VARCHAR)" if b.country else "CAST(NULL AS VARCHAR)"
            country = f"trim({raw})"
            if b.alias:
                country = f"CASE WHEN lower(trim({raw})) IN ({quoted(IVORY_COAST)}) THEN 'Ivory Coast' ELSE trim({raw}) END"
            kept = ""
            if b.keep:
                kept = f" WHERE lower({country if b.keep == TRIMMED else raw}) IN ({listed})"
            code = f"trim({b.code.replace('as string', 'as varchar')})" if b.code else "CAST(NULL AS VARCHAR)"
            year = (b.year_duck or b.year.replace("as string", "as varchar")) if b.year else "CAST(NULL AS VARCHAR)"
            parts.append(f"SELECT '{group}' AS indicator_group, {country} AS country, {code} AS country_code, {year} AS year FROM {b.table}{kept}")
        where = " WHERE TRY_CAST(year AS BIGINT) BETWEEN 1960 AND 2026 OR year IS NULL" if bounded else ""
        out[f"indicator_coverage_{group}"] = (
            f"SELECT indicator_group, country, country_code, year, count(*) AS n_rows FROM ({' UNION ALL '.join(parts)}) x{where} "
            "GROUP BY indicator_group, country, country_code, year"
        )
    words = (
        "array_to_string(list_transform(regexp_extract_all({c}, '([\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+)'), lambda x: upper(substr(x, 1, 1)) || lower(substr(x, 2))), '')"
    )
    out["indicator_coverage_yield"] = (
        "SELECT 'yield' AS indicator_group, country, year, count(*) AS n_rows FROM ("
        f"SELECT trim({words.format(c='country')}) AS country, {_MONTH['year_duck']} AS year FROM {_MARKET} UNION ALL "
        f"SELECT trim({words.format(c='country')}), {_FIRST['year_duck']} FROM {_SERIES}) x GROUP BY country, year"
    )
    return out
