"""Queries over the market prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.catalog import Sources
from loamline.operators import measure_units as mu
from loamline.operators.measure_units import convert_prices, harmonise_prices, impute_units

PRICES, REFERENCE = "fews_net_market_prices_time_series_data", "measure_reference"


def p4_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every price in local currency per kg, L or ea."""
    at = Sources(spark, sf_dir)
    return harmonise_prices(at.table(PRICES), at.table(REFERENCE)).select(
        F.col("id").cast("long").alias("id"), "unit", "currency", "value", "common_unit_price", "to_unit", "unit_factor", "unit_from",
        "currency_factor", "converted_price", "status", "confidence",
    )


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose common_unit_price is more than 5 % off the converted price; by the unit that the row or its series names, else
    by the one that the classifier is sure of."""
    off = F.abs(F.col("common_unit_price") - F.col("converted_price")) > 0.05 * F.col("converted_price")
    return p4_prices(spark, sf_dir).where(F.col("status").isin("converted", "imputed") & ~F.isnan("common_unit_price") & off).select("id").distinct()


def p4_imputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose own field names no unit, as the classifier decides them; the unit of the series name is left to compare."""
    at = Sources(spark, sf_dir)
    return impute_units(convert_prices(at.table(PRICES), at.table(REFERENCE))).select(
        F.col("id").cast("long").alias("id"), "unit_from", "to_unit", "unit_factor", "model_unit", "model_factor", "confidence",
        "decision", "model_price",
    )


def p4_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the classifier does on rows it was not fitted on: those whose unit only the series' name tells. Rows, right units and
    right sizes per decision, and the mean confidence."""
    at = Sources(spark, sf_dir)
    judged = impute_units(convert_prices(at.table(PRICES), at.table(REFERENCE))).where("unit_from = 'series' and unit_factor is not null")
    right = F.col("to_unit") == F.col("model_unit")
    size = right & (F.abs(F.col("unit_factor") / F.col("model_factor") - 1) < 1e-3)
    return judged.groupBy("decision").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(F.coalesce(right, F.lit(False)).cast("int")), 4).alias("unit_right"), F.round(F.avg(F.coalesce(size, F.lit(False)).cast("int")), 4).alias("size_right"),
        F.round(F.avg("confidence"), 4).alias("confidence"),
    )


def _prices_sql() -> str:
    """CTEs ending in ``p``: every price row with unit_factor, currency_factor and converted_price."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    pairs = lambda table: ", ".join(f"({q(w)}, {q(symbol)})" for symbol, words in table.items() for w in words)
    none = ", ".join(q(x) for x in mu.NAMES_NONE)
    plain = lambda x: f"regexp_replace(trim(regexp_replace(lower({x}), '[\\s\\x{{a0}}]+', ' ', 'g')), '[ .;]+$', '')"
    begin = {True: "^", False: "^.*?(?:[,/-] ?|\\s)"}
    pattern = {(own, name): q(f"{begin[own]}{p}$") for own in (True, False) for name, p in (("holding", mu._HOLDING), ("sized", mu._SIZED), ("bare", mu._BARE))}
    pick = lambda name, fn: f"CASE WHEN own THEN {fn(pattern[True, name])} ELSE {fn(pattern[False, name])} END"
    match = lambda name: pick(name, lambda p: f"regexp_matches(t, {p})")
    part = lambda name, i: pick(name, lambda p: f"regexp_extract(t, {p}, {i})")
    number = lambda x: (
        f"CASE WHEN {x} = '' THEN 1.0 WHEN {x} LIKE '%½' THEN coalesce(TRY_CAST(replace({x}, '½', '') AS DOUBLE), 0) + 0.5 WHEN {x} LIKE '%¼' THEN coalesce(TRY_CAST(replace({x}, '¼', '') AS DOUBLE), 0) + 0.25 "
        f"WHEN {x} LIKE '%¾' THEN coalesce(TRY_CAST(replace({x}, '¾', '') AS DOUBLE), 0) + 0.75 WHEN {x} LIKE '%/%' THEN coalesce(TRY_CAST(regexp_extract({x}, '^(\\d+) ', 1) AS DOUBLE), 0) + "
        f"TRY_CAST(regexp_extract({x}, '(\\d+)/', 1) AS DOUBLE) / nullif(TRY_CAST(regexp_extract({x}, '/(\\d+)$', 1) AS DOUBLE), 0) "
        f"WHEN regexp_matches({x}, '^\\d{{1,3}}(,\\d{{3}})+([.]\\d+)?$') THEN TRY_CAST(replace({x}, ',', '') AS DOUBLE) ELSE TRY_CAST(replace({x}, ',', '.') AS DOUBLE) END"
    )
    whole = "regexp_replace(code, '^thousands? (?:of )?| thousands?$| ''?000$', '', 'g')"
    return f"""std(word, symbol) AS (VALUES {pairs(mu.SPELLINGS)}), con(word, symbol) AS (VALUES {pairs(mu.CONTAINERS)}), cur(word, iso) AS (VALUES {pairs(mu.CURRENCIES)}),
 ref AS (SELECT DISTINCT ON (measure, symbol, country_code) measure, symbol, upper(country_code) AS country_code, common_unit, factor FROM measure_reference),
 a AS (SELECT *, upper(trim(country_code)) AS cc, NOT coalesce(trim(lower(unit)) IN ({none}), true) AS own, trim(regexp_replace(replace(lower(trim(currency)), '.', ''), '\\s+', ' ', 'g')) AS code FROM {PRICES}),
 b AS (SELECT *, CASE WHEN own THEN {plain('unit')} ELSE regexp_replace({plain('dataseries_name')}, '\\s*[,/-]\\s*[a-z]{{3}}$', '') END AS t FROM a),
 c AS (SELECT *, CASE WHEN {match('holding')} THEN 'holding' WHEN {match('sized')} THEN 'sized' WHEN {match('bare')} THEN 'bare' END AS kind FROM b),
 d AS (SELECT *, CASE kind WHEN 'holding' THEN {part('holding', 1)} WHEN 'sized' THEN {part('sized', 2)} WHEN 'bare' THEN {part('bare', 1)} END AS num,
 CASE kind WHEN 'holding' THEN {part('holding', 2)} WHEN 'sized' THEN {part('sized', 3)} WHEN 'bare' THEN {part('bare', 2)} END AS word,
 CASE kind WHEN 'sized' THEN {part('sized', 1)} ELSE '' END AS times, CASE kind WHEN 'sized' THEN {part('sized', 4)} ELSE '' END AS tail FROM c),
 e AS (SELECT d.*, ({number('num')}) * ({number('times')}) AS quantity, CASE WHEN kind <> 'bare' AND (tail = '' OR num <> '') THEN std.symbol END AS symbol, CASE WHEN kind = 'bare' THEN con.symbol END AS container
 FROM d LEFT JOIN std ON std.word = d.word LEFT JOIN con ON con.word = d.word),
 f AS (SELECT e.*, coalesce(r1.factor, r2.factor) AS f, coalesce(r1.common_unit, r2.common_unit) AS to_unit, r3.factor AS fsub, r3.common_unit AS own_cur, lower(r3.symbol) AS sub, ({whole}) AS money FROM e
 LEFT JOIN ref r1 ON r1.measure <> 'currency' AND r1.country_code IS NULL AND r1.symbol = e.symbol LEFT JOIN ref r2 ON r2.measure <> 'currency' AND r2.country_code = cc AND r2.symbol = e.container
 LEFT JOIN ref r3 ON r3.measure = 'currency' AND r3.country_code = cc),
 g AS (SELECT f.*, cur.iso, CASE WHEN regexp_matches(code, '(^thousands? | thousands?$| ''?000$)') THEN 1000.0 ELSE 1.0 END AS scale,
 coalesce(regexp_replace(regexp_extract(code, '([^ ()]+)\\)?$', 1), 's$', '') = regexp_replace(sub, 's$', ''), false) AS is_sub FROM f LEFT JOIN cur ON cur.word = money),
 p AS (SELECT *, CASE WHEN coalesce(trim(lower(currency)) IN ({none}), true) THEN 1.0 WHEN is_sub THEN fsub WHEN iso = 'USD' THEN scale * exchange_rate
 WHEN iso IS NOT NULL AND coalesce(iso = own_cur, true) THEN scale END AS currency_factor, quantity * f AS unit_factor FROM g)"""


def oracle_sql() -> dict[str, str]:
    number = "CASE WHEN NOT isnan(value) THEN value END"
    factor = "CASE WHEN unit_factor > 0 THEN unit_factor END"
    source = "CASE WHEN own THEN 'row' WHEN symbol IS NOT NULL OR container IS NOT NULL THEN 'series' END"
    return {
        "p4_prices": (
            f"WITH {_prices_sql()} SELECT CAST(id AS BIGINT) AS id, unit, currency, value, common_unit_price, to_unit, {factor} AS unit_factor, {source} AS unit_from, currency_factor, {number} * currency_factor / ({factor}) AS converted_price, "
            f"CASE WHEN {number} IS NULL THEN 'no_value' WHEN {source} IS NULL THEN 'no_unit' WHEN {factor} IS NULL THEN 'unit_unknown' WHEN currency_factor IS NULL THEN 'currency_unknown' ELSE 'converted' END AS status, CAST(NULL AS DOUBLE) AS confidence FROM p"
        ),
        "p4_found": (
            f"WITH {_prices_sql()} SELECT DISTINCT CAST(id AS BIGINT) AS id FROM p WHERE NOT isnan(value) AND NOT isnan(common_unit_price) AND unit_factor > 0 "
            "AND abs(common_unit_price - value * currency_factor / unit_factor) > 0.05 * (value * currency_factor / unit_factor)"
        )
    }
