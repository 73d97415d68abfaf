"""The star schema: one canonical long relation, 14 dimensions and 10 facts, all by specification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.catalog import Sources
from loamline.functions.keys import surrogate_key
from loamline.session import cut_lineage

# Dimensions as (columns of the key, rows kept when any of them is not null).
DIMENSIONS = {
    "country": ["country_code", "country_name"],
    "crop": ["crop_name"],
    "farm_practice": ["practice_name"],
    "geography": ["country_code", "country_name", "admin_region"],
    "indicator": ["indicator_name"],
    "ipc_phase": ["ipc_phase_name", "ipc_phase_numeric"],
    "period": ["period_year"],
    "policy_area": ["policy_area_name"],
    "season": ["season_name"],
    "shock_type": ["shock_type_name"],
    "source": ["source_name"],
    "technology": ["technology_name"],
    "unit": ["unit_name"],
    "value_chain": ["value_chain_stage_name"],
}
# Facts as (columns of the key, further dimension keys); all have the common ones.
FACTS = {
    "climate": (["source_name", "indicator_name", "country_code", "period_year", "metric_value"], []),
    "enterprise_investment": (["source_name", "indicator_name", "country_code", "period_year", "crop_name"], ["crop"]),
    "humanitarian": (["source_name", "country_code", "period_year", "ipc_phase_name", "shock_type_name"], ["shock_type", "ipc_phase"]),
    "land_use": (["source_name", "indicator_name", "country_code", "period_year", "crop_name"], ["crop"]),
    "market_access": (["source_name", "indicator_name", "country_code", "period_year", "crop_name"], ["crop"]),
    "nutrition": (["source_name", "indicator_name", "country_code", "period_year", "crop_name"], ["crop"]),
    "policy": (["source_name", "indicator_name", "country_code", "period_year", "policy_area_name"], ["policy_area"]),
    "production": (["source_name", "indicator_name", "country_code", "period_year", "crop_name", "season_name"], ["crop", "season", "practice"]),
    "technology": (["source_name", "indicator_name", "country_code", "period_year", "technology_name"], ["technology"]),
    "value_chain": (["source_name", "indicator_name", "country_code", "period_year", "value_chain_stage_name"], ["value_chain_stage"]),
}
COMMON = ["country", "geography", "indicator", "source", "unit"]
_KEY_COLUMNS = {
    "practice": ["practice_name"], "value_chain_stage": ["value_chain_stage_name"], **{k: v for k, v in DIMENSIONS.items() if k != "period"},
}
DOMAINS = sorted(FACTS)


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical metric rows from the order lines: one row per line, attributes from part, order, supplier and nation."""
    at = Sources(spark, sf_dir)
    lines = at.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus")
    orders = at.table("orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    parts = at.table("part").select("p_partkey", "p_type", "p_brand", "p_size")
    suppliers = at.table("supplier").select("s_suppkey", "s_nationkey")
    nations = at.table("nation").join(at.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    pick = lambda names, by: F.element_at(F.array(*[F.lit(x) for x in names]), (by % len(names) + 1).cast("int"))
    size = F.col("p_size")
    return rows.select(
        F.concat(F.lit("source_"), "l_returnflag").alias("source_name"),
        pick(DOMAINS, F.col("l_partkey")).alias("domain_name"),
        F.col("p_type").alias("indicator_name"),
        F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("country_code"),
        F.col("n_name").alias("country_name"),
        F.when(F.col("l_suppkey") % 7 != 0, F.col("r_name")).alias("admin_region"),
        F.year("o_orderdate").cast("long").alias("period_year"),
        F.to_date("o_orderdate").alias("period_date"),
        F.when(size % 5 != 0, F.concat(F.lit("unit_"), (size % 5).cast("string"))).alias("unit_name"),
        F.col("p_brand").alias("crop_name"),
        F.col("o_orderpriority").alias("season_name"),
        F.col("l_linestatus").alias("practice_name"),
        F.when(size % 3 == 0, F.concat(F.lit("tech_"), (size % 11).cast("string"))).alias("technology_name"),
        F.when(size % 4 == 0, F.concat(F.lit("policy_"), (size % 13).cast("string"))).alias("policy_area_name"),
        F.when(size % 2 == 0, F.concat(F.lit("stage_"), (size % 6).cast("string"))).alias("value_chain_stage_name"),
        F.when(size % 7 == 0, F.concat(F.lit("shock_"), F.col("o_orderstatus"))).alias("shock_type_name"),
        F.when(size % 6 == 0, F.concat(F.lit("phase "), (size % 5 + 1).cast("string"))).alias("ipc_phase_name"),
        F.when(size % 6 == 0, (size % 5 + 1).cast("long")).alias("ipc_phase_numeric"),
        F.col("l_quantity").cast("double").alias("metric_value"),
    )


def key_of(columns: list[str]) -> Column:
    """Key over columns; a whole-numbered value is written without a fraction."""
    whole = F.col("metric_value").cast("bigint").cast("string")
    value = F.when(F.col("metric_value") == F.col("metric_value").cast("bigint"), whole).otherwise(F.col("metric_value").cast("string"))
    return surrogate_key(*[value if c == "metric_value" else F.col(c) for c in columns])


def dimension(name: str):  # noqa: ANN201
    columns = DIMENSIONS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = staging(spark, sf_dir).select(*columns).where(F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull()).distinct()
        if name == "period":
            return rows.select(F.col("period_year").alias("period_key"), "period_year", F.make_date("period_year", F.lit(1), F.lit(1)).alias("start_date"))
        return rows.select(key_of(columns).alias(f"{name}_key"), *columns)

    return run


def fact(name: str):  # noqa: ANN201
    columns, further = FACTS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = staging(spark, sf_dir).where(F.col("domain_name") == name)
        return rows.select(
            key_of(columns).alias(f"fact_{name}_key"), F.col("period_year").alias("period_key"),
            *[key_of(_KEY_COLUMNS[k]).alias(f"{k}_key") for k in [*COMMON, *further]], F.col("metric_value").alias(f"{name}_value"),
        )

    return run


def rollup_by_country_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact joined to its dimensions on keys: production by country and year. The six-table join is staged once for all three."""
    rows = cut_lineage(staging(spark, sf_dir).select("domain_name", "country_code", "country_name", "period_year", "metric_value"))
    facts = rows.where(F.col("domain_name") == "production").select(key_of(["country_code", "country_name"]).alias("country_key"), F.col("period_year").alias("period_key"), F.col("metric_value").alias("production_value"))
    countries = rows.select("country_code", "country_name").distinct().select(key_of(["country_code", "country_name"]).alias("country_key"), "country_name")
    periods = rows.select(F.col("period_year").alias("period_key"), "period_year").distinct()
    return (
        facts.join(countries, "country_key").join(periods, "period_key").groupBy("country_name", "period_year")
        .agg(F.sum("production_value").alias("production_total"), F.count(F.lit(1)).alias("n_rows"))
    )


def queries() -> dict:
    return {
        **{f"star_dim_{n}": dimension(n) for n in DIMENSIONS}, **{f"star_fact_{n}": fact(n) for n in FACTS},
        "star_rollup_by_country_year": rollup_by_country_year,
    }


# ---------------------------------------------------------------- the same in SQL
_STAGING = """WITH stg AS (
SELECT 'source_' || l_returnflag AS source_name, (ARRAY[%s])[CAST(l_partkey %% %d AS INTEGER) + 1] AS domain_name, p_type AS indicator_name,
 'C' || CAST(n_nationkey AS VARCHAR) AS country_code, n_name AS country_name, CASE WHEN l_suppkey %% 7 <> 0 THEN r_name END AS admin_region,
 CAST(year(o_orderdate) AS BIGINT) AS period_year,
 CASE WHEN p_size %% 5 <> 0 THEN 'unit_' || CAST(p_size %% 5 AS VARCHAR) END AS unit_name, p_brand AS crop_name, o_orderpriority AS season_name,
 l_linestatus AS practice_name, CASE WHEN p_size %% 3 = 0 THEN 'tech_' || CAST(p_size %% 11 AS VARCHAR) END AS technology_name,
 CASE WHEN p_size %% 4 = 0 THEN 'policy_' || CAST(p_size %% 13 AS VARCHAR) END AS policy_area_name,
 CASE WHEN p_size %% 2 = 0 THEN 'stage_' || CAST(p_size %% 6 AS VARCHAR) END AS value_chain_stage_name,
 CASE WHEN p_size %% 7 = 0 THEN 'shock_' || o_orderstatus END AS shock_type_name,
 CASE WHEN p_size %% 6 = 0 THEN 'phase ' || CAST(p_size %% 5 + 1 AS VARCHAR) END AS ipc_phase_name,
 CASE WHEN p_size %% 6 = 0 THEN CAST(p_size %% 5 + 1 AS BIGINT) END AS ipc_phase_numeric, CAST(l_quantity AS DOUBLE) AS metric_value
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
 JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
""" % (", ".join(f"'{d}'" for d in DOMAINS), len(DOMAINS))


def _sql_key(columns: list[str]) -> str:
    text = lambda c: "CAST(CAST(metric_value AS BIGINT) AS VARCHAR)" if c == "metric_value" else f"CAST({c} AS VARCHAR)"
    return "md5(" + " || '|' || ".join(f"coalesce({text(c)}, '')" for c in columns) + ")"


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, columns in DIMENSIONS.items():
        kept = " OR ".join(f"{c} IS NOT NULL" for c in columns)
        select = (
            "period_year AS period_key, period_year, make_date(period_year, 1, 1) AS start_date" if name == "period"
            else f"{_sql_key(columns)} AS {name}_key, {', '.join(columns)}"
        )
        out[f"star_dim_{name}"] = f"{_STAGING} SELECT DISTINCT {select} FROM stg WHERE {kept}"
    for name, (columns, further) in FACTS.items():
        keys = ", ".join(f"{_sql_key(_KEY_COLUMNS[k])} AS {k}_key" for k in [*COMMON, *further])
        out[f"star_fact_{name}"] = (
            f"{_STAGING} SELECT {_sql_key(columns)} AS fact_{name}_key, period_year AS period_key, {keys}, metric_value AS {name}_value "
            f"FROM stg WHERE domain_name = '{name}'"
        )
    out["star_rollup_by_country_year"] = (
        f"{_STAGING} SELECT country_name, period_year, sum(metric_value) AS production_total, count(*) AS n_rows "
        "FROM stg WHERE domain_name = 'production' GROUP BY country_name, period_year"
    )
    return out
