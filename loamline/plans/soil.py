"""Grids, wide tables and joins of the land and soil models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.catalog import Sources
from loamline.functions.geo import MERCATOR_LIMIT, grid, latitude_of, longitude_of
from loamline.operators.places import nearest

YEARS = list(range(1992, 1999))
_ITEMS = ["Agricultural land", "Fertilizers by nutrient", "Pesticides use", "Other"]
_PROPERTIES = ["carbon_organic", "nitrogen_total", "ph", "phosphorus_extractable", "clay"]


def isda_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Soil points in Web Mercator metres, made from customers."""
    c = Sources(spark, sf_dir).table("customer").select("c_custkey", "c_acctbal")
    key = F.col("c_custkey")
    return c.select(
        F.when(key % 41 != 0, ((key * 104_729) % 6_000_000 - 3_000_000 + F.when(key % 43 == 0, 30_000_000).otherwise(0)).cast("double")).alias("y"),
        ((key * 7_919) % 4_000_000 - 2_000_000).cast("double").alias("x"),
        F.element_at(F.array(*[F.lit(p) for p in _PROPERTIES]), (key % 5 + 1).cast("int")).alias("property"),
        F.when(key % 37 != 0, F.col("c_acctbal")).alias("value"), key.alias("key"),
    )


def isric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Soil points in degrees: a third of the same places, and others made from suppliers."""
    a = isda_points(spark, sf_dir).where(F.col("key") % 3 == 0).select(
        latitude_of(F.col("y")).alias("latitude"), longitude_of(F.col("x")).alias("longitude"), F.col("value").alias("soc"), (F.col("key") % 9).cast("double").alias("phh2o")
    )
    s = Sources(spark, sf_dir).table("supplier").select("s_suppkey", "s_acctbal")
    b = s.select(
        ((F.col("s_suppkey") * 31 % 6000 - 3000) / 100 + 0.001).alias("latitude"), ((F.col("s_suppkey") * 17 % 9000 - 4500) / 100 + 0.001).alias("longitude"),
        F.col("s_acctbal").alias("soc"), (F.col("s_suppkey") % 9).cast("double").alias("phh2o"),
    )
    return a.union(b)


def grid_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two soil sources on one grid of rounded degrees: aggregated each on its own, then full outer joined on the cell."""
    limit = MERCATOR_LIMIT
    isda = isda_points(spark, sf_dir).where(F.col("y").isNotNull() & F.col("value").isNotNull() & F.col("y").between(-limit, limit) & F.col("x").between(-limit, limit))
    isda = isda.select(grid(latitude_of(F.col("y"))).alias("lat_2"), grid(longitude_of(F.col("x"))).alias("lon_2"), F.lower("property").alias("p"), "value")
    mean = lambda cond: F.avg(F.when(cond, F.col("value")))
    isda = isda.groupBy("lat_2", "lon_2").agg(
        F.count(F.lit(1)).alias("isda_points"), F.round(F.avg("value"), 6).alias("isda_avg_value_all"), F.round(mean(F.col("p").like("%carbon%")), 6).alias("isda_avg_carbon"),
        F.round(mean(F.col("p").like("%nitrogen%")), 6).alias("isda_avg_nitrogen"),
        F.round(mean(F.col("p").isin("ph", "phh2o") | F.col("p").like("%ph%")), 6).alias("isda_avg_ph"),
    )
    isric = isric_points(spark, sf_dir).where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    isric = isric.groupBy(grid(F.col("latitude")).alias("lat_2"), grid(F.col("longitude")).alias("lon_2")).agg(
        F.count(F.lit(1)).alias("isric_points"), F.round(F.avg("soc"), 6).alias("isric_avg_soc"), F.round(F.avg("phh2o"), 6).alias("isric_avg_ph")
    )
    return isda.join(isric, ["lat_2", "lon_2"], "full_outer").withColumns({"lat_2": F.col("lat_2").cast("double"), "lon_2": F.col("lon_2").cast("double")})


def fao_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide table, one column per year; code 3 has two names."""
    at = Sources(spark, sf_dir)
    lines = at.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag").join(at.table("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    lines = lines.join(at.table("orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    lines = lines.join(at.table("nation").select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"))
    item = F.element_at(F.array(*[F.lit(x) for x in _ITEMS]), (F.col("l_partkey") % 4 + 1).cast("int"))
    name = F.when((F.col("n_nationkey") == 3) & (F.col("l_suppkey") % 2 == 0), F.lit("NATION_3 (old)")).otherwise(F.col("n_name"))
    year = F.year("o_orderdate")
    return lines.groupBy(F.col("n_nationkey").alias("area_code"), name.alias("area"), item.alias("item"), F.col("l_returnflag").alias("element")).agg(
        *[F.sum(F.when(year == y, F.col("l_quantity"))).alias(f"y{y}") for y in YEARS]
    )


def unpivot_years(wide: DataFrame, ids: list[str], columns: list[str]) -> DataFrame:
    """Long form of year columns ``y1961 ...``: ids, year, metric_value; null values are left out."""
    long = wide.unpivot(ids, columns, "year_label", "metric_value").where(F.col("metric_value").isNotNull())
    return long.withColumn("year", F.regexp_replace("year_label", "^y", "").cast("long")).drop("year_label")


def unpivot_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = unpivot_years(fao_wide(spark, sf_dir), ["area_code", "area", "item", "element"], [f"y{y}" for y in YEARS])
    return long.select("area_code", "area", "item", "element", "year", F.col("metric_value").cast("double").alias("metric_value"))


def land_use_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country-years with three totals by pattern, left joined on code and year, and one row of soil averages on every row.

    Totals are grouped by code, name and year but joined on code and year: a code with two names fans out.
    """
    long = unpivot_years(fao_wide(spark, sf_dir), ["area_code", "area", "item", "element"], [f"y{y}" for y in YEARS]).select(
        F.col("area_code").cast("string").alias("country_code"), F.col("area").alias("country_name"), "year", F.lower(F.coalesce("item", F.lit(""))).alias("i"),
        F.lower(F.coalesce("element", F.lit(""))).alias("e"), F.col("metric_value").cast("double").alias("v"),
    )

    def total(pattern: str, out: str) -> DataFrame:
        hit = F.col("i").rlike(pattern) | F.col("e").rlike(pattern)
        return long.where(hit).groupBy("country_code", "country_name", "year").agg(F.sum("v").alias(out)).drop("country_name")

    base = long.select("country_code", "country_name", "year").distinct()
    for pattern, out in (("land", "land_use_value_sum"), ("fertili", "fertilizer_value_sum"), ("pesticide", "pesticide_value_sum")):
        base = base.join(total(pattern, out), ["country_code", "year"], "left")
    soil = grid_full_outer(spark, sf_dir).agg(F.round(F.avg("isda_avg_value_all"), 4).alias("soil_avg_value"), F.round(F.avg("isric_avg_soc"), 4).alias("soil_avg_soc"), F.count(F.lit(1)).alias("soil_cells"))
    return base.crossJoin(F.broadcast(soil))  # one row


def yield_change_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range and mean of a measure per country since a year, the 20 largest."""
    long = unpivot_years(fao_wide(spark, sf_dir), ["area_code", "area", "item", "element"], [f"y{y}" for y in YEARS])
    return (
        long.where((F.col("year") >= 1994) & F.col("metric_value").isNotNull()).groupBy(F.col("area").alias("country"))
        .agg((F.max("metric_value") - F.min("metric_value")).cast("double").alias("yield_change"), F.round(F.avg("metric_value"), 4).cast("double").alias("avg_yield"), F.count(F.lit(1)).alias("n_obs"))
        .orderBy(F.desc("yield_change"), "country").limit(20)
    )


def partition_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filtered, limited scan: the filter prunes, the limit is the feature."""
    return Sources(spark, sf_dir).table("orders").where("o_orderstatus = 'F' and o_totalprice > 1000").orderBy("o_orderkey").limit(1000).select("o_orderkey", "o_custkey", "o_totalprice")


def nearest_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest supplier place of every customer place, planar degrees; ties go to the lower key.

    The supplier places are sent to the tasks as a tree of boxes, in blocks of bounded size; no pairs are shuffled.
    """
    return nearest(
        Sources(spark, sf_dir).table("customer").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") * 37 % 6000 / 100 - 30).alias("lat"), (F.col("c_custkey") * 53 % 9000 / 100 - 45).alias("lon")),
        Sources(spark, sf_dir).table("supplier").select(F.col("s_suppkey").alias("site"), ((F.col("s_suppkey") * 31 % 6000) / 100 - 30).alias("lat"), ((F.col("s_suppkey") * 17 % 9000) / 100 - 45).alias("lon")),
    )


def queries() -> dict:
    return {
        "grid_full_outer": grid_full_outer, "unpivot_measures": unpivot_measures, "land_use_join": land_use_join, "yield_change_topk": yield_change_topk,
        "partition_sample": partition_sample, "nearest_site": nearest_site,
    }


_ISDA = """isda_raw AS (SELECT CASE WHEN c_custkey % 41 <> 0 THEN CAST((c_custkey * 104729) % 6000000 - 3000000 + CASE WHEN c_custkey % 43 = 0 THEN 30000000 ELSE 0 END AS DOUBLE) END AS y,
 CAST((c_custkey * 7919) % 4000000 - 2000000 AS DOUBLE) AS x, (ARRAY['carbon_organic','nitrogen_total','ph','phosphorus_extractable','clay'])[CAST(c_custkey % 5 + 1 AS INTEGER)] AS property,
 CASE WHEN c_custkey % 37 <> 0 THEN c_acctbal END AS value, c_custkey AS key FROM customer)"""
_GRID = f"""WITH {_ISDA}, isda AS (SELECT round(CAST(atan(sinh(y / 6378137.0)) * 180.0 / pi() AS DECIMAL(38,9)), 2) AS lat_2, round(CAST(x / 6378137.0 * 180.0 / pi() AS DECIMAL(38,9)), 2) AS lon_2,
 lower(property) AS p, value FROM isda_raw WHERE y IS NOT NULL AND value IS NOT NULL AND y BETWEEN -20037508.34 AND 20037508.34 AND x BETWEEN -20037508.34 AND 20037508.34),
 a AS (SELECT lat_2, lon_2, count(*) AS isda_points, round(avg(value), 6) AS isda_avg_value_all, round(avg(CASE WHEN p LIKE '%carbon%' THEN value END), 6) AS isda_avg_carbon,
 round(avg(CASE WHEN p LIKE '%nitrogen%' THEN value END), 6) AS isda_avg_nitrogen, round(avg(CASE WHEN p IN ('ph','phh2o') OR p LIKE '%ph%' THEN value END), 6) AS isda_avg_ph FROM isda GROUP BY 1, 2),
 isric AS (SELECT atan(sinh(y / 6378137.0)) * 180.0 / pi() AS latitude, x / 6378137.0 * 180.0 / pi() AS longitude, value AS soc, CAST(key % 9 AS DOUBLE) AS phh2o FROM isda_raw WHERE key % 3 = 0
 UNION ALL SELECT (s_suppkey * 31 % 6000 - 3000) / 100 + 0.001, (s_suppkey * 17 % 9000 - 4500) / 100 + 0.001, s_acctbal, CAST(s_suppkey % 9 AS DOUBLE) FROM supplier),
 b AS (SELECT round(CAST(latitude AS DECIMAL(38,9)), 2) AS lat_2, round(CAST(longitude AS DECIMAL(38,9)), 2) AS lon_2, count(*) AS isric_points, round(avg(soc), 6) AS isric_avg_soc,
 round(avg(phh2o), 6) AS isric_avg_ph FROM isric WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2),
 g AS (SELECT CAST(coalesce(a.lat_2, b.lat_2) AS DOUBLE) AS lat_2, CAST(coalesce(a.lon_2, b.lon_2) AS DOUBLE) AS lon_2, isda_points, isda_avg_value_all, isda_avg_carbon, isda_avg_nitrogen, isda_avg_ph,
 isric_points, isric_avg_soc, isric_avg_ph FROM a FULL OUTER JOIN b ON a.lat_2 = b.lat_2 AND a.lon_2 = b.lon_2)"""
_WIDE = (
    "wide AS (SELECT n_nationkey AS area_code, CASE WHEN n_nationkey = 3 AND l_suppkey % 2 = 0 THEN 'NATION_3 (old)' ELSE n_name END AS area, "
    "(ARRAY['Agricultural land','Fertilizers by nutrient','Pesticides use','Other'])[CAST(l_partkey % 4 + 1 AS INTEGER)] AS item, l_returnflag AS element, "
    + ", ".join(f"sum(CASE WHEN year(o_orderdate) = {y} THEN l_quantity END) AS y{y}" for y in YEARS)
    + " FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2, 3, 4)"
)
_LONG = (
    "long AS (SELECT area_code, area, item, element, CAST(replace(year_label, 'y', '') AS BIGINT) AS year, CAST(metric_value AS DOUBLE) AS metric_value FROM "
    f"(UNPIVOT wide ON {', '.join(f'y{y}' for y in YEARS)} INTO NAME year_label VALUE metric_value))"
)


def oracle_sql() -> dict[str, str]:
    total = lambda p, out: (
        f"(SELECT CAST(area_code AS VARCHAR) AS cc, area, year AS yy, sum(metric_value) AS {out} FROM long WHERE lower(item) LIKE '%{p}%' OR lower(element) LIKE '%{p}%' GROUP BY 1, 2, 3)"
    )
    return {
        "grid_full_outer": f"{_GRID} SELECT * FROM g",
        "unpivot_measures": f"WITH {_WIDE}, {_LONG} SELECT area_code, area, item, element, year, metric_value FROM long",
        "land_use_join": (
            f"{_GRID}, {_WIDE}, {_LONG}, base AS (SELECT DISTINCT CAST(area_code AS VARCHAR) AS country_code, area AS country_name, year FROM long), "
            "soil AS (SELECT round(avg(isda_avg_value_all), 4) AS soil_avg_value, round(avg(isric_avg_soc), 4) AS soil_avg_soc, count(*) AS soil_cells FROM g) "
            "SELECT country_code, country_name, year, land_use_value_sum, fertilizer_value_sum, pesticide_value_sum, soil_avg_value, soil_avg_soc, soil_cells FROM base "
            f"LEFT JOIN {total('land', 'land_use_value_sum')} l ON l.cc = country_code AND l.yy = year LEFT JOIN {total('fertili', 'fertilizer_value_sum')} f ON f.cc = country_code AND f.yy = year "
            f"LEFT JOIN {total('pesticide', 'pesticide_value_sum')} p ON p.cc = country_code AND p.yy = year CROSS JOIN soil"
        ),
        "yield_change_topk": (
            f"WITH {_WIDE}, {_LONG} SELECT area AS country, max(metric_value) - min(metric_value) AS yield_change, round(avg(metric_value), 4) AS avg_yield, count(*) AS n_obs "
            "FROM long WHERE year >= 1994 GROUP BY area ORDER BY yield_change DESC, country LIMIT 20"
        ),
        "partition_sample": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000 ORDER BY o_orderkey LIMIT 1000",
        "nearest_site": (
            "WITH p AS (SELECT c_custkey AS id, (c_custkey * 37 % 6000) / 100 - 30 AS lat, (c_custkey * 53 % 9000) / 100 - 45 AS lon FROM customer), "
            "s AS (SELECT s_suppkey AS site, (s_suppkey * 31 % 6000) / 100 - 30 AS lat, (s_suppkey * 17 % 9000) / 100 - 45 AS lon FROM supplier), "
            "x AS (SELECT id, site, sqrt(pow(p.lat - s.lat, 2) + pow(p.lon - s.lon, 2)) AS distance, row_number() OVER (PARTITION BY id ORDER BY pow(p.lat - s.lat, 2) + pow(p.lon - s.lon, 2), site) AS r FROM p, s) "
            "SELECT id, site, distance FROM x WHERE r = 1"
        ),
    }
