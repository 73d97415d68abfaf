"""Queries over the air-quality archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.catalog import Sources
from loamline.functions.instants import instant_micros
from loamline.operators.spikes import AIR_QUALITY, SKETCH_BASE, SKETCH_FLOOR, flag_implausible
from loamline.operators.time_grid import OBSERVED, regular_grid


def p5_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly series per sensor: observed, filled and missing hours."""
    readings = Sources(spark, sf_dir).table("nakuru_air_quality_archive")
    return regular_grid(readings, "sensor_id", instant_micros("timestamp"), F.col("pm2_5"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours without a usable reading."""
    return p5_grid(spark, sf_dir).where(F.col("status") != OBSERVED).select(
        "sensor_id", F.date_format("slot", "yyyy-MM-dd HH:mm:ss").alias("slot")
    )


def p6_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every implausible value with its reason."""
    readings = Sources(spark, sf_dir).table("nakuru_air_quality_archive")
    return flag_implausible(readings, "sensor_id", "reading_id", instant_micros("timestamp"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct implausible readings and measures."""
    return p6_flags(spark, sf_dir).select("reading_id", "measure").distinct()


_INSTANT = """CASE WHEN regexp_full_match(t, '[0-9]{1,11}') THEN to_timestamp(CAST(t AS BIGINT)) AT TIME ZONE 'UTC'
 WHEN regexp_full_match(t, '[0-9]{12,14}') THEN to_timestamp(CAST(t AS BIGINT) / 1000.0) AT TIME ZONE 'UTC'
 WHEN regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9:]{8}Z?') THEN TRY_CAST(replace(replace(t, 'T', ' '), 'Z', '') AS TIMESTAMP)
 WHEN regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9:]{8}[+][0-9]{2}:[0-9]{2}') THEN TRY_CAST(substr(t, 1, 19) AS TIMESTAMP) - to_minutes(CAST(substr(t, 21, 2) AS INTEGER) * 60 + CAST(substr(t, 24, 2) AS INTEGER))
 WHEN regexp_full_match(t, '[0-9]{2}[.][0-9]{2}[.][0-9]{4} [0-9:]{8}') THEN TRY_CAST(substr(t, 7, 4) || '-' || substr(t, 4, 2) || '-' || substr(t, 1, 2) || substr(t, 11) AS TIMESTAMP)
 WHEN regexp_full_match(t, '[0-9]{8}T[0-9]{6}Z') THEN TRY_CAST(substr(t, 1, 4) || '-' || substr(t, 5, 2) || '-' || substr(t, 7, 2) || ' ' || substr(t, 10, 2) || ':' || substr(t, 12, 2) || ':' || substr(t, 14, 2) AS TIMESTAMP) END"""
_SLOTS = f"""WITH r AS (SELECT sensor_id, trim(timestamp) AS t, pm2_5 FROM nakuru_air_quality_archive WHERE pm2_5 IS NOT NULL AND NOT isnan(pm2_5)),
 u AS (SELECT sensor_id, date_trunc('hour', {_INSTANT}) AS slot, pm2_5 FROM r), g AS (SELECT sensor_id, slot, avg(pm2_5) AS v, count(*) AS n FROM u WHERE slot >= TIMESTAMP '2021-01-01' GROUP BY 1, 2),
 e AS (SELECT sensor_id, min(slot) AS a, max(slot) AS b FROM g GROUP BY 1), s AS (SELECT sensor_id, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS slot FROM e),
 j AS (SELECT s.sensor_id, s.slot, g.v, g.n FROM s LEFT JOIN g ON s.sensor_id = g.sensor_id AND s.slot = g.slot),
 l AS (SELECT *, last_value(CASE WHEN n IS NOT NULL THEN slot END IGNORE NULLS) OVER w AS last_slot, last_value(v IGNORE NULLS) OVER w AS last_v FROM j
 WINDOW w AS (PARTITION BY sensor_id ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _flags_sql() -> str:
    """Implausible values by windows and lists over whole sources: no blocks, no halos. The quantiles are taken from the same
    logarithmic buckets, since they are the definition of a fence."""
    bounds = ", ".join(f"('{n}', {m.low}, {m.high}, {str(m.ratio).lower()})" for n, m in AIR_QUALITY.items())
    values = " UNION ALL ".join(f"SELECT sensor_id, reading_id, ts, '{n}' AS measure, {n} AS v FROM t WHERE {n} IS NOT NULL AND NOT isnan({n})" for n in AIR_QUALITY)
    near = lambda way: f"list_transform(list_filter({way}, lambda z: abs(z.p - p) <= 256), lambda z: z.x)"
    steps = lambda way, level, fn: " + ".join(
        "CASE WHEN " + " AND ".join(f"coalesce(sign * ({fn}(x, {k}) OVER o - {level}) > size / 2 AND abs({fn}(p, {k}) OVER o - p) <= 256, false)" for k in range(1, i + 1)) + " THEN 1 ELSE 0 END" for i in (1, 2, 3)
    )
    bucket = f"CAST(sign(rest) * ceil(ln(greatest(abs(rest), {SKETCH_FLOOR}) / {SKETCH_FLOOR}) / ln({SKETCH_BASE})) AS INTEGER)"
    size = lambda b: f"(sign({b}) * {SKETCH_FLOOR} * pow({SKETCH_BASE}, abs({b})))"
    return f"""WITH bounds(measure, low, high, ratio) AS (VALUES {bounds}), t AS (SELECT *, {_INSTANT} AS ts FROM (SELECT *, trim(timestamp) AS t FROM nakuru_air_quality_archive) WHERE sensor_id IS NOT NULL AND reading_id IS NOT NULL),
 every AS ({values}), impossible AS (SELECT reading_id, measure FROM every JOIN bounds USING (measure) WHERE v < low OR v > high),
 f AS (SELECT *, CASE WHEN v IS DISTINCT FROM lag(v) OVER w OR ts IS DISTINCT FROM lag(ts) OVER w THEN 1 ELSE 0 END AS fresh FROM every WHERE ts >= TIMESTAMP '2021-01-01' WINDOW w AS (PARTITION BY sensor_id, measure ORDER BY ts, reading_id)),
 g AS (SELECT *, sum(fresh) OVER (PARTITION BY sensor_id, measure ORDER BY ts, reading_id ROWS UNBOUNDED PRECEDING) AS p FROM f),
 s AS (SELECT *, CASE WHEN v IS DISTINCT FROM lag(v) OVER (PARTITION BY sensor_id, measure ORDER BY p) THEN 1 ELSE 0 END AS begins FROM g WHERE fresh = 1),
 r AS (SELECT *, sum(begins) OVER (PARTITION BY sensor_id, measure ORDER BY p ROWS UNBOUNDED PRECEDING) AS run FROM s),
 c AS (SELECT *, count(*) OVER (PARTITION BY sensor_id, measure, run) >= 15 AS stuck FROM r),
 u AS (SELECT c.*, ratio, CASE WHEN ratio THEN ln(least(greatest(v, 0.1), high)) ELSE v END AS x FROM c JOIN bounds USING (measure) WHERE NOT stuck AND v BETWEEN low AND high),
 n AS (SELECT *, list({{'x': x, 'p': p}}) OVER (o ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS l1, list({{'x': x, 'p': p}}) OVER (o ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) AS l2, abs(v - lag(v) OVER o) AS step FROM u WINDOW o AS (PARTITION BY sensor_id, measure ORDER BY p)),
 m AS (SELECT *, {near('coalesce(l1, [])')} AS n1, {near('coalesce(l2, [])')} AS n2 FROM n),
 b AS (SELECT *, CASE WHEN len(n1) >= 3 THEN list_aggregate(n1, 'median') END AS before, CASE WHEN len(n2) >= 3 THEN list_aggregate(n2, 'median') END AS after FROM m),
 d AS (SELECT *, x - (before + after) / 2 AS rest, CASE WHEN x > before AND x > after THEN 1 WHEN x < before AND x < after THEN -1 ELSE 0 END AS sign, least(abs(x - before), abs(x - after)) AS size, list_sort(list_concat(n1, n2)) AS both_, hour(ts) // 6 AS context FROM b),
 e AS (SELECT *, 1 + {steps('l', 'before', 'lag')} + {steps('r', 'after', 'lead')} AS length FROM d WINDOW o AS (PARTITION BY sensor_id, measure ORDER BY p)),
 q0 AS (SELECT sensor_id, measure, context, {bucket} AS bucket FROM d WHERE rest IS NOT NULL), q1 AS (SELECT sensor_id, measure, unnest([context, -1]) AS context, bucket FROM q0),
 q2 AS (SELECT *, count(*) AS k FROM q1 GROUP BY ALL), q3 AS (SELECT *, sum(k) OVER (PARTITION BY sensor_id, measure, context ORDER BY bucket) AS upto, sum(k) OVER (PARTITION BY sensor_id, measure, context) AS total FROM q2),
 q4 AS (SELECT sensor_id, measure, context, max(total) AS total, min(bucket) FILTER (WHERE upto >= 0.25 * total) AS b1, min(bucket) FILTER (WHERE upto >= 0.75 * total) AS b3 FROM q3 GROUP BY ALL),
 fence AS (SELECT a.sensor_id, a.measure, a.context, {size('CASE WHEN a.total >= 40 THEN a.b1 ELSE w.b1 END')} AS q1, {size('CASE WHEN a.total >= 40 THEN a.b3 ELSE w.b3 END')} AS q3 FROM q4 a JOIN q4 w ON a.sensor_id = w.sensor_id AND a.measure = w.measure AND w.context = -1),
 coarse AS (SELECT sensor_id, measure, min(step) FILTER (WHERE step > 0.0000005) AS step FROM n GROUP BY ALL),
 spike AS (SELECT e.sensor_id, e.measure, e.p FROM e JOIN fence USING (sensor_id, measure, context) JOIN coarse ON coarse.sensor_id = e.sensor_id AND coarse.measure = e.measure WHERE sign <> 0 AND length <= 3
 AND size > both_[CAST(ceil(0.75 * (len(both_) - 1)) AS INTEGER) + 1] - both_[CAST(floor(0.25 * (len(both_) - 1)) AS INTEGER) + 1] AND size > CASE WHEN sign > 0 THEN q3 ELSE -q1 END + 3 * (q3 - q1)
 AND abs(v - CASE WHEN ratio THEN exp(CASE WHEN sign > 0 THEN greatest(before, after) ELSE least(before, after) END) ELSE CASE WHEN sign > 0 THEN greatest(before, after) ELSE least(before, after) END END) > 3 * coalesce(coarse.step, 0)),
 z AS (SELECT reading_id, measure, 'impossible' AS reason FROM impossible UNION ALL SELECT reading_id, measure, 'spike' FROM g JOIN spike USING (sensor_id, measure, p) UNION ALL SELECT g.reading_id, g.measure, 'stuck' FROM g JOIN c ON g.sensor_id = c.sensor_id AND g.measure = c.measure AND g.p = c.p WHERE stuck)"""


def oracle_sql() -> dict[str, str]:
    near = "slot - last_slot <= INTERVAL 3 HOUR"
    return {
        "p6_flags": f"{_flags_sql()} SELECT reading_id, measure, reason FROM z",
        "p6_found": f"{_flags_sql()} SELECT DISTINCT reading_id, measure FROM z",
        "p5_grid": (
            f"{_SLOTS} SELECT sensor_id, slot, CASE WHEN {near} THEN last_v END AS value, coalesce(n, 0) AS n_readings, "
            f"CASE WHEN n IS NOT NULL THEN 'observed' WHEN {near} THEN 'filled' ELSE 'missing' END AS status FROM l"
        ),
        "p5_found": f"{_SLOTS} SELECT sensor_id, strftime(slot, '%Y-%m-%d %H:%M:%S') AS slot FROM j WHERE n IS NULL",
    }
