"""Irregular readings onto a regular grid per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.session import cut_lineage

OBSERVED, FILLED, MISSING = "observed", "filled", "missing"


def regular_grid(
    readings: DataFrame,
    source: str,
    micros: Column,
    value: Column,
    *,
    step_seconds: int = 3600,
    max_gap_steps: int = 3,
    not_before: str = "2021-01-01T00:00:00Z",
) -> DataFrame:
    """One row per source and step from the source's first usable reading to its last.

    Returns ``(source, slot timestamp, value, n_readings, status)``: ``observed`` steps carry the mean of their readings,
    ``filled`` ones the last observation if it is at most ``max_gap_steps`` back, ``missing`` ones null.

    Usable: ``micros`` (microseconds since 1970) is not null and not before ``not_before``; ``value`` is neither null nor NaN
    and the source is not null. Sources without a usable reading, and an empty table, give no rows. Repeated rows and ties
    fall into the same step and are averaged. Other columns are ignored, whatever their names.

    Plan: readings are pre-aggregated to (source, step) before any shuffle, so a hot source shrinks to one row per step. The
    sequence of steps comes from each source's two end points; it and the aggregate meet on (source, step), a key that spreads
    a hot source over all tasks. The one window per source then sees steps, not readings.
    """
    step = step_seconds * 1_000_000
    usable = readings.select(F.col(source).alias("_s"), micros.alias("_m"), value.cast("double").alias("_v")).where(
        F.col("_s").isNotNull() & F.col("_v").isNotNull() & ~F.isnan("_v")
    )
    # early and missing instants leave in the aggregate: a filter would be pushed below the projection and parse them twice
    kept = F.when(F.col("_m") >= F.unix_micros(F.lit(not_before).cast("timestamp")), F.col("_v"))
    seen = cut_lineage(  # both the ends and the join read it: one row per source and step, so that readings are parsed once
        usable.groupBy("_s", F.expr(f"_m div {step}").alias("_k")).agg(F.avg(kept).alias("_v"), F.count(kept).alias("_n")).where(F.col("_n") > 0)
    )
    ends = seen.groupBy("_s").agg(F.min("_k").alias("_a"), F.max("_k").alias("_b"))
    grid = ends.select("_s", F.explode(F.sequence("_a", "_b")).alias("_k"))
    joined = grid.join(seen, ["_s", "_k"], "left")
    back = Window.partitionBy("_s").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("_n").isNotNull(), F.struct("_k", "_v")), ignorenulls=True).over(back)
    joined = joined.withColumn("_last", last)
    near = (F.col("_k") - F.col("_last._k")) <= max_gap_steps
    return joined.select(
        F.col("_s").alias(source),
        F.timestamp_micros(F.col("_k") * step).alias("slot"),
        F.when(near, F.col("_last._v")).alias("value"),
        F.coalesce("_n", F.lit(0)).alias("n_readings"),
        F.when(F.col("_n").isNotNull(), OBSERVED).when(near, FILLED).otherwise(MISSING).alias("status"),
    )
