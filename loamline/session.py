"""Session helpers: one place for the settings every plan relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings the engine assumes. ANSI mode and adaptive execution are Spark's own defaults; UTC is not.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "loamline", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the engine's defaults; ``extra`` uses underscores for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("_", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared ``spark.checkpoint.dir``; only where it is unset (tests) fall back to a local folder."""
    if spark.sparkContext.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = "file://" + os.path.join(tempfile.gettempdir(), "loamline-checkpoints")
    spark.sparkContext.setCheckpointDir(shared)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared checkpoint folder, so that it is neither recomputed nor lost with an executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_within(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else as it is, for the planner to join by shuffle. For
    materialised tables of narrow rows, whose count costs little."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
