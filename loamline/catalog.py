"""Sources by name and the layer-to-database mapping of the medallion layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: The warehouse layers.
LAYERS = {"landing": "landing", "raw": "raw_dev", "staging": "staging_dev", "mart": "mart_dev"}


class Sources:
    """Lazy tables of one directory of Parquet files; column pruning and pushdown stay with Catalyst."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    __getattr__ = table


def route_schema(custom: str | None, target: str) -> str:
    """Database a model is written to: its own schema verbatim if it has one, else the target's."""
    return custom.strip() if custom and custom.strip() else target
