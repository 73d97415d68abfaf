"""Relational databases and CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """CSV with a header and a stated schema: nothing is read twice to guess types; cells that do not fit are null."""
    return spark.read.csv(path, header=True, schema=schema, mode="PERMISSIVE", multiLine=False)


def read_table(spark: SparkSession, url: str, table: str, *, properties: dict[str, str] | None = None, split: tuple[str, int, int, int] | None = None) -> DataFrame:
    """A table of a database over JDBC; filters and columns are pushed down. split: ``(column, lower, upper, partitions)``, so that
    many tasks read a large table; without it one task does."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(properties or {}))
    if split:
        column, lower, upper, n = split
        reader = reader.option("partitionColumn", column).option("lowerBound", lower).option("upperBound", upper).option("numPartitions", n)
    return reader.load()


def overwrite_table(df: DataFrame, url: str, table: str, *, properties: dict[str, str] | None = None, schema: str | None = None, connections: int = 8) -> None:
    """Replaces a table of a database; with ``schema`` (PostgreSQL only) it is created where missing. At most ``connections``
    tasks write at once."""
    properties = dict(properties or {})
    if schema and url.startswith("jdbc:postgresql"):
        connection = df.sparkSession._jvm.java.sql.DriverManager.getConnection(url, properties.get("user"), properties.get("password"))
        try:
            connection.createStatement().execute('CREATE SCHEMA IF NOT EXISTS "' + schema.replace('"', '""') + '"')
        finally:
            connection.close()
        table = f'"{schema}".{table}'
    df.write.format("jdbc").mode("overwrite").option("url", url).option("dbtable", table).option("numPartitions", connections).options(**properties).save()
