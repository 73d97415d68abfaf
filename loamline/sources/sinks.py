"""Writers: tables, snapshots, upserts, chunk lines, article files, definitions and catalogues."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loamline.catalog import LAYERS
from loamline.functions.keys import country_slug

#: Column types of the warehouse in a relational database.
SQL_TYPES = {
    "string": "TEXT", "bigint": "BIGINT", "int": "BIGINT", "double": "DOUBLE PRECISION", "float": "DOUBLE PRECISION", "boolean": "BOOLEAN", "timestamp": "TIMESTAMPTZ",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "binary": "BYTEA", "variant": "JSONB",
}


def sql_type(kind: str) -> str:
    """Type of a column in a relational database; nested ones are JSON, unknown ones text."""
    if kind.startswith("decimal"):
        return "NUMERIC"
    return "JSONB" if kind.startswith(("struct", "array", "map")) else SQL_TYPES.get(kind, "TEXT")


def ddl(table: str, schema: StructType) -> str:
    quote = lambda n: '"' + n.replace('"', '""') + '"'
    columns = ",\n  ".join(f"{quote(f.name)} {sql_type(f.dataType.simpleString())}" for f in schema)
    return f"CREATE TABLE IF NOT EXISTS {quote(table)} (\n  {columns}\n);"


def materialise(df: DataFrame, name: str, kind: str, path: str | None = None) -> None:
    """A model as a table (rebuilt whole) or as a view."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    else:
        writer = df.write.mode("overwrite")
        (writer.option("path", path) if path else writer).saveAsTable(name)


def write_chunks(df: DataFrame, path: str, append: bool = False) -> None:
    """``id, text, metadata`` as JSON lines."""
    df.select("id", "text", "metadata").write.mode("append" if append else "overwrite").json(path)


def write_articles(df: DataFrame, path: str, today: datetime | None = None) -> None:
    """Articles by country and year, one line of JSON each; a missing year is the current one (UTC)."""
    year = F.coalesce(F.year(F.col("published_at").try_cast("date")), F.lit((today or datetime.now(UTC)).year))
    df.withColumns({"country_slug": country_slug("country"), "year": year}).write.mode("overwrite").partitionBy("country_slug", "year").json(path)


def upsert(old: DataFrame | None, new: DataFrame, key: str, version: str, ignore: list[str] | None = None) -> DataFrame:
    """Old and new points, the latest version of each key; writing the same batch twice changes nothing. Ties are broken by the
    other columns, those in ``ignore`` (maps, which have no order) aside."""
    every = new if old is None else old.unionByName(new, allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy(F.desc(version), F.xxhash64(*[c for c in every.columns if c != key and c not in (ignore or [])]))
    return every.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")


class Snapshots:
    """A table kept as dated directories: written whole, read as of an instant, restored."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _versions(self) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        return sorted(s.getPath().getName()[3:] for s in fs.listStatus(path) if s.getPath().getName().startswith("at="))

    def write(self, df: DataFrame, at: datetime) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/at={at:%Y%m%dT%H%M%S}")

    def as_of(self, at: datetime) -> DataFrame | None:
        """The last snapshot not after the instant; None where there is none."""
        known = [v for v in self._versions() if v <= f"{at:%Y%m%dT%H%M%S}"]
        return self.spark.read.parquet(f"{self.root}/at={known[-1]}") if known else None


    def restore(self, at: datetime, to: datetime) -> bool:
        """Writes the snapshot of an instant as a new one; whether there was one (a missing one is skipped)."""
        old = self.as_of(at)
        if old is not None:
            self.write(old, to)
        return old is not None


def restore_all(spark: SparkSession, roots: list[str], at: datetime, to: datetime) -> dict[str, bool]:
    """Tables as they were at an instant; those without a snapshot of it are skipped and named."""
    return {root: Snapshots(spark, root).restore(at, to) for root in roots}


def source_definitions(tables: dict[str, dict[str, list[tuple[str, str, bool]]]], order: list[str] = list(LAYERS)) -> str:
    """Source definitions of layers as YAML: ``{layer: {table: [(column, type, nullable)]}}``; known layers first, then by name."""
    quote = lambda x: '"' + str(x).replace("\\", "\\\\").replace('"', '\\"') + '"'
    lines = ["version: 2", "", "sources:"]
    for layer in [*[x for x in order if x in tables], *sorted(set(tables) - set(order))]:
        lines += [f"  - name: {quote(layer)}", f"    schema: {quote(LAYERS.get(layer, layer))}", "    tables:"]
        for table, columns in tables[layer].items() or {"_placeholder": []}.items():
            lines.append(f"      - name: {quote(table)}")
            if columns:
                lines.append("        columns:")
            for name, kind, nullable in columns:
                lines += [f"          - name: {quote(name)}", f"            description: {quote(kind + (' (NULLABLE)' if nullable else ' (REQUIRED)'))}"]
    return "\n".join(lines)


def model_text(layer: str, table: str) -> str:
    """The model that takes a source over as it is."""
    return f"{{{{ config(materialized='table') }}}}\n\nselect *\nfrom {{{{ source('{layer}', '{table}') }}}}\n"


def catalogue(spark: SparkSession, database: str) -> str:
    """Tables and columns of a database as Markdown."""
    lines = [f"# {database}"]
    for t in spark.catalog.listTables(database):
        lines += [f"\n## {t.name}\n", "| column | type |", "|---|---|", *[f"| {c.name} | {c.dataType} |" for c in spark.catalog.listColumns(f"{database}.{t.name}")]]
    return "\n".join(lines)
