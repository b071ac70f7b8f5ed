"""Named tables: loading, guarding, scanning."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

RESERVED_CATALOGS = ("hive_metastore",)


def load_csv_table(spark: SparkSession, path: str, schema: StructType | str, name: str, location: str | None = None) -> None:
    """Load CSV files with a declared schema into a table, replacing what it held.

    The schema is declared rather than inferred: inference reads the files twice, and codes
    such as ``02116`` must stay text. Malformed rows fail the load.
    """
    frame = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    save_table(frame, name, location)


def save_table(df: DataFrame, name: str, location: str | None = None) -> None:
    """Write ``df`` as a table, replacing what it held."""
    writer = df.write.mode("overwrite")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)


def swap_table(spark: SparkSession, name: str, df: DataFrame) -> None:
    """Replace a table by a frame that may still read it: write under a new name, then rename."""
    mark = uuid.uuid4().hex
    new, old = f"{name}_next_{mark}", f"{name}_last_{mark}"
    df.write.saveAsTable(new)
    if spark.catalog.tableExists(name):
        spark.sql("ALTER TABLE identifier(:a) RENAME TO identifier(:b)", args={"a": name, "b": old})
    spark.sql("ALTER TABLE identifier(:a) RENAME TO identifier(:b)", args={"a": new, "b": name})
    spark.sql("DROP TABLE IF EXISTS identifier(:t)", args={"t": old})


def load_parquet(spark: SparkSession, path: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """Parquet files without the named columns, which the scan then never reads."""
    return spark.read.parquet(path).drop(*drop)


def scan_named(spark: SparkSession, *parts: str) -> DataFrame:
    """A table whose name comes in parts, bound as parameters rather than pasted into SQL text."""
    markers = "||'.'||".join(f":part{i}" for i in range(len(parts)))
    return spark.sql(f"SELECT * FROM identifier({markers})", args={f"part{i}": p for i, p in enumerate(parts)})


def table_is_filled(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and not spark.table(name).isEmpty()


def ensure_tables(spark: SparkSession, names: list[str], load: Callable[[], None]) -> bool:
    """Run ``load`` if any of the tables is missing or empty. True when it ran."""
    if all(table_is_filled(spark, name) for name in names):
        return False
    load()
    return True


def ensure_schema(spark: SparkSession, schema: str, catalog: str = "", reset: bool = False) -> str:
    """Create a schema if absent and use it; ``reset`` first drops it with all it holds.

    In open Spark a catalog is configured, not created, so an unknown one is an error.
    Returns the qualified name in use.
    """
    if catalog in RESERVED_CATALOGS:
        raise ValueError(f"catalog {catalog} is reserved")
    if catalog and catalog != spark.catalog.currentCatalog():
        known = [c.name for c in spark.catalog.listCatalogs()]
        if catalog not in known:
            raise ValueError(f"catalog {catalog} is not configured; known: {known}")
        spark.catalog.setCurrentCatalog(catalog)
    if reset:
        spark.sql("DROP SCHEMA IF EXISTS identifier(:s) CASCADE", args={"s": schema})
    spark.sql("CREATE SCHEMA IF NOT EXISTS identifier(:s)", args={"s": schema})
    spark.catalog.setCurrentDatabase(schema)
    return f"{spark.catalog.currentCatalog()}.{schema}"


def create_chunk_table(spark: SparkSession, name: str, embedding: bool = False, properties: dict[str, str] | None = None) -> None:
    """An empty chunk table, with a vector column if asked for, unless it exists."""
    columns = "id BIGINT, url STRING, content STRING" + (", embedding ARRAY<FLOAT>" if embedding else "")
    spark.sql(f"CREATE TABLE IF NOT EXISTS identifier(:t) ({columns}) USING parquet", args={"t": name})
    if properties:
        pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        spark.sql(f"ALTER TABLE identifier(:t) SET TBLPROPERTIES ({pairs})", args={"t": name})


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows; with ``order``, always the same ones."""
    return (df.orderBy(*order) if order else df).limit(n)


def session_info(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT current_catalog() AS catalog, current_schema() AS schema, current_user() AS user")
