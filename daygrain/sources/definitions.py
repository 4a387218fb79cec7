"""Typed table definitions over the zones' folders, generated from the declared schemas."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import SparkSession

from daygrain.sinks import files
from daygrain.sources import schemas

ZONES = ("clean", "quarantine")


def defined_tables(zone: str, with_rules: Collection[str]) -> list[str]:
    """All tables have a clean zone; only tables with rules can have rejected rows."""
    return [t for t in schemas.TABLES if zone == "clean" or t in with_rules]


def create_table(
    name: str, zone: str, location: str, with_rules: Collection[str], prefix: str = ""
) -> str:
    """CREATE TABLE statement for one table, partitioned by arrival day."""
    schema = schemas.zone_schema(name, zone, name in with_rules)
    columns = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return (
        f"CREATE TABLE IF NOT EXISTS {prefix}{zone}_{name} (\n  {columns},\n"
        f"  `ingest_dt` string)\nUSING parquet\nPARTITIONED BY (ingest_dt)\n"
        f"LOCATION '{files.join(location, name)}'"
    )


def register_views(
    spark: SparkSession, location: str, zone: str, with_rules: Collection[str]
) -> list[str]:
    """A temporary view per table that has data, typed by its definition; returns their names."""
    made = []
    for name in defined_tables(zone, with_rules):
        path = files.join(location, name)
        if not files.exists(spark, path):
            continue
        schema = schemas.zone_schema(name, zone, name in with_rules).add("ingest_dt", "string")
        spark.read.schema(schema).parquet(path).createOrReplaceTempView(f"{zone}_{name}")
        made.append(f"{zone}_{name}")
    return made
