"""Table DDL through Spark SQL: drop, partitioned create, clone-like.

Tables created here live in the session catalog; with a Hive metastore
configured the same statements create metastore tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


def _cols(schema: StructType, skip=()) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in skip)


def create_partitioned_table(spark: SparkSession, name: str, schema: StructType, partition_cols: Sequence[str],
                             fmt: str = "parquet", location: str | None = None, properties: dict | None = None,
                             options: dict | None = None, replace: bool = True) -> None:
    """``DROP TABLE IF EXISTS`` + ``CREATE TABLE ... USING fmt PARTITIONED BY (...)``
    with table properties (e.g. partition-commit settings) and format options
    (e.g. ``sep`` for a delimited text table)."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    ddl = f"CREATE TABLE {name} ({_cols(schema)}) USING {fmt}"
    if options:
        ddl += " OPTIONS (" + ", ".join(f"'{k}' '{v}'" for k, v in options.items()) + ")"
    if partition_cols:
        ddl += f" PARTITIONED BY ({', '.join(partition_cols)})"
    if location:
        ddl += f" LOCATION '{location}'"
    if properties:
        ddl += " TBLPROPERTIES (" + ", ".join(f"'{k}' = '{v}'" for k, v in properties.items()) + ")"
    spark.sql(ddl)


def create_table_like(spark: SparkSession, name: str, source: str, fmt: str | None = None,
                      location: str | None = None) -> None:
    """``CREATE TABLE name LIKE source``: the columns only, not the source's options."""
    ddl = f"CREATE TABLE {name} LIKE {source}"
    if fmt:
        ddl += f" USING {fmt}"
    if location:
        ddl += f" LOCATION '{location}'"
    spark.sql(ddl)
