"""Reading the warehouse's input tables.

Every input is Parquet read by path with its own schema; Catalyst prunes
columns and pushes filters into the scan, so adapters below may select
freely without paying for unused columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The input table as a DataFrame, listed anew: files added since the last
    read (a dimension that changes under a stream) are seen."""
    return spark.read.parquet(table_path(sf_dir, name))
