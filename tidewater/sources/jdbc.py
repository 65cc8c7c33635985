"""JDBC sources (key-value SQL stores, relational databases).

These are the DataFrame reader's JDBC options; a driver jar for the store
must be on the classpath.  Large tables are read in parallel ranges of a
numeric column (``partition_column``), never through one connection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidewater.functions.casts import schema_cast
from tidewater.functions.strings import lowercase_columns


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, fetch_size: int = 10_000,
              custom_schema: str | None = None, properties: dict | None = None) -> DataFrame:
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size)
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    r = r.option("dbtable", table) if table is not None else r.option("query", query)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
              .option("upperBound", upper_bound).option("numPartitions", num_partitions))
    if custom_schema:  # e.g. map NUMBER -> DECIMAL(38,10), DATE -> TIMESTAMP
        r = r.option("customSchema", custom_schema)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()


def read_jdbc_typed(spark: SparkSession, url: str, query: str, target: StructType, **kw) -> DataFrame:
    """Query -> column names lower-cased -> cast to the target schema."""
    return schema_cast(lowercase_columns(read_jdbc(spark, url, query=query, **kw)), target)


def jdbc_view(spark: SparkSession, name: str, url: str, table: str, properties: dict | None = None) -> None:
    """``CREATE TEMPORARY VIEW name USING jdbc OPTIONS (...)`` (a DDL-declared JDBC table)."""
    opts = {"url": url, "dbtable": table, **(properties or {})}
    body = ", ".join(f"{k} '{v}'" for k, v in opts.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} USING jdbc OPTIONS ({body})")
