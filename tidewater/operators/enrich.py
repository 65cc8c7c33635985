"""Dimension enrichment: lookup joins and the date-part table function."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.dates import datetime_columns


def lookup_join(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Left lookup join of a fact to a dimension (``FOR SYSTEM_TIME AS OF proctime``).

    Batch form of the processing-time lookup: the dimension as it is now.
    Nothing is counted or hinted: Spark broadcasts a side whose size it knows
    to be under ``spark.sql.autoBroadcastJoinThreshold``, from file sizes when
    planning or from shuffle sizes while running, and shuffles otherwise.
    """
    return fact.join(dim, on=on, how=how)


def with_proctime(df: DataFrame, name: str = "proctime") -> DataFrame:
    """Adds the time of processing (one instant for a whole batch or micro-batch)."""
    return df.withColumn(name, F.current_timestamp())


def with_datetime_parts(df: DataFrame, ts: str, prefix: str) -> DataFrame:
    """``LEFT JOIN LATERAL TABLE(dim_datetime(ts)) ON TRUE``: the function
    is one-row-per-input, so it is nine column expressions on the row.
    A part whose name is already a column (``{prefix}_datetime`` when ``ts``
    is named so) is not repeated."""
    return df.select("*", *datetime_columns(F.col(ts), prefix, skip=df.columns))
