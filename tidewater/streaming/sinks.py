"""Plain stream sinks: console (print) and rolling files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def console(df: DataFrame, mode: str = "append", truncate: bool = False, trigger: str | None = None):
    """``.print()`` / print connector: rows of each micro-batch to stdout."""
    w = df.writeStream.format("console").outputMode(mode).option("truncate", truncate)
    if trigger:
        w = w.trigger(processingTime=trigger)
    return w


def rolling_files(df: DataFrame, path: str, partition_cols: Sequence[str] = (), fmt: str = "parquet",
                  roll_records: int | None = None, rollover_interval: str | None = "2 minutes"):
    """Exactly-once file sink.  Files roll per micro-batch (the trigger
    interval) and by record count; Spark has no size-based roll."""
    w = df.writeStream.format(fmt).option("path", path)
    if roll_records:
        w = w.option("maxRecordsPerFile", roll_records)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if rollover_interval:
        w = w.trigger(processingTime=rollover_interval)
    return w
