"""Sinks: partition overwrite, append, CSV export, several sinks at once, JDBC.

All writes go through the DataFrame writer, so each task writes its own
files and a failed task is retried by Spark; dynamic partition overwrite
replaces only the partitions present in the data being written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overwrite_partition(df: DataFrame, path: str, values: dict[str, str], fmt: str = "parquet",
                        partition_cols: Sequence[str] | None = None) -> None:
    """``INSERT OVERWRITE t PARTITION (p_day='d') SELECT ...``: replace exactly
    the named partition; all other partitions are kept.  An empty input
    leaves the partition empty, as a static overwrite does."""
    cols = list(partition_cols or values.keys())
    out = df.select(*[c for c in df.columns if c not in values],
                    *[F.lit(v).cast("string").alias(k) for k, v in values.items()])
    if out.isEmpty():  # stops at the first row when there is data
        from tidewater.sources import fs
        sub = "/".join(f"{k}={values[k]}" for k in cols)
        fs.delete(df.sparkSession, f"{path.rstrip('/')}/{sub}")
        return
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*cols).format(fmt).save(path))


def overwrite_partitions(df: DataFrame, path: str, partition_cols: Sequence[str], fmt: str = "parquet") -> None:
    """Dynamic overwrite: replace the partitions present in ``df``.  A first
    load has none to replace and is written straight into place."""
    from tidewater.sources import fs
    with _file_bound(df):
        if not fs.exists(df.sparkSession, path):
            append(df, path, partition_cols, fmt)
        else:
            (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy(*partition_cols).format(fmt).save(path))


@contextmanager
def _file_bound(df: DataFrame):
    """A write of many small partitions costs by the file, not by the byte: for
    its time AQE does not merge small shuffle partitions into one writer."""
    conf, key = df.sparkSession.conf, "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    old = conf.get(key)
    conf.set(key, "1b")
    try:
        yield
    finally:
        conf.set(key, old)


def append(df: DataFrame, path: str, partition_cols: Sequence[str] = (), fmt: str = "parquet") -> None:
    """``INSERT INTO t SELECT ...``."""
    w = df.write.mode("append").format(fmt)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.save(path)


def export_csv(df: DataFrame, path: str, max_records_per_file: int | None = None, sep: str = ",",
               header: bool = False, partition_cols: Sequence[str] = ()) -> None:
    """CSV directory overwrite; files roll by record count (Spark has no
    size- or time-based roll for batch writes)."""
    w = df.write.mode("overwrite").option("sep", sep).option("header", header)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.csv(path)


def stage_table(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet under ``spark.checkpoint.dir`` and return
    the written table: the lineage is cut on shared storage, so a lost
    executor costs a re-read, not a recomputation of the joins behind ``df``."""
    from tidewater.session import scratch_dir
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def multi_sink(df: DataFrame, sinks: Sequence[Callable[[DataFrame], None]], staged: bool = True,
               level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> None:
    """Several inserts from one input as one unit: the input is computed once
    and each sink writes from that copy.  ``staged`` (default) writes the
    copy to shared storage; ``staged=False`` caches it on the executors
    instead (fine for inputs that are cheap to recompute)."""
    if staged:
        copy = stage_table(df, "multi-sink")
        for sink in sinks:
            sink(copy)
        return
    cached = df.persist(level)
    try:
        for sink in sinks:
            sink(cached)
    finally:
        cached.unpersist()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch_size: int = 1000,
               properties: dict | None = None) -> None:
    """Batched JDBC insert; each Spark partition commits its own batches."""
    w = (df.write.format("jdbc").option("url", url).option("dbtable", table)
           .option("batchsize", batch_size).mode(mode))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def show(df: DataFrame, n: int = 20) -> None:
    """Print sink (batch)."""
    df.show(n, truncate=False)
