"""Keyed upsert on plain Parquet: the new row replaces the old one for its key.

Parquet has no MERGE, so an upsert is: read the buckets of the target that the
updates touch, union the updates, keep the newest row per key (an update beats
a stored row; among several updates of one key ``order`` decides), drop keys
whose newest row is a delete, write the result to a staging folder, then swap
it in with a dynamic partition overwrite.

The table is partitioned by a bucket of the key, which never changes for a key,
so a correction that moves a row to another day still replaces it.  A target
that cannot be read, or whose columns differ from the updates', fails the
upsert and is left as it was.  Re-running the same upsert gives the same table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewater.operators.cdc import OP_DELETE
from tidewater.session import scratch_dir
from tidewater.sources import fs

BUCKET = "_bucket"
_NEW = "_is_update"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Exactly one row per key: the one with the greatest ``order`` tuple.

    ``max_by`` over a struct aggregates partially before the shuffle, so a key
    with millions of versions sends one row per map task, not all of them.
    ``order`` should end in a unique column so the winner is deterministic.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(best.alias("_latest")).select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in rest])


def without_deletes(df: DataFrame, op_col: str = "data_op_type") -> DataFrame:
    return df.where(F.col(op_col).isNull() | (F.col(op_col) != OP_DELETE))


def upsert(spark: SparkSession, target: str, updates: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
           op_col: str | None = "data_op_type", buckets: int = 64) -> str:
    """Merge ``updates`` into the Parquet table at ``target`` and return its path.

    ``buckets`` is fixed when the table is made: every later upsert must name
    the same number.  The lists collected here hold bucket numbers only.
    """
    target = target.rstrip("/")
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string")
    stage = scratch_dir(spark, "upsert-stage")
    # the updates are computed once; what follows reads them from the stage
    new = updates.withColumn(BUCKET, bucket)
    new.write.parquet(f"{stage}/updates")
    new = spark.read.schema(new.schema).parquet(f"{stage}/updates")
    touched = [r[0] for r in new.select(BUCKET).distinct().collect()]       # at most ``buckets`` values
    merged = new.withColumn(_NEW, F.lit(1))
    if fs.exists(spark, target):
        stored = spark.read.parquet(target)
        if sorted(stored.columns) != sorted(new.columns):
            raise ValueError(f"columns of {target} and of the updates differ: {sorted(set(stored.columns) ^ set(new.columns))}")
        old = stored.select(*[F.col(c).cast(t.dataType) for c, t in zip(new.columns, new.schema)]).where(F.col(BUCKET).isin(touched))
        merged = old.withColumn(_NEW, F.lit(0)).unionByName(merged)
    latest = latest_per_key(merged, keys, [_NEW, *order]).drop(_NEW)
    if op_col and op_col in latest.columns:
        latest = without_deletes(latest, op_col)
    # few files per bucket; AQE splits a bucket holding many rows
    latest.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{stage}/merged")
    schema = StructType([f for f in latest.schema if f.name != BUCKET] + [StructField(BUCKET, StringType())])
    staged = spark.read.schema(schema).parquet(f"{stage}/merged")
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(target))
    left = {n.removeprefix(f"{BUCKET}=") for n in fs.list_names(spark, f"{stage}/merged")}
    for b in set(touched) - left:           # every key of the bucket was deleted
        fs.delete(spark, f"{target}/{BUCKET}={b}")
    fs.delete(spark, stage)
    return target


def read_upserted(spark: SparkSession, target: str) -> DataFrame:
    """The rows of an upserted table, whether buckets were rewritten or deltas merged (``DeltaTable``)."""
    from tidewater.operators.delta_table import DeltaTable
    if fs.exists(spark, f"{target.rstrip('/')}/_log"):
        return DeltaTable.open(spark, target).read()
    return spark.read.parquet(target).drop(BUCKET)
