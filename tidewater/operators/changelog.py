"""Changelogs: what a result gained and lost between two states.

A changelog row carries ``op``: ``D`` for a row that is no longer in the result
and ``I`` for one that now is; a changed row is one of each.  Rows are counted,
so a result that holds a row twice is followed too.  Folding the changelog of
all steps gives the result itself.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OP = "op"


def net(changes: DataFrame) -> DataFrame:
    """The changelog without rows that are both withdrawn and added: one shuffle on the whole row."""
    cols = [c for c in changes.columns if c != OP]
    left = changes.groupBy(*cols).agg(F.sum(F.when(F.col(OP) == "D", -1).otherwise(1)).alias("_n")).where("_n <> 0")
    times = F.sequence(F.lit(1).cast("bigint"), F.abs("_n"))
    return left.select(F.when(F.col("_n") < 0, "D").otherwise("I").alias(OP), *cols, F.explode(times).alias("_k")).drop("_k")


def difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """The changelog from ``before`` to ``after`` (the same columns)."""
    cols = after.columns
    return net(before.select(F.lit("D").alias(OP), *cols).unionByName(after.select(F.lit("I").alias(OP), *cols)))


def fold(changes: DataFrame | Sequence[DataFrame]) -> DataFrame:
    """The rows that a changelog leaves; a row deleted more often than it was inserted fails the query."""
    if not isinstance(changes, DataFrame):
        changes = functools.reduce(DataFrame.unionByName, changes)
    cols = [c for c in changes.columns if c != OP]
    net = changes.groupBy(*cols).agg(F.sum(F.when(F.col(OP) == "D", -1).otherwise(1)).alias("_n"))
    wrong = F.raise_error(F.concat(F.lit("deleted more often than inserted: "), F.to_json(F.struct(*cols)))).cast("bigint")
    net = net.withColumn("_n", F.when(F.col("_n") < 0, wrong).otherwise(F.col("_n"))).where("_n > 0")
    return net.select(*cols, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))).alias("_k")).drop("_k")


def as_updates(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The changelog as keyed updates: a key that is deleted and inserted is just replaced."""
    rest = [c for c in changes.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.col(OP))     # I is greater than D
    return changes.groupBy(*keys).agg(last.alias("_row")).select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
