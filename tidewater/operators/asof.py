"""As-of join: every fact meets the version of its key that was valid at its time.

A version is valid from its own time until the next version of the key.  Facts
and versions are cut into time slices; the last version of each slice is carried
forward over the key's slices (a row per key and slice), so that a slice knows what
was valid when it began.  Within a slice facts and versions are merged in time order
and the last version is carried to each fact.  Everything is partitioned by (key,
slice): a key that holds a large share of the facts is split over as many tasks
as it has slices, and no version is copied to facts it does not serve.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SLICE = "_slice"


def _slice_of(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("bigint")


def asof_join(facts: DataFrame, versions: DataFrame, on: Sequence[str], ts: str, valid_from: str,
              slice_seconds: int = 86_400) -> DataFrame:
    """``facts`` left-joined with the newest row of ``versions`` whose ``valid_from`` is at or before ``ts``.

    All columns of ``versions`` but ``on`` are added (names must not clash); they
    are null for a fact without key or time, or older than every version.  Of versions of one
    key and time, the greatest row (column by column) is taken.  ``slice_seconds`` only
    decides how finely a key is split.
    """
    on = list(on)
    added = [c for c in versions.columns if c not in on]
    clash = set(added) & set(facts.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    known = F.lit(True)
    for c in [*on, valid_from]:
        known = known & F.col(c).isNotNull()
    v = (versions.where(known).select(*on, _slice_of(F.col(valid_from), slice_seconds).alias(_SLICE),
                                      F.col(valid_from).alias("_at"), F.struct(*added).alias("_v")))
    f = facts.select(*on, _slice_of(F.col(ts), slice_seconds).alias(_SLICE), F.col(ts).alias("_at"),
                     F.struct(*facts.columns).alias("_f"))
    # what is valid when a slice begins: one row per key and slice, carried over the key's slices
    ends = v.groupBy(*on, _SLICE).agg(F.max(F.struct("_at", "_v"))["_v"].alias("_last"))
    asked = f.select(*on, _SLICE).distinct()
    by_slice = Window.partitionBy(*on).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    begin = (ends.join(asked.withColumn("_asked", F.lit(True)), [*on, _SLICE], "full")
             .withColumn("_v", F.last("_last", ignorenulls=True).over(by_slice))
             .where("_asked and _v is not null").select(*on, _SLICE, "_v"))
    none_f, none_v = (F.lit(None).cast(d.schema[c].dataType) for d, c in ((f, "_f"), (v, "_v")))
    none_at = F.lit(None).cast(f.schema["_at"].dataType)
    rows = (f.select(*on, _SLICE, "_at", F.lit(2).alias("_turn"), "_f", none_v.alias("_v"))
            .unionByName(v.select(*on, _SLICE, F.col("_at").cast(f.schema["_at"].dataType).alias("_at"), F.lit(1).alias("_turn"),
                                  none_f.alias("_f"), "_v"))
            .unionByName(begin.select(*on, _SLICE, none_at.alias("_at"), F.lit(0).alias("_turn"), none_f.alias("_f"), "_v")))
    # nulls first: what was valid at the beginning, then by time, a version before the facts of its instant
    in_time = Window.partitionBy(*on, _SLICE).orderBy("_at", "_turn", "_v").rowsBetween(Window.unboundedPreceding, 0)
    met = rows.withColumn("_met", F.last("_v", ignorenulls=True).over(in_time)).where("_turn = 2")
    # a fact without a key or time stands alone
    whole = F.lit(True)
    for c in on:
        whole = whole & F.col(c).isNotNull()
    found = F.when(whole & F.col("_at").isNotNull(), F.col("_met"))
    return met.select(*[F.col("_f")[c].alias(c) for c in facts.columns], *[found[c].alias(c) for c in added])
