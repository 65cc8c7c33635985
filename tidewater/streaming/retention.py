"""Running totals whose keys are forgotten once they are idle.

A key's totals live from its first row until no row of it has come for the
retention time (in event time); then its state is dropped and the totals are
reported, and the key's next row starts from nothing.  That is a session per
key with the retention as its gap, so Spark's own session state holds one entry for
each live key and gap, merges late rows into it, and evicts it when the watermark passes.
Rows of a key are merged inside each task before the shuffle, however hot the key
(``session.py`` switches that on).

Defined results: a row exactly the retention after the last one still goes on with its totals; a null
event time belongs to no period and is left out; a null key is a key; rows later
than the watermark are dropped, as in any stateful query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def totals_until_idle(stream: DataFrame, keys: Sequence[str], event_time: str, totals: Sequence[Column], idle: str = "24 hours",
                      delay: str = "3 seconds") -> DataFrame:
    """One row for each key and period, when its state is dropped: keys, ``first_seen``, ``last_seen``,
    ``idle_at`` (when the retention ran out) and the named aggregates ``totals``.

    On a stream (append output) a period is reported when the watermark, ``delay`` behind the
    greatest event time, passes ``idle_at``; on a batch every period is reported.
    """
    timed = stream.withColumn("_at", F.col(event_time).cast("timestamp")).where(F.col("_at").isNotNull())
    if stream.isStreaming:
        timed = timed.withWatermark("_at", delay)
    kept = timed.groupBy(*keys, F.session_window("_at", idle).alias("_period")).agg(
        F.min("_at").alias("first_seen"), F.max("_at").alias("last_seen"), *totals)
    mine = [c for c in kept.columns if c not in (*keys, "_period", "first_seen", "last_seen")]
    return kept.select(*keys, "first_seen", "last_seen", F.col("_period.end").alias("idle_at"), *mine)
