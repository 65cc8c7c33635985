"""Continuously updated top-N per key (foreachBatch + bucketed keyed state).

Spark rejects ``row_number`` on a stream, so each micro-batch is ranked as
a batch DataFrame and merged with the stored top-N of the keys it touches.
The state holds at most N rows per key, partitioned by a hash bucket of the
key; a batch rewrites only the buckets it touches (staged first, so no plan
overwrites the folder it reads).  Re-running a batch gives the same state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.rank import top_n
from tidewater.session import scratch_dir
from tidewater.sources import fs


class TopNState:
    def __init__(self, path: str, keys: Sequence[str], order: Sequence[Column], unique: Sequence[str], n: int,
                 buckets: int = 64, rank_col: str = "row_num"):
        self.path, self.keys, self.order, self.unique, self.n = path, list(keys), list(order), list(unique), n
        self.buckets, self.rank_col = buckets, rank_col

    def _bucket(self) -> Column:
        return F.pmod(F.hash(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("string").alias("_bucket")

    def read(self, spark) -> DataFrame:
        return spark.read.parquet(self.path).drop("_bucket")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            if not batch.isEmpty():  # watermark-only batches carry no rows
                self._apply(spark, batch, batch_id)
        finally:
            batch.unpersist()

    def _apply(self, spark, batch: DataFrame, batch_id: int) -> None:
        fresh = top_n(batch, self.keys, self.order, self.n, self.rank_col).drop(self.rank_col) \
            .select("*", self._bucket())
        touched = [r[0] for r in fresh.select("_bucket").distinct().collect()]  # <= buckets values
        if not touched:
            return
        merged = fresh
        if fs.exists(spark, self.path):     # any other trouble with the state fails the batch
            old = spark.read.parquet(self.path).where(F.col("_bucket").isin(touched)).drop(self.rank_col)
            merged = old.unionByName(fresh)
        merged = merged.dropDuplicates(self.keys + self.unique)  # a retried batch adds nothing
        ranked = top_n(merged, self.keys, self.order, self.n, self.rank_col)
        stage = scratch_dir(spark, f"topn-stage-{batch_id}")
        ranked.write.mode("overwrite").partitionBy("_bucket").parquet(stage)
        (spark.read.schema(ranked.schema).parquet(stage).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("_bucket").parquet(self.path))
        fs.delete(spark, stage)


# ---------------------------------------------------------------------------
# Keyed-state form: Spark's stateful operator keeps each key's current top-N
# in the state store (RocksDB), so a micro-batch touches only its own keys.

from collections.abc import Iterator  # noqa: E402

import pandas as pd  # noqa: E402
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle  # noqa: E402
from pyspark.sql.types import IntegerType, StructField, StructType  # noqa: E402


def _in_order(frame: pd.DataFrame, order: list[tuple[str, bool]]) -> pd.DataFrame:
    """Sorted as Spark sorts: NULLs first ascending, last descending."""
    for c, descending in reversed(order):
        frame = frame.sort_values(c, ascending=not descending, kind="mergesort",
                                  na_position="last" if descending else "first")
    return frame


class _TopNProcessor(StatefulProcessor):
    """Per key: merge the batch's rows into the stored top-N, emit the new top-N.

    The key's rows arrive as Arrow-sized pandas chunks and are folded in one
    chunk at a time, so memory stays at N + one chunk even for a key that
    holds a large share of the batch.
    """

    def __init__(self, value_schema: StructType, order: list[tuple[str, bool]], unique: list[str], n: int,
                 rank_col: str, ttl_ms: int | None):
        self.value_schema, self.order, self.unique, self.n = value_schema, order, unique, n
        self.rank_col, self.ttl_ms = rank_col, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.top = handle.getListState("top", self.value_schema, self.ttl_ms)

    def _best(self, frame: pd.DataFrame) -> pd.DataFrame:
        return _in_order(frame.drop_duplicates(self.unique), self.order).head(self.n)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = self.value_schema.names
        best = pd.DataFrame(list(self.top.get()), columns=names) if self.top.exists() else None
        for chunk in rows:
            part = chunk[names]
            best = self._best(part if best is None or best.empty else pd.concat([best, part], ignore_index=True))
        if best is None:
            return
        self.top.put([tuple(r) for r in best.itertuples(index=False, name=None)])
        out = best.reset_index(drop=True)
        out[self.rank_col] = range(1, len(out) + 1)
        yield out

    def close(self) -> None:
        pass


def stateful_top_n(stream: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, bool]],
                   unique: Sequence[str], n: int, rank_col: str = "row_num",
                   ttl_ms: int | None = None) -> DataFrame:
    """Continuously updated top-N per key with keyed state.

    ``order`` is ``[(column, descending), ...]`` ending in a unique tie-break.
    Emits, for every key present in a micro-batch, its complete new top-N
    (update semantics: the rows replace the key's previous ones).  ``ttl_ms``
    expires the state of keys idle for that long; it needs processing-time
    mode, meant for continuous triggers (with ``availableNow`` the query did
    not finish locally, so bounded replays run without TTL).
    """
    values = [f for f in stream.schema.fields]
    value_schema = StructType(values)
    out_schema = StructType(values + [StructField(rank_col, IntegerType())])
    proc = _TopNProcessor(value_schema, list(order), list(unique), n, rank_col, ttl_ms)

    def best_of_batch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # before the shuffle: n rows per key and Arrow batch, however hot the key
        for f in frames:
            yield _in_order(f.drop_duplicates([*keys, *unique]), list(order)).groupby(list(keys), dropna=False).head(n)

    return (stream.mapInPandas(best_of_batch, stream.schema).groupBy(*keys)
                  .transformWithStateInPandas(proc, out_schema, outputMode="Update",
                                              timeMode="ProcessingTime" if ttl_ms else "None"))
