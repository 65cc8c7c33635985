"""A watermark that moves with every row.

Rows have an order of arrival.  The watermark a row meets is the greatest event
time of all rows before it, less a delay; the row is late if its own event time
lies below.  Spark's watermark moves once a micro-batch; this one is a running
maximum over the whole input, computed in parallel: the rows are cut into ranges of the
arrival order, each range yields its maximum, the maxima of the ranges before it
(one row a range) are handed to every range, and the running maximum is then taken
inside the ranges, each its own task.

Defined results: rows that tie in the order do not see one another; a null event
time moves nothing and is never late; a null in the order comes first; the first
row, and rows with no event time before them, have no watermark and are not late.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.operators.sinks import stage_table

#: About so many rows make a range.
RANGE_ROWS = 1_000_000
WATERMARK, LATE = "watermark", "late"
_RANGE, _BEFORE = "_range", "_before"


def row_watermark(df: DataFrame, order: Sequence[str], event_time: str, delay: str = "0 seconds", start: Column | None = None,
                  ranges: int | None = None) -> DataFrame:
    """``df`` with ``watermark`` and ``late``; ``start`` is the greatest event time known before the first row.

    The ranges are written once under ``spark.checkpoint.dir``, so all steps see the same ones.
    """
    clash = {WATERMARK, LATE, _RANGE, _BEFORE} & set(df.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are the result's own")
    names = df.columns
    ranges = ranges or max(1, -(-df.count() // RANGE_ROWS))
    cut = df.repartitionByRange(ranges, *order).withColumn(_RANGE, F.spark_partition_id())
    cut = stage_table(cut, "row-watermark")
    start = F.lit(None) if start is None else start
    start = start.cast(df.schema[event_time].dataType)
    # one row a range: their number, not their size, grows with the input
    maxima = cut.groupBy(_RANGE).agg(F.max(event_time).alias("_top"))
    earlier = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    maxima = maxima.select(_RANGE, F.greatest(F.max("_top").over(earlier), start).alias(_BEFORE))
    rows = cut.join(F.broadcast(maxima), _RANGE)
    within = Window.partitionBy(_RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(_BEFORE, F.greatest(_BEFORE, F.max(event_time).over(within)))
    peers = Window.partitionBy(_RANGE, *order)  # the first of those that tie has seen none of them
    seen = F.min(_BEFORE).over(peers)
    missed = F.count_if(F.col(_BEFORE).isNull()).over(peers)
    rows = rows.withColumn(WATERMARK, F.when(missed == 0, seen) - F.expr(f"INTERVAL {delay}"))
    return rows.select(*names, WATERMARK, F.coalesce(F.col(event_time) < F.col(WATERMARK), F.lit(False)).alias(LATE))


class RowWatermarkSink:
    """``row_watermark`` over a stream (foreachBatch): a batch starts from the greatest event
    time of all earlier batches.  Rows go to ``rows/batch_id=<n>`` and the maximum to
    ``tops/batch_id=<n>``; a retried batch writes both again, from the same start."""

    def __init__(self, path: str, order: Sequence[str], event_time: str, delay: str = "0 seconds"):
        self.path, self.order, self.event_time, self.delay = path.rstrip("/"), list(order), event_time, delay

    def _tops(self, spark, schema: StructType) -> DataFrame:
        from tidewater.sources import fs
        known = StructType().add("top", schema[self.event_time].dataType).add("batch_id", "long")
        if not fs.exists(spark, f"{self.path}/tops"):
            return spark.createDataFrame([], known)
        return spark.read.schema(known).parquet(f"{self.path}/tops")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kind = batch.schema[self.event_time].dataType
        start = self._tops(spark, batch.schema).where(F.col("batch_id") < batch_id).agg(F.max("top")).first()[0]
        marked = row_watermark(batch, self.order, self.event_time, self.delay, F.lit(start).cast(kind))
        to = f"{self.path}/rows/batch_id={batch_id}"
        marked.write.mode("overwrite").parquet(to)
        top = spark.read.schema(marked.schema).parquet(to).agg(F.max(self.event_time).alias("top"))
        top.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/tops/batch_id={batch_id}")

    def read(self, spark, schema: StructType) -> DataFrame:
        """All rows of the stream, of ``schema``, with their watermark."""
        kind = schema[self.event_time].dataType
        out = StructType([*schema]).add(WATERMARK, kind).add(LATE, "boolean")
        return spark.read.schema(StructType([*out]).add("batch_id", "long")).parquet(f"{self.path}/rows").select(*out.names)
