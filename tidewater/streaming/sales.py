"""Streaming per-minute sales and milestone recompute.

Minute sums are additive, so no state is kept and no row is ever too late:
each micro-batch writes its own partial sums once, below ``batch_id=<n>`` (a
retried batch replaces its own files), and readers add the partials up.  The
milestones of the days a batch touches are then recomputed from the current
sums.  ``compact`` folds the partials of finished batches into one folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.milestones import AMOUNT, PARTIAL, TOTAL, milestones_from_minutes
from tidewater.sources import fs
from tidewater.streaming.sources import with_event_time

_SCHEMA = "minute string, part decimal(38,8), p_day string"
_MARKS = "submit_date date, mark_no bigint, mark_minute string, p_day string"


def streaming_amounts(events: DataFrame, ts: str, amount: str, delay: str = "1 second") -> DataFrame:
    """Streaming DataFrame of (event_time, amount) with its watermark.  The
    watermark is for operators downstream; nothing here drops a late row."""
    return with_event_time(events, ts, delay, out="event_time").select(
        "event_time", F.col(amount).cast(AMOUNT).alias("amount"))


class MinuteSalesSink:
    """foreachBatch target: partial minute sums of every batch."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, batch: DataFrame, batch_id: int) -> None:
        parts = (batch.where("event_time is not null")
                 .groupBy(F.date_format("event_time", "yyyy-MM-dd HH:mm").alias("minute"))
                 .agg(F.sum("amount").cast(PARTIAL).alias("part"))
                 .withColumn("p_day", F.substring("minute", 1, 10)))
        parts.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.write(batch, batch_id)

    def _folders(self, spark: SparkSession) -> list[str]:
        """The batches that count: the last finished compaction and all later ones."""
        names = {n[len("batch_id="):] for n in fs.list_names(spark, self.path) if n.startswith("batch_id=")}
        done = [int(n[1:]) for n in names if n.startswith("c") and fs.exists(spark, f"{self.path}/batch_id={n}/_SUCCESS")]
        upto = max(done, default=-1)
        late = sorted(int(n) for n in names if not n.startswith("c") and int(n) > upto)
        return ([f"c{upto}"] if done else []) + [str(n) for n in late]

    def partials(self, spark: SparkSession) -> DataFrame:
        paths = [f"{self.path}/batch_id={n}" for n in self._folders(spark)]
        return spark.read.schema(_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], _SCHEMA)

    def read(self, spark: SparkSession) -> DataFrame:
        return minutes_of(self.partials(spark))

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Fold all batches up to ``upto`` (finished ones) into one folder.  Readers
        take the old folders until the new one has its success marker, then only it."""
        names = [n for n in self._folders(spark) if n.startswith("c") or int(n) <= upto]
        if len(names) < 2:
            return
        sums = (spark.read.schema(_SCHEMA).parquet(*[f"{self.path}/batch_id={n}" for n in names])
                .groupBy("minute", "p_day").agg(F.sum("part").cast(PARTIAL).alias("part")).select("minute", "part", "p_day"))
        sums.write.mode("overwrite").parquet(f"{self.path}/batch_id=c{upto}")
        for n in names:
            fs.delete(spark, f"{self.path}/batch_id={n}")


def minutes_of(partials: DataFrame) -> DataFrame:
    return (partials.groupBy("minute").agg(F.sum("part").cast(TOTAL).alias("sale_amount"))
            .select(F.to_date(F.substring("minute", 1, 10)).alias("submit_date"), "minute", "sale_amount"))


class MilestoneSink(MinuteSalesSink):
    """Partial minute sums, then the milestones of the touched days only."""

    def __init__(self, minutes_path: str, marks_path: str, step: int):
        super().__init__(minutes_path)
        self.marks_path, self.step = marks_path, step

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.write(batch, batch_id)
        spark = batch.sparkSession
        own = spark.read.schema(_SCHEMA).parquet(f"{self.path}/batch_id={batch_id}")
        # at most a row per calendar day in the batch
        touched = self.partials(spark).join(F.broadcast(own.select("p_day").distinct()), "p_day", "left_semi")
        # sums only grow, so a day that had milestones keeps some: overwriting its partition is enough
        marks = milestones_from_minutes(minutes_of(touched), self.step)
        (marks.withColumn("p_day", F.col("submit_date").cast("string")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("p_day").parquet(self.marks_path))

    def read_marks(self, spark: SparkSession) -> DataFrame:
        if not fs.exists(spark, self.marks_path):
            return spark.createDataFrame([], _MARKS).drop("p_day")
        return spark.read.schema(_MARKS).parquet(self.marks_path).drop("p_day")
