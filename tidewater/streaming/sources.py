"""Stream sources.

Production streams come from Kafka (``kafka_source``; the connector jar
must be on the classpath).  Locally, and in tests, a table is replayed as a
file stream: Spark writes it into a folder in one parallel pass and the file
source reads the files in one or more micro-batches.
"""

from __future__ import annotations

import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.session import scratch_dir


def replay_as_files(df: DataFrame, order_col: str, files: int, name: str = "replay",
                    fmt: str = "parquet", shuffled: bool = False, path: str | None = None) -> str:
    """Append ``df`` to a folder of stream files and return the folder.

    One parallel write: ``files`` range partitions of ``order_col``, each file
    written by its own task.  With ``shuffled=True`` every file holds rows from
    all over the range, so most rows come late and out of order.
    """
    path = path or scratch_dir(df.sparkSession, name)
    dealt = df.repartition(files, F.hash(F.col(order_col))) if shuffled else df.repartitionByRange(files, order_col)
    dealt.write.mode("append").format(fmt).save(path)
    return path


#: Rows of a replay's file, and the fewest files it writes, so that a stream has several micro-batches.
REPLAY_ROWS, LEAST_FILES = 1_000_000, 4


def replay_files(df: DataFrame) -> int:
    """How many files a replay of ``df`` takes: in proportion to its rows."""
    return max(LEAST_FILES, -(-df.count() // REPLAY_ROWS))


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, options: dict | None = None) -> DataFrame:
    """A file stream; ``max_files_per_trigger`` bounds a micro-batch if given."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path)


def kafka_source(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                 starting_timestamp_ms: int | None = None) -> DataFrame:
    """Raw Kafka records as text ``value``; start at earliest offsets or at a
    timestamp (e.g. yesterday 00:00)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic))
    r = r.option("startingTimestamp", starting_timestamp_ms) if starting_timestamp_ms is not None \
        else r.option("startingOffsets", starting)
    return r.load().select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("kafka_ts"))


def with_event_time(df: DataFrame, col: str, delay: str, out: str | None = None) -> DataFrame:
    """Bounded-out-of-orderness watermark on ``col``.

    Watermarks need a zoned TIMESTAMP, so a TIMESTAMP_NTZ column is cast (the
    session zone is UTC, so wall-clock values are unchanged).  Epoch-second
    numbers are converted with ``timestamp_seconds``.
    """
    out = out or col
    c = F.col(col)
    dtype = dict(df.dtypes)[col]
    if dtype in ("bigint", "int", "double"):
        c = F.timestamp_seconds(c)
    else:
        c = c.cast("timestamp")
    return df.withColumn(out, c).withWatermark(out, delay)


def yesterday_start_ms(today: datetime.date, zone: str = "UTC") -> int:
    """Epoch milliseconds of 00:00 of the day before ``today``, a stream's start time."""
    start = datetime.datetime.combine(today - datetime.timedelta(days=1), datetime.time(), ZoneInfo(zone))
    return int(start.timestamp() * 1000)


def run_to_end(writer, checkpoint: str):
    """Run a configured ``DataStreamWriter`` over all available input, then stop."""
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
