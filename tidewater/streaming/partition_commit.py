"""Streaming writes into a partitioned table with partition commit.

Each micro-batch is written below its partitions in a ``batch_id=<n>``
folder with dynamic partition overwrite, so a retried batch replaces its
own files and nothing else (exactly-once, O(batch) work per batch).

Commit rule (partition-time trigger): with the watermark at
``max event time seen - watermark_delay``, a partition is committed once
``watermark > partition_time + commit_delay``, where ``partition_time`` is
built from the partition values by a pattern such as ``"$dt $h:$m:00"``.
Committing writes ``_SUCCESS`` into the partition folder and, when a
catalog table is named (partitioned by the same columns and ``batch_id``), adds
the partition's batch folders to it, so its rows are read through the table.  A
late row for a committed partition is still written and the partition is
re-committed.  Rows without an event time go to the default partition, which is
never committed.

The tracker (max event time, pending and committed partitions: one entry
per partition, i.e. metadata) is versioned per batch beside the table, so a
retried batch starts from the state before it.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_dir
from tidewater.sources import fs

_TS_FMT = "%Y-%m-%d %H:%M:%S"


def partition_time(pattern: str, values: dict) -> dt.datetime:
    text = re.sub(r"\$(\w+)", lambda m: str(values[m.group(1)]), pattern)
    return dt.datetime.strptime(text, _TS_FMT)


def _parse_delay(s) -> dt.timedelta:
    if isinstance(s, (int, float)):
        return dt.timedelta(seconds=s)
    n, unit = s.split()
    unit = unit.rstrip("s")
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "d": 86400, "h": 3600, "min": 60, "s": 1}[unit]
    return dt.timedelta(seconds=float(n) * mult)


class PartitionCommitSink:
    def __init__(self, path: str, partition_cols: Sequence[str], time_col: str, pattern: str,
                 watermark_delay="0 seconds", commit_delay="0 seconds", fmt: str = "parquet",
                 table: str | None = None, tracker: str | None = None, compact_on_commit: bool = False):
        self.path = path.rstrip("/")
        self.partition_cols = list(partition_cols)
        self.time_col, self.pattern, self.fmt, self.table = time_col, pattern, fmt, table
        self.wm_delay, self.commit_delay = _parse_delay(watermark_delay), _parse_delay(commit_delay)
        self.tracker = (tracker or f"{self.path}_commit_tracker").rstrip("/")
        self.compact_on_commit = compact_on_commit

    # -- tracker ------------------------------------------------------------
    # state-<b>.json: {max_event_time, pending} after batch b (pending is
    # bounded by the partitions still inside watermark lag + commit delay);
    # commits-<b>.json: partitions committed by batch b (the commit log).
    # Committing is idempotent, so no list of all committed partitions is kept.
    # All states stay, so a query can be rewound to any batch.

    def _ids(self, spark: SparkSession, prefix: str) -> list[int]:
        return sorted(int(n[len(prefix) + 1:-5]) for n in fs.list_names(spark, self.tracker)
                      if n.startswith(prefix + "-") and n.endswith(".json"))

    def _load(self, spark: SparkSession, batch_id: int) -> dict:
        last = batch_id - 1
        if not fs.exists(spark, f"{self.tracker}/state-{last}.json"):   # empty batches leave no state
            last = max((i for i in self._ids(spark, "state") if i < batch_id), default=None)
        if last is None:
            return {"max_event_time": None, "pending": []}
        return json.loads(fs.read_text(spark, f"{self.tracker}/state-{last}.json"))

    def _save(self, spark: SparkSession, batch_id: int, state: dict, committed_now: list) -> None:
        fs.write_text(spark, f"{self.tracker}/commits-{batch_id}.json", json.dumps(committed_now, sort_keys=True))
        fs.write_text(spark, f"{self.tracker}/state-{batch_id}.json", json.dumps(state, sort_keys=True))

    def committed(self, spark: SparkSession) -> list[dict]:
        """Partitions committed so far (read from the commit log)."""
        seen = {}
        for i in self._ids(spark, "commits"):
            for p in json.loads(fs.read_text(spark, f"{self.tracker}/commits-{i}.json")):
                seen[json.dumps(p, sort_keys=True)] = p
        return [seen[k] for k in sorted(seen)]

    # -- batch ----------------------------------------------------------------
    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            if not batch.isEmpty():  # watermark-only batches carry no rows
                self._apply(spark, batch, batch_id)
        finally:
            batch.unpersist()

    def _apply(self, spark: SparkSession, batch: DataFrame, batch_id: int) -> None:
        # rebalance: few files per partition per batch, hot partitions split by AQE
        rows = batch.withColumn("batch_id", F.lit(str(batch_id))).hint("rebalance", *self.partition_cols)
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*self.partition_cols, "batch_id").format(self.fmt).save(self.path))
        # per touched partition: one row (partition values, max event time as text)
        stats = (batch.groupBy(*self.partition_cols)
                      .agg(F.date_format(F.max(self.time_col), "yyyy-MM-dd HH:mm:ss").alias("_max"))
                      .collect())
        state = self._load(spark, batch_id)
        times = [dt.datetime.strptime(r["_max"], _TS_FMT) for r in stats if r["_max"] is not None]
        if state["max_event_time"]:
            times.append(dt.datetime.strptime(state["max_event_time"], _TS_FMT))
        mx = max(times, default=None)
        key = lambda vals: json.dumps(vals, sort_keys=True)
        # new data, or late data for a committed partition: (re)commit
        pending = {key(p) for p in state["pending"]}
        pending |= {key({c: str(r[c]) for c in self.partition_cols}) for r in stats
                    if all(r[c] is not None for c in self.partition_cols)}
        ready = set()
        if mx is not None:
            watermark = mx - self.wm_delay
            ready = {k for k in pending
                     if watermark > partition_time(self.pattern, json.loads(k)) + self.commit_delay}
            self._commit(spark, [json.loads(k) for k in sorted(ready)])
        state = {"max_event_time": mx.strftime(_TS_FMT) if mx else None,
                 "pending": [json.loads(k) for k in sorted(pending - ready)]}
        self._save(spark, batch_id, state, [json.loads(k) for k in sorted(ready)])

    def compact(self, spark: SparkSession, vals: dict) -> None:
        """Rewrite one partition's per-batch folders as a single folder.

        The rows of every ``batch_id=<n>`` folder are written to
        ``batch_id=c<max n>`` (one dynamic-overwrite job, atomic at commit),
        then the other folders are deleted.  A compacted folder whose id is
        at least every other id already holds their rows, so a re-run after a
        failure between the two steps only finishes the deletes.
        """
        sub = "/".join(f"{c}={vals[c]}" for c in self.partition_cols)
        part = f"{self.path}/{sub}"
        dirs = [n for n in fs.list_names(spark, part) if n.startswith("batch_id=")]
        ids = {n: int(n[len("batch_id="):].lstrip("c")) for n in dirs}
        if len(dirs) <= 1:
            return
        top = max(ids.values())
        done = f"batch_id=c{top}"
        if done not in dirs:
            rows = spark.read.option("basePath", self.path).format(self.fmt).load(part)
            out = rows.drop("batch_id").withColumn("batch_id", F.lit(f"c{top}"))
            for c in self.partition_cols:
                out = out.withColumn(c, F.lit(vals[c]))
            staged = scratch_dir(spark, "compact-stage")
            out.write.mode("overwrite").partitionBy(*self.partition_cols, "batch_id").format(self.fmt).save(staged)
            (spark.read.option("basePath", staged).format(self.fmt).load(staged)
                  .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                  .partitionBy(*self.partition_cols, "batch_id").format(self.fmt).save(self.path))
        for n in dirs:
            if n != done:
                fs.delete(spark, f"{part}/{n}")

    def _commit(self, spark: SparkSession, partitions: list[dict]) -> None:
        """Commit the partitions of one batch: their markers, and one statement for the catalog."""
        specs = []
        for vals in partitions:
            sub = "/".join(f"{c}={vals[c]}" for c in self.partition_cols)
            before = self._batches(spark, sub) if self.table else []
            if self.compact_on_commit:
                self.compact(spark, vals)
            now = self._batches(spark, sub) if self.table and self.compact_on_commit else before
            fs.write_text(spark, f"{self.path}/{sub}/_SUCCESS", "")
            spec = ", ".join(f"{c} = '{vals[c]}'" for c in self.partition_cols)
            specs += [f"PARTITION ({spec}, batch_id = '{b}')" for b in now]
            for gone in sorted(set(before) - set(now)):
                spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION ({spec}, batch_id = '{gone}')")
        if self.table and specs:
            spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS {' '.join(specs)}")

    def _batches(self, spark: SparkSession, sub: str) -> list[str]:
        return [n[len("batch_id="):] for n in fs.list_names(spark, f"{self.path}/{sub}") if n.startswith("batch_id=")]

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.option("basePath", self.path).format(self.fmt).load(self.path)
