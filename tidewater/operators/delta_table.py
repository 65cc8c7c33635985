"""A keyed table of immutable files: merge-on-read upserts and snapshots.

Layout below ``path``::

    data/<folder>/_bucket=<b>/*.parquet     written once, never changed
    _log/<version>.json                     a manifest: one snapshot of the table

A manifest lists, bucket by bucket, the folders that hold the bucket's rows, the
number each was written under, and the range of its keys there.  A commit writes
its own folder and then one new manifest (complete under a temporary name, then
renamed), so a reader sees whole commits only, and a job that dies leaves
files that no manifest names.

*Upsert*: the updates alone are written, with their operation kept (a delete is
a row too): the bytes written do not depend on the table.  *Read*: the newest row
of each key wins, by ``order`` and then by commit; deleted keys drop out.  A read
may name buckets, or a range of the first key, and opens only the files that may hold them.
*Compact*: the buckets with more than ``most`` folders are folded into one; readers
of older manifests keep their files until ``vacuum``.

There is one writer at a time (a job, or a streaming query); readers are free.
A commit may carry the id of a streaming batch: committing it again is a no-op.
Within one upsert, two rows with one key and equal ``order`` fail the commit
unless they are equal, so no result depends on the order of tasks.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.operators.cdc import OP_DELETE
from tidewater.sources import fs

BUCKET = "_bucket"
SEQ = "_seq"
GONE = "_gone"


class DeltaTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] = (), buckets: int = 64,
                 bucket_by: Sequence[str] | None = None, op_col: str | None = None, most: int = 8):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.order, self.buckets, self.op_col, self.most = list(keys), list(order), buckets, op_col, most
        self.bucket_by = list(bucket_by or keys)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> DeltaTable:
        """The table at ``path`` with the settings it was made with."""
        table = cls(spark, path, [])
        made = table.manifest().get("table")
        if made is None:
            raise ValueError(f"{path} is not a table, or has no commit yet")
        return cls(spark, path, **made)

    def _settings(self) -> dict:
        return {k: getattr(self, k) for k in ("keys", "order", "buckets", "bucket_by", "op_col")}

    # -- snapshots ---------------------------------------------------------

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in fs.list_names(self.spark, f"{self.path}/_log")
                      if n.endswith(".json") and not n.startswith("."))

    def manifest(self, version: int | None = None) -> dict:
        """The newest snapshot (or that of ``version``); an empty one for a table not yet written."""
        if version is None:
            version = max(self.versions(), default=None)
        if version is None:
            return {"version": -1, "schema": None, "buckets": {}, "batches": {}}
        return json.loads(fs.read_text(self.spark, f"{self.path}/_log/{version:012d}.json"))

    def _commit(self, snapshot: dict) -> None:
        path = f"{self.path}/_log/{snapshot['version']:012d}.json"
        if fs.exists(self.spark, path):
            raise RuntimeError(f"{path} exists: another writer committed first")
        fs.write_text(self.spark, path, json.dumps(snapshot, sort_keys=True))

    def applied(self, batch: tuple[str, int] | None) -> bool:
        """Whether a streaming batch (query name, batch id) is already in the table."""
        return batch is not None and self.manifest()["batches"].get(batch[0], [-1])[0] >= batch[1]

    def commit_of(self, name: str) -> tuple[int, DataFrame]:
        """The snapshot before the last batch of a streaming query, and the batch's rows (deletes
        included) as they were committed: what a retry needs to go on from there."""
        _, before, folder = self.manifest()["batches"][name]
        path = f"{self.path}/data/{folder}"
        schema = StructType.fromJson(self.manifest()["schema"])
        if not any(n.startswith(f"{BUCKET}=") for n in fs.list_names(self.spark, path)):
            return before, self.spark.createDataFrame([], schema)
        return before, self.spark.read.schema(StructType([*schema]).add(BUCKET, "integer")).parquet(path)

    # -- writing -----------------------------------------------------------

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    def upsert(self, updates: DataFrame, batch: tuple[str, int] | None = None, order: Sequence[str] = ()) -> int:
        """Commit ``updates``; returns the table's version afterwards.  Among updates of one key the
        greatest ``order`` (or the table's own) wins."""
        now = self.manifest()
        if self.applied(batch):
            return now["version"]
        if now.get("table", self._settings()) != self._settings():
            raise ValueError(f"{self.path} was made with {now['table']}, not {self._settings()}")
        gone = F.lit(False) if self.op_col is None else F.coalesce(F.col(self.op_col) == OP_DELETE, F.lit(False))
        rows = self._newest(updates.withColumn(GONE, gone), order or self.order, strict=True).withColumn(
            SEQ, F.lit(now["version"] + 1).cast("bigint")).withColumn(BUCKET, self.bucket())
        schema = rows.drop(BUCKET).schema
        if now["schema"] is not None:
            have = StructType.fromJson(now["schema"])
            if sorted((f.name, f.dataType.simpleString()) for f in have) != sorted((f.name, f.dataType.simpleString()) for f in schema):
                raise ValueError(f"columns of {self.path} and of the updates differ: {have.simpleString()}, {schema.simpleString()}")
        snapshot = {**now, "version": now["version"] + 1, "schema": now["schema"] or json.loads(schema.json()), "table": self._settings(),
                    "buckets": dict(now["buckets"]), "batches": dict(now["batches"])}
        folder = f"{snapshot['version']:012d}-{uuid.uuid4().hex[:8]}"
        for b, lo, hi in self._write(rows, folder):
            snapshot["buckets"][b] = [*snapshot["buckets"].get(b, []), [folder, snapshot["version"], lo, hi]]
        if batch is not None:
            snapshot["batches"][batch[0]] = [batch[1], now["version"], folder]
        self._commit(snapshot)
        if any(len(x) > self.most for x in snapshot["buckets"].values()):
            return self.compact()
        return snapshot["version"]

    def _write(self, rows: DataFrame, folder: str) -> list[tuple[str, str, str]]:
        """Write the rows below ``folder``; (bucket, least, greatest first key as text), at most a row per bucket."""
        path = f"{self.path}/data/{folder}"
        # AQE splits a bucket that holds many rows
        rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)
        if not any(n.startswith(f"{BUCKET}=") for n in fs.list_names(self.spark, path)):
            return []
        key = F.col(self.keys[0])
        schema = StructType([*rows.drop(BUCKET).schema]).add(BUCKET, "string")
        found = self.spark.read.schema(schema).parquet(path).groupBy(BUCKET).agg(
            F.min(key).cast("string").alias("lo"), F.max(key).cast("string").alias("hi"))
        return [(r[BUCKET], r["lo"], r["hi"]) for r in found.collect()]

    def compact(self, least: int | None = None) -> int:
        """Fold every bucket of more than ``least`` (``most``) folders into one folder, under one new manifest."""
        now = self.manifest()
        least = self.most if least is None else least
        wide = [b for b, parts in now["buckets"].items() if len(parts) > least]
        if not wide:
            return now["version"]
        snapshot = {**now, "version": now["version"] + 1, "buckets": dict(now["buckets"])}
        folder = f"{snapshot['version']:012d}-{uuid.uuid4().hex[:8]}"
        # all folders of a bucket are folded, so its deletes have nothing left to delete
        rows = self._stored(now, [int(b) for b in wide]).where(f"not {GONE}").withColumn(BUCKET, self.bucket())
        written = {b: [[folder, snapshot["version"], lo, hi]] for b, lo, hi in self._write(rows, folder)}
        for b in wide:
            snapshot["buckets"].pop(b)
        snapshot["buckets"].update(written)
        self._commit(snapshot)
        return snapshot["version"]

    def vacuum(self, keep: int = 1) -> None:
        """Delete the manifests before the last ``keep`` and the folders that none of those left names."""
        versions = self.versions()
        named = {part[0] for v in versions[-keep:] for parts in self.manifest(v)["buckets"].values() for part in parts}
        for v in versions[:-keep]:
            fs.delete(self.spark, f"{self.path}/_log/{v:012d}.json")
        for folder in fs.list_names(self.spark, f"{self.path}/data"):
            if folder not in named:
                fs.delete(self.spark, f"{self.path}/data/{folder}")

    # -- reading -----------------------------------------------------------

    def _newest(self, rows: DataFrame, order: Sequence[str], strict: bool = False) -> DataFrame:
        """One row per key, that of the greatest ``order``; ``max_by`` aggregates before the shuffle.
        With ``strict``, different rows that tie for it fail the query."""
        rest = [c for c in rows.columns if c not in self.keys]
        by = F.struct(*[F.col(c) for c in order]) if order else F.lit(0)
        row = F.struct(*[F.col(c) for c in rest])
        best = [F.max_by(row, by).alias("row")]
        if strict:      # the greatest and the least hash among the rows of the greatest order
            h = F.xxhash64(*rest).cast("decimal(20,0)")
            best += [F.max(F.struct(by.alias("by"), sign.alias("h")))["h"].alias(name) for name, sign in (("most", h), ("least", -h))]
        out = rows.groupBy(*self.keys).agg(*best)
        if strict:
            clash = F.concat(F.lit(f"{self.path}: different updates of one key and order: "), F.to_json(F.struct(*self.keys)))
            out = out.withColumn("row", F.when(F.col("most") == -F.col("least"), F.col("row"))
                                 .otherwise(F.raise_error(clash).cast(out.schema["row"].dataType)))
        return out.select(*self.keys, *[F.col("row")[c].alias(c) for c in rest])

    def files(self, version: int | None = None, buckets: Sequence[int] | None = None, keys: tuple | None = None) -> list[tuple[str, int]]:
        """(folder of a bucket, commit number) that a read opens; ``keys`` is a range of the first key
        (compared as text, so for text keys)."""
        return self._files(self.manifest(version), buckets, keys)

    def _files(self, snapshot: dict, buckets=None, keys=None) -> list[tuple[str, int]]:
        wanted = None if buckets is None else {str(b) for b in buckets}
        return [(f"{self.path}/data/{folder}/{BUCKET}={b}", seq)
                for b, parts in sorted(snapshot["buckets"].items()) if wanted is None or b in wanted
                for folder, seq, lo, hi in parts if keys is None or lo is None or not (hi < keys[0] or lo > keys[1])]

    def _stored(self, snapshot: dict, buckets=None, keys=None) -> DataFrame:
        """The newest row of every key, deleted ones included."""
        files = self._files(snapshot, buckets, keys)
        schema = StructType.fromJson(snapshot["schema"])
        if not files:
            return self.spark.createDataFrame([], schema)
        # a key has one row a folder at most: nothing to fold, and so to sort, before the shuffle
        rows = self.spark.read.schema(schema).parquet(*[f for f, _ in files]).repartition(*self.keys)
        return self._newest(rows, [*self.order, SEQ])

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None, keys: tuple | None = None) -> DataFrame:
        """The live rows of a snapshot (the newest, or ``version``)."""
        snapshot = self.manifest(version)
        if snapshot["schema"] is None:
            raise ValueError(f"{self.path} has no rows and no schema yet")
        return self._stored(snapshot, buckets, keys).where(f"not {GONE}").drop(SEQ, GONE)

    def read_or_empty(self, schema: StructType, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """As ``read``; no rows of ``schema`` before the first commit."""
        if version == -1 or self.manifest()["schema"] is None:
            return self.spark.createDataFrame([], schema)
        return self.read(version, buckets).select(*schema.names)

    def stored_rows(self, buckets: Sequence[int] | None = None) -> int:
        """How many rows a read of ``buckets`` opens: those of all commits, deletes included."""
        files = self.files(buckets=buckets)
        return self.spark.read.parquet(*[f for f, _ in files]).count() if files else 0

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of ``rows`` (which has the ``bucket_by`` columns): at most ``buckets`` numbers."""
        return [r[0] for r in rows.select(self.bucket()).distinct().collect()]
