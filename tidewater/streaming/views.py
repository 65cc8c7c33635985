"""Results that follow changing inputs, as changelogs (foreachBatch).

An input row is inserted, replaced or withdrawn: rows carry an operation (``D``
withdraws) and, where records may come out of order, a version; the newest
version of a key counts, whenever it arrives.  Inputs and results are
``DeltaTable``s bucketed by the grouping columns, so a micro-batch reads the
buckets it touches and writes what changed.  Every batch leaves its changelog below
``changes/batch_id=<n>`` (folding all of them gives the result) and then updates
the result table; each step of a retried batch is either seen to be done or done
again with the same outcome.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.operators import changelog
from tidewater.operators.asof import asof_join
from tidewater.operators.delta_table import DeltaTable
from tidewater.operators.milestones import TOTAL, milestones_from_minutes
from tidewater.operators.rank import top_n
from tidewater.sources import fs

OP = changelog.OP
#: Stored rows of both sides that a task of a maintained join takes.
TASK_ROWS = 200_000


def _within(rows: DataFrame, groups: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The rows of the named groups; a null is a group of its own."""
    named = groups.select(*[F.col(c).alias(f"_of_{c}") for c in cols])
    same = F.lit(True)
    for c in cols:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return rows.join(named, same, "left_semi")


class _View:
    """A result table, its changelog, and the steps every batch ends with."""

    def __init__(self, spark: SparkSession, path: str, result_schema: StructType, result_keys: Sequence[str],
                 group: Sequence[str], buckets: int):
        self.spark, self.path, self.buckets, self.name = spark, path.rstrip("/"), buckets, "view"
        self.result_schema = result_schema
        self.result = DeltaTable(spark, f"{self.path}/result", result_keys, bucket_by=group, op_col=OP, buckets=buckets)

    def read(self) -> DataFrame:
        return self.result.read_or_empty(self.result_schema)

    def changes(self) -> DataFrame:
        """The whole changelog, with the batch of every row."""
        schema = StructType([*self.result_schema]).add(OP, "string")
        if not fs.exists(self.spark, f"{self.path}/changes"):
            return self.spark.createDataFrame([], StructType([*schema]).add("batch_id", "long"))
        return self.spark.read.schema(StructType([*schema]).add("batch_id", "long")).parquet(f"{self.path}/changes")

    def _publish(self, changes: DataFrame, batch_id: int) -> None:
        to = f"{self.path}/changes/batch_id={batch_id}"
        changes.select(OP, *self.result_schema.names).write.mode("overwrite").parquet(to)
        written = self.spark.read.schema(StructType([*self.result_schema]).add(OP, "string")).parquet(to)
        # a key has two changes at most: nothing to fold before the shuffle
        self.result.upsert(changelog.as_updates(written.repartition(*self.result.keys), self.result.keys), (self.name, batch_id))


class GroupView(_View):
    """``query`` over the live rows of each group; a batch recomputes the groups it touches.

    The input rows of a group are stored for good, so a result can be refilled
    when rows that made it are withdrawn.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], group: Sequence[str],
                 query: Callable[[DataFrame], DataFrame], result_schema: StructType, result_keys: Sequence[str],
                 version: Sequence[str] = (), buckets: int = 64):
        super().__init__(spark, path, result_schema, result_keys, group, buckets)
        self.group, self.query = list(group), query
        self.rows = DeltaTable(spark, f"{self.path}/rows", keys, version, bucket_by=group, op_col=OP, buckets=buckets)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.rows.upsert(batch, (self.name, batch_id))
        if self.result.applied((self.name, batch_id)):
            return
        _, own = self.rows.commit_of(self.name)
        touched = own.select(*self.group).distinct()
        numbers = self.rows.touched(touched)
        live = _within(self.rows.read(buckets=numbers), touched, self.group)
        before = _within(self.read_buckets(numbers), touched, self.group)
        after = self.query(live).select(*self.result_schema.names)
        self._publish(changelog.difference(before, after), batch_id)

    def read_buckets(self, numbers: Sequence[int]) -> DataFrame:
        return self.result.read_or_empty(self.result_schema, buckets=numbers)


def top_n_view(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], unique: Sequence[str],
               order: Sequence[Column], n: int, version: Sequence[str] = (), rank_col: str = "row_num", buckets: int = 64) -> GroupView:
    """Top-N per key over rows of ``schema`` that may be replaced or withdrawn; ``order`` ends in a unique column."""
    names = schema.names
    return GroupView(spark, path, [*keys, *unique], keys, lambda live: top_n(live.select(*names), keys, order, n, rank_col),
                     StructType([*schema]).add(rank_col, "integer"), [*keys, rank_col], version, buckets)


_MARKS = StructType().add("submit_date", "date").add("mark_no", "long").add("mark_minute", "string")


def milestone_view(spark: SparkSession, path: str, step: int, buckets: int = 64) -> GroupView:
    """Milestones over minute values that are corrected: rows (submit_date, minute, version, amount, op).
    The newest version of a minute counts, ``D`` removes the minute, and marks that a smaller or
    missing value no longer reaches are withdrawn."""
    def marks(live: DataFrame) -> DataFrame:
        minutes = live.select("submit_date", "minute", F.col("amount").cast(TOTAL).alias("sale_amount"))
        return milestones_from_minutes(minutes, step)

    return GroupView(spark, path, ["submit_date", "minute"], ["submit_date"], marks, _MARKS, ["submit_date", "mark_no"],
                     ["version"], buckets)


def asof_view(spark: SparkSession, path: str, fact: StructType, fact_id: str, on: Sequence[str], ts: str, version: StructType,
              valid_from: str, buckets: int = 64, slice_seconds: int = 86_400) -> GroupView:
    """Lookup of a changing dimension: every fact with the version of its own time.  Rows are facts and versions
    in one stream, ``kind`` ``fact`` or ``version``, with the columns of both (null where they have none) and
    ``op``.  A version that arrives late corrects the facts it was valid for.  A batch recomputes the keys it touches, each
    split by time slice (``asof_join``)."""
    def lookup(live: DataFrame) -> DataFrame:
        of = lambda kind, schema: live.where(F.col("kind") == kind).select(*schema.names)
        return asof_join(of("fact", fact), of("version", version), on, ts, valid_from, slice_seconds)

    added = [f for f in version if f.name not in on]
    return GroupView(spark, path, [*on, "kind", fact_id, valid_from], on, lookup, StructType([*fact, *added]), [*on, fact_id],
                     buckets=buckets)


class LeftJoinView(_View):
    """``left LEFT JOIN right`` on ``on``, kept up to date as rows of either side come, change or go.

    A batch costs its own rows joined with the other side's touched buckets: new
    left rows meet all right rows, all old left rows meet the new right rows, and a
    left row's null-padded result is withdrawn with the first match of its key and
    comes back when the last is gone.  ``on`` is part of both sides' keys (a row that
    changes it is a delete and an insert); a null in it matches nothing.  Columns other than ``on`` are
    named differently on the two sides.
    """

    def __init__(self, spark: SparkSession, path: str, left: StructType, left_keys: Sequence[str], right: StructType,
                 right_keys: Sequence[str], on: Sequence[str], version: Sequence[str] = (), buckets: int = 64):
        self.on = list(on)
        self.extra = [f for f in right if f.name not in self.on]
        for side in (left_keys, right_keys):
            if not set(self.on) <= set(side):
                raise ValueError(f"{self.on} must be part of the keys {list(side)}")
        keys = [*left_keys, *[k for k in right_keys if k not in self.on]]
        super().__init__(spark, path, StructType([*left, *self.extra]), keys, self.on, buckets)
        table = lambda name, k: DeltaTable(spark, f"{self.path}/{name}", k, version, bucket_by=self.on, op_col=OP, buckets=buckets)
        self.sides = {"left": (table("left", left_keys), left), "right": (table("right", right_keys), right)}

    def _states(self, side: str, numbers: Sequence[int]) -> tuple[DataFrame, DataFrame]:
        """The touched buckets of a side before and after its last batch."""
        t, schema = self.sides[side]
        before, _ = t.commit_of(self.name)
        return t.read_or_empty(schema, before, numbers), t.read_or_empty(schema, None, numbers)

    def apply(self, left: DataFrame, right: DataFrame, batch_id: int) -> None:
        """One step: changes (rows with ``op``) of both sides, either of which may be empty."""
        batch = (self.name, batch_id)
        for side, rows in (("left", left), ("right", right)):
            self.sides[side][0].upsert(rows, batch)
        if self.result.applied(batch):
            return
        numbers = sorted({b for t, _ in self.sides.values() for b in t.touched(t.commit_of(self.name)[1])})
        # each input is dealt by the key over tasks of about TASK_ROWS rows, and each part of the result (dealt by its
        # whole rows) is made in a stage of its own: a task's memory does not depend on the size of batch or table
        tasks = max(1, -(-sum(t.stored_rows(numbers) for t, _ in self.sides.values()) // TASK_ROWS))
        dealt = lambda df: df.repartition(tasks, *self.on)
        old, new, changed = {}, {}, {}
        for s in self.sides:
            old[s], new[s] = map(dealt, self._states(s, numbers))
            changed[s] = changelog.difference(old[s], new[s])       # rows of other keys cancel out
        cols = self.result_schema.names
        padded = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.extra]
        # keys that got their first match (the padded row goes) or lost their last (it comes back)
        count = lambda df, had, gain: df.select(*self.on, had.alias("had"), gain.alias("gain"))
        gain = F.when(F.col(OP) == "D", -1).otherwise(1)
        matches = (count(old["right"], F.lit(1), F.lit(0)).unionByName(count(changed["right"], F.lit(0), gain)).dropna(subset=self.on)
                   .groupBy(*self.on).agg(F.sum("had").alias("had"), F.sum("gain").alias("gain")))
        flips = matches.where("(had > 0) <> (had + gain > 0)").select(*self.on, F.when(F.col("had") > 0, "I").otherwise("D").alias(OP))
        parts = (
            changed["left"].join(new["right"], self.on, "left"),        # changed left rows as they stand now
            old["left"].join(changed["right"], self.on),                # old left rows with changed right ones
            old["left"].join(flips, self.on).select("*", *padded),
        )
        # a row that two parts add and withdraw is no change
        both = functools.reduce(DataFrame.unionByName, [part.select(OP, *cols).repartition(tasks, *cols) for part in parts])
        net = changelog.net(both)
        self._publish(net, batch_id)


