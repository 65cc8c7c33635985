"""Merge-on-read table: upserts, snapshots, compaction, pruning, failures."""

import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators.delta_table import DeltaTable
from tidewater.sources import fs

SCHEMA = "k string, v long, op string"


def rows_of(df):
    return sorted((r.k, r.v) for r in df.collect())


def size_of(spark, path):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def test_upserts_deletes_and_compaction_follow_a_plain_dictionary(spark, tmp_out):
    rng = random.Random(3)
    t, want = DeltaTable(spark, tmp_out("delta"), ["k"], buckets=4, op_col="op", most=2), {}
    for step in range(6):
        batch = {f"k{rng.randrange(30)}": (rng.randrange(1000), rng.choice("IUUD")) for _ in range(12)}
        t.upsert(spark.createDataFrame([(k, v, op) for k, (v, op) in batch.items()], SCHEMA), ("q", step))
        for k, (v, op) in batch.items():
            want.pop(k, None) if op == "D" else want.__setitem__(k, v)
        assert rows_of(t.read()) == sorted(want.items())
        assert all(len(parts) <= 2 for parts in t.manifest()["buckets"].values())
    again = DeltaTable.open(spark, t.path)
    again.compact(0)
    again.vacuum()
    assert rows_of(again.read()) == sorted(want.items())
    assert len(fs.list_names(spark, f"{t.path}/data")) == 1


def test_a_batch_is_committed_once(spark, tmp_out):
    t = DeltaTable(spark, tmp_out("once"), ["k"], buckets=2)
    rows = spark.createDataFrame([("a", 1, "I")], SCHEMA)
    assert t.upsert(rows, ("q", 0)) == t.upsert(rows.withColumn("v", F.lit(9).cast("long")), ("q", 0)) == 0
    assert rows_of(t.read()) == [("a", 1)]


def test_bytes_of_a_small_upsert_do_not_grow_with_the_table(spark, tmp_out):
    written = []
    for n in (1_000, 200_000):
        t = DeltaTable(spark, tmp_out(f"bytes-{n}"), ["k"], buckets=8)
        t.upsert(spark.range(n).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v"), F.lit("I").alias("op")))
        before = size_of(spark, t.path)
        t.upsert(spark.range(50).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(-1).cast("long").alias("v"), F.lit("U").alias("op")))
        written.append(size_of(spark, t.path) - before)
        assert t.read().where("v = -1").count() == 50 and t.read().count() == n
    assert written[1] < 1.2 * written[0]


def test_readers_keep_their_snapshot_and_never_see_a_broken_compaction(spark, tmp_out, monkeypatch):
    t = DeltaTable(spark, tmp_out("snap"), ["k"], buckets=2, op_col="op", most=100)
    for i in range(4):
        t.upsert(spark.createDataFrame([("a", i, "U"), (f"b{i}", i, "I")], SCHEMA))
    want, old = rows_of(t.read()), rows_of(t.read(version=1))
    reader = t.read()                                   # planned before the compaction
    monkeypatch.setattr(t, "_commit", lambda snapshot: (_ for _ in ()).throw(OSError("died")))
    with pytest.raises(OSError):
        t.compact(1)
    assert rows_of(t.read()) == want                    # files no manifest names
    monkeypatch.undo()
    t.compact(1)
    assert rows_of(t.read()) == want == rows_of(reader) and rows_of(t.read(version=1)) == old
    t.vacuum()
    assert rows_of(t.read()) == want and t.versions() == [t.manifest()["version"]]


def test_ties_fail_unless_the_rows_are_equal(spark, tmp_out):
    t = DeltaTable(spark, tmp_out("ties"), ["k"], ["v"], buckets=2)
    t.upsert(spark.createDataFrame([("a", 1, "I"), ("a", 1, "I"), ("a", 0, "U")], SCHEMA))
    assert rows_of(t.read()) == [("a", 1)]
    with pytest.raises(Exception, match="different updates of one key"):
        t.upsert(spark.createDataFrame([("a", 5, "I"), ("a", 5, "U")], SCHEMA))
    assert rows_of(t.read()) == [("a", 1)]
    t.upsert(spark.createDataFrame([("a", 0, "U")], SCHEMA))     # an older version that comes late
    assert rows_of(t.read()) == [("a", 1)]


def test_reads_open_only_the_files_they_need(spark, tmp_out):
    t = DeltaTable(spark, tmp_out("prune"), ["k"], buckets=8)
    t.upsert(spark.createDataFrame([(f"k{i:03d}", i, "I") for i in range(100)], SCHEMA))
    t.upsert(spark.createDataFrame([("k050", -1, "U")], SCHEMA))
    one = t.touched(spark.createDataFrame([("k050",)], "k string"))
    assert len(one) == 1 and len(t.files(buckets=one)) == 2 and len(t.files()) == 9
    assert ("k050", -1) in rows_of(t.read(buckets=one))
    assert len(t.files(keys=("z", "zz"))) == 0 and rows_of(t.read(keys=("z", "zz"))) == []
    opened = {f for f, _ in t.files(keys=("k050", "k050"))}
    assert {f for f, _ in t.files(buckets=one)} <= opened


def test_wrong_columns_and_settings_are_refused(spark, tmp_out):
    t = DeltaTable(spark, tmp_out("cols"), ["k"], buckets=2)
    t.upsert(spark.createDataFrame([("a", 1, "I")], SCHEMA))
    with pytest.raises(ValueError, match="differ"):
        t.upsert(spark.createDataFrame([("a", 1)], "k string, w long"))
    with pytest.raises(ValueError, match="was made with"):
        DeltaTable(spark, t.path, ["k"], buckets=3).upsert(spark.createDataFrame([("a", 1, "I")], SCHEMA))
    with pytest.raises(ValueError, match="no commit yet"):
        DeltaTable.open(spark, tmp_out("none"))
    empty = DeltaTable(spark, tmp_out("empty"), ["k"], buckets=2)
    empty.upsert(spark.createDataFrame([], SCHEMA))
    assert rows_of(empty.read()) == []
