"""Idle keys, the watermark of every row, and files rolled by size, against plain Python."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators.lateness import RowWatermarkSink, row_watermark
from tidewater.operators.sized_files import SizedFileSink, export_sized, read_sized
from tidewater.session import local_path
from tidewater.streaming.retention import totals_until_idle
from tidewater.streaming.sources import file_stream, replay_as_files, run_to_end

T0 = dt.datetime(2024, 3, 1)


def hours(h):
    return T0 + dt.timedelta(hours=h)


def plain_lateness(rows, delay):
    """(id, watermark, late) of (id, order, ts), rows of one order not seeing one another."""
    top, out = None, []
    for o in sorted({r[1] for r in rows}, key=lambda x: (x is not None, x)):
        same = [r for r in rows if r[1] == o]
        mark = None if top is None else top - delay
        out += [(i, mark, bool(mark and t and t < mark)) for i, _, t in same]
        top = max((t for t in [top, *(r[2] for r in same)] if t), default=None)
    return sorted(out)


def test_row_watermark_in_ranges(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, *range(400)]), rng.choice([None, hours(rng.uniform(0, 60))])) for i in range(700)]
    df = spark.createDataFrame(rows, "id long, at long, ts timestamp_ntz")
    want = plain_lateness(rows, dt.timedelta(minutes=30))
    for ranges in (1, 7):
        got = row_watermark(df, ["at"], "ts", "30 minutes", ranges=ranges)
        assert sorted((r.id, r.watermark, r.late) for r in got.collect()) == want
    assert row_watermark(df.limit(0), ["at"], "ts").count() == 0
    with pytest.raises(ValueError, match="late"):
        row_watermark(df.withColumn("late", F.lit(1)), ["at"], "ts")


def test_row_watermark_goes_on_from_batch_to_batch(spark, tmp_out):
    rng = random.Random(4)
    rows = [(i, i, hours(rng.uniform(0, 60))) for i in range(90)]
    sink, schema = RowWatermarkSink(tmp_out("rw"), ["at"], "ts"), "id long, at long, ts timestamp"
    frame = lambda part: spark.createDataFrame(part, schema)
    for n, part in [(0, rows[:30]), (1, rows[30:60]), (1, rows[30:60]), (2, []), (3, rows[60:])]:   # batch 1 is retried
        sink(frame(part), n)
    got = sorted((r.id, r.watermark, r.late) for r in sink.read(spark, frame([]).schema).collect())
    assert got == plain_lateness(rows, dt.timedelta())


def test_totals_until_idle_on_both_sides_of_the_retention(spark, tmp_out):
    day = dt.timedelta(hours=24)
    rows = [("a", hours(0), 1), ("a", hours(23.99), 2), ("a", hours(47.9), 4),         # gaps under a day: one period
            ("b", hours(0), 1), ("b", hours(24), 2), ("b", hours(48.5), 4),              # at a day: still one; over it: a new one
            (None, hours(1), 7), ("c", None, 9), ("z", hours(80), 0)]
    schema = "k string, ts timestamp, v long"
    totals = [F.sum("v").alias("total")]
    batch = totals_until_idle(spark.createDataFrame(rows, schema), ["k"], "ts", totals)
    every = {(r.k, r.first_seen, r.last_seen, r.idle_at, r.total) for r in batch.collect()}
    assert every == {("a", hours(0), hours(47.9), hours(47.9) + day, 7), ("b", hours(0), hours(24), hours(48), 3), ("b", hours(48.5), hours(48.5), hours(72.5), 4),
                     (None, hours(1), hours(1), hours(25), 7), ("z", hours(80), hours(80), hours(104), 0)}
    path, dest, ckpt = tmp_out("idle-in"), tmp_out("idle-out"), tmp_out("idle-ckpt")
    for low, high in ((0, 24), (24, 60), (60, 100)):                                    # the state lives on between runs
        part = [r for r in rows if r[1] and hours(low) <= r[1] < hours(high)]
        replay_as_files(spark.createDataFrame(part, schema), "ts", 2, shuffled=True, path=path)
        out = totals_until_idle(file_stream(spark, path, batch.sparkSession.createDataFrame([], schema).schema), ["k"], "ts", totals)
        run_to_end(out.writeStream.format("parquet").outputMode("append").option("path", dest), ckpt)
    mark = hours(80) - dt.timedelta(seconds=3)
    got = {(r.k, r.first_seen, r.last_seen, r.idle_at, r.total) for r in spark.read.schema(batch.schema).parquet(dest).collect()}
    assert got == {r for r in every if r[3] <= mark}


def sizes(path):
    found = {}
    for folder, _, names in os.walk(local_path(path)):
        found.update({os.path.basename(folder): os.path.getsize(os.path.join(folder, n)) for n in names if n.startswith("part-")})
    return found


ODD = ["", None, " outer ", 'quo"te', "a,b", "line\nend", "carriage\r\nreturn", "back\\slash\\", '\\"', "#", "日本語", "\t"]


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_files_are_full_to_within_a_line(spark, tmp_out, fmt):
    rng, target, widest = random.Random(8), 20_000, 1_500
    rows = [(i, rng.choice(ODD) if i % 5 == 0 else "é" * rng.randint(0, 700) if i % 40 == 0 else "x" * rng.randint(0, 30)) for i in range(20_000)]
    df = spark.createDataFrame(rows, "id long, s string").repartition(3)
    path = tmp_out(f"sized-{fmt}")
    for _ in range(2):                                          # an export replaces the one before
        export_sized(df, path, target, fmt)
    assert sorted((r.id, r.s) for r in read_sized(spark, path, df.schema, fmt).collect()) == sorted(rows)
    found, tasks = sizes(path), {}
    for name, size in found.items():
        task, n = name.removeprefix("file=").split("-")
        tasks.setdefault(task, {})[int(n)] = size
    assert len(tasks) == 3 and len(found) > 12
    for by_number in tasks.values():
        assert sorted(by_number) == list(range(len(by_number)))
        assert all(abs(size - target) <= widest < target * 0.1 for n, size in by_number.items() if n + 1 < len(by_number))


def test_sized_files_of_odd_inputs(spark, tmp_out):
    lone = spark.createDataFrame([(None,), ("",), ("x" * 5000,), ("y",)], "s string").coalesce(1)
    export_sized(lone, tmp := tmp_out("lone"), 100)
    assert sorted(r.s or str(r.s) for r in read_sized(spark, tmp, lone.schema).collect()) == sorted(["None", "", "x" * 5000, "y"])
    export_sized(lone.limit(0), empty := tmp_out("none"), 100)
    assert read_sized(spark, empty, lone.schema).count() == 0
    with pytest.raises(ValueError):
        export_sized(lone, empty, 0)
    with pytest.raises(ValueError, match="csv or json"):
        export_sized(lone, empty, 100, "orc")


def test_sized_stream_rewrites_a_retried_batch(spark, tmp_out):
    df = spark.range(3000).select("id", F.repeat(F.lit("w"), (F.col("id") % 50).cast("int")).alias("s"))
    sink = SizedFileSink(tmp_out("sized-stream"), 4096)
    for n, part in [(0, "id < 1000"), (1, "id >= 1000"), (1, "id >= 1000")]:
        sink(df.where(part), n)
    assert sink.read(spark, df.schema).exceptAll(df).isEmpty() and sink.read(spark, df.schema).count() == 3000
