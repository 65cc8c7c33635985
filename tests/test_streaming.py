import os

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidewater.operators.milestones import sales_milestones
from tidewater.session import local_path
from tidewater.sources.order_model import cdc_from_events
from tidewater.sources.tables import read_table
from tidewater.streaming.partition_commit import PartitionCommitSink
from tidewater.streaming.sales import MilestoneSink, MinuteSalesSink, streaming_amounts
from tidewater.streaming.sources import file_stream, replay_as_files, run_to_end, with_event_time
from tidewater.streaming.topn import TopNState


def _events(spark):
    return read_table(spark, SF_SMALL, "events")


def test_topn_state_retry_is_idempotent(spark, tmp_out):
    e = _events(spark).select("user_id", "event_id", "value")
    state = TopNState(tmp_out("topn"), ["user_id"], [F.col("value").desc(), F.col("event_id")], ["event_id"], 2, 4)
    half = e.where(F.col("event_id") % 2 == 0)
    state(half, 0)
    state(e.where(F.col("event_id") % 2 == 1), 1)
    first = sorted(tuple(r) for r in state.read(spark).collect())
    state(e.where(F.col("event_id") % 2 == 1), 1)  # the same batch again
    assert sorted(tuple(r) for r in state.read(spark).collect()) == first
    assert len(first) <= 2 * e.select("user_id").distinct().count()


def test_partition_commit_minutes(spark, tmp_out):
    e = _events(spark).where(F.col("ts") < F.lit("2024-01-01 02:00:00").cast("timestamp_ntz"))
    src = replay_as_files(e, "ts", 3, name="pc-src")
    s = with_event_time(file_stream(spark, src, e.schema), "ts", "0 seconds", out="event_time")
    s = s.select("user_id", F.col("value").alias("order_amount"), "event_time",
                 F.date_format("event_time", "yyyy-MM-dd").alias("dt"), F.date_format("event_time", "HH").alias("h"),
                 F.date_format("event_time", "mm").alias("m"))
    path = tmp_out("pc-table")
    # commit a minute partition once the watermark has passed its end
    sink = PartitionCommitSink(path, ["dt", "h", "m"], "event_time", "$dt $h:$m:00", commit_delay="1 minute")
    run_to_end(s.writeStream.foreachBatch(sink), tmp_out("pc-ckpt"))
    table = sink.read(spark)
    assert table.count() == e.count()
    committed = sink.committed(spark)
    parts = {(r.dt, r.h, r.m) for r in table.select("dt", "h", "m").distinct().collect()}
    done = {(c["dt"], c["h"], c["m"]) for c in committed}
    assert done == parts - {max(parts)}
    for c in committed:
        assert os.path.exists(os.path.join(local_path(path), f"dt={c['dt']}/h={c['h']}/m={c['m']}/_SUCCESS"))
    # a retried batch rewrites its own files only
    batch = table.drop("batch_id").where(F.col("batch_id") == "0")
    sink(batch, 0)
    assert sink.read(spark).count() == e.count()


def test_restart_from_checkpoint(spark, tmp_out):
    e = cdc_from_events(_events(spark))
    src, out, ckpt = tmp_out("rs-src"), tmp_out("rs-out"), tmp_out("rs-ckpt")
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    raw = _events(spark)
    replay_as_files(raw.where(F.col("ts") < cut), "ts", 2, path=src)

    def run():
        s = cdc_from_events(file_stream(spark, src, raw.schema)).where(F.col("data_op_type") == "I")
        run_to_end(s.writeStream.format("parquet").option("path", out), ckpt)

    run()
    part = spark.read.parquet(out).count()
    replay_as_files(raw.where(F.col("ts") >= cut), "ts", 2, path=src)
    run()  # resumes from the checkpoint: only the new files are read
    want = e.where(F.col("data_op_type") == "I").count()
    assert 0 < part < want
    assert spark.read.parquet(out).count() == want


def test_late_data_milestones_recomputed(spark, tmp_out):
    e = _events(spark).where(F.col("event_type") == "purchase")
    src = replay_as_files(e, "ts", 6, name="late-src", shuffled=True)
    s = streaming_amounts(file_stream(spark, src, e.schema, max_files_per_trigger=2), "ts", "value")
    sink = MilestoneSink(tmp_out("late-min"), tmp_out("late-marks"), 100)
    run_to_end(s.writeStream.foreachBatch(sink), tmp_out("late-ckpt"))
    got = sorted(tuple(r) for r in sink.read_marks(spark).collect())
    want = sorted(tuple(r) for r in sales_milestones(e, "ts", "value", 100).collect())
    assert got == want and len(want) > 0


def test_minute_partials_survive_retries_and_compaction(spark, tmp_out):
    e = _events(spark).select(F.col("ts").alias("event_time"), F.col("value").cast("decimal(28,8)").alias("amount"))
    sink = MinuteSalesSink(tmp_out("partials"))
    for i in range(4):
        sink(e.where(F.pmod(F.hash("amount"), F.lit(4)) == i), i)
    sink(e.where(F.pmod(F.hash("amount"), F.lit(4)) == 2), 2)          # a retried batch
    sink(e.limit(1).select(F.lit(None).cast("timestamp").alias("event_time"), "amount"), 4)  # no event time
    want = sorted(map(tuple, sink.read(spark).collect()))
    assert sum(r[2] for r in want) == e.agg(F.sum("amount")).first()[0]
    sink.compact(spark, 2)
    assert sorted(map(tuple, sink.read(spark).collect())) == want
    sink.compact(spark, 4)
    assert sorted(map(tuple, sink.read(spark).collect())) == want and len(sink._folders(spark)) == 1


def test_commit_ignores_rows_without_event_time(spark, tmp_out):
    rows = [(1, "2024-01-01 00:10:00"), (2, None), (3, "2024-01-02 00:10:00")]
    df = spark.createDataFrame(rows, "k int, t string").select("k", F.to_timestamp("t").alias("event_time"))
    df = df.withColumn("dt", F.date_format("event_time", "yyyy-MM-dd"))
    sink = PartitionCommitSink(tmp_out("null-time"), ["dt"], "event_time", "$dt 00:00:00", commit_delay="1 day")
    sink(df, 0)
    sink(df, 0)                                                          # the retry passes too
    assert sink.committed(spark) == [{"dt": "2024-01-01"}] and sink.read(spark).count() == 3


def test_crash_between_data_and_tracker(spark, tmp_out, monkeypatch):
    df = spark.createDataFrame([(1, "2024-01-01 00:10:00"), (2, "2024-01-03 00:10:00")], "k int, t string")
    df = df.select("k", F.to_timestamp("t").alias("event_time")).withColumn("dt", F.date_format("event_time", "yyyy-MM-dd"))
    sink = PartitionCommitSink(tmp_out("crash"), ["dt"], "event_time", "$dt 00:00:00", commit_delay="1 day")
    with monkeypatch.context() as m:
        m.setattr(sink, "_save", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        try:
            sink(df, 0)
        except OSError:
            pass
    assert sink.committed(spark) == []
    sink(df, 0)
    assert sink.committed(spark) == [{"dt": "2024-01-01"}] and sink.read(spark).count() == 2


def test_topn_state_fails_on_a_changed_schema(spark, tmp_out):
    import pytest
    e = _events(spark).select("user_id", "event_id", "value")
    state = TopNState(tmp_out("topn-schema"), ["user_id"], [F.col("value").desc(), F.col("event_id")], ["event_id"], 2, 4)
    state(e, 0)
    before = sorted(map(tuple, state.read(spark).collect()))
    with pytest.raises(Exception):
        state(e.withColumn("more", F.lit(1)), 1)
    assert sorted(map(tuple, state.read(spark).collect())) == before


def test_topn_orders_nulls_as_spark_does():
    import pandas as pd

    from tidewater.streaming.topn import _in_order
    f = pd.DataFrame({"v": [None, 2.0, 1.0], "i": [1, 2, 3]})
    assert _in_order(f, [("v", False), ("i", False)])["i"].tolist() == [1, 3, 2]
    assert _in_order(f, [("v", True), ("i", False)])["i"].tolist() == [2, 3, 1]


def test_sensor_stream_top2_epoch_watermark(spark, tmp_out):
    """Text lines -> typed rows -> epoch-second watermark -> continuously updated top-2."""
    from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType
    from tidewater.sources.files import parse_delimited
    here = os.path.dirname(os.path.abspath(__file__))
    schema = StructType([StructField("id", StringType()), StructField("time", LongType()),
                         StructField("temperature", DoubleType())])
    lines = spark.readStream.format("text").option("pathGlobFilter", "sensor.txt").load(os.path.join(here, "data"))
    s = with_event_time(parse_delimited(lines, schema), "time", "1 second", out="ts")
    state = TopNState(tmp_out("sensor-top"), ["id"], [F.col("temperature").desc(), F.col("time")], ["time"], 2, 4)
    run_to_end(s.select("id", "time", "temperature").writeStream.foreachBatch(state), tmp_out("sensor-ck"))
    got = sorted((r.id, r.temperature) for r in state.read(spark).collect())
    assert got == [("probe_a", 28.0), ("probe_a", 30.5), ("probe_b", 18.5), ("probe_b", 19.0), ("probe_c", 25.25)]


def test_stateful_top_n_matches_batch(spark, tmp_out):
    """Keyed-state top-N (transformWithStateInPandas) over two micro-batches."""
    from tidewater.operators.rank import top_n
    from tidewater.streaming.topn import stateful_top_n
    e = _events(spark).select("user_id", "event_id", "value")
    src = replay_as_files(e, "event_id", 2, name="tws-src")
    top = stateful_top_n(file_stream(spark, src, e.schema), ["user_id"], [("value", True), ("event_id", False)],
                         ["event_id"], 2)
    name = "tws_out"
    q = (top.writeStream.outputMode("update").format("memory").queryName(name)
         .option("checkpointLocation", tmp_out("tws-ck")).trigger(availableNow=True).start())
    q.awaitTermination(240)
    assert not q.isActive
    # emissions only ever improve a key's top-N, so the top-N over everything
    # emitted is the current top-N
    emitted = spark.table(name).select("user_id", "event_id", "value").distinct()
    got = sorted(tuple(r) for r in top_n(emitted, ["user_id"], [F.col("value").desc(), F.col("event_id")], 2).collect())
    want = sorted(tuple(r) for r in top_n(e, ["user_id"], [F.col("value").desc(), F.col("event_id")], 2).collect())
    assert got == want


def test_partition_compaction_on_commit(spark, tmp_out):
    e = _events(spark).where(F.col("ts") < F.lit("2024-01-03 00:00:00").cast("timestamp_ntz"))
    src = replay_as_files(e, "ts", 4, name="cmp-src")
    s = with_event_time(file_stream(spark, src, e.schema, max_files_per_trigger=1), "ts", "0 seconds", out="event_time")
    s = s.select("event_id", "event_time", F.date_format("event_time", "yyyy-MM-dd").alias("dt"))
    path = tmp_out("cmp-table")
    sink = PartitionCommitSink(path, ["dt"], "event_time", "$dt 00:00:00", commit_delay="1 day",
                               compact_on_commit=True)
    run_to_end(s.writeStream.foreachBatch(sink), tmp_out("cmp-ckpt"))
    table = sink.read(spark)
    assert table.count() == e.count()
    assert table.select("event_id").distinct().count() == e.count()
    committed = sink.committed(spark)
    assert [c["dt"] for c in committed] == ["2024-01-01"]
    batches = [d for d in os.listdir(os.path.join(local_path(path), "dt=2024-01-01")) if d.startswith("batch_id=")]
    assert len(batches) == 1 and batches[0].startswith("batch_id=c")  # one compacted folder
    sink.compact(spark, {"dt": "2024-01-01"})  # re-run: nothing changes
    assert sink.read(spark).count() == e.count()
