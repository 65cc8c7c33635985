import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from tidewater.operators import sinks
from tidewater.operators.upsert import latest_per_key, read_upserted, upsert
from tidewater.session import local_path

ROWS = [("k1", "2020-11-01", 1, "I", dt.datetime(2020, 11, 1, 1)),
        ("k2", "2020-11-01", 2, "I", dt.datetime(2020, 11, 1, 2)),
        ("k3", "2020-11-02", 3, "I", dt.datetime(2020, 11, 2, 3))]
SCHEMA = "k string, p_day string, v int, data_op_type string, data_op_ts timestamp_ntz"


def test_overwrite_partition_keeps_others(spark, tmp_out):
    path = tmp_out("ow")
    df = spark.createDataFrame(ROWS, SCHEMA)
    sinks.overwrite_partitions(df, path, ["p_day"])
    repl = spark.createDataFrame([("k9", 9, "I", dt.datetime(2020, 11, 1))],
                                 "k string, v int, data_op_type string, data_op_ts timestamp_ntz")
    sinks.overwrite_partition(repl, path, {"p_day": "2020-11-01"})
    got = sorted((r.k, r.p_day) for r in spark.read.parquet(path).collect())
    assert got == [("k3", "2020-11-02"), ("k9", "2020-11-01")]
    # p_day stays a string on read-back (no type inference)
    assert dict(spark.read.parquet(path).dtypes)["p_day"] == "string"


def test_append_and_csv_roll(spark, tmp_out):
    path, csv = tmp_out("app"), tmp_out("csv")
    df = spark.createDataFrame(ROWS, SCHEMA)
    sinks.append(df, path, ["p_day"])
    sinks.append(df, path, ["p_day"])
    assert spark.read.parquet(path).count() == 6
    sinks.export_csv(df.coalesce(1), csv, max_records_per_file=1)
    files = glob.glob(os.path.join(local_path(csv), "part-*.csv"))
    assert len(files) == 3


def test_multi_sink_computes_once(spark, tmp_out):
    a, b = tmp_out("ms-a"), tmp_out("ms-b")
    df = spark.createDataFrame(ROWS, SCHEMA)
    sinks.multi_sink(df, [lambda d: d.write.parquet(a), lambda d: sinks.export_csv(d, b)])
    assert spark.read.parquet(a).count() == 3 and spark.read.text(b).count() == 3


def test_latest_per_key_handles_hot_key(spark):
    # one key holds most rows: partial aggregation keeps one row per task
    rows = [("hot", i, dt.datetime(2020, 1, 1) + dt.timedelta(seconds=i)) for i in range(2000)]
    rows += [("cold", 1, dt.datetime(2020, 1, 1))]
    df = spark.createDataFrame(rows, "k string, v int, ts timestamp_ntz").repartition(8)
    got = {r.k: r.v for r in latest_per_key(df, ["k"], ["ts", "v"]).collect()}
    assert got == {"hot": 1999, "cold": 1}


def test_upsert_replaces_by_key_and_is_idempotent(spark, tmp_out):
    path = tmp_out("upsert")
    upsert(spark, path, spark.createDataFrame(ROWS, SCHEMA), ["k"], ["data_op_ts"], buckets=3)
    upd = spark.createDataFrame([
        ("k1", "2020-11-09", 10, "U", dt.datetime(2020, 10, 1, 5)),   # older by its own time, another day: it replaces
        ("k2", "2020-11-01", 0, "D", dt.datetime(2020, 11, 1, 6)),
        ("k3", None, 0, "D", dt.datetime(2020, 11, 2, 6)),
        ("k4", None, 4, "I", dt.datetime(2020, 11, 3, 1)),
        ("k1", "2020-11-01", 7, "U", dt.datetime(2020, 9, 1, 4)),     # of two updates of a key, order decides
    ], SCHEMA)
    for _ in range(2):                                                # the retry gives the same table
        upsert(spark, path, upd, ["k"], ["data_op_ts"], buckets=3)
        got = sorted((r.k, r.v, r.p_day) for r in read_upserted(spark, path).collect())
        assert got == [("k1", 10, "2020-11-09"), ("k4", 4, None)]


def test_upsert_leaves_a_target_it_cannot_read(spark, tmp_out):
    path = tmp_out("upsert-broken")
    upsert(spark, path, spark.createDataFrame(ROWS, SCHEMA), ["k"], ["data_op_ts"], buckets=1)
    before = sorted(os.listdir(os.path.join(local_path(path), "_bucket=0")))
    upd = spark.createDataFrame([("k1", "2020-11-01", 5, "U", dt.datetime(2020, 11, 2))], SCHEMA)
    with pytest.raises(ValueError, match="columns"):
        upsert(spark, path, upd.withColumn("more", F.lit(1)), ["k"], ["data_op_ts"], buckets=1)
    assert sorted(os.listdir(os.path.join(local_path(path), "_bucket=0"))) == before
    with open(os.path.join(local_path(path), "_bucket=0", "part-broken.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        upsert(spark, path, upd, ["k"], ["data_op_ts"], buckets=1)
    os.remove(os.path.join(local_path(path), "_bucket=0", "part-broken.parquet"))
    assert sorted((r.k, r.v) for r in read_upserted(spark, path).collect()) == [("k1", 1), ("k2", 2), ("k3", 3)]


def test_overwrite_partition_with_empty_input_empties_it(spark, tmp_out):
    path = tmp_out("ow-empty")
    sinks.overwrite_partitions(spark.createDataFrame(ROWS, SCHEMA), path, ["p_day"])
    empty = spark.createDataFrame([], "k string, v int, data_op_type string, data_op_ts timestamp_ntz")
    sinks.overwrite_partition(empty, path, {"p_day": "2020-11-01"})
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == ["k3"]


def test_print_sinks(spark, tmp_out, capsys):
    from tidewater.streaming.sinks import console
    from tidewater.streaming.sources import file_stream, replay_as_files, run_to_end
    df = spark.createDataFrame(ROWS, SCHEMA)
    sinks.show(df.select("k"))
    assert "k1" in capsys.readouterr().out
    stream = file_stream(spark, replay_as_files(df, "v", 1), df.schema)
    run_to_end(console(stream), tmp_out("console-ckpt"))       # it prints from the JVM: only that it runs


def test_tables_added_later_are_seen(spark, tmp_out):
    from tidewater.sources.tables import read_table
    root = tmp_out("grow")
    df = spark.createDataFrame(ROWS, SCHEMA)
    df.write.parquet(f"{root}/customer.parquet")
    assert read_table(spark, root, "customer").count() == 3
    df.write.mode("append").parquet(f"{root}/customer.parquet")
    assert read_table(spark, root, "customer").count() == 6
