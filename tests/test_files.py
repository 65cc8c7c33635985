import os

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tidewater.operators.aggregate import count_per_key
from tidewater.operators.rank import top_n
from tidewater.sources.files import read_csv, read_text_records

HERE = os.path.dirname(os.path.abspath(__file__))
PLAYER = StructType([StructField(n, t) for n, t in [
    ("season", StringType()), ("player", StringType()), ("play_num", StringType()), ("first_court", IntegerType()),
    ("time", DoubleType()), ("assists", DoubleType()), ("steals", DoubleType()), ("blocks", DoubleType()),
    ("scores", DoubleType())]])
SENSOR = StructType([StructField("id", StringType()), StructField("time", LongType()),
                     StructField("temperature", DoubleType())])


def test_player_filter_and_count(spark):
    df = read_csv(spark, os.path.join(HERE, "data", "players.csv"), PLAYER)
    df.createOrReplaceTempView("score")
    # reserved word column quoted
    assert spark.sql("SELECT count(*) FROM score WHERE player = 'Player Gamma' AND `time` > 34").first()[0] == 3
    counts = {r.player: r.cnt for r in count_per_key(df, ["player"]).collect()}
    assert counts == {"Player Alpha": 3, "Player Beta": 2, "Player Gamma": 4, "Player Délta": 1}


def test_sensor_top2(spark):
    df = read_text_records(spark, os.path.join(HERE, "data", "sensor.txt"), SENSOR)
    df = df.withColumn("ts", F.timestamp_seconds("time"))
    got = sorted((r.id, r.temperature) for r in
                 top_n(df, ["id"], [F.col("temperature").desc(), F.col("time")], 2).collect())
    assert got == [("probe_a", 28.0), ("probe_a", 30.5), ("probe_b", 18.5), ("probe_b", 19.0), ("probe_c", 25.25)]


def test_stream_csv_filter_to_view(spark, tmp_out):
    """Text stream -> typed rows -> temp view -> SQL filter (the file-filter job)."""
    from tidewater.sources.files import stream_csv
    from tidewater.streaming.sources import run_to_end
    s = stream_csv(spark, os.path.join(HERE, "data"), PLAYER, max_files_per_trigger=1)
    s = s.where(F.col("season").isNotNull() & F.col("player").isNotNull())
    s.createOrReplaceTempView("score_stream")
    out = spark.sql("SELECT season, player, scores FROM score_stream WHERE player = 'Player Alpha'")
    dest = tmp_out("csv-stream")
    run_to_end(out.writeStream.format("parquet").option("path", dest), tmp_out("csv-stream-ck"))
    assert spark.read.parquet(dest).count() == 3


def test_jdbc_reader_needs_one_of_table_or_query(spark):
    import pytest
    from tidewater.sources.jdbc import read_jdbc
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none", table="t", query="select 1")
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none")
