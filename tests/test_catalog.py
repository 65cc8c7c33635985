from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewater.operators.ddl import create_partitioned_table, create_table_like
from tidewater.sources.registry import Dataset, Registry
from tidewater.streaming.sinks import rolling_files
from tidewater.streaming.sources import file_stream, run_to_end

TARGET = StructType([StructField("ordercode", StringType()), StructField("suspenddesc", StringType()),
                     StructField("lastmodifytime", StringType()), StructField("dt", StringType())])


def test_partitioned_text_table_and_like(spark, tmp_out):
    create_partitioned_table(spark, "suspend_t", TARGET, ["dt"], fmt="csv", location=tmp_out("suspend"),
                             options={"sep": "\t"},
                             properties={"partition.time-extractor.timestamp-pattern": "$dt 00:00:00"})
    spark.createDataFrame([("o1", "x", "2020-01-01 10:00:00", "2020-01-01")], TARGET).write.insertInto("suspend_t")
    assert spark.table("suspend_t").count() == 1
    spark.sql("ALTER TABLE suspend_t ADD IF NOT EXISTS PARTITION (dt = '2020-01-02')")
    parts = [r[0] for r in spark.sql("SHOW PARTITIONS suspend_t").collect()]
    assert parts == ["dt=2020-01-01", "dt=2020-01-02"]
    create_table_like(spark, "suspend_copy", "suspend_t", location=tmp_out("suspend-copy"))
    assert spark.table("suspend_copy").schema.names == spark.table("suspend_t").schema.names
    assert spark.table("suspend_copy").count() == 0


def test_registry_and_schema_introspection(spark, tmp_out):
    path = tmp_out("reg")
    spark.createDataFrame([("a", "2020-01-01")], "k string, p_day string").write.partitionBy("p_day").parquet(path)
    reg = Registry(spark)
    reg.add(Dataset("ods.t", path, partition_cols=("p_day",), keys=("k",)))
    assert reg.schema("ods.t").names == ["k", "p_day"]
    reg.view("ods.t", "t")
    assert spark.sql("SELECT k FROM t WHERE p_day BETWEEN '2020-01-01' AND '2020-09-31'").count() == 1


def test_rolling_file_sink(spark, tmp_out):
    src, out = tmp_out("roll-src"), tmp_out("roll-out")
    spark.range(10).select(F.col("id"), (F.col("id") % 2).cast("string").alias("dt")).write.parquet(src)
    s = file_stream(spark, src, spark.read.parquet(src).schema)
    run_to_end(rolling_files(s, out, ["dt"], roll_records=2, rollover_interval=None), tmp_out("roll-ck"))
    assert spark.read.parquet(out).count() == 10
