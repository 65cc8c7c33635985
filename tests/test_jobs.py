from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidewater.operators.upsert import read_upserted
from tidewater.plans import facts, jobs
from tidewater.plans.batch_queries import CDC_DAY, ODS_CDC_SCHEMA
from tidewater.sources.order_model import OrderModel


def test_facts_are_served_whole_and_again(spark, tmp_out):
    m = OrderModel(spark, SF_SMALL)
    for job, fact, schema in ((jobs.dwd_retail_submit_job, facts.retail_submit_fact(m), facts.DWD_SUBMIT_SCHEMA),
                              (jobs.dwd_retail_pay_job, facts.retail_pay_fact(m), facts.DWD_PAY_SCHEMA)):
        target, n = tmp_out("dwd"), fact.count()
        for _ in range(2):                       # rerun: same table, no fact row lost
            job(spark, m, target)
            table = read_upserted(spark, target)
            assert table.count() == table.select("id").distinct().count() == n > 0
        assert set(table.columns) == set(schema.names) | {"p_day"}


def test_sync_to_serving(spark, tmp_out):
    from tidewater.plans.batch_queries import SERVING_ORDER_SCHEMA
    from tidewater.operators.cdc import with_cdc_columns
    o = with_cdc_columns(OrderModel(spark, SF_SMALL).om_order(), wall_clock=False)
    target = tmp_out("serving-sync")
    jobs.sync_to_serving(spark, o, target, SERVING_ORDER_SCHEMA, ["ordercode"])
    jobs.sync_to_serving(spark, o.where("ordercode % 2 = 0").withColumn("shopcode", F.lit("moved")), target,
                         SERVING_ORDER_SCHEMA, ["ordercode"])
    t = read_upserted(spark, target)
    assert t.count() == o.count()
    assert t.where((F.col("shopcode") == "moved") != (F.col("ordercode").cast("long") % 2 == 0)).count() == 0


def test_sync_by_table_names(spark, tmp_out):
    from tidewater.sources.registry import Dataset, Registry
    m = OrderModel(spark, SF_SMALL)
    src, dst, log = tmp_out("src-cdc"), tmp_out("dst-cdc"), tmp_out("orders")
    m.cdc().write.parquet(src)
    reg = Registry(spark)
    reg.add(Dataset("store.om_order_cdc", src))
    reg.use("ods")
    reg.add(Dataset("om_order_cdc", dst, schema=ODS_CDC_SCHEMA, partition_cols=("p_day",)))
    jobs.sync_day(reg, "store.om_order_cdc", "om_order_cdc", CDC_DAY)
    day = F.lit(CDC_DAY)
    want = m.cdc().where((F.date_format("data_op_ts", "yyyy-MM-dd") == day) | (F.date_format("ordertime", "yyyy-MM-dd") == day))
    assert reg.read("om_order_cdc").count() == want.count() > 0
    reg.add(Dataset("loaded", log, schema=reg.read("store.om_order_cdc").schema))
    jobs.load_table(reg, "store.om_order_cdc", "loaded")
    jobs.load_table(reg, "store.om_order_cdc", "ods.loaded", "detailid", 5)
    assert reg.read("loaded").count() == m.cdc().count() + 5
    import pytest
    with pytest.raises(KeyError):
        reg.get("om_missing")


def test_processing_time_column(spark):
    from tidewater.operators.enrich import with_proctime
    rows = with_proctime(spark.range(3)).select("proctime").distinct().collect()
    assert len(rows) == 1 and rows[0].proctime is not None


def test_ods_increment_and_delete_log(spark, tmp_out):
    m = OrderModel(spark, SF_SMALL)
    ods, dlog = tmp_out("ods-cdc"), tmp_out("ods-del")
    jobs.ods_increment(m.cdc(), CDC_DAY, ods, ODS_CDC_SCHEMA)
    jobs.ods_increment(m.cdc(), "2024-01-11", ods, ODS_CDC_SCHEMA, exclude_deletes=True)
    jobs.ods_increment(m.cdc(), CDC_DAY, ods, ODS_CDC_SCHEMA)  # re-run replaces the day
    t = spark.read.parquet(ods)
    days = {r.p_day: r.n for r in t.groupBy("p_day").agg(F.count(F.lit(1)).alias("n")).collect()}
    want = m.cdc().where(F.date_format("data_op_ts", "yyyy-MM-dd").eqNullSafe(CDC_DAY)
                         | F.date_format("ordertime", "yyyy-MM-dd").eqNullSafe(CDC_DAY)).count()
    assert days[CDC_DAY] == want
    assert t.where((F.col("p_day") == "2024-01-11") & (F.col("data_op_type") == "D")).count() == 0
    jobs.ods_delete_log(m.cdc(), CDC_DAY, dlog, ODS_CDC_SCHEMA)
    assert spark.read.parquet(dlog).where(F.col("data_op_type") != "D").count() == 0


def test_bulk_export_csv(spark, tmp_out):
    from tidewater.plans.batch_queries import EXPORT_SCHEMA
    path = tmp_out("export")
    jobs.bulk_export_csv(OrderModel(spark, SF_SMALL), ("1998-01-01", "1998-12-31"), path, EXPORT_SCHEMA, shift=-8,
                         max_records_per_file=50)
    rows = spark.read.text(path).count()
    assert rows == OrderModel(spark, SF_SMALL).om_orderdetail(("1998-01-01", "1998-12-31")).count() > 0


def test_backfill_serving_and_ts_check_load(spark, tmp_out):
    from pyspark.sql.types import StructField, StructType, TimestampNTZType
    from tidewater.plans.batch_queries import SERVING_ORDER_SCHEMA
    m = OrderModel(spark, SF_SMALL)
    days = ("1998-01-01", "1998-12-31")
    target = tmp_out("serving")
    schema = StructType(list(SERVING_ORDER_SCHEMA.fields) + [StructField("data_modified_datetime", TimestampNTZType())])
    src = m.om_order(days)
    jobs.backfill_serving(spark, src, target, schema, ["ordercode"], ["createdate"])
    jobs.backfill_serving(spark, src, target, schema, ["ordercode"], ["createdate"])  # idempotent
    t = read_upserted(spark, target)
    assert t.count() == src.count() and t.where(F.col("is_delete").isNotNull()).count() == 0
    assert t.where(F.col("data_modified_datetime").isNull()).count() == 0
    path = tmp_out("ts-check")
    jobs.ts_check_load(m.om_order(("1998-03-10", "1998-03-10")).drop("p_day"), "createdate", "1998-03-10", path)
    back = spark.read.parquet(path)
    assert back.where(F.col("createdate_text") != F.col("createdate").cast("string")).count() == 0
