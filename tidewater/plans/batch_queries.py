"""Batch queries over the order model (registered for the oracle check)."""

from __future__ import annotations

from tidewater.plans import facts
from tidewater.plans import oracle as sql
from tidewater.plans.registry import register
from tidewater.session import apply_conf
from tidewater.sources.order_model import OrderModel


def _model(spark, sf_dir) -> OrderModel:
    apply_conf(spark)
    return OrderModel(spark, sf_dir)


def _warehouse(spark, sf_dir, *names):
    """The named model tables written out in the production layout."""
    from tidewater.session import scratch_dir
    from tidewater.sources.warehouse import WarehouseTables, build_ods
    return WarehouseTables(spark, build_ods(_model(spark, sf_dir), scratch_dir(spark, "ods"), names=names))


@register("dwd_retail_submit", sql.submit_fact_sql(*facts.SUBMIT_DAYS))
def dwd_retail_submit(spark, sf_dir):
    return facts.retail_submit_fact(_model(spark, sf_dir))


@register("paid_days", sql.paid_days_sql(*facts.PAY_DAYS))
def paid_days(spark, sf_dir):
    return facts.paid_days(_model(spark, sf_dir))


@register("dwd_retail_pay", sql.pay_fact_sql(*facts.PAY_DAYS))
def dwd_retail_pay(spark, sf_dir):
    return facts.retail_pay_fact(_model(spark, sf_dir))


# ---------------------------------------------------------------------------
# Change-capture slices (ODS sync jobs B3-B5)

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import (ByteType, DecimalType, FloatType, LongType, ShortType,  # noqa: E402
                               StringType, StructField, StructType, TimestampNTZType)

from tidewater.functions.casts import schema_cast  # noqa: E402
from tidewater.operators import cdc as cdcops  # noqa: E402

CDC_DAY = "2024-01-10"
CDC_FIELDS_DAY = "2024-01-20"
CDC_FIELDS = ("ordertime", "data_op_ts")

# ODS target of the change-captured rows (p_day is the static partition).
ODS_CDC_SCHEMA = StructType([
    StructField("detailid", LongType()), StructField("ordercode", LongType()),
    StructField("value", DecimalType(18, 4)), StructField("data_op_type", StringType()),
    StructField("data_op_ts", TimestampNTZType()), StructField("ordertime", TimestampNTZType()),
    StructField("p_day", StringType()),
])

_CDC_COLS = """CAST(detailid AS BIGINT) AS detailid, CAST(ordercode AS BIGINT) AS ordercode,
       CAST(value AS DECIMAL(18,4)) AS value, data_op_type, data_op_ts, ordertime"""


def _ods(df, day):
    return schema_cast(df, ODS_CDC_SCHEMA, exclude=["p_day"]).withColumn("p_day", F.lit(day))


def _day_eq(c, d):
    return f"strftime({c}, '%Y-%m-%d') = '{d}'"


@register("cdc_increment", sql.with_model(
    f"SELECT {_CDC_COLS}, '{CDC_DAY}' AS p_day FROM cdc "
    f"WHERE {_day_eq('data_op_ts', CDC_DAY)} OR {_day_eq('ordertime', CDC_DAY)}", "cdc"))
def cdc_increment(spark, sf_dir):
    return _ods(cdcops.slice_day(_model(spark, sf_dir).cdc(), CDC_DAY), CDC_DAY)


@register("cdc_increment_fields", sql.with_model(
    f"SELECT {_CDC_COLS}, '{CDC_FIELDS_DAY}' AS p_day FROM cdc "
    f"WHERE {' OR '.join(_day_eq(c, CDC_FIELDS_DAY) for c in CDC_FIELDS)}", "cdc"))
def cdc_increment_fields(spark, sf_dir):
    return _ods(cdcops.slice_day(_model(spark, sf_dir).cdc(), CDC_FIELDS_DAY, CDC_FIELDS), CDC_FIELDS_DAY)


@register("cdc_increment_no_delete", sql.with_model(
    f"SELECT {_CDC_COLS}, '{CDC_DAY}' AS p_day FROM cdc "
    f"WHERE ({_day_eq('data_op_ts', CDC_DAY)} OR {_day_eq('ordertime', CDC_DAY)}) AND data_op_type <> 'D'", "cdc"))
def cdc_increment_no_delete(spark, sf_dir):
    return _ods(cdcops.slice_day(_model(spark, sf_dir).cdc(), CDC_DAY, exclude_deletes=True), CDC_DAY)


@register("cdc_delete_append", sql.with_model(
    " UNION ALL ".join(f"SELECT {_CDC_COLS}, '{d}' AS p_day FROM cdc WHERE {_day_eq('data_op_ts', d)} AND data_op_type = 'D'"
                       for d in (CDC_DAY, CDC_FIELDS_DAY)), "cdc"))
def cdc_delete_append(spark, sf_dir):
    """The job appends the day's deletes to a log that already holds another day's."""
    from tidewater.plans.jobs import ods_delete_log
    from tidewater.session import scratch_dir
    cdc, path = _model(spark, sf_dir).cdc(), scratch_dir(spark, "delete-log")
    for day in (CDC_DAY, CDC_FIELDS_DAY):
        ods_delete_log(cdc, day, path, ODS_CDC_SCHEMA)
    return spark.read.schema(ODS_CDC_SCHEMA).parquet(path)


@register("upsert_latest", sql.with_model("""
SELECT ordercode, detailid, value, data_op_type, data_op_ts, ordertime FROM (
  SELECT *, row_number() OVER (PARTITION BY ordercode ORDER BY data_op_ts DESC, detailid DESC) AS rn FROM cdc)
WHERE rn = 1 AND data_op_type <> 'D'""", "cdc"))
def upsert_latest(spark, sf_dir):
    from tidewater.operators.upsert import latest_per_key, without_deletes
    return without_deletes(latest_per_key(_model(spark, sf_dir).cdc(), ["ordercode"], ["data_op_ts", "detailid"]))


@register("upsert_serving", f"""
WITH f AS (SELECT id, order_id, submit_amount, submit_datetime FROM ({sql.submit_fact_sql(*facts.SUBMIT_DAYS)}))
SELECT id, order_id, CASE WHEN order_id % 2 = 0 THEN CAST(submit_amount - 10 AS DECIMAL(18,4)) ELSE submit_amount END
         AS submit_amount,
       CASE WHEN order_id % 2 = 1 THEN strftime(submit_datetime, '%Y-%m-%d') WHEN order_id % 6 = 0 THEN NULL
            ELSE strftime(submit_datetime + INTERVAL 3 DAY, '%Y-%m-%d') END AS p_day
FROM f WHERE order_id % 10 <> 0""")
def upsert_serving(spark, sf_dir):
    """The submit fact served twice: the second load has lower amounts, moved
    and missing days, and deletes."""
    from tidewater.operators.upsert import read_upserted
    from tidewater.plans.jobs import serve
    from tidewater.session import scratch_dir
    target = scratch_dir(spark, "serving")
    fact = facts.retail_submit_fact(_model(spark, sf_dir)).select("id", "order_id", "submit_amount", "submit_datetime")
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    base = fact.select("id", "order_id", "submit_amount", day("submit_datetime").alias("p_day"), F.lit("I").alias("data_op_type"))
    key = F.col("order_id")
    later = fact.where(key % 2 == 0).select(
        "id", "order_id", (F.col("submit_amount") - 10).cast("decimal(18,4)").alias("submit_amount"),
        F.when(key % 6 == 0, F.lit(None)).otherwise(day(F.timestamp_add("DAY", F.lit(3), "submit_datetime"))).alias("p_day"),
        F.when(key % 10 == 0, F.lit("D")).otherwise(F.lit("U")).alias("data_op_type"))
    for rows in (base, later):
        serve(spark, target, rows)
    return read_upserted(spark, target).drop("data_op_type")


# ---------------------------------------------------------------------------
# Projections, predicates, scalar functions

LINEITEM_TARGET = StructType([
    StructField("l_orderkey", LongType()), StructField("l_linenumber", ShortType()),
    StructField("l_quantity", ByteType()),
    StructField("l_extendedprice", DecimalType(18, 4)),
    StructField("l_discount", FloatType()),
    StructField("l_returnflag", StringType()), StructField("l_shipdate", StringType()),
])


@register("schema_cast", """
SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber,
       CAST(l_quantity AS TINYINT) AS l_quantity, CAST(l_extendedprice AS DECIMAL(18,4)) AS l_extendedprice,
       CAST(l_discount AS FLOAT) AS l_discount, l_returnflag, CAST(l_shipdate AS VARCHAR) AS l_shipdate
FROM lineitem""")
def schema_cast_q(spark, sf_dir):
    from tidewater.sources.tables import read_table
    return schema_cast(read_table(spark, sf_dir, "lineitem"), LINEITEM_TARGET)


RANGE_DAYS = ("1998-05-01", "1998-09-31")  # upper bound is not a real date: string BETWEEN
_ORDER_COLS = "ordercode, cuscode, changetype, ordersource, shopcode, salemode, invoicetype, createdate, p_day"


@register("partition_range_scan", sql.with_model(
    f"SELECT {_ORDER_COLS} FROM om_order WHERE p_day BETWEEN '{RANGE_DAYS[0]}' AND '{RANGE_DAYS[1]}'", "om_order"))
def partition_range_scan(spark, sf_dir):
    """On the table partitioned by day: only the range's folders are read."""
    return _warehouse(spark, sf_dir, "om_order").om_order(days=RANGE_DAYS)


@register("order_not_in", sql.with_model(
    "SELECT ordercode, changetype, p_day FROM om_order WHERE changetype NOT IN (1, 2, 3)", "om_order"))
def order_not_in(spark, sf_dir):
    return (_model(spark, sf_dir).om_order().where(cdcops.not_in("changetype", facts.EXCHANGE_ORDER_TYPES))
            .select("ordercode", "changetype", "p_day"))


@register("semi_paid_days", sql.with_model(
    f", {sql.paid_days_cte(*facts.PAY_DAYS)}\nSELECT {_ORDER_COLS} FROM om_order WHERE p_day IN (SELECT p_day FROM temp)",
    "om_orderstatus", "om_order"))
def semi_paid_days(spark, sf_dir):
    """On the partitioned table: the paid days prune its folders at run time."""
    wh = _warehouse(spark, sf_dir, "om_order", "om_orderstatus")
    return wh.om_order(day_set=facts.paid_days(wh))


@register("composite_ids", sql.with_model(
    "SELECT ordercode, concat_ws('-', CAST(ordercode AS VARCHAR), paymentdate) AS pay_key FROM om_orderstatus",
    "om_orderstatus"))
def composite_ids(spark, sf_dir):
    from tidewater.functions.strings import composite_id
    return _model(spark, sf_dir).om_orderstatus().select("ordercode", composite_id("ordercode", "paymentdate").alias("pay_key"))


@register("submit_projection", sql.with_model("""
SELECT strftime(ordertime, '%Y-%m-%d') AS submit_date, detailid AS id, warecode AS ware_id, ordercode AS order_id,
       ordertime AS order_datetime, ordertime AS submit_datetime
FROM om_orderdetail ORDER BY id, ware_id, order_datetime LIMIT 100""", "om_orderdetail"))
def submit_projection(spark, sf_dir):
    from tidewater.functions.dates import day_string
    d = _model(spark, sf_dir).om_orderdetail()
    return (d.select(day_string("ordertime").alias("submit_date"), F.col("detailid").alias("id"),
                     F.col("warecode").alias("ware_id"), F.col("ordercode").alias("order_id"),
                     F.col("ordertime").alias("order_datetime"), F.col("ordertime").alias("submit_datetime"))
             .orderBy("id", "ware_id", "order_datetime").limit(100))


RANGE_TS = ("1998-03-01 00:00:00", "1998-03-31 00:00:00")


@register("range_limit", sql.with_model(
    f"SELECT {_ORDER_COLS} FROM om_order WHERE createdate BETWEEN TIMESTAMP '{RANGE_TS[0]}' AND TIMESTAMP '{RANGE_TS[1]}' "
    "ORDER BY ordercode LIMIT 10", "om_order"))
def range_limit(spark, sf_dir):
    lo, hi = (F.lit(t).cast("timestamp_ntz") for t in RANGE_TS)
    return _model(spark, sf_dir).om_order().where(F.col("createdate").between(lo, hi)).orderBy("ordercode").limit(10)


BACKFILL_DAYS = ("1998-01-01", "1998-01-31")
SERVING_ORDER_SCHEMA = StructType([
    StructField("ordercode", StringType()), StructField("cuscode", StringType()),
    StructField("changetype", ShortType()),
    StructField("ordersource", ShortType()),
    StructField("shopcode", StringType()), StructField("createdate", TimestampNTZType()),
    StructField("data_op_type", StringType()),
    StructField("is_delete", ByteType()),
])


@register("backfill_cdc_cols", sql.with_model(f"""
SELECT CAST(ordercode AS VARCHAR) AS ordercode, CAST(cuscode AS VARCHAR) AS cuscode,
       CAST(changetype AS SMALLINT) AS changetype, CAST(ordersource AS SMALLINT) AS ordersource,
       shopcode, createdate, 'I' AS data_op_type, CAST(NULL AS TINYINT) AS is_delete
FROM om_order WHERE p_day BETWEEN '{BACKFILL_DAYS[0]}' AND '{BACKFILL_DAYS[1]}'""", "om_order"))
def backfill_cdc_cols(spark, sf_dir):
    o = _model(spark, sf_dir).om_order(days=BACKFILL_DAYS)
    # the load-time column is wall-clock: built by the job, left out of the compared result
    return schema_cast(cdcops.with_cdc_columns(o, wall_clock=False), SERVING_ORDER_SCHEMA)


EXPORT_DAYS = ("1998-11-28", "1998-11-29")
EXPORT_SHIFT_HOURS = -8


EXPORT_SCHEMA = StructType([
    StructField("detailid", StringType()), StructField("ordercode", LongType()), StructField("warecode", LongType()),
    StructField("ordertime", TimestampNTZType()), StructField("qty", DecimalType(18, 4)),
    StructField("sumnetamt", DecimalType(18, 4)), StructField("p_day", StringType()), StructField("is_delete", ByteType()),
    StructField("data_op_type", StringType()), StructField("data_op_ts", TimestampNTZType()),
])


@register("bulk_export_rows", sql.with_model(f"""
SELECT detailid, ordercode, warecode, ordertime, CAST(qty AS DECIMAL(18,4)) AS qty,
       CAST(sumnetamt AS DECIMAL(18,4)) AS sumnetamt, p_day, CAST(NULL AS TINYINT) AS is_delete, 'I' AS data_op_type,
       ordertime + to_hours({EXPORT_SHIFT_HOURS}) AS data_op_ts
FROM om_orderdetail WHERE p_day BETWEEN '{EXPORT_DAYS[0]}' AND '{EXPORT_DAYS[1]}'""", "om_orderdetail"))
def bulk_export_rows(spark, sf_dir):
    """The CSV files of the export, cast to the target schema, read back."""
    from tidewater.plans.jobs import bulk_export_csv
    from tidewater.session import scratch_dir
    path = scratch_dir(spark, "bulk-export")
    bulk_export_csv(_model(spark, sf_dir), EXPORT_DAYS, path, EXPORT_SCHEMA, EXPORT_SHIFT_HOURS)
    return spark.read.schema(EXPORT_SCHEMA).csv(path)


@register("ts_dual_projection", sql.with_model(
    "SELECT ordercode, CAST(createdate AS VARCHAR) AS createdate_text, createdate AS createdate_ts FROM om_order",
    "om_order"))
def ts_dual_projection(spark, sf_dir):
    return _model(spark, sf_dir).om_order().select(
        "ordercode", F.col("createdate").cast("string").alias("createdate_text"),
        F.col("createdate").cast("timestamp_ntz").alias("createdate_ts"))


@register("string_to_date", sql.with_model(
    "SELECT ordercode, CAST(TRY_CAST(paymentdate AS TIMESTAMP) AS DATE) AS pay_date FROM om_orderstatus",
    "om_orderstatus"))
def string_to_date(spark, sf_dir):
    from tidewater.functions.dates import string_to_date as to_day
    return _model(spark, sf_dir).om_orderstatus().select("ordercode", to_day("paymentdate").alias("pay_date"))


def _ts_text_spark():
    s = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS")
    return F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("2024-13"), F.substring(s, 8, 100))).otherwise(s)


@register("strict_timestamp", """
WITH t AS (
  SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '2024-13' || substr(strftime(ts, '%Y-%m-%d %H:%M:%S.%g'), 8)
                        ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%g') END AS ts_text FROM events)
SELECT event_id, ts_text, try_strptime(ts_text, '%Y-%m-%d %H:%M:%S.%g') AS parsed FROM t""")
def strict_timestamp(spark, sf_dir):
    from tidewater.functions.dates import strict_timestamp as parse
    from tidewater.sources.tables import read_table
    e = read_table(spark, sf_dir, "events").select("event_id", _ts_text_spark().alias("ts_text"))
    return e.select("event_id", "ts_text", parse("ts_text").cast("timestamp_ntz").alias("parsed"))


@register("dim_datetime", sql.with_model(
    f"SELECT ordercode, {sql.date_parts_sql('createdate', 'order', skip_datetime=False)} FROM om_order", "om_order"))
def dim_datetime(spark, sf_dir):
    from tidewater.functions.dates import datetime_columns
    return _model(spark, sf_dir).om_order().select("ordercode", *datetime_columns("createdate", "order"))


@register("dim_lookup", sql.with_model("""
SELECT od.detailid, od.warecode, dw.ware_name, dw.ware_brand
FROM om_orderdetail od LEFT JOIN dim_ware dw ON dw.ware_id = od.warecode""", "om_orderdetail", "dim_ware"))
def dim_lookup(spark, sf_dir):
    from tidewater.operators.enrich import lookup_join
    m = _model(spark, sf_dir)
    d = m.om_orderdetail().select("detailid", "warecode")
    return (lookup_join(d, m.dim_ware(), d.warecode == F.col("ware_id"))
            .select("detailid", "warecode", "ware_name", "ware_brand"))


@register("cross_store_inner", sql.with_model("""
SELECT a.ordercode, b.provincecode, b.citycode, a.createdate
FROM om_order a JOIN om_orderaddress b ON a.ordercode = b.ordercode""", "om_order", "om_orderaddress"))
def cross_store_inner(spark, sf_dir):
    m = _model(spark, sf_dir)
    return (m.om_order().select("ordercode", "createdate")
            .join(m.om_orderaddress().select("ordercode", "provincecode", "citycode"), "ordercode")
            .select("ordercode", "provincecode", "citycode", "createdate"))


@register("cross_store_left", sql.with_model("""
SELECT s.ordercode, s.paymentdate, o.shopcode, o.createdate
FROM om_orderstatus s LEFT JOIN (SELECT * FROM om_order WHERE changetype NOT IN (1, 2, 3)) o
  ON s.ordercode = o.ordercode""", "om_orderstatus", "om_order"))
def cross_store_left(spark, sf_dir):
    m = _model(spark, sf_dir)
    o = m.om_order().where(cdcops.not_in("changetype", facts.EXCHANGE_ORDER_TYPES)).select("ordercode", "shopcode", "createdate")
    return m.om_orderstatus().select("ordercode", "paymentdate").join(o, "ordercode", "left")


# ---------------------------------------------------------------------------
# Aggregations, windows, milestones

ORACLE_TOP2 = """
SELECT user_id, event_id, value, row_num FROM (
  SELECT user_id, event_id, value,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS INTEGER) AS row_num
  FROM events)
WHERE row_num <= 2"""


@register("top2_per_key", ORACLE_TOP2)
def top2_per_key(spark, sf_dir):
    from tidewater.operators.rank import top_n
    from tidewater.sources.tables import read_table
    e = read_table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    return top_n(e, ["user_id"], [F.col("value").desc(), F.col("event_id")], 2)


MINUTE_SALES_SQL = """
SELECT CAST(ts AS DATE) AS submit_date, strftime(ts, '%Y-%m-%d %H:%M') AS minute,
       CAST(SUM(CAST(value AS DECIMAL(28,8))) AS DECIMAL(38,2)) AS sale_amount
FROM events {where} GROUP BY 1, 2"""


@register("minute_sales", MINUTE_SALES_SQL.format(where=""))
def minute_sales(spark, sf_dir):
    from tidewater.operators.milestones import minute_sales as ms
    from tidewater.sources.tables import read_table
    return ms(read_table(spark, sf_dir, "events"), "ts", "value")


MILESTONE_STEP = 500  # the demo's 5000 would give almost no marks on ~95k of sales over 30 days


def milestones_sql(step: int) -> str:
    return f"""
WITH m AS ({MINUTE_SALES_SQL.format(where="WHERE event_type = 'purchase'")}),
c AS (SELECT submit_date, minute, sale_amount,
             SUM(sale_amount) OVER (PARTITION BY submit_date ORDER BY minute
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM m),
k AS (SELECT submit_date, minute, CAST(floor((cum - sale_amount) / {step}) AS BIGINT) AS lo,
             CAST(floor(cum / {step}) AS BIGINT) AS hi FROM c)
SELECT submit_date, CAST(unnest(generate_series(lo + 1, hi)) AS BIGINT) AS mark_no,
       substr(minute, 12, 5) AS mark_minute
FROM k WHERE hi > lo"""


@register("sales_milestones", milestones_sql(MILESTONE_STEP))
def sales_milestones(spark, sf_dir):
    from tidewater.operators.milestones import sales_milestones as sm
    from tidewater.sources.tables import read_table
    e = read_table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return sm(e, "ts", "value", MILESTONE_STEP)


@register("group_count", sql.with_model(
    "SELECT shopcode, count(*) AS cnt FROM om_order GROUP BY shopcode", "om_order"))
def group_count(spark, sf_dir):
    from tidewater.operators.aggregate import count_per_key
    return count_per_key(_model(spark, sf_dir).om_order(), ["shopcode"])


@register("reduce_concat", sql.with_model("""
SELECT ordercode, string_agg(CAST(warecode AS VARCHAR), ',' ORDER BY CAST(warecode AS VARCHAR)) AS concatenated
FROM om_orderdetail GROUP BY ordercode""", "om_orderdetail"))
def reduce_concat(spark, sf_dir):
    from tidewater.operators.aggregate import reduce_concat as rc
    d = _model(spark, sf_dir).om_orderdetail().select("ordercode", F.col("warecode").cast("string").alias("warecode"))
    return rc(d, ["ordercode"], "warecode", sep=",")


@register("word_split", """
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part""")
def word_split(spark, sf_dir):
    from tidewater.functions.strings import words
    from tidewater.sources.tables import read_table
    return read_table(spark, sf_dir, "part").select("p_partkey", words("p_name").alias("word"))


@register("json_extract", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_extract(spark, sf_dir):
    from tidewater.functions.json import json_field
    from tidewater.sources.tables import read_table
    return read_table(spark, sf_dir, "events").select("event_id", json_field("props", "$.k").cast("bigint").alias("k"))


LOOKUP_CUSTOMER = 7


@register("param_lookup", sql.with_model(f"""
SELECT COALESCE(CAST(ordercode AS VARCHAR), '') AS ordercode, COALESCE(CAST(cuscode AS VARCHAR), '') AS cuscode,
       COALESCE(shopcode, '') AS shopcode, COALESCE(CAST(createdate AS VARCHAR), '') AS createdate,
       COALESCE(paymentdate, '') AS paymentdate
FROM om_order JOIN om_orderstatus USING (ordercode) WHERE cuscode = {LOOKUP_CUSTOMER}""", "om_order", "om_orderstatus"))
def param_lookup(spark, sf_dir):
    from tidewater.plans.jobs import find_result
    m = _model(spark, sf_dir)
    m.om_order().createOrReplaceTempView("om_order")
    m.om_orderstatus().createOrReplaceTempView("om_orderstatus")
    return find_result(spark, """
        SELECT ordercode, cuscode, shopcode, createdate, paymentdate
        FROM om_order JOIN om_orderstatus USING (ordercode) WHERE cuscode = :cus""", {"cus": LOOKUP_CUSTOMER})


LOWER_TARGET = StructType([
    StructField("ordercode", StringType()), StructField("cuscode", LongType()),
    StructField("orderstatus", StringType()), StructField("sumamt", DecimalType(18, 4)),
    StructField("createdate", TimestampNTZType()),
])


@register("lowercase_limit_scan", """
SELECT CAST(o_orderkey AS VARCHAR) AS ordercode, o_custkey AS cuscode, o_orderstatus AS orderstatus,
       CAST(o_totalprice AS DECIMAL(18,4)) AS sumamt, o_orderdate AS createdate
FROM orders ORDER BY o_orderkey LIMIT 5""")
def lowercase_limit_scan(spark, sf_dir):
    from tidewater.plans.jobs import typed_rows_from_source
    from tidewater.sources.tables import read_table
    # The store reports upper-case names (as JDBC stores do).
    src = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ORDERCODE"), F.col("o_custkey").alias("CUSCODE"),
        F.col("o_orderstatus").alias("ORDERSTATUS"), F.col("o_totalprice").alias("SUMAMT"),
        F.col("o_orderdate").alias("CREATEDATE"))
    return typed_rows_from_source(src, LOWER_TARGET, order_by="ORDERCODE", limit=5)


@register("partition_derive_dhm", """
SELECT CAST(user_id AS VARCHAR) AS user_id, value AS order_amount, strftime(ts, '%Y-%m-%d') AS dt,
       strftime(ts, '%H') AS h, strftime(ts, '%M') AS m FROM events""")
def partition_derive_dhm(spark, sf_dir):
    from tidewater.plans.jobs import dhm_partition_columns
    from tidewater.sources.tables import read_table
    e = read_table(spark, sf_dir, "events")
    return e.select(F.col("user_id").cast("string").alias("user_id"), F.col("value").alias("order_amount"),
                    *dhm_partition_columns("ts"))


# ---------------------------------------------------------------------------
# Sink round trips: write with the sink, read the result back

OVERWRITE_DAY = "1998-03-10"


@register("partition_overwrite", sql.with_model(f"""
SELECT {_ORDER_COLS} FROM om_order WHERE p_day <> '{OVERWRITE_DAY}' OR changetype = 0""", "om_order"))
def partition_overwrite(spark, sf_dir):
    """Write the whole table by day, then replace one day: every other day is kept."""
    from tidewater.operators import sinks
    from tidewater.session import scratch_dir
    m = _model(spark, sf_dir)
    path = scratch_dir(spark, "ods-order")
    sinks.overwrite_partitions(m.om_order().hint("rebalance", "p_day"), path, ["p_day"])
    replacement = m.om_order(days=(OVERWRITE_DAY, OVERWRITE_DAY)).where(F.col("changetype") == 0).drop("p_day")
    sinks.overwrite_partition(replacement, path, {"p_day": OVERWRITE_DAY})
    return spark.read.schema(m.om_order().schema).parquet(path)


_DETAIL_COLS = "detailid, ordercode, warecode, ordertime, qty, sumnetamt, p_day"


@register("multi_sink_counts", sql.with_model(f"""
SELECT 'parquet' AS sink, {_DETAIL_COLS} FROM om_orderdetail
UNION ALL SELECT 'csv' AS sink, {_DETAIL_COLS} FROM om_orderdetail""", "om_orderdetail"))
def multi_sink_counts(spark, sf_dir):
    """One input written to two sinks in one unit; the rows of each, read back."""
    from tidewater.plans.jobs import two_sink_export
    from tidewater.session import scratch_dir
    pq, csv = scratch_dir(spark, "two-sink-parquet"), scratch_dir(spark, "two-sink-csv")
    rows = _model(spark, sf_dir).om_orderdetail()
    two_sink_export(rows, pq, csv)
    return (spark.read.parquet(pq).select(F.lit("parquet").alias("sink"), *rows.columns)
            .unionByName(spark.read.schema(rows.schema).csv(csv).select(F.lit("csv").alias("sink"), *rows.columns)))


@register("dim_datetime_sql", sql.with_model(
    f"SELECT ordercode, {sql.date_parts_sql('createdate', 'order', skip_datetime=False)} FROM om_order", "om_order"))
def dim_datetime_sql(spark, sf_dir):
    """The date-part function registered by name and called from SQL."""
    from tidewater.functions.dates import register_datetime_function
    _model(spark, sf_dir).om_order().createOrReplaceTempView("om_order")
    register_datetime_function(spark, "order_dim_date_time", "order")
    return spark.sql("SELECT ordercode, d.* FROM (SELECT ordercode, order_dim_date_time(createdate) AS d FROM om_order)")


from tidewater.functions.dates import DATETIME_PARTS  # noqa: E402

_PAY_PARTS = ", ".join(f"x.d.pay_{p}" for p in DATETIME_PARTS if p != "datetime")

# One relation of payments feeds the day selection and the join; the order-sized
# tables meet first, the lines come last.
PAY_SQL = """
WITH status AS (
  SELECT ordercode, try_to_timestamp(paymentdate) AS paid_at, date_format(try_to_timestamp(ordertime), 'yyyy-MM-dd') AS day
  FROM om_orderstatus WHERE length(paymentdate) > 0),
payment AS (SELECT ordercode, day, CAST(paid_at AS TIMESTAMP_NTZ) AS pay_datetime
            FROM status WHERE date_format(paid_at, 'yyyy-MM-dd') BETWEEN :lo AND :hi),
held AS (SELECT DISTINCT day FROM payment),
paid_order AS (
  SELECT ordercode, pay_datetime, cuscode, createdate, ordersource, shopcode, changetype, salemode, invoicetype,
         concat_ws('-', CAST(provincecode AS STRING), CAST(citycode AS STRING)) AS address_id
  FROM payment
  JOIN om_order ord USING (ordercode)
  JOIN om_orderaddress place USING (ordercode)
  WHERE ord.p_day IN (SELECT day FROM held) AND place.p_day IN (SELECT day FROM held) AND changetype NOT IN (1, 2, 3)),
line AS (
  SELECT detailid AS id, cuscode AS customer_id, warecode AS ware_id, address_id, ordercode AS order_id, pay_datetime,
         createdate AS order_datetime, qty AS pay_count, sumnetamt AS pay_amount, ordersource AS order_source_id,
         shopcode AS order_shop_id, concat_ws('-', CAST(ordersource AS STRING), shopcode) AS order_sale_channel_id,
         changetype AS order_type, salemode AS order_sale_mode, invoicetype AS order_invoice_type,
         pay_dim_date_time(pay_datetime) AS d
  FROM om_orderdetail JOIN paid_order USING (ordercode)
  WHERE p_day IN (SELECT day FROM held))
SELECT x.* EXCEPT (d), {parts}, address_name, address_region, ware_name, ware_brand
FROM line x LEFT JOIN dim_address USING (address_id) LEFT JOIN dim_ware USING (ware_id)""".replace("{parts}", _PAY_PARTS)


@register("dwd_retail_pay_sql", sql.pay_fact_sql(*facts.PAY_DAYS))
def dwd_retail_pay_sql(spark, sf_dir):
    """B2 as SQL text: CTEs, ``p_day IN (SELECT ...)`` partition selection and
    the registered date-part function, over the model tables exposed as views."""
    from tidewater.functions.dates import register_datetime_function
    m = _model(spark, sf_dir)
    for name in ("om_orderstatus", "om_orderdetail", "om_order", "om_orderaddress", "dim_address", "dim_ware"):
        getattr(m, name)().createOrReplaceTempView(name)
    register_datetime_function(spark, "pay_dim_date_time", "pay")
    lo, hi = facts.PAY_DAYS
    return schema_cast(spark.sql(PAY_SQL, args={"lo": lo, "hi": hi}), facts.DWD_PAY_SCHEMA)
