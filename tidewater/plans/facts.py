"""DWD fact builders: order lines joined into wide, enriched fact rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DecimalType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from tidewater.functions.casts import schema_cast
from tidewater.functions.dates import DATETIME_PARTS, day_string, parse_loose_timestamp
from tidewater.functions.strings import composite_id
from tidewater.operators.cdc import not_in
from tidewater.operators.enrich import lookup_join, with_datetime_parts
from tidewater.sources.order_model import OrderModel

# Order types dropped from retail facts (exchange / resend / ship-first orders).
EXCHANGE_ORDER_TYPES = (1, 2, 3)

SUBMIT_DAYS = ("1998-03-10", "1998-06-20")
PAY_DAYS = ("1998-03-01", "1998-03-31")

_TS = TimestampNTZType()
_AMT = DecimalType(18, 4)


def _fact_schema(kind: str) -> StructType:
    """Serving-table schema of the submit / pay fact (the cast target)."""
    head = [
        StructField("id", StringType()), StructField("customer_id", LongType()),
        StructField("ware_id", LongType()), StructField("address_id", StringType()),
        StructField("order_id", LongType()), StructField(f"{kind}_datetime", _TS),
        StructField("order_datetime", _TS), StructField(f"{kind}_count", _AMT),
        StructField(f"{kind}_amount", _AMT), StructField("order_source_id", IntegerType()),
        StructField("order_shop_id", StringType()), StructField("order_sale_channel_id", StringType()),
        StructField("order_type", IntegerType()), StructField("order_sale_mode", IntegerType()),
        StructField("order_invoice_type", IntegerType()),
    ]
    types = {"datetime": _TS, "date": _TS, "week_start_date": _TS}
    parts = [StructField(f"{kind}_{p}", types.get(p, IntegerType())) for p in DATETIME_PARTS if p != "datetime"]
    dims = [StructField(n, StringType()) for n in ("address_name", "address_region", "ware_name", "ware_brand")]
    return StructType(head + parts + dims)


DWD_SUBMIT_SCHEMA = _fact_schema("submit")
DWD_PAY_SCHEMA = _fact_schema("pay")


def _order_attrs() -> list:
    return [
        F.col("ordersource").alias("order_source_id"),
        F.col("shopcode").alias("order_shop_id"),
        composite_id("ordersource", "shopcode").alias("order_sale_channel_id"),
        F.col("changetype").alias("order_type"),
        F.col("salemode").alias("order_sale_mode"),
        F.col("invoicetype").alias("order_invoice_type"),
    ]


def enrich_fact(fact: DataFrame, model: OrderModel, kind: str) -> DataFrame:
    """Date parts of ``{kind}_datetime`` plus the address and ware dimensions."""
    out = with_datetime_parts(fact, f"{kind}_datetime", kind)
    return lookup_join(lookup_join(out, model.dim_address(), "address_id"), model.dim_ware(), "ware_id")


def retail_submit_fact(model: OrderModel, days=SUBMIT_DAYS) -> DataFrame:
    """B1: order lines of a day range joined to their order and address on
    (ordercode, p_day), exchange orders dropped, enriched and cast."""
    od = model.om_orderdetail(days)
    o = model.om_order(days).where(not_in("changetype", EXCHANGE_ORDER_TYPES))
    oa = model.om_orderaddress(days)
    fact = (od.join(o, ["ordercode", "p_day"], "inner")
              .join(oa, ["ordercode", "p_day"], "inner")
              .select(
                  F.col("detailid").alias("id"),
                  F.col("cuscode").alias("customer_id"),
                  F.col("warecode").alias("ware_id"),
                  composite_id("provincecode", "citycode").alias("address_id"),
                  F.col("ordercode").alias("order_id"),
                  F.col("ordertime").alias("submit_datetime"),
                  F.col("createdate").alias("order_datetime"),
                  F.col("qty").alias("submit_count"),
                  F.col("sumnetamt").alias("submit_amount"),
                  *_order_attrs()))
    return schema_cast(enrich_fact(fact, model, "submit"), DWD_SUBMIT_SCHEMA)


def is_paid(payment) -> F.Column:
    c = F.col(payment) if isinstance(payment, str) else payment
    return (c != "") & c.isNotNull()


def paid_days(model: OrderModel, days=PAY_DAYS) -> DataFrame:
    """Order days having a payment in ``days`` (GROUP BY without aggregates)."""
    return payments(model, days).select("p_day").distinct()


def payments(model: OrderModel, days=PAY_DAYS) -> DataFrame:
    """ordercode, pay_datetime and the order's day of the orders paid in ``days``."""
    at = parse_loose_timestamp("paymentdate")
    return (model.om_orderstatus().where(is_paid("paymentdate") & day_string(at).between(*days))
            .select("ordercode", at.cast("timestamp_ntz").alias("pay_datetime"),
                    day_string(parse_loose_timestamp("ordertime")).alias("p_day")))


def retail_pay_fact(model: OrderModel, days=PAY_DAYS) -> DataFrame:
    """B2: payments of a day range joined to detail, order and address of the
    order days that hold them (``p_day IN (paid days)``).  The order-sized
    tables are joined first, so the lines are shuffled once, against orders
    that are already known to be paid and kept."""
    held = paid_days(model, days)
    o = model.om_order(day_set=held).drop("p_day").where(not_in("changetype", EXCHANGE_ORDER_TYPES))
    oa = model.om_orderaddress(day_set=held).drop("p_day")
    paid = payments(model, days).drop("p_day").join(o, "ordercode").join(oa, "ordercode")
    fact = model.om_orderdetail(day_set=held).drop("p_day").join(paid, "ordercode").select(
        F.col("detailid").alias("id"),
        F.col("cuscode").alias("customer_id"),
        F.col("warecode").alias("ware_id"),
        composite_id("provincecode", "citycode").alias("address_id"),
        F.col("ordercode").alias("order_id"),
        "pay_datetime",
        F.col("createdate").alias("order_datetime"),
        F.col("qty").alias("pay_count"),
        F.col("sumnetamt").alias("pay_amount"),
        *_order_attrs())
    return schema_cast(enrich_fact(fact, model, "pay"), DWD_PAY_SCHEMA)
