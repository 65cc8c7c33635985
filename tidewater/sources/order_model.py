"""The order-warehouse tables, derived from the driver's TPC-H-like tables.

A production deployment reads these as day-partitioned warehouse tables
(``p_day`` STRING partitions).  Here each is a lazy DataFrame over the given
Parquet inputs, so its size grows with theirs.  Every adapter takes an
optional ``days=(lo, hi)`` string range; it is applied to the source
timestamp as a pushable range plus the exact string test, which is what
partition pruning on ``p_day`` gives on the real tables.

Column rules (fixed; the oracle SQL in ``plans/oracle.py`` states the same):

  om_order        ordercode=o_orderkey, cuscode=o_custkey,
                  changetype=int(first char of o_orderpriority) % 5,
                  ordersource=ascii(o_orderstatus) % 3, shopcode=o_orderpriority,
                  salemode=o_custkey % 3, invoicetype=o_orderkey % 2,
                  createdate=o_orderdate, p_day=yyyy-MM-dd(o_orderdate)
  om_orderdetail  lineitem x orders: detailid='l_orderkey-l_linenumber-l_partkey-l_suppkey' (unique),
                  ordercode, warecode=l_partkey,
                  ordertime=o_orderdate + l_linenumber hours,
                  qty=l_quantity, sumnetamt=l_extendedprice, p_day
  om_orderaddress orders x customer x nation: provincecode=n_regionkey,
                  citycode=n_nationkey, areacode=c_custkey, p_day
  om_orderstatus  orders: ordertime text, paymentdate text = order day + 1
                  (status F), '' (status O), NULL (status P)
  dim_address     nation x region:
                  address_id='n_regionkey-n_nationkey', address_name, address_region
  dim_ware        part: ware_id, ware_name, ware_brand
  cdc             events: detailid=event_id, ordercode=user_id, value,
                  data_op_type signup->I, error->D, else U; data_op_ts=ts,
                  ordertime=ts - (event_id % 3) days
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.dates import day_between, day_string
from tidewater.sources.tables import read_table

TS_TEXT_FMT = "yyyy-MM-dd HH:mm:ss"


def day_broadcast(day_set: DataFrame, name: str) -> DataFrame:
    """A set of day strings, broadcast.

    Size bound: distinct ``yyyy-MM-dd`` values, i.e. at most one row per
    calendar day (about 37k rows for a century), whatever the data volume.
    """
    return F.broadcast(day_set.select(F.col(day_set.columns[0]).alias(name)).distinct())


class OrderModel:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _t(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def _orders(self, days=None, day_set: DataFrame | None = None) -> DataFrame:
        """orders restricted to a day range and/or to the days in ``day_set``
        (a one-column ``p_day`` frame): the partition selection of the real
        tables, applied before any join."""
        o = self._t("orders")
        if days is not None:
            o = o.where(day_between("o_orderdate", *days))
        if day_set is not None:
            o = o.join(day_broadcast(day_set, "_sel_day"), day_string("o_orderdate") == F.col("_sel_day"), "left_semi")
        return o

    # -- ODS tables ---------------------------------------------------------
    def om_order(self, days=None, day_set=None) -> DataFrame:
        return self._orders(days, day_set).select(
            F.col("o_orderkey").alias("ordercode"),
            F.col("o_custkey").alias("cuscode"),
            (F.substring("o_orderpriority", 1, 1).cast("int") % 5).alias("changetype"),
            (F.ascii("o_orderstatus") % 3).alias("ordersource"),
            F.col("o_orderpriority").alias("shopcode"),
            (F.col("o_custkey") % 3).cast("int").alias("salemode"),
            (F.col("o_orderkey") % 2).cast("int").alias("invoicetype"),
            F.col("o_orderdate").alias("createdate"),
            day_string("o_orderdate").alias("p_day"),
        )

    def om_orderdetail(self, days=None, day_set=None) -> DataFrame:
        li = self._t("lineitem")
        o = self._orders(days, day_set).select("o_orderkey", "o_orderdate")
        return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
            F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
                        ).alias("detailid"),
            F.col("l_orderkey").alias("ordercode"),
            F.col("l_partkey").alias("warecode"),
            F.timestamp_add("HOUR", F.col("l_linenumber"), F.col("o_orderdate")).alias("ordertime"),
            F.col("l_quantity").alias("qty"),
            F.col("l_extendedprice").alias("sumnetamt"),
            day_string("o_orderdate").alias("p_day"),
        )

    def om_orderaddress(self, days=None, day_set=None) -> DataFrame:
        o = self._orders(days, day_set).select("o_orderkey", "o_custkey", "o_orderdate")
        c = self._t("customer").select("c_custkey", "c_nationkey")
        n = self._t("nation").select("n_nationkey", "n_regionkey")
        # nation is a fixed 25-row table: broadcasting it is bounded at any scale.
        cn = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "inner")
        return o.join(cn, o.o_custkey == cn.c_custkey, "inner").select(
            F.col("o_orderkey").alias("ordercode"),
            F.col("n_regionkey").alias("provincecode"),
            F.col("n_nationkey").alias("citycode"),
            F.col("c_custkey").alias("areacode"),
            day_string("o_orderdate").alias("p_day"),
        )

    def om_orderstatus(self) -> DataFrame:
        o = self._orders()
        paid = F.date_format(F.timestamp_add("DAY", F.lit(1), F.col("o_orderdate")), TS_TEXT_FMT)
        return o.select(
            F.col("o_orderkey").alias("ordercode"),
            F.date_format("o_orderdate", TS_TEXT_FMT).alias("ordertime"),
            F.when(F.col("o_orderstatus") == "F", paid)
             .when(F.col("o_orderstatus") == "O", F.lit(""))
             .otherwise(F.lit(None).cast("string")).alias("paymentdate"),
        )

    # -- dimensions ---------------------------------------------------------
    def dim_address(self) -> DataFrame:
        n = self._t("nation")
        r = self._t("region")
        # region is a fixed 5-row table
        return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "inner").select(
            F.concat_ws("-", F.col("n_regionkey").cast("string"),
                        F.col("n_nationkey").cast("string")).alias("address_id"),
            F.col("n_name").alias("address_name"),
            F.col("r_name").alias("address_region"),
        )

    def dim_ware(self) -> DataFrame:
        return self._t("part").select(
            F.col("p_partkey").alias("ware_id"),
            F.col("p_name").alias("ware_name"),
            F.col("p_brand").alias("ware_brand"),
        )

    # -- change capture -----------------------------------------------------
    def cdc(self) -> DataFrame:
        return cdc_from_events(self._t("events"))


def cdc_from_events(e: DataFrame) -> DataFrame:
    """Change-captured order rows from an events frame (batch or stream)."""
    return e.select(
        F.col("event_id").alias("detailid"),
        F.col("user_id").alias("ordercode"),
        F.col("value"),
        F.when(F.col("event_type") == "signup", "I")
         .when(F.col("event_type") == "error", "D")
         .otherwise("U").alias("data_op_type"),
        F.col("ts").alias("data_op_ts"),
        F.timestamp_add("DAY", -(F.col("event_id") % 3), F.col("ts")).alias("ordertime"),
    )
