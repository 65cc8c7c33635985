"""Day-partitioned warehouse tables on storage.

``build_ods`` writes the order-model tables as Parquet partitioned by
``p_day`` (the ODS layer); ``WarehouseTables`` reads them back with the
same interface as ``OrderModel``, so the fact builders run unchanged.  A
``days`` range becomes a partition filter on the string ``p_day`` (pruned
at planning time), and a ``day_set`` becomes a semi join on ``p_day`` that
Spark turns into dynamic partition pruning of the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import sinks
from tidewater.sources.order_model import OrderModel, day_broadcast

PARTITIONED = ("om_order", "om_orderdetail", "om_orderaddress")
UNPARTITIONED = ("om_orderstatus", "dim_address", "dim_ware", "cdc")


def build_ods(model: OrderModel, root: str, days=None, names=(*PARTITIONED, *UNPARTITIONED)) -> str:
    """Write the model tables (all, or those named) under ``root``: day tables partitioned by
    ``p_day``, the others as plain Parquet.

    The ``rebalance`` hint clusters rows by day before the write (few files
    per day) and lets AQE split a day that holds a large share of the rows
    across several tasks instead of one.
    """
    for name in (n for n in PARTITIONED if n in names):
        df = getattr(model, name)(days) if days else getattr(model, name)()
        sinks.overwrite_partitions(df.hint("rebalance", "p_day"), f"{root}/{name}", ["p_day"])
    for name in (n for n in UNPARTITIONED if n in names):
        getattr(model, name)().write.mode("overwrite").parquet(f"{root}/{name}")
    return root


class WarehouseTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def _days(self, df: DataFrame, days=None, day_set: DataFrame | None = None) -> DataFrame:
        if days is not None:
            df = df.where(F.col("p_day").between(*days))
        if day_set is not None:  # broadcast build side: also what lets DPP prune the scan
            df = df.join(day_broadcast(day_set, "p_day"), "p_day", "left_semi")
        return df

    def _ordered(self, name: str, cols: list[str], days=None, day_set=None) -> DataFrame:
        return self._days(self._read(name), days, day_set).select(*cols)

    def om_order(self, days=None, day_set=None) -> DataFrame:
        return self._ordered("om_order", ["ordercode", "cuscode", "changetype", "ordersource", "shopcode", "salemode",
                                          "invoicetype", "createdate", "p_day"], days, day_set)

    def om_orderdetail(self, days=None, day_set=None) -> DataFrame:
        return self._ordered("om_orderdetail", ["detailid", "ordercode", "warecode", "ordertime", "qty", "sumnetamt",
                                                "p_day"], days, day_set)

    def om_orderaddress(self, days=None, day_set=None) -> DataFrame:
        return self._ordered("om_orderaddress", ["ordercode", "provincecode", "citycode", "areacode", "p_day"],
                             days, day_set)

    def om_orderstatus(self) -> DataFrame:
        return self._read("om_orderstatus")

    def dim_address(self) -> DataFrame:
        return self._read("dim_address")

    def dim_ware(self) -> DataFrame:
        return self._read("dim_ware")

    def cdc(self) -> DataFrame:
        return self._read("cdc")
