"""The composite jobs (thin compositions of sources, operators and sinks).

Each job reads whole tables through the order model (or any DataFrames of
the same shape), and writes with the sinks; the queries registered for the
oracle check are the DataFrames these jobs write.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.functions.casts import schema_cast
from tidewater.functions.dates import shift_hours
from tidewater.functions.strings import lowercase_columns
from tidewater.operators import cdc as cdcops
from tidewater.operators import sinks
from tidewater.operators.delta_table import DeltaTable
from tidewater.plans import facts
from tidewater.sources.order_model import OrderModel
from tidewater.sources.registry import Registry


# -- DWD facts into the serving store (B1, B2, B8) ---------------------------

def dwd_retail_submit_job(spark: SparkSession, model: OrderModel, target: str, days=facts.SUBMIT_DAYS) -> str:
    """B1: build the submit fact and upsert it (key ``id``) into ``target``."""
    fact = facts.retail_submit_fact(model, days)
    return serve(spark, target, fact.withColumn("p_day", F.date_format("submit_datetime", "yyyy-MM-dd")))


def dwd_retail_pay_job(spark: SparkSession, model: OrderModel, target: str, days=facts.PAY_DAYS) -> str:
    """B2: build the pay fact and upsert it into ``target``."""
    fact = facts.retail_pay_fact(model, days)
    return serve(spark, target, fact.withColumn("p_day", F.date_format("pay_datetime", "yyyy-MM-dd")))


def serve(spark: SparkSession, target: str, fact: DataFrame, order: Sequence[str] = ()) -> str:
    """Fact rows into the serving table: a row replaces the one with its id,
    whatever day either belongs to; op type D removes it.  Within a load the
    greatest ``order`` wins, and different rows that tie for it fail the load."""
    return _merge(spark, target, fact, ["id"], order, "data_op_type" if "data_op_type" in fact.columns else None)


def _merge(spark: SparkSession, target: str, rows: DataFrame, keys: Sequence[str], order: Sequence[str], op_col: str | None) -> str:
    # a load is newer than what is stored: ``order`` decides within the load only
    DeltaTable(spark, target, keys, op_col=op_col).upsert(rows, order=order)
    return target


def sync_to_serving(spark: SparkSession, source: DataFrame, target: str, target_schema: StructType,
                    keys: Sequence[str], order: Sequence[str] = ()) -> str:
    """B8: whole table (or a day range of it) cast to the serving schema and upserted."""
    return _merge(spark, target, schema_cast(source, target_schema), keys, order, None)


def backfill_serving(spark: SparkSession, source: DataFrame, target: str, target_schema: StructType,
                     keys: Sequence[str], order: Sequence[str] = ()) -> str:
    """B6: warehouse rows with the CDC columns added ('I', NULL delete flag,
    load time), cast to the serving schema and upserted by key."""
    rows = schema_cast(cdcops.with_cdc_columns(source), target_schema)
    return _merge(spark, target, rows, keys, order, None)


# -- ODS sync (B3, B4, B5, B15, B20) ------------------------------------------

def ods_increment(cdc: DataFrame, day: str, target: str, target_schema: StructType,
                  columns: Sequence[str] = ("data_op_ts", "ordertime"), exclude_deletes: bool = False) -> None:
    """B3/B5: the day's increment, cast to the ODS schema, replaces partition ``p_day=day``."""
    inc = cdcops.slice_day(cdc, day, columns, exclude_deletes)
    sinks.overwrite_partition(schema_cast(inc, target_schema, exclude=["p_day"]), target, {"p_day": day})


def sync_day(registry: Registry, source: str, target: str, day: str,
             columns: Sequence[str] = ("data_op_ts", "ordertime"), exclude_deletes: bool = False) -> None:
    """B5: the generic sync, by table names: ``target``'s registered path and
    schema take the day's increment of ``source``."""
    to = registry.get(target)
    ods_increment(registry.read(source), day, to.path, registry.schema(target), columns, exclude_deletes)


def load_table(registry: Registry, source: str, target: str, order_by: str | None = None, limit: int | None = None) -> None:
    """B15: a store's rows, lower-cased and cast, appended to a registered table."""
    to = registry.get(target)
    sinks.append(typed_rows_from_source(registry.read(source), registry.schema(target), order_by, limit), to.path,
                 to.partition_cols, to.fmt)


def ods_delete_log(cdc: DataFrame, day: str, target: str, target_schema: StructType) -> None:
    """B4: the day's deletes appended to the delete log."""
    dels = schema_cast(cdcops.deletes_of(cdc, day), target_schema, exclude=["p_day"]).withColumn("p_day", F.lit(day))
    sinks.append(dels, target, ["p_day"])


def typed_rows_from_source(src: DataFrame, target: StructType, order_by: str | None = None,
                           limit: int | None = None) -> DataFrame:
    """S6/B15: a source's rows with names lower-cased and cast to the target.
    ``limit`` is the ROWNUM bound of the source query (taken in key order)."""
    if order_by is not None:
        src = src.orderBy(order_by)
    if limit is not None:
        src = src.limit(limit)
    return schema_cast(lowercase_columns(src), target)


def ts_check_load(df: DataFrame, ts_col: str, day: str, target: str) -> None:
    """B20: string and timestamp copies of one column, into one day partition."""
    out = df.select("*", F.col(ts_col).cast("string").alias(f"{ts_col}_text"))
    sinks.overwrite_partition(out, target, {"p_day": day})


# -- exports (B6, B7, B16) -----------------------------------------------------

def export_rows(model: OrderModel, days, shift: int = 0, wall_clock: bool = False) -> DataFrame:
    """B7 rows: order lines of a day range with the CDC columns; the op time
    is the line time shifted by ``shift`` hours (a loader zone correction)."""
    d = model.om_orderdetail(days)
    cols = [F.lit(None).cast("tinyint").alias("is_delete"), F.lit(cdcops.OP_INSERT).alias("data_op_type"),
            shift_hours("ordertime", shift).alias("data_op_ts")]
    if wall_clock:
        cols.insert(0, shift_hours(F.localtimestamp(), shift).alias("data_modified_datetime"))
    return d.select("*", *cols)


def bulk_export_csv(model: OrderModel, days, path: str, target: StructType, shift: int = 0,
                    max_records_per_file: int | None = 1_000_000) -> None:
    """B7: the rows cast to the store's schema, as CSV files for its bulk loader."""
    rows = export_rows(model, days, shift, wall_clock="data_modified_datetime" in target.names)
    sinks.export_csv(schema_cast(rows, target), path, max_records_per_file)


def two_sink_export(df: DataFrame, parquet_path: str, csv_path: str) -> None:
    """B16: one input, two sinks, input computed once."""
    sinks.multi_sink(df, [lambda d: d.write.mode("overwrite").parquet(parquet_path),
                          lambda d: sinks.export_csv(d, csv_path)])


# -- lookups and partition derivation -----------------------------------------

def find_result(spark: SparkSession, query: str, params: dict, null_as_empty: bool = True) -> DataFrame:
    """S7: parameterised query (bound, never spliced into the text); NULLs
    come back as '' and every value as text."""
    df = spark.sql(query, args=params)
    if not null_as_empty:
        return df
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def dhm_partition_columns(ts: str) -> list[Column]:
    """dt / h / m partition values of an event time (strings)."""
    return [F.date_format(ts, "yyyy-MM-dd").alias("dt"), F.date_format(ts, "HH").alias("h"),
            F.date_format(ts, "mm").alias("m")]
