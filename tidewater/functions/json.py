"""JSON access for change-capture envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def envelope_schema(after_fields: list[str], typed: dict | None = None) -> StructType:
    """Envelope ``{table, op_type, op_ts, current_ts, pos, before, after}``;
    ``before``/``after`` are row images with the given fields."""
    typed = typed or {}
    img = StructType([StructField(f, typed.get(f, StringType())) for f in after_fields])
    head = [StructField(n, StringType()) for n in ("table", "op_type", "op_ts", "current_ts", "pos")]
    return StructType(head + [StructField("before", img), StructField("after", img)])


def parse_envelope(df: DataFrame, schema: StructType, col: str = "value") -> DataFrame:
    """Raw JSON text -> envelope struct columns.  Malformed text gives NULL
    fields, a JSON null gives a SQL NULL; neither raises."""
    return df.select(F.from_json(F.col(col), schema, {"mode": "PERMISSIVE"}).alias("_e")).select("_e.*")


def json_field(c, path: str) -> Column:
    """Bare value at a JSON path (no surrounding quotes); JSON null -> NULL."""
    return F.get_json_object(F.col(c) if isinstance(c, str) else c, path)


def payments_of(envelopes: DataFrame, table: str, key: str = "ORDERCODE", paid: str = "PAYMENTDATE") -> DataFrame:
    """Envelopes of ``table`` whose after-image has a payment date ->
    (ordercode, paymentdate).  A missing or null ``after`` is no match."""
    return (envelopes.where((F.col("table") == table) & F.col(f"after.{paid}").isNotNull())
                     .select(F.col(f"after.{key}").alias(key.lower()), F.col(f"after.{paid}").alias(paid.lower())))
