"""Schema-driven cast projection (one definition for every job)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def cast_columns(target: StructType, exclude: Iterable[str] = (), on_error: str = "fail") -> list[Column]:
    """For each target field emit ``CAST(name AS type) AS name``.

    The cast is driven by the ``DataType`` itself, never by type text, so
    ``DECIMAL(18, 4) NOT NULL`` and quoted names cannot be cut short.
    Nullability of the target is not enforced.  ``on_error="null"`` turns
    uncastable values into NULL (``try_cast``); ``"fail"`` raises under ANSI.
    """
    skip = {e.lower() for e in exclude}
    out = []
    for f in target.fields:
        if f.name.lower() in skip:
            continue
        c = _quoted(f.name)
        c = c.try_cast(f.dataType) if on_error == "null" else c.cast(f.dataType)
        out.append(c.alias(f.name))
    return out


def schema_cast(df: DataFrame, target: StructType, exclude: Iterable[str] = (), on_error: str = "fail") -> DataFrame:
    """Project ``df`` onto ``target``'s columns, in target order, cast to its types."""
    return df.select(*cast_columns(target, exclude, on_error))


def schema_of(spark, table: str) -> StructType:
    """Schema of a registered table or view (the target of a cast projection)."""
    return spark.table(table).schema
