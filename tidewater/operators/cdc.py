"""Change-capture slicing: the incremental day slice, deletes, inserts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.dates import on_day

OP_INSERT, OP_UPDATE, OP_DELETE = "I", "U", "D"


def not_in(c, values: Iterable) -> Column:
    """``c NOT IN (...)``: a NULL ``c`` is dropped, as in SQL."""
    return ~(F.col(c) if isinstance(c, str) else c).isin(list(values))


def touched_on(day: str, columns: Sequence[str]) -> Column:
    """Rows whose any of ``columns`` falls on ``day`` (OR over the list).

    Each column test is a half-open range, so every disjunct reaches the scan.
    """
    if not columns:
        raise ValueError("at least one date column is needed")
    return reduce(or_, [on_day(c, day) for c in columns])


def slice_day(df: DataFrame, day: str, columns: Sequence[str] = ("data_op_ts", "ordertime"),
              exclude_deletes: bool = False, op_col: str = "data_op_type") -> DataFrame:
    """The day's increment: rows changed or created on ``day``.

    ``exclude_deletes`` keeps only rows whose op type is not a delete (a NULL
    op type is dropped too, SQL three-valued logic).
    """
    cond = touched_on(day, columns)
    if exclude_deletes:
        cond = cond & (F.col(op_col) != OP_DELETE)
    return df.where(cond)


def deletes_of(df: DataFrame, day: str, ts_col: str = "data_op_ts", op_col: str = "data_op_type") -> DataFrame:
    """The day's delete log: rows deleted on ``day``."""
    return df.where(on_day(ts_col, day) & (F.col(op_col) == OP_DELETE))


def inserts_only(df: DataFrame, op_col: str = "data_op_type") -> DataFrame:
    return df.where(F.col(op_col) == OP_INSERT)


def with_cdc_columns(df: DataFrame, op_type: str = OP_INSERT, wall_clock: bool = True) -> DataFrame:
    """Add the change-capture columns a back-filled row carries: a constant op
    type, a typed NULL delete flag, and (optionally) the load time."""
    cols = [F.lit(op_type).alias("data_op_type"), F.lit(None).cast("tinyint").alias("is_delete")]
    if wall_clock:
        cols.append(F.localtimestamp().alias("data_modified_datetime"))
    return df.select("*", *cols)
