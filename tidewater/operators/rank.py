"""Top-N per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
          rank_col: str = "row_num") -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order) <= n``.

    ``order`` must end in a unique tie-break so the kept rows are
    deterministic.  Catalyst plans a partial ``WindowGroupLimit`` before the
    shuffle, so each map task forwards at most ``n`` rows per key: a key
    holding a third of the table still ships only ``n`` rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)
