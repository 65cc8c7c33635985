"""Aggregations of the reference jobs: counts, distinct days, string reduce."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_per_key(df: DataFrame, keys: Sequence[str], name: str = "cnt") -> DataFrame:
    """map(x -> (x, 1)).groupBy(0).sum(1): a partial (map-side) count per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))



def reduce_concat(df: DataFrame, keys: Sequence[str], value: str, name: str = "concatenated",
                  sep: str = "") -> DataFrame:
    """Pairwise string reduce per key, made deterministic by sorting.

    ``collect_list`` aggregates partially on the map side; the final string
    of a key is necessarily as large as the key's values, so use it on keys
    whose groups are bounded (lines of one order, words of one part).
    """
    return df.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(value)), sep).alias(name))
