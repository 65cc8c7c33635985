"""String helpers: composite ids, splitting, name casing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def composite_id(*cols, sep: str = "-") -> Column:
    """CONCAT_WS(sep, a, b, ...): NULL parts are skipped, numbers become text."""
    return F.concat_ws(sep, *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols])


def split_keep_inner(s, sep: str) -> Column:
    """Split like Java's ``String.split``: trailing empty fields are dropped,
    inner and leading ones kept.  ``sep`` is a regular expression."""
    c = F.col(s) if isinstance(s, str) else s
    parts = F.split(c, sep)
    # index of the last non-empty element (0 when all are empty)
    last = F.aggregate(F.sequence(F.lit(1), F.size(parts)), F.lit(0),
                       lambda acc, i: F.when(F.element_at(parts, i) != "", i).otherwise(acc))
    # Java returns the input itself when nothing matched, so "" -> [""].
    return (F.when(c.isNull(), F.lit(None).cast("array<string>"))
             .when(c == "", F.array(F.lit("")))
             .when(last == 0, F.array().cast("array<string>"))
             .otherwise(F.slice(parts, 1, last)))


def words(s, sep: str = " ") -> Column:
    """Flat-map a text column into words (one output row per word)."""
    return F.explode(split_keep_inner(s, sep))


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Source column names lower-cased (JDBC stores report upper case)."""
    return df.toDF(*[c.lower() for c in df.columns])
