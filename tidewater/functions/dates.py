"""Date and time column helpers (all JVM-side expressions, no UDFs)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FMT = "yyyy-MM-dd"
MINUTE_FMT = "yyyy-MM-dd HH:mm"
STRICT_TS_FMT = "yyyy-MM-dd HH:mm:ss.SSS"

# Fixed names of the nine date-part columns, in output order.
DATETIME_PARTS = ("datetime", "date", "year", "month", "day", "quarter",
                  "day_of_week", "week_start_date", "hour")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def datetime_parts(ts, prefix: str = "datetime") -> dict[str, Column]:
    """One timestamp -> nine prefixed date-part columns, by name.

    ``{p}_date`` and ``{p}_week_start_date`` are midnight timestamps (week
    starts Monday), ``{p}_day_of_week`` is ISO (Monday = 1).  NULL in gives
    NULL out.  Truncations are cast back to TIMESTAMP_NTZ so the columns keep
    the input's wall-clock type.
    """
    t = _c(ts).cast("timestamp_ntz")
    exprs = {
        "datetime": t,
        "date": F.date_trunc("DAY", t).cast("timestamp_ntz"),
        "year": F.year(t),
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "quarter": F.quarter(t),
        "day_of_week": F.weekday(t) + F.lit(1),
        "week_start_date": F.date_trunc("WEEK", t).cast("timestamp_ntz"),
        "hour": F.hour(t),
    }
    return {f"{prefix}_{k}": exprs[k].alias(f"{prefix}_{k}") for k in DATETIME_PARTS}


def datetime_columns(ts, prefix: str = "datetime", skip=()) -> list[Column]:
    return [c for n, c in datetime_parts(ts, prefix).items() if n not in set(skip)]


def day_string(ts) -> Column:
    """``yyyy-MM-dd`` text of a timestamp (the p_day partition value)."""
    return F.date_format(_c(ts), DAY_FMT)



def parse_loose_timestamp(s) -> Column:
    """Text -> timestamp; blank or unparsable text gives NULL instead of an error."""
    return F.try_to_timestamp(_c(s))


def strict_timestamp(s, fmt: str = STRICT_TS_FMT, on_error: str = "null") -> Column:
    """Non-lenient parse: month 13 or day 32 is rejected, not rolled over."""
    if on_error == "fail":
        return F.to_timestamp(_c(s), fmt)
    return F.try_to_timestamp(_c(s), F.lit(fmt))


def shift_hours(ts, hours: int) -> Column:
    """TIMESTAMPADD(HOUR, n, ts)."""
    return F.timestamp_add("HOUR", F.lit(hours), _c(ts))



def string_to_date(s) -> Column:
    """A datetime text written into a DATE column keeps its day part."""
    return F.to_date(F.try_to_timestamp(_c(s)))


# ---------------------------------------------------------------------------
# Day ranges that reach the Parquet scan.
#
# ``date_format(ts, 'yyyy-MM-dd') = 'd'`` and string BETWEEN over a derived day
# cannot be pushed into a scan.  The helpers below add an equivalent
# half-open timestamp range that can, computed on the driver from the literal
# bounds (never from data).

def _parse_day_prefix(s: str):
    try:
        y, m, d = int(s[0:4]), int(s[5:7]), int(s[8:10])
    except (ValueError, IndexError):
        return None
    if len(s) < 10 or s[4] != "-" or s[7] != "-":
        return None
    return y, m, d


def first_day_at_or_after(s: str) -> _dt.date | None:
    """Smallest real date whose ``yyyy-MM-dd`` text is >= ``s``."""
    p = _parse_day_prefix(s)
    if p is None:
        return None
    y, m, d = p
    extra = s[10:]
    if not (1 <= m <= 12):
        return _dt.date(y + 1, 1, 1) if m > 12 else _dt.date(y, 1, 1)
    if d < 1:
        return _dt.date(y, m, 1)
    try:
        day = _dt.date(y, m, d)
    except ValueError:  # e.g. '2020-09-31': no such day, next month starts after it
        return _dt.date(y + (m == 12), m % 12 + 1, 1)
    return day + _dt.timedelta(days=1) if extra else day


def first_day_after(s: str) -> _dt.date | None:
    """Smallest real date whose ``yyyy-MM-dd`` text is > ``s``."""
    d = first_day_at_or_after(s)
    if d is None:
        return None
    return d + _dt.timedelta(days=1) if d.isoformat() == s else d


def day_between(ts, lo: str, hi: str) -> Column:
    """``date_format(ts,'yyyy-MM-dd') BETWEEN lo AND hi`` on strings.

    For bounds of the form ``yyyy-MM-dd...`` (real dates or not, such as
    ``'2020-09-31'``) the string test equals a half-open timestamp range
    computed here from the literals, and only that range is emitted, so it
    reaches the scan even inside an OR.  Other bounds keep the string form.
    """
    start, stop = first_day_at_or_after(lo), first_day_after(hi)
    if start is None or stop is None:
        return day_string(ts).between(F.lit(lo), F.lit(hi))
    t = _c(ts)
    return ((t >= F.lit(f"{start.isoformat()} 00:00:00").cast("timestamp_ntz")) &
            (t < F.lit(f"{stop.isoformat()} 00:00:00").cast("timestamp_ntz")))


def on_day(ts, day: str) -> Column:
    """``date_format(ts,'yyyy-MM-dd') = day`` as a pushable half-open range."""
    return day_between(ts, day, day)


# SQL text of each date part over an argument named ``ts`` (same rules as
# ``datetime_parts``), for the SQL-registered form of the function.
_SQL_PARTS = {
    "datetime": ("TIMESTAMP_NTZ", "ts"),
    "date": ("TIMESTAMP_NTZ", "CAST(date_trunc('DAY', ts) AS TIMESTAMP_NTZ)"),
    "year": ("INT", "year(ts)"),
    "month": ("INT", "month(ts)"),
    "day": ("INT", "day(ts)"),
    "quarter": ("INT", "quarter(ts)"),
    "day_of_week": ("INT", "weekday(ts) + 1"),
    "week_start_date": ("TIMESTAMP_NTZ", "CAST(date_trunc('WEEK', ts) AS TIMESTAMP_NTZ)"),
    "hour": ("INT", "hour(ts)"),
}


def register_datetime_function(spark, name: str, prefix: str) -> None:
    """Register ``name(ts)`` for SQL users: a STRUCT of the nine prefixed parts.

    A scalar SQL function is inlined into the calling projection (whole-stage
    codegen, no join); use it as ``SELECT t.*, name(ts).* FROM t``.  A SQL
    *table* function joined laterally would instead be decorrelated into a
    join against the distinct timestamps, which does not scale.
    """
    fields = ", ".join(f"{prefix}_{p}: {_SQL_PARTS[p][0]}" for p in DATETIME_PARTS)
    body = ", ".join(f"'{prefix}_{p}', {_SQL_PARTS[p][1]}" for p in DATETIME_PARTS)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(ts TIMESTAMP_NTZ) "
              f"RETURNS STRUCT<{fields}> RETURN named_struct({body})")
