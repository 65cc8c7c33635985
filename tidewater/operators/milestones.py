"""Per-minute sales and running-total milestones.

Milestone rule: within a day, minutes are taken in order and their sales
summed; each time the running total reaches another multiple of ``step``
the minute (``HH:mm``) is emitted, once per multiple crossed.  With the
cumulative total ``C_i`` after minute *i*, minute *i* is emitted
``floor(C_i/step) - floor(C_{i-1}/step)`` times.  A late or corrected
minute only changes the minute's sum, and the day is re-evaluated from the
current sums, so the result never depends on arrival order.

Amounts are summed as wide DECIMALs and rounded once, at the end; a negative
minute total fails the query (a milestone, once reached, is never withdrawn).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

AMOUNT = DecimalType(28, 8)
PARTIAL = DecimalType(38, 8)
TOTAL = DecimalType(38, 2)
# Step of the reference demo (named "million" there, value 5000).
DEFAULT_STEP = 5000


def minute_sales(df: DataFrame, ts: str, amount: str) -> DataFrame:
    """Sales per (day, minute): ``submit_date`` DATE, ``minute`` 'yyyy-MM-dd HH:mm'."""
    return (df.groupBy(F.to_date(F.col(ts)).alias("submit_date"),
                       F.date_format(F.col(ts), "yyyy-MM-dd HH:mm").alias("minute"))
              .agg(F.sum(F.col(amount).cast(AMOUNT)).cast(TOTAL).alias("sale_amount")))


def milestones_from_minutes(minutes: DataFrame, step: int = DEFAULT_STEP, day: str = "submit_date",
                            minute: str = "minute", amount: str = "sale_amount") -> DataFrame:
    """One row per milestone: (day, mark_no, mark_minute 'HH:mm').

    The window is partitioned by day over at most 1440 pre-aggregated minute
    rows, so its size is bounded whatever the input volume or skew.
    """
    w = Window.partitionBy(day).orderBy(minute).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = F.sum(F.col(amount)).over(w)
    sound = F.when(F.col(amount) < 0, F.raise_error(F.concat(F.lit("negative amount in minute "), F.col(minute)))
                   .cast(TOTAL)).otherwise(F.col(amount))
    minutes = minutes.select(day, minute, sound.alias(amount))
    k = (minutes.select(day, minute, amount, cum.cast(TOTAL).alias("_cum"))
         .select(day, minute,
                 F.floor((F.col("_cum") - F.col(amount)) / F.lit(step)).cast("bigint").alias("_lo"),
                 F.floor(F.col("_cum") / F.lit(step)).cast("bigint").alias("_hi")))
    return (k.where(F.col("_hi") > F.col("_lo"))
             .select(F.col(day),
                     F.explode(F.sequence(F.col("_lo") + 1, F.col("_hi"))).alias("mark_no"),
                     F.substring(F.col(minute), 12, 5).alias("mark_minute")))


def sales_milestones(df: DataFrame, ts: str, amount: str, step: int = DEFAULT_STEP) -> DataFrame:
    return milestones_from_minutes(minute_sales(df, ts, amount), step)


def milestone_arrays(marks: DataFrame, day: str = "submit_date") -> DataFrame:
    """The reference's array result: per day, the minutes in emission order.

    A day's array holds one entry per milestone (total / step entries), so
    this is for reporting; jobs should keep the row form.
    """
    return (marks.groupBy(day)
                 .agg(F.array_sort(F.collect_list(F.struct("mark_no", "mark_minute"))).alias("_m"))
                 .select(day, F.col("_m.mark_minute").alias("milestones")))
