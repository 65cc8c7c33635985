import datetime as dt

from pyspark.sql import functions as F


from tidewater.functions.dates import (datetime_columns, first_day_after, first_day_at_or_after, on_day,
                                       strict_timestamp)


def test_day_bounds_for_string_ranges():
    assert first_day_at_or_after("2020-09-30") == dt.date(2020, 9, 30)
    # '2020-09-31' is not a date: every real day up to 2020-09-30 sorts below it
    assert first_day_after("2020-09-31") == dt.date(2020, 10, 1)
    assert first_day_after("2020-12-32") == dt.date(2021, 1, 1)
    assert first_day_after("2020-02-28") == dt.date(2020, 2, 29)
    assert first_day_at_or_after("nonsense") is None


def test_between_on_strings_matches_exact_form(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 9, 30, 12),), (dt.datetime(2020, 10, 1),),
                                (dt.datetime(2020, 4, 30, 23, 59),)], "ts timestamp_ntz")
    from tidewater.functions.dates import day_between
    got = sorted(r[0] for r in df.where(day_between("ts", "2020-05-01", "2020-09-31")).collect())
    assert got == [dt.datetime(2020, 9, 30, 12)]
    assert df.where(on_day("ts", "2020-10-01")).count() == 1


def test_datetime_parts(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 1, 3, 17, 45),), (None,)], "ts timestamp_ntz")
    r = df.select(*datetime_columns("ts", "pay")).collect()
    a = r[0].asDict()
    assert a["pay_date"] == dt.datetime(2021, 1, 3)
    assert (a["pay_year"], a["pay_month"], a["pay_day"], a["pay_quarter"], a["pay_hour"]) == (2021, 1, 3, 1, 17)
    assert a["pay_day_of_week"] == 7  # Sunday, ISO
    assert a["pay_week_start_date"] == dt.datetime(2020, 12, 28)
    assert all(v is None for v in r[1].asDict().values())


def test_strict_timestamp(spark):
    df = spark.createDataFrame([("2020-01-02 03:04:05.678",), ("2020-13-02 03:04:05.678",), ("",)], "s string")
    got = [r[0] for r in df.select(strict_timestamp("s").cast("timestamp_ntz")).collect()]
    assert got == [dt.datetime(2020, 1, 2, 3, 4, 5, 678000), None, None]


def test_range_equals_string_between_exhaustively(spark):
    """The emitted range selects exactly the days the string BETWEEN selects."""
    from tidewater.functions.dates import day_between
    days = spark.range(0, 800).select(
        F.timestamp_add("HOUR", F.col("id") * 11, F.lit("2019-12-01 00:00:00").cast("timestamp_ntz")).alias("ts"))
    for lo, hi in [("2020-01-31", "2020-02-30"), ("2020-02-29", "2020-03-01"), ("2020-04-31", "2020-06-00"),
                   ("2020-02-10 12:00", "2020-02-12 08"), ("2020-13-01", "2021-01-01")]:
        want = days.where(F.date_format("ts", "yyyy-MM-dd").between(lo, hi)).count()
        assert days.where(day_between("ts", lo, hi)).count() == want, (lo, hi)
