import datetime as dt

from tidewater.operators import cdc

ROWS = [
    (1, "I", dt.datetime(2024, 1, 10, 5), dt.datetime(2024, 1, 8)),
    (2, "D", dt.datetime(2024, 1, 10, 6), dt.datetime(2024, 1, 10)),
    (3, None, dt.datetime(2024, 1, 9, 23, 59, 59), dt.datetime(2024, 1, 10, 0, 0)),
    (4, "U", dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 9, 23, 59, 59, 999999)),
    (5, "U", None, None),
]
SCHEMA = "id int, data_op_type string, data_op_ts timestamp_ntz, ordertime timestamp_ntz"


def _ids(df):
    return sorted(r.id for r in df.collect())


def test_slice_day_ors_columns_and_bounds(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert _ids(cdc.slice_day(df, "2024-01-10")) == [1, 2, 3]
    assert _ids(cdc.slice_day(df, "2024-01-10", ["ordertime"])) == [2, 3]


def test_exclude_deletes_drops_null_op_type(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    # NULL <> 'D' is unknown, so the row is dropped, as in SQL
    assert _ids(cdc.slice_day(df, "2024-01-10", exclude_deletes=True)) == [1]
    assert _ids(cdc.deletes_of(df, "2024-01-10")) == [2]
    assert _ids(cdc.inserts_only(df)) == [1]


def test_not_in_drops_null(spark):
    df = spark.createDataFrame([(1, 1), (2, 4), (3, None)], "id int, changetype int")
    assert _ids(df.where(cdc.not_in("changetype", (1, 2, 3)))) == [2]


def test_slice_pushes_ranges_to_scan(spark, tmp_out):
    path = tmp_out("cdc-scan")
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(path)
    plan = cdc.slice_day(spark.read.parquet(path), "2024-01-10")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(data_op_ts,2024-01-10T00:00)" in plan
