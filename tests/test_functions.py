import decimal

import pytest
from pyspark.sql.types import (ByteType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType,
                               StringType, StructField, StructType)

from tidewater.functions.casts import schema_cast
from tidewater.functions.json import envelope_schema, json_field, parse_envelope, payments_of
from tidewater.functions.strings import composite_id, split_keep_inner


def test_java_split_drops_trailing_empties(spark):
    df = spark.createDataFrame([("a,,b,,",), (",a",), ("",), (",,",), (None,)], "s string")
    got = [r[0] for r in df.select(split_keep_inner("s", ",")).collect()]
    assert got == [["a", "", "b"], ["", "a"], [""], [], None]


def test_composite_id_skips_nulls(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    assert [r[0] for r in df.select(composite_id("a", "b")).collect()] == ["1-x", "2"]


TYPE_ROW = StructType([
    StructField("_varchar", StringType()), StructField("_int", IntegerType()), StructField("bigint", LongType()),
    StructField("smallint", ShortType()), StructField("tinyint", ByteType()),
    StructField("decimal_5_4", DecimalType(5, 4)), StructField("decimal_18_4", DecimalType(18, 4)),
    StructField("_double", DoubleType()), StructField("_float", FloatType()),
])


def test_typed_load_every_primitive(spark, tmp_out):
    src = spark.createDataFrame([("v", "7", "8", "9", "10", "1.2345", "43.22", "1.5", "2.5")],
                                ", ".join(f"`{f.name}` string" for f in TYPE_ROW.fields))
    out = schema_cast(src, TYPE_ROW)
    path = tmp_out("typed")
    out.write.mode("append").parquet(path)
    back = spark.read.parquet(path)
    assert back.schema == TYPE_ROW
    r = back.first()
    assert r["decimal_5_4"] == decimal.Decimal("1.2345") and r["tinyint"] == 10


def test_cast_overflow_fails_or_nulls(spark):
    src = spark.createDataFrame([("43.22",)], "decimal_5_4 string")
    target = StructType([StructField("decimal_5_4", DecimalType(5, 4))])
    with pytest.raises(Exception):
        schema_cast(src, target).collect()
    assert schema_cast(src, target, on_error="null").first()[0] is None


def test_schema_cast_excludes_and_orders(spark):
    src = spark.createDataFrame([(1, "2020-01-01", "x")], "b int, p_day string, `a b` string")
    target = StructType([StructField("a b", StringType()), StructField("b", LongType()),
                         StructField("p_day", StringType())])
    out = schema_cast(src, target, exclude=["P_DAY"])
    assert out.columns == ["a b", "b"] and dict(out.dtypes)["b"] == "bigint"


ENVELOPES = [
    '{"table":"OM_ORDERSTATUS","op_type":"U","after":{"ORDERCODE":"A1","PAYMENTDATE":"2020-11-01 10:00:00"}}',
    '{"table":"OM_ORDER","op_type":"U","after":{"ORDERCODE":"A2","PAYMENTDATE":"2020-11-01 10:00:00"}}',
    '{"table":"OM_ORDERSTATUS","op_type":"U","after":{"ORDERCODE":"A3","PAYMENTDATE":null}}',
    '{"table":"OM_ORDERSTATUS","op_type":"U","after":{"ORDERCODE":"A4"}}',
    '{"table":"OM_ORDERSTATUS","op_type":"D","after":null}',
    '{"table":"OM_ORDERSTATUS","op_type":"U","after":{"ORDERCODE":"A6",',
]


def test_envelope_filter_cases(spark):
    raw = spark.createDataFrame([(s,) for s in ENVELOPES], "value string")
    env = parse_envelope(raw, envelope_schema(["ORDERCODE", "PAYMENTDATE"]))
    got = [tuple(r) for r in payments_of(env, "OM_ORDERSTATUS").collect()]
    assert got == [("A1", "2020-11-01 10:00:00")]


def test_json_field_bare_value(spark):
    df = spark.createDataFrame([('{"k": "v", "n": null}',)], "j string")
    r = df.select(json_field("j", "$.k"), json_field("j", "$.n")).first()
    assert tuple(r) == ("v", None)
