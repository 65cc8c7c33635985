"""The flagship's physical plan: filters reach the scans, columns are pruned,
expressions stay in whole-stage codegen, no Python in the plan."""

import __spark_entry__ as entry
from tests.conftest import SF_SMALL


def test_flagship_plan_pushdown_and_pruning(spark):
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # untruncated scan details
    try:
        _check_flagship(spark)
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)


def _check_flagship(spark):
    df = entry.queries()["dwd_retail_submit"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1998-03-10T00:00)" in plan
    assert "LessThan(o_orderdate,1998-06-21T00:00)" in plan
    scan = next(ln for ln in plan.splitlines() if "FileScan parquet [l_orderkey" in ln)
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_quantity:double," \
           "l_extendedprice:double>" in scan
    df.collect()  # runs this query execution, so AQE's final plan is visible
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final and "*(" in final  # whole-stage codegen stages
    for python_op in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert python_op not in final


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_unmatched_dimensions_stay_in_the_fact(spark):
    from pyspark.sql import functions as F

    from tidewater.plans import facts
    from tidewater.sources.order_model import OrderModel

    class Gaps(OrderModel):
        def dim_ware(self):
            return super().dim_ware().where(F.col("ware_id") % 2 == 0)

        def dim_address(self):
            return super().dim_address().where(~F.col("address_id").startswith("0-"))

    whole = facts.retail_submit_fact(OrderModel(spark, SF_SMALL))
    gaps = facts.retail_submit_fact(Gaps(spark, SF_SMALL))
    assert gaps.count() == whole.count()
    assert gaps.where((F.col("ware_id") % 2 == 1) != F.col("ware_name").isNull()).count() == 0
    assert gaps.where(F.col("address_id").startswith("0-") != F.col("address_name").isNull()).count() == 0


def test_lines_are_shuffled_once(spark):
    from tidewater.plans import facts
    from tidewater.sources.order_model import OrderModel
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = OrderModel(spark, SF_SMALL)
        for df, most in ((facts.retail_submit_fact(m), 6), (facts.retail_pay_fact(m), 10)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") <= most + 4      # 4: two dimension joins of two sides
            assert plan.count("FileScan parquet [l_orderkey") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_partitioned_scans_prune(spark):
    plan = _final_plan(entry.queries()["partition_range_scan"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(p_day" in plan
    plan = _final_plan(entry.queries()["semi_paid_days"](spark, SF_SMALL))
    assert "dynamicpruning" in plan.lower()


def test_no_scratch_folder_off_local(monkeypatch):
    import pytest

    from tidewater import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Spark:
        sparkContext = Context()

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Spark())
