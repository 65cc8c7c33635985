"""A key holding a third of all rows: results stay whole and the plans
reduce the hot key before the shuffle."""

import datetime as dt

from pyspark.sql import functions as F

from tidewater.operators.milestones import sales_milestones
from tidewater.operators.rank import top_n
from tidewater.operators.upsert import latest_per_key


def _skewed(spark, n=30000):
    # user 0 gets every third row; the rest spread over 500 users
    return spark.range(n).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500 + 1).alias("user_id"),
        ((F.col("id") * 7919) % 10007 / 100).alias("value"),
        F.timestamp_add("SECOND", F.col("id") * 3, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("ts"),
    ).repartition(8)


def test_top_n_hot_key(spark):
    df = _skewed(spark)
    out = top_n(df, ["user_id"], [F.col("value").desc(), F.col("event_id")], 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan
    hot = sorted(r.event_id for r in out.where(F.col("user_id") == 0).collect())
    want = sorted(r.event_id for r in df.where(F.col("user_id") == 0)
                  .orderBy(F.col("value").desc(), F.col("event_id")).limit(3).collect())
    assert hot == want
    assert out.count() == 3 * df.select("user_id").distinct().count()


def test_latest_per_key_hot_key_plan(spark):
    df = _skewed(spark)
    out = latest_per_key(df, ["user_id"], ["ts", "event_id"])
    assert "partial_max_by" in out._jdf.queryExecution().executedPlan().toString()
    got = {r.user_id: r.event_id for r in out.collect()}
    assert got[0] == 29997 and len(got) == 501


def test_milestones_on_hot_day(spark):
    df = _skewed(spark)  # about a day of events, one every 3 s
    marks = sales_milestones(df, "ts", "value", 1000)
    total = df.agg(F.sum(F.col("value").cast("decimal(18,2)"))).first()[0]
    per_day = {r.submit_date: r.n for r in marks.groupBy("submit_date").agg(F.count(F.lit(1)).alias("n")).collect()}
    # every day's marks count equals floor(day total / step)
    days = {r.d: r.t for r in df.groupBy(F.to_date("ts").alias("d"))
            .agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("t")).collect()}
    assert sum(days.values()) == total
    assert {d: int(t // 1000) for d, t in days.items() if t >= 1000} == per_day
    assert dt.date(2024, 1, 1) in per_day
