"""Streaming queries: each replays its input table as a file stream, runs
the streaming plan to the end of the input (``availableNow``) and returns
the sink's contents as a batch DataFrame for comparison with the batch
oracle."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tidewater.functions.json import envelope_schema, parse_envelope, payments_of
from tidewater.operators.enrich import lookup_join
from tidewater.plans import batch_queries as bq
from tidewater.plans import oracle as sql
from tidewater.plans.registry import register
from tidewater.session import apply_conf, scratch_dir
from tidewater.sources.order_model import OrderModel, cdc_from_events
from tidewater.sources.tables import read_table
from tidewater.streaming.partition_commit import PartitionCommitSink
from tidewater.streaming.sales import MilestoneSink, MinuteSalesSink, streaming_amounts
from tidewater.streaming.sources import file_stream, replay_as_files, replay_files, run_to_end, with_event_time, yesterday_start_ms
from tidewater.streaming.topn import TopNState


def _replay(spark, rows, order_col, name, fmt="parquet", shuffled=False):
    """A file stream of ``rows``, half of its files in each micro-batch."""
    files = replay_files(rows)
    path = replay_as_files(rows, order_col, files, name=name, fmt=fmt, shuffled=shuffled)
    return file_stream(spark, path, rows.schema, fmt, max_files_per_trigger=files // 2)


def _events_stream(spark, sf_dir, where=None, shuffled=False):
    apply_conf(spark)
    e = read_table(spark, sf_dir, "events")
    if where is not None:
        e = e.where(where)
    return _replay(spark, e, "ts", "events-replay", shuffled=shuffled)


_CDC_SELECT = "detailid, ordercode, value, data_op_type, data_op_ts, ordertime"


@register("stream_filter_inserts", sql.with_model(f"SELECT {_CDC_SELECT} FROM cdc WHERE data_op_type = 'I'", "cdc"))
def stream_filter_inserts(spark, sf_dir):
    s = cdc_from_events(_events_stream(spark, sf_dir))
    s = with_event_time(s, "data_op_ts", "3 seconds", out="_event_time")
    out = s.where(F.col("data_op_type") == "I").select(*[c.strip() for c in _CDC_SELECT.split(",")])
    path = scratch_dir(spark, "stream-inserts")
    run_to_end(out.writeStream.format("parquet").outputMode("append").option("path", path),
               scratch_dir(spark, "ckpt-inserts"))
    return spark.read.parquet(path)


@register("stream_top2", bq.ORACLE_TOP2)
def stream_top2(spark, sf_dir):
    s = _events_stream(spark, sf_dir).select("user_id", "event_id", "value")
    state = TopNState(scratch_dir(spark, "top2-state"), ["user_id"], [F.col("value").desc(), F.col("event_id")],
                      unique=["event_id"], n=2, buckets=4)
    run_to_end(s.writeStream.foreachBatch(state), scratch_dir(spark, "ckpt-top2"))
    return state.read(spark).select("user_id", "event_id", "value", "row_num")


@register("stream_minute_sales", bq.MINUTE_SALES_SQL.format(where=""))
def stream_minute_sales(spark, sf_dir):
    """Rows arrive out of order (``shuffled``): most are later than the watermark, none is lost."""
    s = streaming_amounts(_events_stream(spark, sf_dir, shuffled=True), "ts", "value")
    sink = MinuteSalesSink(scratch_dir(spark, "minute-sales"))
    run_to_end(s.writeStream.foreachBatch(sink), scratch_dir(spark, "ckpt-minutes"))
    return sink.read(spark)


@register("stream_milestones", bq.milestones_sql(bq.MILESTONE_STEP))
def stream_milestones(spark, sf_dir):
    s = streaming_amounts(_events_stream(spark, sf_dir, F.col("event_type") == "purchase", shuffled=True), "ts", "value")
    sink = MilestoneSink(scratch_dir(spark, "ms-minutes"), scratch_dir(spark, "ms-marks"), bq.MILESTONE_STEP)
    run_to_end(s.writeStream.foreachBatch(sink), scratch_dir(spark, "ckpt-milestones"))
    return sink.read_marks(spark)


@register("stream_partition_counts", """
WITH c AS (SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS cnt FROM events GROUP BY 1),
w AS (SELECT date_trunc('second', max(ts)) - INTERVAL 3 SECOND AS wm FROM events)
SELECT dt, cnt, CAST(dt AS TIMESTAMP) + INTERVAL 1 DAY < (SELECT wm FROM w) AS committed FROM c""")
def stream_partition_counts(spark, sf_dir):
    s = with_event_time(_events_stream(spark, sf_dir), "ts", "3 seconds", out="event_time")
    s = s.select("user_id", "value", "event_time", F.date_format("event_time", "yyyy-MM-dd").alias("dt"))
    sink = PartitionCommitSink(scratch_dir(spark, "stream-table"), ["dt"], "event_time", "$dt 00:00:00",
                               watermark_delay="3 seconds", commit_delay="1 day")
    run_to_end(s.writeStream.foreachBatch(sink), scratch_dir(spark, "ckpt-partitions"))
    counts = sink.read(spark).groupBy("dt").agg(F.count(F.lit(1)).alias("cnt"))
    done = spark.createDataFrame([(p["dt"],) for p in sink.committed(spark)] or [("",)], "dt string")
    return (counts.join(done.withColumn("committed", F.lit(True)), "dt", "left")
                  .select("dt", "cnt", F.coalesce("committed", F.lit(False)).alias("committed")))


@register("stream_dhm_table", """
WITH e AS (SELECT user_id, value, ts, strftime(ts, '%Y-%m-%d') AS dt,
                  lpad(CAST(hour(ts) - hour(ts) % 6 AS VARCHAR), 2, '0') AS h, '00' AS m FROM events),
w AS (SELECT date_trunc('second', max(ts)) - INTERVAL 3 SECOND AS wm FROM events)
SELECT user_id, value, dt, h, m FROM e
WHERE CAST(dt || ' ' || h || ':' || m || ':00' AS TIMESTAMP) + INTERVAL 6 HOUR < (SELECT wm FROM w)""")
def stream_dhm_table(spark, sf_dir):
    """The dt/h/m sink, a partition for every six hours; its committed rows, read back through the catalog table."""
    import uuid
    s = with_event_time(_events_stream(spark, sf_dir), "ts", "3 seconds", out="event_time")
    hour = F.hour("event_time")
    s = s.select("user_id", "value", "event_time", F.date_format("event_time", "yyyy-MM-dd").alias("dt"),
                 F.lpad((hour - hour % 6).cast("string"), 2, "0").alias("h"), F.lit("00").alias("m"))
    path, name = scratch_dir(spark, "dhm-table"), f"dhm_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE TABLE {name} (user_id BIGINT, value DOUBLE, event_time TIMESTAMP, dt STRING, h STRING, m STRING, "
              f"batch_id STRING) USING parquet PARTITIONED BY (dt, h, m, batch_id) LOCATION '{path}'")
    sink = PartitionCommitSink(path, ["dt", "h", "m"], "event_time", "$dt $h:$m:00", watermark_delay="3 seconds",
                               commit_delay="6 hours", table=name)
    run_to_end(s.writeStream.foreachBatch(sink), scratch_dir(spark, "ckpt-dhm"))
    return spark.table(name).select("user_id", "value", "dt", "h", "m")


ORDERS_TODAY = datetime.date(2024, 1, 16)


@register("stream_orders_json", """
SELECT event_id AS order_id, user_id, value AS amount, CAST(ts AS TIMESTAMP) AS order_time FROM events
WHERE event_id % 29 <> 0 AND ts >= TIMESTAMP '2024-01-15 00:00:00'""")
def stream_orders_json(spark, sf_dir):
    """Order records as JSON text, read from yesterday 00:00 of a given day on;
    records that do not parse are left out."""
    apply_conf(spark)
    e = read_table(spark, sf_dir, "events")
    body = F.to_json(F.struct(F.col("event_id").alias("order_id"), "user_id", F.col("value").alias("amount"),
                              F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("order_time")))
    raw = e.select(F.when(F.col("event_id") % 29 == 0, F.substring(body, 1, 12)).otherwise(body).alias("value"))
    start = F.timestamp_millis(F.lit(yesterday_start_ms(ORDERS_TODAY)))
    order = F.from_json("value", "order_id BIGINT, user_id BIGINT, amount DOUBLE, order_time STRING").alias("o")
    s = _replay(spark, raw, "value", "orders-json", fmt="text").select(order).select("o.*")
    s = s.withColumn("order_time", F.try_to_timestamp("order_time").cast("timestamp_ntz"))
    s = s.where(F.col("order_time") >= start.cast("timestamp_ntz"))
    dest = scratch_dir(spark, "stream-orders")
    run_to_end(s.writeStream.format("parquet").option("path", dest), scratch_dir(spark, "ckpt-orders"))
    return spark.read.parquet(dest)


ENVELOPE_TABLE = "OM_ORDERSTATUS"


def envelopes(model: OrderModel):
    """CDC envelopes (JSON text) of order-status changes, with other-table
    rows, null after-images, missing payment keys and malformed text mixed in."""
    st = model.om_orderstatus()
    k = F.col("ordercode")
    after = F.when(k % 17 == 0, F.lit(None)).otherwise(
        F.struct(k.cast("string").alias("ORDERCODE"), F.col("paymentdate").alias("PAYMENTDATE")))
    body = F.to_json(F.struct(
        F.when(k % 10 == 0, F.lit("OM_ORDER")).otherwise(F.lit(ENVELOPE_TABLE)).alias("table"),
        F.lit("U").alias("op_type"), F.col("ordertime").alias("op_ts"), F.col("ordertime").alias("current_ts"),
        k.cast("string").alias("pos"), after.alias("after")))
    return st.select(k, F.when(k % 23 == 0, F.substring(body, 1, 20)).otherwise(body).alias("value"))


@register("stream_cdc_payments", sql.with_model(f"""
SELECT CAST(ordercode AS VARCHAR) AS ordercode, paymentdate FROM om_orderstatus
WHERE ordercode % 10 <> 0 AND ordercode % 17 <> 0 AND ordercode % 23 <> 0 AND paymentdate IS NOT NULL""",
                                                "om_orderstatus"))
def stream_cdc_payments(spark, sf_dir):
    apply_conf(spark)
    env = envelopes(OrderModel(spark, sf_dir))
    raw = _replay(spark, env, "ordercode", "envelope-replay")
    parsed = parse_envelope(raw, envelope_schema(["ORDERCODE", "PAYMENTDATE"]))
    out = payments_of(parsed, ENVELOPE_TABLE)
    dest = scratch_dir(spark, "stream-payments")
    run_to_end(out.writeStream.format("parquet").option("path", dest), scratch_dir(spark, "ckpt-payments"))
    return spark.read.parquet(dest)


@register("stream_dim_join", sql.with_model("""
SELECT detailid, ordercode, data_op_type, c_name AS customer_name, c_mktsegment AS customer_segment
FROM cdc LEFT JOIN customer ON ordercode = c_custkey""", "cdc"))
def stream_dim_join(spark, sf_dir):
    s = cdc_from_events(_events_stream(spark, sf_dir)).select("detailid", "ordercode", "data_op_type")
    dim = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ordercode"), F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_segment"))
    out = lookup_join(s, dim, "ordercode")
    dest = scratch_dir(spark, "stream-dim")
    run_to_end(out.writeStream.format("parquet").option("path", dest), scratch_dir(spark, "ckpt-dim"))
    return spark.read.parquet(dest)



@register("stream_top2_stateful", bq.ORACLE_TOP2)
def stream_top2_stateful(spark, sf_dir):
    """T4 with Spark's keyed state: each key's top-2 lives in the state store;
    every micro-batch emits the new top-2 of the keys it touched, and the sink
    replaces those keys' rows in a table keyed by (user_id, row_num)."""
    from tidewater.operators.delta_table import DeltaTable
    from tidewater.streaming.topn import stateful_top_n
    s = _events_stream(spark, sf_dir).select("user_id", "event_id", "value")
    top = stateful_top_n(s, ["user_id"], [("value", True), ("event_id", False)], ["event_id"], 2)
    table = DeltaTable(spark, scratch_dir(spark, "top2-stateful"), ["user_id", "row_num"], bucket_by=["user_id"], buckets=4)

    def replace_keys(batch, batch_id):
        table.upsert(batch, ("top2", batch_id))

    run_to_end(top.writeStream.outputMode("update").foreachBatch(replace_keys), scratch_dir(spark, "ckpt-top2s"))
    return table.read().select("user_id", "event_id", "value", "row_num")


@register("stream_milestone_corrections", f"""
WITH r AS (SELECT CAST(ts AS DATE) AS submit_date, strftime(ts, '%Y-%m-%d %H:%M') AS minute,
                  arg_max(value, event_id) AS value, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1, 2),
m AS (SELECT submit_date, minute, CAST(CAST(value AS DECIMAL(28,8)) AS DECIMAL(38,2)) AS sale_amount FROM r
      WHERE event_type <> 'error'),
c AS (SELECT *, SUM(sale_amount) OVER (PARTITION BY submit_date ORDER BY minute) AS cum FROM m),
k AS (SELECT submit_date, minute, CAST(floor((cum - sale_amount) / {bq.MILESTONE_STEP}) AS BIGINT) AS lo,
             CAST(floor(cum / {bq.MILESTONE_STEP}) AS BIGINT) AS hi FROM c)
SELECT submit_date, CAST(unnest(generate_series(lo + 1, hi)) AS BIGINT) AS mark_no, substr(minute, 12, 5) AS mark_minute
FROM k WHERE hi > lo""")
def stream_milestone_corrections(spark, sf_dir):
    """Every event replaces (or, as an error, deletes) the value of its minute; versions arrive out of
    order, and the result is the folded changelog of the marks."""
    from tidewater.operators.changelog import fold
    from tidewater.operators.milestones import AMOUNT
    from tidewater.streaming.views import milestone_view
    e = read_table(spark, sf_dir, "events").where("ts is not null")
    rows = e.select(F.to_date("ts").alias("submit_date"), F.date_format("ts", "yyyy-MM-dd HH:mm").alias("minute"),
                    F.col("event_id").alias("version"), F.col("value").cast(AMOUNT).alias("amount"),
                    F.when(F.col("event_type") == "error", "D").otherwise("U").alias("op"))
    view = milestone_view(spark, scratch_dir(spark, "milestone-view"), bq.MILESTONE_STEP, buckets=8)
    run_to_end(_replay(spark, rows, "version", "corrections", shuffled=True).writeStream.foreachBatch(view), scratch_dir(spark, "ckpt-mv"))
    return fold(view.changes().drop("batch_id"))


@register("stream_top2_changelog", """
SELECT user_id, event_id, value, CAST(rn AS INTEGER) AS row_num FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn FROM events
  WHERE event_type <> 'error') WHERE rn <= 2""")
def stream_top2_changelog(spark, sf_dir):
    """Top-2 over rows some of which are withdrawn again (errors), before or after the row itself
    arrives: the result refills, and is read as the folded changelog."""
    from pyspark.sql.types import StructType

    from tidewater.operators.changelog import fold
    from tidewater.streaming.views import top_n_view
    e = read_table(spark, sf_dir, "events").select("user_id", "event_id", "value", "event_type")
    record = lambda df, v, op: df.select("user_id", "event_id", "value", F.lit(v).alias("version"), F.lit(op).alias("op"))
    rows = record(e, 1, "I").unionByName(record(e.where("event_type = 'error'"), 2, "D"))
    schema = StructType().add("user_id", "long").add("event_id", "long").add("value", "double")
    view = top_n_view(spark, scratch_dir(spark, "top2-view"), schema, ["user_id"], ["event_id"],
                      [F.col("value").desc(), F.col("event_id")], 2, version=["version"], buckets=8)
    stream = _replay(spark, rows.withColumn("turn", F.hash("event_id", "version")), "turn", "top2-records", shuffled=True).drop("turn")
    run_to_end(stream.writeStream.foreachBatch(view), scratch_dir(spark, "ckpt-top2v"))
    return fold(view.changes().drop("batch_id"))


@register("stream_left_join", sql.with_model("""
SELECT s.ordercode, s.paymentdate, o.shopcode, o.createdate
FROM om_orderstatus s LEFT JOIN (SELECT * FROM om_order WHERE changetype NOT IN (1, 2, 3)) o
  ON s.ordercode = o.ordercode""", "om_orderstatus", "om_order"))
def stream_left_join(spark, sf_dir):
    """The left join of order states and orders, both arriving in several batches in either order."""
    from pyspark.sql.types import StructType

    from tidewater.operators import cdc as cdcops
    from tidewater.plans import facts
    from tidewater.streaming.views import LeftJoinView
    m = OrderModel(spark, sf_dir)
    right = m.om_order().where(cdcops.not_in("changetype", facts.EXCHANGE_ORDER_TYPES)).select("ordercode", "shopcode", "createdate")
    left = m.om_orderstatus().select("ordercode", "paymentdate")
    side = lambda name, df, cols: df.select(F.lit(name).alias("side"), "ordercode", *cols, F.lit("I").alias("op"))
    null = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    rows = side("left", left, ["paymentdate", null(right, "shopcode"), null(right, "createdate")]).unionByName(
        side("right", right, [null(left, "paymentdate"), "shopcode", "createdate"]))
    types = lambda df, cols: StructType([df.schema[c] for c in cols])
    view = LeftJoinView(spark, scratch_dir(spark, "join-view"), types(left, ["ordercode", "paymentdate"]), ["ordercode"],
                        types(right, ["ordercode", "shopcode", "createdate"]), ["ordercode"], ["ordercode"], buckets=8)

    def step(batch, batch_id):
        of = lambda name, cols: batch.where(F.col("side") == name).select("ordercode", *cols, "op")
        view.apply(of("left", ["paymentdate"]), of("right", ["shopcode", "createdate"]), batch_id)

    stream = _replay(spark, rows.withColumn("turn", F.hash("side", "ordercode")), "turn", "join-records", shuffled=True).drop("turn")
    run_to_end(stream.writeStream.foreachBatch(step), scratch_dir(spark, "ckpt-join"))
    return view.read()


ASOF_SQL = """
WITH f AS (SELECT user_id, event_id, ts, value FROM events WHERE event_type = 'purchase'),
v AS (SELECT user_id, ts AS known_from, arg_max(value, value) AS level FROM events WHERE event_type = 'view' GROUP BY 1, 2)
SELECT f.user_id, f.event_id, f.ts, f.value, v.known_from, v.level
FROM f ASOF LEFT JOIN v ON f.user_id = v.user_id AND f.ts >= v.known_from"""


def _asof_sides(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    return (e.where("event_type = 'purchase'").select("user_id", "event_id", "ts", "value"),
            e.where("event_type = 'view'").select("user_id", F.col("ts").alias("known_from"), F.col("value").alias("level")))


@register("asof_lookup", ASOF_SQL)
def asof_lookup(spark, sf_dir):
    """Purchases with the user's last view at or before them."""
    from tidewater.operators.asof import asof_join
    facts, versions = _asof_sides(spark, sf_dir)
    return asof_join(facts, versions, ["user_id"], "ts", "known_from")


@register("stream_asof_lookup", ASOF_SQL)
def stream_asof_lookup(spark, sf_dir):
    """The same from a stream of facts and dimension versions that arrive out of order: a version that comes
    after its facts corrects them."""
    from tidewater.streaming.views import asof_view
    facts, versions = _asof_sides(spark, sf_dir)
    rows = (facts.withColumn("kind", F.lit("fact"))
            .unionByName(versions.withColumn("kind", F.lit("version")), allowMissingColumns=True)
            .withColumn("op", F.lit("I")).withColumn("turn", F.xxhash64("user_id", "event_id", "known_from")))
    view = asof_view(spark, scratch_dir(spark, "asof-view"), facts.schema, "event_id", ["user_id"], "ts", versions.schema,
                     "known_from", buckets=8)
    stream = _replay(spark, rows, "turn", "asof-records", shuffled=True).drop("turn")
    run_to_end(stream.writeStream.foreachBatch(view), scratch_dir(spark, "ckpt-asof"))
    return view.read()


@register("stream_idle_totals", """
WITH g AS (SELECT user_id, CAST(ts AS TIMESTAMP) AS ts, value,
                  ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 24 HOUR AS anew, event_id FROM events),
p AS (SELECT *, count(*) FILTER (WHERE anew) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS period FROM g),
s AS (SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, max(ts) + INTERVAL 24 HOUR AS idle_at, count(*) AS n_events,
             sum(CAST(value AS DECIMAL(28,8))) AS amount FROM p GROUP BY user_id, period)
SELECT * FROM s WHERE idle_at <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 3 SECOND FROM events)""")
def stream_idle_totals(spark, sf_dir):
    """Each user's totals, reported and forgotten after 24 hours without an event; rows
    come in the order of their time over several micro-batches."""
    from tidewater.streaming.retention import totals_until_idle
    rows = _events_in_turns(spark, sf_dir, "ts")
    dest, checkpoint = scratch_dir(spark, "idle-totals"), scratch_dir(spark, "ckpt-idle")
    for stream in rows:
        out = totals_until_idle(stream.select("user_id", "ts", "value"), ["user_id"], "ts",
                                [F.count(F.lit(1)).alias("n_events"), F.sum(F.col("value").cast("decimal(28,8)")).alias("amount")])
        schema = out.schema
        run_to_end(out.writeStream.format("parquet").outputMode("append").option("path", dest), checkpoint)
    return spark.read.schema(schema).parquet(dest).select(
        "user_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("first_seen", "last_seen", "idle_at")], "n_events", "amount")


#: The turns in which ``_events_in_turns`` lets the events arrive.
TURNS = 4


def _events_in_turns(spark, sf_dir, order_col):
    """The events' stream, once for each turn: a turn adds the next range of ``order_col`` to its folder."""
    e = read_table(spark, sf_dir, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp")) if order_col == "ts" else F.col(order_col)
    ends = e.select(F.percentile_approx(at, [k / TURNS for k in range(1, TURNS)]).alias("q")).first().q
    turn = sum((F.coalesce(at > end, F.lit(False)).cast("int") for end in ends), F.lit(0)) if ends else F.lit(0)
    path, files = scratch_dir(spark, "turns"), max(1, replay_files(e) // TURNS)
    for k in range(TURNS):
        replay_as_files(e.where(turn == k), order_col, files, shuffled=True, path=path)
        yield file_stream(spark, path, e.schema)


ARRIVAL = "event_id"


@register("stream_row_watermark", """
WITH a AS (SELECT event_id, user_id, ts + CASE WHEN event_type = 'error' THEN -INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END AS ts FROM events),
w AS (SELECT *, max(ts) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 3 SECOND AS watermark FROM a)
SELECT event_id, user_id, CAST(ts AS TIMESTAMP) AS ts, CAST(watermark AS TIMESTAMP) AS watermark, coalesce(ts < watermark, false) AS late FROM w""")
def stream_row_watermark(spark, sf_dir):
    """Every event with the watermark it meets; errors tell of one hour before, so most are late."""
    from tidewater.operators.lateness import RowWatermarkSink
    sink, checkpoint = RowWatermarkSink(scratch_dir(spark, "row-watermark"), [ARRIVAL], "ts", "3 seconds"), scratch_dir(spark, "ckpt-rw")
    hour = F.expr("INTERVAL 1 HOUR")
    for stream in _events_in_turns(spark, sf_dir, ARRIVAL):
        rows = stream.select("event_id", "user_id", F.when(F.col("event_type") == "error", F.col("ts") - hour).otherwise(F.col("ts")).alias("ts"))
        run_to_end(rows.writeStream.foreachBatch(sink), checkpoint)
    return sink.read(spark, rows.schema)


#: The stream sinks' file size in the data model.
ROLL_BYTES = 1 << 20


@register("stream_sized_files", "SELECT event_id, user_id, event_type, value, props FROM events")
def stream_sized_files(spark, sf_dir):
    """Events as JSON files of 1 MB, read back whole."""
    from tidewater.operators.sized_files import SizedFileSink
    s = _events_stream(spark, sf_dir).select("event_id", "user_id", "event_type", "value", "props")
    sink = SizedFileSink(scratch_dir(spark, "sized-events"), ROLL_BYTES, "json")
    run_to_end(s.writeStream.foreachBatch(sink), scratch_dir(spark, "ckpt-sized"))
    return sink.read(spark, s.schema)


@register("bulk_export_sized", "SELECT doc_id, lang, source, text, n_chars FROM documents")
def bulk_export_sized(spark, sf_dir):
    """Texts of very different lengths as CSV files of 1 MB, read back whole."""
    from tidewater.operators.sized_files import export_sized, read_sized
    d = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text", "n_chars")
    path = scratch_dir(spark, "sized-texts")
    export_sized(d, path, ROLL_BYTES)
    return read_sized(spark, path, d.schema)
