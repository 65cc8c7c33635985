"""DuckDB text of the order model and of each registered query.

The driver runs these against the raw input tables (pre-registered views)
and compares with the Spark result.  The model CTEs restate the column
rules of ``tidewater.sources.order_model`` in SQL.
"""

from __future__ import annotations

DAY = "strftime({c}, '%Y-%m-%d')"


def day(c: str) -> str:
    return DAY.format(c=c)


MODEL_CTES = {
    "om_order": f"""
  SELECT o_orderkey AS ordercode, o_custkey AS cuscode,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) % 5 AS changetype,
         ascii(o_orderstatus) % 3 AS ordersource, o_orderpriority AS shopcode,
         CAST(o_custkey % 3 AS INTEGER) AS salemode, CAST(o_orderkey % 2 AS INTEGER) AS invoicetype,
         o_orderdate AS createdate, {day('o_orderdate')} AS p_day
  FROM orders""",
    "om_orderdetail": f"""
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
                   CAST(l_suppkey AS VARCHAR)) AS detailid,
         l_orderkey AS ordercode, l_partkey AS warecode,
         o_orderdate + to_hours(CAST(l_linenumber AS BIGINT)) AS ordertime,
         l_quantity AS qty, l_extendedprice AS sumnetamt, {day('o_orderdate')} AS p_day
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "om_orderaddress": f"""
  SELECT o_orderkey AS ordercode, n_regionkey AS provincecode, n_nationkey AS citycode,
         c_custkey AS areacode, {day('o_orderdate')} AS p_day
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "om_orderstatus": """
  SELECT o_orderkey AS ordercode, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ordertime,
         CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S')
              WHEN o_orderstatus = 'O' THEN '' END AS paymentdate
  FROM orders""",
    "dim_address": """
  SELECT concat_ws('-', CAST(n_regionkey AS VARCHAR), CAST(n_nationkey AS VARCHAR)) AS address_id,
         n_name AS address_name, r_name AS address_region
  FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "dim_ware": """
  SELECT p_partkey AS ware_id, p_name AS ware_name, p_brand AS ware_brand FROM part""",
    "cdc": """
  SELECT event_id AS detailid, user_id AS ordercode, value,
         CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS data_op_type,
         ts AS data_op_ts, ts - to_days(CAST(event_id % 3 AS INTEGER)) AS ordertime
  FROM events""",
}


def with_model(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs of the model tables it names."""
    ctes = ",\n".join(f"{n} AS ({MODEL_CTES[n]}\n)" for n in names)
    return f"WITH {ctes}\n{body}" if names else body


def date_parts_sql(ts: str, prefix: str, skip_datetime: bool = True) -> str:
    cols = [] if skip_datetime else [f"CAST({ts} AS TIMESTAMP) AS {prefix}_datetime"]
    cols += [
        f"CAST(date_trunc('day', {ts}) AS TIMESTAMP) AS {prefix}_date",
        f"CAST(year({ts}) AS INTEGER) AS {prefix}_year",
        f"CAST(month({ts}) AS INTEGER) AS {prefix}_month",
        f"CAST(day({ts}) AS INTEGER) AS {prefix}_day",
        f"CAST(quarter({ts}) AS INTEGER) AS {prefix}_quarter",
        f"CAST(isodow({ts}) AS INTEGER) AS {prefix}_day_of_week",
        f"CAST(date_trunc('week', {ts}) AS TIMESTAMP) AS {prefix}_week_start_date",
        f"CAST(hour({ts}) AS INTEGER) AS {prefix}_hour",
    ]
    return ",\n       ".join(cols)


ORDER_ATTRS = """o.ordersource AS order_source_id, o.shopcode AS order_shop_id,
       concat_ws('-', CAST(o.ordersource AS VARCHAR), o.shopcode) AS order_sale_channel_id,
       o.changetype AS order_type, o.salemode AS order_sale_mode, o.invoicetype AS order_invoice_type"""

ADDRESS_ID = "concat_ws('-', CAST(oa.provincecode AS VARCHAR), CAST(oa.citycode AS VARCHAR))"

DIM_COLS = "da.address_name, da.address_region, dw.ware_name, dw.ware_brand"


def submit_fact_sql(lo: str, hi: str) -> str:
    body = f"""
SELECT od.detailid AS id, o.cuscode AS customer_id, od.warecode AS ware_id,
       {ADDRESS_ID} AS address_id, o.ordercode AS order_id,
       od.ordertime AS submit_datetime, o.createdate AS order_datetime,
       CAST(od.qty AS DECIMAL(18,4)) AS submit_count, CAST(od.sumnetamt AS DECIMAL(18,4)) AS submit_amount,
       {ORDER_ATTRS},
       {date_parts_sql('od.ordertime', 'submit')},
       {DIM_COLS}
FROM om_orderdetail od
JOIN om_order o ON od.ordercode = o.ordercode AND od.p_day = o.p_day
JOIN om_orderaddress oa ON od.ordercode = oa.ordercode AND od.p_day = oa.p_day
LEFT JOIN dim_address da ON da.address_id = {ADDRESS_ID}
LEFT JOIN dim_ware dw ON dw.ware_id = od.warecode
WHERE od.p_day BETWEEN '{lo}' AND '{hi}' AND o.p_day BETWEEN '{lo}' AND '{hi}'
  AND oa.p_day BETWEEN '{lo}' AND '{hi}' AND o.changetype NOT IN (1, 2, 3)"""
    return with_model(body, "om_orderdetail", "om_order", "om_orderaddress", "dim_address", "dim_ware")


def paid_days_cte(lo: str, hi: str) -> str:
    return f"""temp AS (
  SELECT strftime(CAST(ordertime AS TIMESTAMP), '%Y-%m-%d') AS p_day FROM om_orderstatus
  WHERE paymentdate <> '' AND paymentdate IS NOT NULL
    AND strftime(TRY_CAST(paymentdate AS TIMESTAMP), '%Y-%m-%d') BETWEEN '{lo}' AND '{hi}'
  GROUP BY 1)"""


def paid_days_sql(lo: str, hi: str) -> str:
    return with_model(f", {paid_days_cte(lo, hi)}\nSELECT p_day FROM temp", "om_orderstatus")


def pay_fact_sql(lo: str, hi: str) -> str:
    body = f""", {paid_days_cte(lo, hi)}
SELECT od.detailid AS id, o.cuscode AS customer_id, od.warecode AS ware_id,
       {ADDRESS_ID} AS address_id, os.ordercode AS order_id,
       CAST(TRY_CAST(os.paymentdate AS TIMESTAMP) AS TIMESTAMP) AS pay_datetime,
       o.createdate AS order_datetime,
       CAST(od.qty AS DECIMAL(18,4)) AS pay_count, CAST(od.sumnetamt AS DECIMAL(18,4)) AS pay_amount,
       {ORDER_ATTRS},
       {date_parts_sql('TRY_CAST(os.paymentdate AS TIMESTAMP)', 'pay')},
       {DIM_COLS}
FROM (SELECT ordercode, paymentdate FROM om_orderstatus
      WHERE paymentdate <> '' AND paymentdate IS NOT NULL
        AND strftime(TRY_CAST(paymentdate AS TIMESTAMP), '%Y-%m-%d') BETWEEN '{lo}' AND '{hi}') os
JOIN (SELECT * FROM om_orderdetail WHERE p_day IN (SELECT p_day FROM temp)) od ON os.ordercode = od.ordercode
JOIN (SELECT * FROM om_order WHERE p_day IN (SELECT p_day FROM temp)) o ON os.ordercode = o.ordercode
JOIN (SELECT * FROM om_orderaddress WHERE p_day IN (SELECT p_day FROM temp)) oa ON os.ordercode = oa.ordercode
LEFT JOIN dim_address da ON da.address_id = {ADDRESS_ID}
LEFT JOIN dim_ware dw ON dw.ware_id = od.warecode
WHERE o.changetype NOT IN (1, 2, 3)"""
    return with_model(body, "om_orderstatus", "om_orderdetail", "om_order", "om_orderaddress",
                      "dim_address", "dim_ware")
