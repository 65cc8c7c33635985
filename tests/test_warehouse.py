from tests.conftest import SF_SMALL
from tidewater.plans import facts
from tidewater.sources.order_model import OrderModel
from tidewater.sources.warehouse import WarehouseTables, build_ods

DAYS = ("1998-01-01", "1998-12-31")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_facts_on_partitioned_warehouse(spark, tmp_out):
    model = OrderModel(spark, SF_SMALL)
    root = build_ods(model, tmp_out("ods"), DAYS)
    wh = WarehouseTables(spark, root)
    sub = facts.retail_submit_fact(wh, facts.SUBMIT_DAYS)
    assert _rows(sub) == _rows(facts.retail_submit_fact(model, facts.SUBMIT_DAYS))
    plan = sub._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p_day" in plan
    pay = facts.retail_pay_fact(wh, facts.PAY_DAYS)
    assert _rows(pay) == _rows(facts.retail_pay_fact(model, facts.PAY_DAYS))
    assert "dynamicpruning" in pay._jdf.queryExecution().executedPlan().toString().lower() or \
        "dynamicpruning" in pay._jdf.queryExecution().optimizedPlan().toString().lower()
