import datetime as dt
import random
from bisect import bisect_left
from decimal import Decimal
from itertools import accumulate

import pytest

from tidewater.operators.milestones import milestone_arrays, milestones_from_minutes

SCHEMA = "submit_date date, minute string, sale_amount decimal(38,2)"


def _hhmm(m):
    return f"{m // 60:02d}:{m % 60:02d}"


def test_kth_mark_is_the_first_minute_whose_total_reaches_it(spark):
    rng = random.Random(7)
    step, rows, want = 500, [], {}
    for case in range(60):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=case)
        amounts = {m: Decimal(rng.randint(0, 90000)) / 100 for m in rng.sample(range(1440), rng.randint(1, 40))}
        minutes = sorted(amounts)
        totals = list(accumulate(amounts[m] for m in minutes))
        want[day] = [_hhmm(minutes[bisect_left(totals, k * step)]) for k in range(1, int(totals[-1] // step) + 1)]
        rows += [(day, f"{day.isoformat()} {_hhmm(m)}", v) for m, v in amounts.items()]
    rng.shuffle(rows)
    got = {}
    for r in milestones_from_minutes(spark.createDataFrame(rows, SCHEMA), step).orderBy("submit_date", "mark_no").collect():
        got.setdefault(r.submit_date, []).append(r.mark_minute)
    assert got == {d: w for d, w in want.items() if w}


def test_negative_amounts_are_refused(spark):
    day = dt.date(2024, 1, 1)
    rows = [(day, f"2024-01-01 00:0{i}", Decimal(v)) for i, v in enumerate((600, -300, 300))]
    with pytest.raises(Exception, match="negative amount"):
        milestones_from_minutes(spark.createDataFrame(rows, SCHEMA), 500).collect()


def test_milestone_arrays_in_emission_order(spark):
    minutes = spark.createDataFrame([
        (dt.date(2024, 1, 1), "2024-01-01 00:05", Decimal("600.00")),
        (dt.date(2024, 1, 1), "2024-01-01 00:01", Decimal("450.00")),
        (dt.date(2024, 1, 1), "2024-01-01 00:09", Decimal("1000.00")),
        (dt.date(2024, 1, 2), "2024-01-02 23:59", Decimal("499.99")),
    ], SCHEMA)
    got = {r.submit_date: r.milestones for r in milestone_arrays(milestones_from_minutes(minutes, 500)).collect()}
    # running totals 450, 1050, 2050 -> marks at 00:05 (500, 1000), 00:09 (1500, 2000)
    assert got == {dt.date(2024, 1, 1): ["00:05", "00:05", "00:09", "00:09"]}
