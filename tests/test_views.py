"""Maintained results: their changelogs fold to the batch result after every step."""

import datetime
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.operators import changelog
from tidewater.operators.asof import asof_join
from tidewater.streaming.views import LeftJoinView, asof_view, milestone_view, top_n_view

DAY = datetime.date(2024, 5, 1)


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def folded(view):
    return sorted_rows(changelog.fold(view.changes().drop("batch_id")).select(*view.result_schema.names))


def test_difference_and_fold_count_repeated_rows(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (3,), (3,), (None,)], "x int")
    change = changelog.difference(a, b)
    assert sorted(tuple(r) for r in change.collect()) == [("D", 1), ("D", 2), ("I", 3), ("I", 3)]
    assert sorted_rows(changelog.fold([a.select(F.lit("I").alias("op"), "x"), change])) == sorted_rows(b)
    with pytest.raises(Exception, match="deleted more often"):
        changelog.fold(change.where("op = 'D'")).collect()


def test_milestones_are_withdrawn_and_come_back(spark, tmp_out):
    view = milestone_view(spark, tmp_out("marks"), 100, buckets=2)
    row = lambda minute, version, amount, op="U", day=DAY: (day, f"{day} {minute}", version, amount, op)
    feed = lambda n, *rows: view(spark.createDataFrame(
        list(rows), "submit_date date, minute string, version long, amount long, op string"), n)
    marks = lambda: [(r.mark_no, r.mark_minute) for r in view.read().orderBy("submit_date", "mark_no").collect()]
    feed(0, row("10:00", 1, 150), row("11:00", 1, 120))
    assert marks() == [(1, "10:00"), (2, "11:00")]
    feed(1, row("10:00", 2, 20))                                     # smaller: the first mark moves, the second goes
    assert marks() == [(1, "11:00")]
    feed(2, row("10:00", 1, 999), row("09:00", 1, 300))              # a stale version changes nothing
    assert marks() == [(1, "09:00"), (2, "09:00"), (3, "09:00"), (4, "11:00")]
    feed(3, row("09:00", 2, 0, "D"), row("11:00", 2, 0, "D"))        # the day loses all its marks
    assert marks() == [] and view.rows.read().count() == 1
    feed(4, row("12:00", 1, 80))
    assert marks() == [(1, "12:00")] and folded(view) == sorted_rows(view.read())
    feed(4, row("12:00", 1, 80))                                     # the batch again
    assert marks() == [(1, "12:00")] and folded(view) == sorted_rows(view.read())
    with pytest.raises(Exception, match="negative amount"):
        feed(5, row("13:00", 1, -5))


def test_top_n_refills_after_withdrawals(spark, tmp_out):
    schema = StructType().add("k", "string").add("id", "long").add("v", "long")
    view = top_n_view(spark, tmp_out("top"), schema, ["k"], ["id"], [F.col("v").desc(), F.col("id")], 2, ["version"], buckets=2)
    rng, live = random.Random(5), {}
    for step in range(5):
        batch = {}
        for _ in range(15):
            k, i = rng.choice("abc"), rng.randrange(12)
            batch[(k, i)] = (rng.randrange(100), rng.choice("IID"))
        view(spark.createDataFrame([(k, i, v, step, op) for (k, i), (v, op) in batch.items()],
                                   "k string, id long, v long, version int, op string"), step)
        for key, (v, op) in batch.items():
            live.pop(key, None) if op == "D" else live.__setitem__(key, v)
        want = []
        for k in "abc":
            best = sorted((-v, i) for (kk, i), v in live.items() if kk == k)[:2]
            want += [(k, i, -v, n + 1) for n, (v, i) in enumerate(best)]
        assert sorted_rows(view.read().select("k", "id", "v", "row_num")) == sorted(want, key=repr) == folded(view)


def test_left_join_follows_both_sides(spark, tmp_out):
    left = StructType().add("k", "long").add("a", "long").add("x", "string")
    right = StructType().add("k", "long").add("b", "long").add("y", "string")
    view = LeftJoinView(spark, tmp_out("join"), left, ["k", "a"], right, ["k", "b"], ["k"], buckets=4)
    rng, live = random.Random(11), {"left": {}, "right": {}}
    for step in range(6):
        frames = {}
        for side, schema in (("left", left), ("right", right)):
            keys = {(rng.choice([0, 0, 0, 1, 2, 3, None]), rng.randrange(4)) for _ in range(rng.choice([0, 5, 8]))}
            rows = [(*key, f"{side}{step}", rng.choice("IIUD")) for key in sorted(keys, key=repr)]
            frames[side] = spark.createDataFrame(rows, StructType([*schema]).add("op", "string"))
            for k, i, text, op in rows:
                live[side].pop((k, i), None) if op == "D" else live[side].__setitem__((k, i), text)
        view.apply(frames["left"], frames["right"], step)
        want = []
        for (k, a), x in live["left"].items():
            met = [(b, y) for (kk, b), y in live["right"].items() if k is not None and kk == k]
            want += [(k, a, x, b, y) for b, y in met or [(None, None)]]
        assert folded(view) == sorted(want, key=repr)
        assert sorted_rows(view.read().select("k", "a", "x", "b", "y")) == sorted(want, key=repr)
        view.apply(frames["left"], frames["right"], step)          # a retried batch
        assert folded(view) == sorted(want, key=repr)


def test_left_join_reads_only_the_buckets_it_touches(spark, tmp_out, monkeypatch):
    left = StructType().add("k", "long").add("x", "string")
    right = StructType().add("k", "long").add("y", "string")
    view = LeftJoinView(spark, tmp_out("touch"), left, ["k"], right, ["k"], ["k"], buckets=16)
    rows = lambda schema, ks, text: spark.createDataFrame([(k, text, "I") for k in ks], StructType([*schema]).add("op", "string"))
    view.apply(rows(left, range(100), "l"), rows(right, [], "r"), 0)
    seen = []
    for t, _ in view.sides.values():
        whole = t.read_or_empty
        monkeypatch.setattr(t, "read_or_empty", lambda schema, version=None, buckets=None, whole=whole: (
            seen.append(buckets), whole(schema, version, buckets))[1])
    view.apply(rows(left, [], "l"), rows(right, [7], "r"), 1)
    assert seen and all(len(b) == 1 for b in seen)
    assert view.read().where("y is not null").count() == 1 and view.read().count() == 100


def test_left_join_takes_tasks_by_its_rows(spark, tmp_out, monkeypatch):
    from tidewater.streaming import views
    monkeypatch.setattr(views, "TASK_ROWS", 25, raising=False)
    left = StructType().add("k", "long").add("x", "string")
    right = StructType().add("k", "long").add("y", "string")
    view = LeftJoinView(spark, tmp_out("tasks"), left, ["k"], right, ["k"], ["k"], buckets=2)
    rows = lambda schema, ks, text: spark.createDataFrame([(k, text, "I") for k in ks], StructType([*schema]).add("op", "string"))
    plans, publish = [], view._publish
    monkeypatch.setattr(view, "_publish", lambda net, n: (plans.append(net._jdf.queryExecution().optimizedPlan().toString()), publish(net, n)))
    view.apply(rows(left, range(150), "l"), rows(right, range(50), "r"), 0)       # 200 rows, 8 tasks
    view.apply(rows(left, range(150, 200), "l"), rows(right, range(50, 200), "r"), 1)
    for plan, tasks in zip(plans, (8, 16)):
        dealt = [line for line in plan.splitlines() if "RepartitionByExpression" in line and line.rstrip().endswith(f", {tasks}")]
        assert len(dealt) >= 3, plan                     # the parts of the result, each by itself
    assert sorted_rows(view.read()) == sorted([(k, "l", "r") for k in range(200)], key=repr) == folded(view)


T0 = datetime.datetime(2024, 1, 1)


def at(hours):
    return None if hours is None else T0 + datetime.timedelta(hours=hours)


def asof_case(rng):
    """Facts and versions; key 0 holds most facts, over many slices."""
    facts = [(rng.choice([0, 0, 0, 1, 2, None]), i, at(rng.choice([None, *range(0, 200)]))) for i in range(150)]
    versions = [(rng.choice([0, 1, None]), at(rng.choice([None, *range(0, 200, 7)])), f"v{i % 5}", i % 3) for i in range(40)]
    want = []
    for k, i, t in facts:
        known = [(vt, name, n) for vk, vt, name, n in versions if k is not None and vk == k and t and vt and vt <= t]
        want.append((k, i, t, *(max(known) if known else (None, None, None))))
    return facts, versions, want


FACT, VERSION = "k long, id long, ts timestamp_ntz", "k long, since timestamp_ntz, name string, n int"


@pytest.mark.parametrize("slice_seconds", [3600, 86_400, 10**9])
def test_asof_join_is_the_plain_lookup(spark, slice_seconds):
    facts, versions, want = asof_case(random.Random(slice_seconds))
    got = asof_join(spark.createDataFrame(facts, FACT), spark.createDataFrame(versions, VERSION), ["k"], "ts", "since", slice_seconds)
    assert sorted_rows(got) == sorted(want, key=repr)
    none = asof_join(spark.createDataFrame(facts, FACT), spark.createDataFrame([], VERSION), ["k"], "ts", "since")
    assert none.where("name is not null").count() == 0 and none.count() == len(facts)
    with pytest.raises(ValueError, match="both sides"):
        asof_join(spark.createDataFrame([], FACT), spark.createDataFrame([], "k long, ts timestamp_ntz"), ["k"], "ts", "ts")


def test_asof_view_corrects_facts_when_a_version_comes_late(spark, tmp_out):
    fact, version = spark.createDataFrame([], FACT).schema, spark.createDataFrame([], VERSION).schema
    view = asof_view(spark, tmp_out("asof"), fact, "id", ["k"], "ts", version, "since", buckets=2)
    cols = "k long, id long, ts timestamp_ntz, since timestamp_ntz, name string, n int, kind string, op string"
    fact_row = lambda k, i, t: (k, i, at(t), None, None, None, "fact", "I")
    version_row = lambda k, t, name: (k, None, None, at(t), name, 1, "version", "I")
    state = lambda: [(r.id, r.name) for r in view.read().orderBy("id").collect()]
    view(spark.createDataFrame([fact_row(1, 1, 50), fact_row(1, 2, 90), fact_row(2, 3, 10)], cols), 0)
    assert state() == [(1, None), (2, None), (3, None)]
    view(spark.createDataFrame([version_row(1, 80, "late")], cols), 1)
    assert state() == [(1, None), (2, "late"), (3, None)]
    view(spark.createDataFrame([version_row(1, 20, "early"), fact_row(1, 4, 81)], cols), 2)
    assert state() == [(1, "early"), (2, "late"), (3, None), (4, "late")]
    assert folded(view) == sorted_rows(view.read())
