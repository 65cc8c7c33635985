import os
import subprocess
import sys

import __spark_entry__ as entry

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["id", "customer_id", "ware_id"]
    assert df.schema == entry.entry(spark).schema


def test_registry_consistent():
    qs, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(qs)
    assert len(qs) >= 40


def test_workers_find_the_package_from_any_folder(tmp_path):
    """A query with Python workers, started from a folder and with a path that do not hold the package."""
    code = f"""
import sys
sys.path.insert(0, {HERE!r})
from tidewater.session import build_session
spark = build_session("local[2]", shuffle_partitions=2, extra={{"spark.checkpoint.dir": {str(tmp_path / "ckpt")!r}}})
from pyspark.sql import functions as F
import tidewater.streaming.topn as topn
of = F.pandas_udf(lambda s: topn._in_order(s.to_frame("x"), [("x", False)])["x"], "long")
print("rows", spark.range(10).select(of("id")).count(), spark.range(10).select(of("id").alias("x")).agg(F.sum("x")).first()[0])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 10 45" in done.stdout, done.stderr[-2000:]


def test_entry_without_a_library_of_the_corpus_operators(tmp_path):
    code = f"""
import sys, warnings
sys.path.insert(0, {HERE!r})
sys.modules["zstandard"] = None
warnings.simplefilter("ignore")
import __spark_entry__ as e
names = e.queries()
print("queries", len(names) >= 49, any(n.startswith("op") or n == "pipeline" for n in names))
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert "queries True False" in done.stdout, done.stderr[-2000:]
