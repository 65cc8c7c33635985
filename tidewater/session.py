"""Spark session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

from tidewater.sources import fs

# Settings every job relies on.  Partition sizing (shuffle partitions,
# maxPartitionBytes) is left to the cluster; AQE coalesces and splits at
# run time, so the same plan holds from sf0.01 to 100 TB.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows placed by (order) already stand together by (order, day): no second shuffle.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # INSERT OVERWRITE replaces only the partitions a batch touches.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # p_day / dt / h / m stay strings when a partitioned path is read back.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Streaming state off the JVM heap, checkpointed incrementally.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Rows of a session are merged inside the task before they are shuffled, however hot the key.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tidewater", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of SESSION_CONF to an existing session."""
    for k, v in SESSION_CONF.items():
        if k.startswith("spark.ui"):
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a session we did not build
            pass
    ship_package(spark)


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, through the shared folder: they
    have no other way to it when the driver's start folder and PYTHONPATH do not hold it."""
    sc = spark.sparkContext
    if getattr(sc, "_tidewater_shipped", False) or not (_root(spark) or _is_local(spark)):
        return
    home = os.path.dirname(os.path.abspath(__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(home)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.relpath(path, os.path.dirname(home)))
    to = f"{scratch_dir(spark, 'package')}/tidewater_package.zip"
    fs.write_bytes(spark, to, data.getvalue())
    sc.addPyFile(to)
    sc._tidewater_shipped = True


def _root(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and must be a shared file
    system; only a local run (one machine, one process) may leave it unset and
    gets a folder of its own, registered so that later ``checkpoint()`` calls
    use it too.
    """
    root = _root(spark)
    if not root:
        if not _is_local(spark):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {spark.sparkContext.master}")
        root = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)  # so DataFrame.checkpoint() writes there too
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the checkpoint root."""
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    return f"{root}{sep}tidewater/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path
