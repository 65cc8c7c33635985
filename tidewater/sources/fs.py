"""Small file-system helpers over the Hadoop FileSystem of the session.

Used for markers and tracker files (``_SUCCESS``, commit state) that must
live on the shared storage the cluster uses (HDFS, object stores), never on
a machine-local folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    write_bytes(spark, path, text.encode("utf-8"))


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """The whole file or nothing: written under a temporary name, then renamed."""
    fs, p = _fs_path(spark, path)
    head, _, name = path.rpartition("/")
    _, tmp = _fs_path(spark, f"{head}/.{name}.{uuid.uuid4().hex[:8]}.tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(tmp, p):
        raise OSError(f"could not move {tmp.toString()} to {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs_path(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)
