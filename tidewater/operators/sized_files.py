"""Text exports whose files roll by size.

Every row is turned into its line (CSV or JSON) first, so its width in bytes is
known and not estimated.  Each task adds the widths up in the order of its rows and a line's file
number is the running sum over the target; no row moves between tasks.  All
files but the last of each task are full to within one line.

The lines are written as text below ``path/file=<task>-<n>``; ``read_sized``
reads them back.  A task that is run again numbers and writes its lines
anew, and only one run of it is committed.

Defined results: a line wider than the target has a file that is as long as the line
needs; an empty input leaves an empty folder; a null is ``\\N`` in CSV, so it stays
apart from an empty text (a text that is ``\\N`` reads as null); quotes, separators, line
ends and outer spaces in a text come back as they were.  CSV files may hold line ends inside quotes, so a reader takes each whole, which its size allows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The files' sizes unless said otherwise.
TARGET_BYTES = 128 << 20
_FILE = "file"
#: CSV that keeps every text as it is, and nulls apart from empty texts.
CSV_AS_IS = {"nullValue": "\\N", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _lines(df: DataFrame, fmt: str, options: dict[str, str]) -> DataFrame:
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    if fmt == "csv":
        return df.select(F.to_csv(row, {**CSV_AS_IS, **options}).alias("line"))
    if fmt == "json":
        return df.select(F.to_json(row, options).alias("line"))
    raise ValueError(f"format {fmt!r}: csv or json")


def _numbered(lines: DataFrame, target: int) -> DataFrame:
    """line, file: lines of one task fill its files one after another."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, full = TaskContext.get().partitionId(), 0
        for b in batches:
            line = b.column(0)
            ends = np.cumsum(pc.binary_length(line).to_numpy(zero_copy_only=False).astype(np.int64) + 1) + full
            starts = np.concatenate([[full], ends[:-1]])[:len(ends)]
            full = int(ends[-1]) if len(ends) else full
            names = [f"{task:06d}-{n:06d}" for n in (starts // target).tolist()]
            yield pa.RecordBatch.from_arrays([line, pa.array(names, pa.string())], names=["line", _FILE])

    return lines.mapInArrow(number, f"line string, {_FILE} string")


def export_sized(df: DataFrame, path: str, target_bytes: int = TARGET_BYTES, fmt: str = "csv",
                 options: dict[str, str] | None = None, mode: str = "overwrite") -> None:
    """Write ``df`` as text files of ``target_bytes`` each."""
    if target_bytes < 1:
        raise ValueError("target_bytes must be positive")
    rows = _numbered(_lines(df, fmt, dict(options or {})), target_bytes)
    # a static overwrite, whatever the session says: the folders of an earlier export go
    (rows.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy(_FILE).text(path))


def read_sized(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv",
               options: dict[str, str] | None = None) -> DataFrame:
    """The rows of an export, or of all batches of a ``SizedFileSink``."""
    options = dict(options or {})
    if fmt == "csv":
        options = {**CSV_AS_IS, "multiLine": "true", "lineSep": "\n", **options}
    return spark.read.schema(schema).options(recursiveFileLookup="true", **options).format(fmt).load(path)


class SizedFileSink:
    """A stream's rows as files of a size (foreachBatch): a batch writes, and when retried rewrites, its own folder."""

    def __init__(self, path: str, target_bytes: int = TARGET_BYTES, fmt: str = "json", options: dict[str, str] | None = None):
        self.path, self.target, self.fmt, self.options = path.rstrip("/"), target_bytes, fmt, options

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        export_sized(batch, f"{self.path}/batch_id={batch_id}", self.target, self.fmt, self.options)

    def read(self, spark: SparkSession, schema: StructType) -> DataFrame:
        return read_sized(spark, self.path, schema, self.fmt, self.options)
