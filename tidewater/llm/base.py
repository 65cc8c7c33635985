"""Helpers shared by the corpus operators: registry, input tables, words."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import checkpoint_root, scratch_dir, ship_package
from tidewater.sources import fs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Rows per Arrow batch: texts can be long, so batches are kept short.
ARROW_ROWS = "250"


def register(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir)`` as a query, with its DuckDB text if SQL can express it."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if oracle:
            ORACLE[name] = oracle
        return fn
    return deco


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on."""
    checkpoint_root(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: later
    stages restart from files that every executor sees."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Written tables of one computation, deleted together once its result is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_dir(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        for p in self.paths:
            fs.delete(self.spark, p)
        self.paths = []


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (case-insensitively)."""
    have = {c.lower() for c in df.columns}
    name, n = stem, 0
    while name.lower() in have:
        n += 1
        name = f"{stem}_{n}"
    return name


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named input columns, under the operator's own names; extra
    columns, whatever they are called, never reach the operator."""
    return df.select(*[df[src].alias(dst) for dst, src in cols.items()])


def words(text: Column) -> Column:
    """Words: runs of anything but the ASCII white space 0x20, 0x09-0x0D."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix64's constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """64-bit hashes of the words of a byte string (runs without ASCII white
    space), without a Python step per word: a word is a difference of running
    sums of byte * base^place, shifted back to its own start."""

    BASE = 0x9E3779B97F4A7C15
    PIECE = 1 << 16
    _SPACE = np.array([c in b" \t\n\x0b\x0c\r" for c in range(256)])
    _NEXT = re.compile(rb"[ \t-\r]")

    def __init__(self):
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, self.PIECE)
            place = lambda b: np.cumprod(np.r_[np.uint64(1), np.full(n, b, dtype=np.uint64)], dtype=np.uint64)
            self.up, self.down = place(self.BASE), place(pow(self.BASE, -1, 1 << 64))

    def __call__(self, raw: bytes) -> np.ndarray:
        if len(raw) <= self.PIECE:
            return self._piece(raw)
        out, at = [], 0
        while at < len(raw):            # pieces end at white space
            found = self._NEXT.search(raw, min(at + self.PIECE, len(raw)))
            end = found.start() if found else len(raw)
            out.append(self._piece(raw[at:end]))
            at = end
        return np.concatenate(out)

    def _piece(self, raw: bytes) -> np.ndarray:
        codes = np.frombuffer(raw, dtype=np.uint8)
        self._grow(len(codes) + 1)
        edge = np.diff(np.r_[True, self._SPACE[codes], True].astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * self.up[:len(codes)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))
