"""Named datasets: name -> (format, path, options, partition columns).

Stands in for the catalogs of the reference jobs (warehouse, JDBC store,
serving store): a job refers to tables by name, the registry knows where
and how they are stored, and ``view`` exposes one to ``spark.sql``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@dataclass
class Dataset:
    name: str
    path: str
    fmt: str = "parquet"
    options: dict = field(default_factory=dict)
    partition_cols: tuple = ()
    keys: tuple = ()
    schema: StructType | None = None


class Registry:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._ds: dict[str, Dataset] = {}
        self.database = "default"

    def use(self, database: str) -> None:
        """The database that plain table names belong to from now on."""
        self.database = database

    def _full(self, name: str) -> str:
        return name if "." in name else f"{self.database}.{name}"

    def add(self, ds: Dataset) -> Dataset:
        self._ds[self._full(ds.name)] = ds
        return ds

    def get(self, name: str) -> Dataset:
        full = self._full(name)
        if full not in self._ds:
            raise KeyError(f"no dataset {full}")
        return self._ds[full]

    def read(self, name: str) -> DataFrame:
        ds = self.get(name)
        r = self.spark.read.format(ds.fmt).options(**ds.options)
        if ds.schema is not None:
            r = r.schema(ds.schema)
        return r.load(ds.path)

    def view(self, name: str, alias: str | None = None) -> DataFrame:
        df = self.read(name)
        df.createOrReplaceTempView(alias or name.rpartition(".")[2])
        return df

    def schema(self, name: str) -> StructType:
        """Schema introspection of a registered table (cast target of P11)."""
        ds = self.get(name)
        return ds.schema if ds.schema is not None else self.read(name).schema
