"""Table resolver: logical table name -> DataFrame.

Three resolvers share one interface:

* ``ParquetCatalog(root)``: ``{root}/{Table}`` (a Parquet file or folder,
  optionally partitioned, e.g. TestResult by date) -- the default;
* ``JdbcCatalog(url, properties)``: ``spark.read.format("jdbc")`` for a
  database that holds the tables;
* ``BindingCatalog(sf_dir)``: the assessment schema projected from the
  driver's TPC-H-style tables (``sources.binding``).

DataFrames are lazy: each report only builds a plan; Catalyst prunes the
columns and pushes the filters into every scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from . import binding
from .schema import conform
from .splits import equi_depth_bounds, predicates


class Catalog:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        df = self._cache.get(name)
        if df is None:
            df = self._cache[name] = self._load(name)
        return df

    __getitem__ = table

    def _load(self, name: str) -> DataFrame:  # pragma: no cover - abstract
        raise NotImplementedError


class ParquetCatalog(Catalog):
    """``typed=True`` casts the declared columns to their logical types
    (``schema.conform``); off by default since Parquet keeps types."""

    def __init__(self, spark, root: str, suffix: str = "", typed: bool = False):
        super().__init__(spark)
        self.root = root
        self.suffix = suffix
        self.typed = typed

    def _load(self, name):
        df = self.spark.read.parquet(os.path.join(self.root, name + self.suffix))
        return conform(df, name) if self.typed else df


# Facts grow with use; one connection must not read them whole.
FACTS = ("TestResult", "TestResultScore", "TestResultSubScore", "Answer", "QTIOnlineTestSession", "TestResultProgram")

# How a dialect quotes a name (``User`` is a reserved word in most).
_QUOTES = {"sqlserver": ("[", "]"), "mysql": ("`", "`"), "mariadb": ("`", "`")}


class JdbcCatalog(Catalog):
    """Reads each table over JDBC.

    ``partitioning`` maps a table to ``(column, lower, upper,
    num_partitions)``, so that it is read by many tasks instead of one
    connection; it must name every fact that a report reads.  ``names`` maps a
    logical table to its name in the database (``schema.table``); names are
    quoted as the dialect of the URL does.  ``properties`` are reader options
    such as user, password and fetchsize.

    ``partitioning`` may also be ``(column, num_partitions)``: the bounds are
    then quantiles of that column in ``snapshot``, a catalog that holds an
    earlier state of the table, so that dense ranges of keys are cut finer."""

    def __init__(self, spark, url: str, properties: dict | None = None,
                 partitioning: dict | None = None, typed: bool = True, names: dict | None = None, snapshot: Catalog | None = None):
        super().__init__(spark)
        self.url, self.snapshot = url, snapshot
        self.properties = dict(properties or {})
        self.partitioning = dict(partitioning or {})
        self.names = dict(names or {})
        self.typed = typed

    def quoted(self, name: str) -> str:
        return ".".join(self.quoted_column(part) for part in self.names.get(name, name).split("."))

    def quoted_column(self, name: str) -> str:
        parts = self.url.split(":")
        left, right = _QUOTES.get(parts[1] if len(parts) > 1 else "", ('"', '"'))
        return left + name.replace(right, right * 2) + right

    def options(self, name: str) -> dict:
        """The reader options of one table."""
        out = {**self.properties, "url": self.url, "dbtable": self.quoted(name)}
        if name in self.partitioning and len(self.partitioning[name]) == 4:
            col, lo, hi, n = self.partitioning[name]
            out |= {"partitionColumn": col, "lowerBound": lo, "upperBound": hi, "numPartitions": n}
        elif name in FACTS and name not in self.partitioning:
            raise ValueError(f"{name} is a fact table: give its partitioning as (column, lower, upper, partitions)")
        return out

    def splits(self, name: str) -> list[str]:
        """The conditions of a table's splits, from the snapshot."""
        col, n = self.partitioning[name]
        if self.snapshot is None:
            raise ValueError(f"{name} is to be split by quantiles of {col}: give a snapshot")
        return predicates(self.quoted_column(col), equi_depth_bounds(self.snapshot[name], col, n))

    def _load(self, name):
        if name in self.partitioning and len(self.partitioning[name]) == 2:
            options = {k: str(v) for k, v in self.properties.items()}
            df = self.spark.read.jdbc(self.url, self.quoted(name), predicates=self.splits(name), properties=options)
            return conform(df, name) if self.typed else df
        reader = self.spark.read.format("jdbc")
        for k, v in self.options(name).items():
            reader = reader.option(k, v)
        df = reader.load()
        return conform(df, name) if self.typed else df


class BindingCatalog(Catalog):
    def __init__(self, spark, sf_dir: str):
        super().__init__(spark)
        self.sf_dir = sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, table: str) -> DataFrame:
        df = self._raw.get(table)
        if df is None:
            df = self._raw[table] = self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")
        return df

    def _load(self, name):
        return binding.to_dataframe(self.spark, self.raw, name)


class MemoryCatalog(Catalog):
    """Tables given as DataFrames (tests, or tables a caller already has)."""

    def __init__(self, spark, tables: dict[str, DataFrame]):
        super().__init__(spark)
        self._cache.update(tables)

    def _load(self, name):
        raise KeyError(f"table {name!r} not provided")
