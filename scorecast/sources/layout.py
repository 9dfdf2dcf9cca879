"""Co-located storage layout for the fact tables.

Scores, answers and result programs are all joined to their result on
``TestResultID``.  Written as tables bucketed (and sorted) by that key with
the same bucket count, those joins run as sort-merge joins with no shuffle
on either side: each task joins one bucket of every table.  At 100 TB, size
the bucket count so one bucket of the largest fact (the answers) is a few
hundred MB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .catalog import Catalog

FACT_BUCKET_KEYS = {
    "TestResult": "TestResultID",
    "TestResultScore": "TestResultID",
    "Answer": "TestResultID",
    "TestResultProgram": "TestResultID",
}


def write_bucketed(cat: Catalog, database: str, num_buckets: int, tables: dict | None = None,
                   mode: str = "overwrite") -> list[str]:
    """Save the fact tables of ``cat`` as bucketed tables in ``database``."""
    spark = cat.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    names = []
    for name, key in (tables or FACT_BUCKET_KEYS).items():
        (cat[name].write.mode(mode).bucketBy(num_buckets, key).sortBy(key)
         .format("parquet").saveAsTable(f"`{database}`.`{name}`"))
        names.append(name)
    return names


class TableCatalog(Catalog):
    """Tables registered in the session catalog (metastore) under one
    database; names not found there come from ``fallback``."""

    def __init__(self, spark: SparkSession, database: str, fallback: Catalog | None = None):
        super().__init__(spark)
        self.database = database
        self.fallback = fallback

    def _load(self, name) -> DataFrame:
        if self.spark.catalog.tableExists(f"{self.database}.{name}"):
            return self.spark.table(f"`{self.database}`.`{name}`")
        if self.fallback is None:
            raise KeyError(f"table {name!r} not in database {self.database!r}")
        return self.fallback.table(name)
