"""Reader options of the JDBC catalog (no database here: nothing is read)."""

import argparse

import pytest

from scorecast.__main__ import jdbc_catalog
from scorecast.sources.catalog import JdbcCatalog


def test_names_are_quoted_by_dialect():
    for url, want in (("jdbc:sqlserver://h;databaseName=d", "[User]"), ("jdbc:postgresql://h/d", '"User"'), ("jdbc:mysql://h/d", "`User`")):
        assert JdbcCatalog(None, url).options("User")["dbtable"] == want
    cat = JdbcCatalog(None, "jdbc:sqlserver://h", names={"User": "dbo.User"})
    assert cat.options("User")["dbtable"] == "[dbo].[User]"
    assert JdbcCatalog(None, "jdbc:sqlserver://h", names={"User": "a]b"}).quoted("User") == "[a]]b]"


def test_facts_need_bounds():
    cat = JdbcCatalog(None, "jdbc:postgresql://h/d", partitioning={"Answer": ("TestResultID", 1, 10**9, 64)})
    assert cat.options("Answer") == {"url": "jdbc:postgresql://h/d", "dbtable": '"Answer"', "partitionColumn": "TestResultID",
                                     "lowerBound": 1, "upperBound": 10**9, "numPartitions": 64}
    with pytest.raises(ValueError, match="TestResult"):
        cat.options("TestResult")


def test_command_line_options(monkeypatch):
    monkeypatch.setenv("PW", "secret")
    a = argparse.Namespace(jdbc="jdbc:sqlserver://h", jdbc_user="me", jdbc_password_env="PW",
                           jdbc_partition=["TestResult:TestResultID:1:1000:8"], jdbc_name=["User=dbo.User"])
    cat = jdbc_catalog(None, a)
    assert cat.options("TestResult")["numPartitions"] == 8 and cat.options("User")["dbtable"] == "[dbo].[User]"
    assert cat.options("School")["user"] == "me" and cat.options("School")["password"] == "secret"


def test_split_bounds_follow_the_rows(spark, tmp_path):
    """Keys that are dense in one place and one key with a third of the rows."""
    from pyspark.sql import functions as F

    from scorecast.sources.splits import equi_depth_bounds, predicates
    key = F.when(F.col("id") % 3 == 0, F.lit(5_000_000)).when(F.col("id") % 100 == 1, F.lit(None)).otherwise(F.pow(F.col("id") / 1000, F.lit(4.0)))
    spark.range(90_000).select(key.cast("bigint").alias("k")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    bounds = equi_depth_bounds(df, "k", 12)
    where = predicates("k", bounds)
    sizes = [df.where(w).count() for w in where]
    assert bounds == sorted(set(bounds)) and 8 <= len(bounds) <= 11
    assert sum(sizes) == 90_000 and df.where(" OR ".join(f"({w})" for w in where)).count() == 90_000
    alone = df.where("k = 5000000").count()
    assert sorted(sizes)[-1] <= alone * 1.05 and sorted(sizes)[-2] <= 1.3 * 90_000 / 12
    assert equi_depth_bounds(df.limit(0), "k", 5) == [] and predicates("k", []) == ["1 = 1"] and equi_depth_bounds(df, "k", 1) == []
    from scorecast.sources.catalog import MemoryCatalog
    cat = JdbcCatalog(spark, "jdbc:sqlserver://h", partitioning={"Answer": ("k", 12)}, snapshot=MemoryCatalog(spark, {"Answer": df}))
    splits = cat.splits("Answer")              # the sketch may differ a little each time
    assert len(splits) >= 9 and splits[0].startswith("[k] < ") and splits[0].endswith("OR [k] IS NULL") and "numPartitions" not in cat.options("Answer")
    with pytest.raises(ValueError, match="snapshot"):
        JdbcCatalog(spark, "jdbc:sqlserver://h", partitioning={"Answer": ("k", 12)}).splits("Answer")
