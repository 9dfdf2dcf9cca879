"""A key holding a third of all rows is spread over many tasks."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from scorecast.operators.joins import write_back

HOT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return fn()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _hot_frame(spark, n=90_000):
    # key 0 holds a third of the rows; the rest spread over 1000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000).alias("k"),
        F.col("id").cast("double").alias("v"))


def test_write_back_of_a_hot_group(spark):
    """Same rows as a window over the raw frame; the hot group is summed
    before it moves."""
    def run():
        df = _hot_frame(spark).withColumn("c", F.col("v").cast("bigint") % 7)
        out = write_back(df, ["k"], ["c"], {"s": F.col("v"), "n": F.lit(1).cast("bigint")})
        group = Window.partitionBy("k")
        want = df.select("k", "c", F.sum("v").over(group).alias("s"), F.count(F.lit(1)).over(group).alias("n"))
        key = ["k", "c", "s", "n"]
        same = (out.groupBy(*key).count().exceptAll(want.groupBy(*key).count()).isEmpty()
                and out.count() == want.count())
        return same, out._jdf.queryExecution().toString()

    same, text = _with_conf(spark, HOT, run)
    assert same and "rand(" not in text


def test_null_keys_get_null_totals(spark):
    df = spark.createDataFrame([(None, 1, 2.0), (None, 1, 3.0), (1, 1, 4.0)], "k int, c int, v double")
    out = sorted(map(tuple, write_back(df, ["k"], ["c"], {"s": F.col("v")}).collect()), key=str)
    assert out == [(1, 1, 4.0), (None, 1, None), (None, 1, None)]


def test_roster_with_one_shared_code(spark):
    """A third of the students share a placeholder code: their rows are
    spread over the tasks of the join."""
    from scorecast.config import DEFAULT
    from scorecast.plans import status
    from tiny import T, catalog, result
    n = 3000
    students = [(i, "TBD" if i % 3 == 0 else None if i % 3 == 1 else f"S{i}", 8, f"F{i}", None, f"L{i}", 1, 1, 1) for i in range(n)]
    cat = catalog(
        spark, State=[(1, "NJ")], District=[(8, "Plain", 1, 113)], Student=students, Grade=[(1, "5")], Subject=[(1, "Math", 1)],
        Bank=[(1, 1)], VirtualTest=[(10, 1, "LinkIt Math Form A", 0, 3, 1)], School=[(1, "One", 8)],
        DistrictTerm=[(1, 8, "2017-18", 1)], Class=[(1, "Class", 1, 1)], User=[(1, 8, "T1", "N", "L")], ClassUser=[(1, 1, 1)],
        ClassUserLOE=[(1,)], ClassStudent=[(1, i) for i in range(n)],
        TestResult=[result(1, 0, 10, T(2018, 3, 5))], TestResultScore=[(1, 1, 1.0, 2.0, 3.0, 4)])
    for key, yes in (("code", n // 3), ("id", 1)):
        out = _with_conf(spark, HOT, lambda: status.status_matrix(cat, None, "A", DEFAULT, key=key).collect())
        assert len(out) == n and sum(r["Math"] == "Yes" for r in out) == yes


def test_heavy_keys_are_split_at_run_time(spark):
    """A key with a third of the rows, and a null key with a sixth: same rows
    as the plain join, no task with over twice the median."""
    from scorecast.operators.skew import heavy_keys, split_join

    def run():
        n = 120_000
        key = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 6 == 1, F.lit(None)).otherwise(F.col("id"))
        left = spark.range(n).select(key.alias("k"), F.col("id").alias("v"))
        right = spark.range(n).filter("id % 7 != 3").select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        heavy = heavy_keys(left, ["k"], 256)
        out = {}
        for how in ("left", "inner"):
            got, want = split_join(left, right, ["k"], how), left.join(right, ["k"], how)
            same = got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
            tasks = sorted(r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect())
            out[how] = (same, tasks)
        return heavy, out

    heavy, out = _with_conf(spark, HOT, run)
    assert sorted(heavy.values()) == [43, 86]
    for same, tasks in out.values():
        assert same and len(tasks) == 16 and tasks[-1] <= 2 * tasks[8], tasks


def test_no_heavy_key_is_a_plain_join(spark):
    from scorecast.operators.skew import split_join
    left, right = spark.range(100).toDF("k"), spark.range(50).selectExpr("id AS k", "id AS w")
    joined = split_join(left, right, ["k"], parts=10)
    assert joined.count() == 50 and "_seat" not in joined._jdf.queryExecution().toString()
    assert split_join(left.limit(0), right, ["k"], "left").count() == 0
