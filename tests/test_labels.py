import datetime as dt

from pyspark.sql import functions as F

from scorecast.config import DEFAULT
from scorecast.functions import labels
from scorecast.functions.predicates import include_exclude, not_in


def _one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_form_letter(spark):
    names = ["LinkIt ELA Form A 5", "linkit form B", "LinkIt Form"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    rows = df.select(labels.form_letter("n", True).alias("g"), labels.form_letter("n", False).alias("u")).collect()
    assert [r.g for r in rows] == ["A", " ", ""]
    assert [r.u for r in rows] == ["A", "i", ""]


def test_year_slice_and_nav_grade(spark):
    assert _one(spark, labels.year_slice(F.lit("2016-2017 PARCC ELA"))) == "2017"
    df = spark.createDataFrame([("PARCC Alg II",), ("PARCC Geo",), ("PARCC Alg I",), ("PARCC ELA",)], "n string")
    got = [r.g for r in df.select(labels.nav_grade("n", F.lit("7")).alias("g")).collect()]
    assert got == ["11", "10", "9", "7"]


def test_subject_recode(spark):
    assert _one(spark, labels.recode_values(F.lit("Language Arts"), DEFAULT.subject_recodes)) == "ELA"
    assert _one(spark, labels.recode_values(F.lit("Math"), DEFAULT.subject_recodes)) == "Math"


def test_school_year_rules(spark):
    cases = [
        ("FY18", dt.datetime(2015, 1, 1), "2017-18"),
        ("2015-16", dt.datetime(2015, 1, 1), "2016-17"),
        ("Fall", dt.datetime(2017, 8, 15), "2017-18"),
        ("Fall", dt.datetime(2017, 7, 30), "2016-17"),
        ("Fall", dt.datetime(2017, 7, 30, 9), "2017-18"),
        ("Fall", dt.datetime(2016, 7, 1), "Fall"),
        (None, dt.datetime(2017, 8, 15), "2017-18"),
    ]
    df = spark.createDataFrame([(t, d.strftime("%Y-%m-%d %H:%M:%S")) for t, d, _ in cases], "t string, d string")
    df = df.select("t", F.col("d").cast("timestamp_ntz").alias("d"))
    got = [r.y for r in df.select(labels.school_year("t", "d", DEFAULT).alias("y")).collect()]
    assert got == [c[2] for c in cases]


def test_strip_crlf(spark):
    assert _one(spark, labels.strip_crlf(F.lit("a\nb\rc"))) == "abc"


def test_patterns_null_and_case(spark):
    df = spark.createDataFrame([("LinkIt Math Form A",), ("linkit form b CR",), (None,)], "n string")
    got = [r.ok for r in df.select(
        include_exclude("n", DEFAULT.standards_include, DEFAULT.standards_exclude).alias("ok")).collect()]
    assert got == [True, False, None]   # NULL name is neither kept nor excluded -> dropped by a filter


def test_not_in_drops_null(spark):
    df = spark.createDataFrame([(None,), (112,), (5,)], "g int")
    assert [r.g for r in df.where(not_in("g", (112, 114))).collect()] == [5]
