import datetime as dt

from pyspark.sql import functions as F

from scorecast.config import DEFAULT
from scorecast.functions import dates
from scorecast.functions.predicates import ts_between_open

D = dt.date


def _bounds(spark, day, strict=False):
    s, e = dates.week_bounds(F.lit(day), strict)
    r = spark.range(1).select(s.alias("s"), e.alias("e")).first()
    return r["s"], r["e"]


def test_week_by_weekday(spark):
    # Mon, Thu, Fri -> [Jan 12, Jan 19); Sat, Sun -> [Jan 12, Jan 26) (14 days)
    assert _bounds(spark, D(2024, 1, 15)) == (D(2024, 1, 12), D(2024, 1, 19))
    assert _bounds(spark, D(2024, 1, 18)) == (D(2024, 1, 12), D(2024, 1, 19))
    assert _bounds(spark, D(2024, 1, 19)) == (D(2024, 1, 12), D(2024, 1, 19))
    assert _bounds(spark, D(2024, 1, 20)) == (D(2024, 1, 12), D(2024, 1, 26))
    assert _bounds(spark, D(2024, 1, 21)) == (D(2024, 1, 12), D(2024, 1, 26))


def test_strict_week_is_seven_days(spark):
    assert _bounds(spark, D(2024, 1, 20), strict=True) == (D(2024, 1, 19), D(2024, 1, 26))


def test_friday_last_year(spark):
    r = spark.range(1).select(
        dates.friday_last_year(F.lit(D(2024, 2, 23))).alias("a"),
        dates.friday_last_year(F.lit(D(2008, 2, 29))).alias("b")).first()
    assert r["a"] == D(2023, 2, 24)
    assert r["b"] == D(2007, 3, 2)  # no error on a leap day


def test_driver_periods_match_column_periods(spark):
    """report_periods (driver) and period_structs (Spark) agree for every
    day over two years, including year ends and a leap day."""
    days = spark.range(0, 800).select(F.date_add(F.lit(D(2023, 12, 1)), F.col("id").cast("int")).alias("as_of"))
    got = {(r["as_of"], r["period"]): (r["week_start"], r["week_end"])
           for r in dates.with_periods(days, "as_of", DEFAULT).collect()}
    for i in range(800):
        d = D(2023, 12, 1) + dt.timedelta(days=i)
        for label, _, s, e in dates.report_periods(d, DEFAULT):
            assert got[(d, label)] == (s, e), (d, label)


def test_period_table_rows(spark):
    rows = dates.period_table(spark, D(1998, 6, 17)).orderBy("period_ord").collect()
    assert [(r.period, r.week_start, r.week_end) for r in rows] == [
        ("This Week", D(1998, 6, 12), D(1998, 6, 19)),
        ("Last Week", D(1998, 6, 5), D(1998, 6, 12)),
        ("Last Year", D(1997, 6, 13), D(1997, 6, 20)),
    ]


def test_hour_label_and_day_text(spark):
    ts = dates.ts_literal(dt.datetime(2018, 3, 5, 2, 15))
    r = spark.range(1).select(dates.hour_label(ts, -4).alias("h"), dates.day_text(ts).alias("p"),
                              dates.day_text(ts, padded=False).alias("u")).first()
    assert (r.h, r.p, r.u) == ("2018-03-04 22", "03/05/2018", "3/5/2018")


def test_interval_bounds_are_strict(spark):
    start, end = dates.ts_literal(dt.datetime(2018, 3, 2)), dates.ts_literal(dt.datetime(2018, 3, 9))
    vals = [dt.datetime(2018, 3, 2), dt.datetime(2018, 3, 2, 0, 0, 1), dt.datetime(2018, 3, 9)]
    df = spark.createDataFrame([(v.strftime("%Y-%m-%d %H:%M:%S"),) for v in vals], "t string") \
        .select(F.col("t").cast("timestamp_ntz").alias("t"))
    got = [r.ok for r in df.select(ts_between_open("t", start, end).alias("ok")).collect()]
    assert got == [False, True, False]


def test_august_first_last_year(spark):
    r = spark.range(1).select(dates.august_first_last_year(F.lit(D(2018, 3, 5))).alias("d")).first()
    assert r.d == D(2017, 8, 1)
