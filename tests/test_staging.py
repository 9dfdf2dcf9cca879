"""The daily store: batches, late rows, replays and stops; weeks at their edges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from scorecast.config import DEFAULT
from scorecast.functions.dates import period_table
from scorecast.plans import staging, usage
from scorecast.registry import CFG, _cat
from scorecast.sources.binding import ORDERS_AS_OF
from conftest import SF_SMALL
from tiny import T, catalog, result

AS_OF = dt.date(2018, 3, 7)


def tiny_catalog(spark, results):
    return catalog(spark, State=[(1, "NJ"), (2, "PA")], District=[(8, "Plain", 1, 113), (9, "Other", 2, 113), (10, "Demo One", 1, 113)],
                   Student=[(i, f"S{i}", d, "F", None, "L", 1, 1, 1) for i, d in ((1, 8), (2, 9), (3, 10))],
                   VirtualTest=[(10, 1, "LinkIt Math Form A", 0, 3, 1)], TestResult=results)


def store_of(spark, tmp_path, stretch="month"):
    return staging.DailyStore(spark, str(tmp_path / "daily"), stretch)


def same(spark, store, cat, as_of, cfg):
    got = [tuple(r) for r in staging.clients_of_week(store, as_of, cfg).collect()]
    want = [tuple(r) for r in usage.results_by_client(cat, as_of, cfg).select("period", "State", "District", *usage.CLIENT_MEASURES, "share").collect()]
    assert sorted(got) == sorted(want) and got


def edge_results():
    weeks = [T(2018, 3, d, h) for d in range(1, 12) for h in (0, 1, 23)] + [T(2017, 3, d, h) for d in range(1, 12) for h in (0, 12)]
    return [result(i, 1 + i % 3, 10, t) for i, t in enumerate(weeks)]


def test_midnight_rows_at_both_ends(spark, tmp_path):
    cat = tiny_catalog(spark, edge_results())
    store = store_of(spark, tmp_path)
    store.apply("all", staging.daily_partials(cat, DEFAULT))
    for day in range(1, 12):
        same(spark, store, cat, dt.date(2018, 3, day), DEFAULT)


def test_batches_late_rows_and_replays(spark, tmp_path):
    cat, store = _cat(spark, SF_SMALL), store_of(spark, tmp_path)
    tr = cat["TestResult"].withColumn("_part", F.pmod(F.xxhash64("TestResultID"), F.lit(4)))
    for n in range(4):
        rows = tr.where(F.col("_part") == n)
        touched = store.apply(f"b{n}", staging.daily_partials(cat, CFG, rows))
        assert touched and store.apply(f"b{n}", staging.daily_partials(cat, CFG, rows)) == []        # a replay counts once
    same(spark, store, cat, ORDERS_AS_OF, CFG)
    # a late row touches its own month only
    before = {r["stretch"]: r["folder"] for r in store._state()[0].collect()}
    month = sorted(before)[len(before) // 2]
    late = cat["TestResult"].where(F.to_date(F.date_trunc("month", "UpdatedDate")) == F.lit(month)).limit(20)
    assert store.apply("late", staging.daily_partials(cat, CFG, late)) == [month]
    after = {r["stretch"]: r["folder"] for r in store._state()[0].collect()}
    assert {d for d in after if after[d] != before.get(d)} == {month}


def test_rows_that_change_and_go(spark, tmp_path):
    rows = edge_results()
    cat, store = tiny_catalog(spark, rows), store_of(spark, tmp_path)
    store.apply("all", staging.daily_partials(cat, DEFAULT))
    moved = [result(5, 1 + 5 % 3, 10, T(2018, 3, 6, 5))]
    old, new = tiny_catalog(spark, [rows[5], rows[6], rows[7], rows[8]]), tiny_catalog(spark, moved)
    store.apply("change", staging.daily_partials(old, DEFAULT, sign=-1), staging.daily_partials(new, DEFAULT))
    cat = tiny_catalog(spark, [r for i, r in enumerate(rows) if i not in (5, 6, 7, 8)] + moved)
    same(spark, store, cat, AS_OF, DEFAULT)
    assert not [r for r in store.days().collect() if r["TotalResults"] == 0]


def test_only_the_days_asked_for_are_read(spark, tmp_path):
    cat = tiny_catalog(spark, edge_results())
    for stretch, most in (("month", 2), ("day", 22)):
        store = store_of(spark, tmp_path / stretch, stretch)
        store.apply("all", staging.daily_partials(cat, DEFAULT))
        one = store.days(dt.date(2018, 3, 5), dt.date(2018, 3, 5))
        assert len(one.inputFiles()) == 1 and len(store.days().inputFiles()) == most
        assert {r["day"] for r in one.collect()} == {dt.date(2018, 3, 5)}
        same(spark, store, cat, AS_OF, DEFAULT)


def test_a_batch_that_stops_changes_nothing(spark, tmp_path, monkeypatch):
    cat, store = tiny_catalog(spark, edge_results()), store_of(spark, tmp_path)
    store.apply("all", staging.daily_partials(cat, DEFAULT))
    want = sorted(map(tuple, store.days().collect()))

    def stop(*a, **k):
        raise KeyboardInterrupt
    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(staging, "publish", stop)
        store.apply("more", staging.daily_partials(cat, DEFAULT))
    assert sorted(map(tuple, store.days().collect())) == want
    bad = staging.daily_partials(cat, DEFAULT).withColumn("TotalResults", F.expr("raise_error('no')").cast("long"))
    with pytest.raises(Exception):
        store.apply("bad", bad)
    assert sorted(map(tuple, store.days().collect())) == want
    assert store.apply("more", staging.daily_partials(cat, DEFAULT))                   # and can be given again


def test_windows_by_two_lookups(spark):
    cat = tiny_catalog(spark, edge_results())
    days = staging.daily_partials(cat, DEFAULT)
    windows = [(dt.date(2018, 3, a), dt.date(2018, 3, b)) for a in range(1, 12) for b in range(a + 1, 13)] + [(dt.date(2016, 1, 1), dt.date(2019, 1, 1)), (dt.date(2030, 1, 1), dt.date(2030, 1, 8))]
    frame = spark.createDataFrame([(i, *w) for i, w in enumerate(windows)], "i int, week_start date, week_end date")
    got = {r["i"]: r["TotalResults"] for r in staging.window_totals(days, frame, ["i"]).collect()}
    rows = [r for r in edge_results() if r[2] != 3 and 1 + r[0] % 3 != 3]
    dates = [next(x for x in r if isinstance(x, dt.datetime)) for r in rows]
    at = dt.datetime.combine
    assert got == {i: sum(at(a, dt.time()) < d < at(b, dt.time()) for d in dates) for i, (a, b) in enumerate(windows)}
    assert staging.window_totals(days, frame.limit(0), ["i"]).count() == 0
    assert period_table(spark, AS_OF, DEFAULT).count() == 3
