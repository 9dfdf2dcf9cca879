"""Property tests: the Spark expressions against a plain-Python statement
of the same rules, on generated inputs (one Spark job per batch)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scorecast.config import DEFAULT
from scorecast.functions import labels

ALPHABET = st.sampled_from(list("FormfrmLinkIt AB-C18 6"))
NAMES = st.lists(st.text(alphabet=ALPHABET, max_size=14), min_size=1, max_size=40)


def py_form(name, guarded):
    i = name.find("Form")
    if guarded and i < 0:
        return " "
    j = i + 5
    return name[j] if 0 <= j < len(name) else ""


@settings(max_examples=15, deadline=None)
@given(NAMES)
def test_form_letter_property(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    rows = df.select("n", labels.form_letter("n", True).alias("g"), labels.form_letter("n", False).alias("u")).collect()
    for r in rows:
        assert r.g == py_form(r.n, True)
        assert r.u == py_form(r.n, False)


def py_school_year(term, when):
    for needle, label in DEFAULT.term_contains_rules:
        if term is not None and needle in term:
            return label
    for bound, label in DEFAULT.term_date_rules:
        if when > bound:
            return label
    return term


TERMS = st.one_of(st.none(), st.text(alphabet=st.sampled_from(list("0123456789-FY ")), max_size=8))
WHENS = st.datetimes(min_value=dt.datetime(2015, 1, 1), max_value=dt.datetime(2019, 1, 1))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(TERMS, WHENS), min_size=1, max_size=40))
def test_school_year_property(spark, rows):
    df = spark.createDataFrame([(t, w.strftime("%Y-%m-%d %H:%M:%S")) for t, w in rows], "t string, w string")
    df = df.select("t", "w", F.col("w").cast("timestamp_ntz").alias("ts"))
    got = df.select("t", "w", labels.school_year("t", "ts").alias("y")).collect()
    for r in got:
        assert r.y == py_school_year(r.t, dt.datetime.strptime(r.w, "%Y-%m-%d %H:%M:%S"))
