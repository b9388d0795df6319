"""Pattern-dictionary and date fixtures (FIXTURES.md B, C)."""

import pytest
from pyspark.sql import functions as F

from scholarweave.functions import patterns as P


def test_expand_literal():
    assert P.expand(".+", {}) == ".+"


def test_expand_one_level():
    assert P.expand("%{TEST1}", {"TEST1": ".*"}) == ".*"


def test_expand_two_levels():
    assert P.expand("%{TEST1}", {"TEST1": "foo %{TEST2}", "TEST2": "bar"}) == "foo bar"


def test_unknown_name():
    with pytest.raises(P.UnknownPatternError) as ei:
        P.expand("%{TEST1}", {})
    assert "'TEST1'" in str(ei.value)


def test_cycle():
    with pytest.raises(Exception) as ei:
        P.expand("%{TEST1}", {"TEST1": "%{TEST2}", "TEST2": "%{TEST1}"})
    assert "'TEST1'" in str(ei.value)


def test_label_renames_or_wraps():
    cp = P.compile_pattern("%{A:x}-%{B:y}", {"A": r"(?P<old>\d+)", "B": r"\w+"})
    assert cp.regex == r"(\d+)-(\w+)"
    assert cp.groups == {"x": [1], "y": [2]}


DATES = [
    ("2009", "2009"), ("SS 2013", None), ("05.09. 2008", "2008"), ("01. 10. 2009", "2009"),
    ("WS 2010/2011", "2011"), ("05.-07.09 2012", "2012"), ("09.-10.09.2010", "2010"),
    ("08.-10.11. 2010", "2010"), ("19.-20. 07.2010", "2010"), ("01.- 03.04. 2009", "2009"),
    ("26. - 28.11. 2012", "2012"), ("28.07.-01.08. 2013", "2013"), ("20. - 22. 10. 2010", "2010"),
    ("29. 07.- 01. 08.2008", "2008"), ("06 - 09. Oktober 2009", "2009"),
]


def test_dates_full_match_and_year(spark):
    dm = P.date_matcher()
    df = spark.createDataFrame([(d,) for d, _ in DATES + [("12. 2012", "2012")]], "s string")
    got = {r["s"]: (r["m"], r["y"]) for r in
           df.select("s", dm.match_text("s").alias("m"), dm.group("s", "year").alias("y")).collect()}
    for d, year in DATES:
        assert got[d] == (d, year), d
    assert got["12. 2012"] == ("2012", "2012")


def test_extract_patterns_columns(spark):
    df = spark.createDataFrame([("held WS 2010/2011 in Kiel",)], "s string")
    r = P.extract_patterns(df, "s", P.DATE_PATTERNS, "DATE").first()
    assert r["date_match"] == "WS 2010/2011" and r["date_year"] == "2011"


def test_unknown_flag_is_refused():
    with pytest.raises(ValueError):
        P.compile_pattern("a", {}, "iq")
