"""Name fixtures (FIXTURES.md A) as DataFrame tests."""

import pytest
from pyspark.sql import functions as F

from scholarweave.functions import names as N


def _one(spark, col_expr, value):
    return spark.createDataFrame([(value,)], "s string").select(col_expr.alias("r")).first()["r"]


@pytest.mark.parametrize("order,sep,value,expected", [
    (N.FIRST_LAST, " ", "John Snow", ("John", "Snow")),
    (N.FIRST_LAST, ",", "John,Snow", ("John", "Snow")),
    (N.LAST_FIRST, ",", "Snow, John", ("John", "Snow")),
    (N.LAST_FIRST, ",", "\t Snow,  \t  John ", ("John", "Snow")),
    (N.FIRST_LAST, " ", "Madonna", ("", "Madonna")),
    (N.LAST_FIRST, " ", "Madonna", ("Madonna", "")),
    (N.LAST_FIRST, ",", "Snow, Jr., John", ("John", "Snow  Jr.")),
    (N.FIRST_LAST, " ", "", ("", "")),
])
def test_split_name(spark, order, sep, value, expected):
    r = _one(spark, N.split_name(F.col("s"), order, sep), value)
    assert (r["firstname"], r["lastname"]) == expected


@pytest.mark.parametrize("list_sep,value", [
    (r";\s*", "Snow, John; Tarly, Samwell"),
    (";", "Snow, John;; Tarly, Samwell"),
    (";", "Snow, John; ; Tarly, Samwell"),
])
def test_name_collection(spark, list_sep, value):
    r = _one(spark, N.names_to_lists(N.split_names(F.col("s"), N.LAST_FIRST, ",", list_sep)), value)
    assert [list(x) for x in r] == [["John", "Snow"], ["Samwell", "Tarly"]]


@pytest.mark.parametrize("f1,l1,f2,l2,expected", [
    ("John", "Snow", "J.", "Snow", True),
    ("John", "Snow", "P.", "Snow", False),
    ("", "Snow", "Peter", "Snow", True),
    ("Jö", "Snow", "Jürgen", "Snow", False),
    ("John", "Snow", "John", "Stark", False),
])
def test_equivalence_both_orders(spark, f1, l1, f2, l2, expected):
    df = spark.createDataFrame([(f1, l1, f2, l2)], "f1 string, l1 string, f2 string, l2 string")
    a = F.struct(F.col("f1").alias("firstname"), F.col("l1").alias("lastname"))
    b = F.struct(F.col("f2").alias("firstname"), F.col("l2").alias("lastname"))
    r = df.select(N.names_equivalent(a, b).alias("ab"), N.names_equivalent(b, a).alias("ba")).first()
    assert r["ab"] is expected and r["ba"] is expected


def test_link_authors_greedy(spark):
    """Greedy one-to-one, first equivalent wins, duplicates and empty firstname."""
    df = spark.createDataFrame(
        [("Snow, John & Snow, J. & Tarly, Samwell & Stark,",
          [("John Snow, Dr.", "u1"), ("J Snow", "u2"), ("Jon Snow", "u3"), ("Arya Stark", "u4")])],
        "authors string, links array<struct<name:string,url:string>>")
    names = N.split_names(F.col("authors"), N.LAST_FIRST, ",", r"&")
    r = df.select(N.link_authors(names, F.col("links")).alias("r")).first()["r"]
    # "John Snow" takes the first Snow; "J Snow" the second; "Jon Snow" finds none left;
    # "Arya Stark" matches the empty firstname.
    assert r["author_urls"] == ["u1", "u2", "u4"]
    assert [tuple(x) for x in r["author_names"]] == [("Samwell", "Tarly")]


def test_academic_title(spark):
    r = _one(spark, N.split_academic_title(F.col("s")), "Prof. Dr. Maria Muster")
    assert r["title"] == "Prof. Dr." and r["name"] == "Maria Muster"
    r = _one(spark, N.split_academic_title(F.col("s")), "Maria Muster")
    assert r["title"] == "" and r["name"] == "Maria Muster"


def test_name_title(spark):
    r = _one(spark, N.split_name_title(F.col("s")), "Jane Doe, PhD")
    assert (r["name"], r["title"], r["malformed"]) == ("Jane Doe", "PhD", False)
