"""Pattern-dictionary queries on orders and events.

Dates are rendered from ``o_orderdate`` in the notations the date dictionary
knows; the notation follows ``o_orderpriority`` / ``o_orderstatus``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarweave.functions.patterns import compile_pattern, date_matcher, extract_patterns
from scholarweave.plans.registry import query
from scholarweave.session import table

# German month names as the date dictionary spells them.
MONTHS_DE = ["Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August",
             "September", "Oktober", "November", "Dezember"]


def render_date_texts(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    d = F.date_format("o_orderdate", "dd")
    m = F.date_format("o_orderdate", "MM")
    y = F.date_format("o_orderdate", "yyyy")
    y1 = (F.year("o_orderdate") + 1).cast("string")
    d2 = F.lpad(F.least(F.dayofmonth("o_orderdate") + 2, F.lit(28)).cast("string"), 2, "0")
    mname = F.element_at(F.array(*[F.lit(x) for x in MONTHS_DE]), F.month("o_orderdate"))
    pr = F.col("o_orderpriority")
    date = (F.when(pr == "1-URGENT", F.concat(d, F.lit("."), m, F.lit(". "), y))
            .when(pr == "2-HIGH", F.concat(F.lit("WS "), y, F.lit("/"), y1))
            .when(pr == "3-MEDIUM", F.concat(d, F.lit(".-"), d2, F.lit("."), m, F.lit("."), y))
            .when(pr == "4-NOT SPECIFIED", F.concat(d, F.lit(". "), mname, F.lit(" "), y))
            .when(F.col("o_orderstatus") == "F", F.concat(d, F.lit("."), m, F.lit(".-"), d2, F.lit("."), m, F.lit(". "), y))
            .otherwise(F.concat(F.lit("SS "), y)))
    return o.select("o_orderkey", F.concat(F.lit("Vortrag am "), date, F.lit(" in Köln.")).alias("text"))


_SQL_DATES = f"""
WITH o AS (SELECT o_orderkey, o_orderpriority AS pr, o_orderstatus,
                  strftime(o_orderdate, '%d') AS d, strftime(o_orderdate, '%m') AS m, strftime(o_orderdate, '%Y') AS y,
                  CAST(year(o_orderdate) + 1 AS VARCHAR) AS y1,
                  lpad(CAST(least(day(o_orderdate) + 2, 28) AS VARCHAR), 2, '0') AS d2,
                  {[*MONTHS_DE]}[month(o_orderdate)] AS mname FROM orders),
t AS (SELECT o_orderkey, 'Vortrag am ' || CASE
        WHEN pr = '1-URGENT' THEN d || '.' || m || '. ' || y
        WHEN pr = '2-HIGH' THEN 'WS ' || y || '/' || y1
        WHEN pr = '3-MEDIUM' THEN d || '.-' || d2 || '.' || m || '.' || y
        WHEN pr = '4-NOT SPECIFIED' THEN d || '. ' || mname || ' ' || y
        WHEN o_orderstatus = 'F' THEN d || '.' || m || '.-' || d2 || '.' || m || '. ' || y
        ELSE 'SS ' || y END || ' in Köln.' AS text FROM o)"""

_DATE = date_matcher()
_YEAR_SQL = "coalesce(" + ", ".join(
    f"nullif(regexp_extract(text, '{_DATE.regex}', {i}), '')" for i in _DATE.groups["year"]) + ")"


@query("date_year_extract", _SQL_DATES + f"""
SELECT o_orderkey, text, nullif(regexp_extract(text, '{_DATE.regex}', 0), '') AS date_match, {_YEAR_SQL} AS date_year
FROM t""")
def date_year_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Date dictionary expanded once into numbered groups; first match and its year."""
    t = render_date_texts(spark, sf)
    return extract_patterns(t, "text", {"D": "%{DATE}", **_date_dict()}, "D", out_prefix="date") \
        .select("o_orderkey", "text", "date_match", "date_year")


def _date_dict():
    from scholarweave.functions.patterns import DATE_PATTERNS
    return DATE_PATTERNS


_ANCHORED = date_matcher(prefix=r"am\s+", suffix=r"\s+in", flags="i")


@query("date_match_text", _SQL_DATES + f"""
SELECT o_orderkey, regexp_extract(text, '{_ANCHORED.regex}', 0) AS matched_text FROM t""")
def date_match_text(spark: SparkSession, sf: str) -> DataFrame:
    """``DateMatcher(prefix, suffix, flags)``: searched, not anchored; prefix/suffix in the match."""
    t = render_date_texts(spark, sf)
    return t.select("o_orderkey", _ANCHORED.match_text("text").alias("matched_text"))


# A user dictionary for event lines (nested and named references).
EVENT_PATTERNS = {
    "WORD": r"[a-z]+",
    "INT": r"\d+",
    "USER": r"user=%{INT:user}",
    "EVENT": r"%{WORD:etype} %{USER} k=%{INT:k}",
}
_EVENT = compile_pattern("%{EVENT}", EVENT_PATTERNS)


@query("pattern_dictionary", f"""
WITH t AS (SELECT event_id, event_type || ' user=' || CAST(user_id AS VARCHAR) || ' k=' || (props->>'$.k') AS line
           FROM events)
SELECT event_id, line,
       nullif(regexp_extract(line, '{_EVENT.regex}', 0), '') AS event_match,
       nullif(regexp_extract(line, '{_EVENT.regex}', {_EVENT.groups['etype'][0]}), '') AS event_etype,
       nullif(regexp_extract(line, '{_EVENT.regex}', {_EVENT.groups['user'][0]}), '') AS event_user,
       nullif(regexp_extract(line, '{_EVENT.regex}', {_EVENT.groups['k'][0]}), '') AS event_k
FROM t""")
def pattern_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """A user dictionary with nested references, expanded on the driver, matched in Catalyst."""
    e = table(spark, sf, "events")
    line = F.concat(F.col("event_type"), F.lit(" user="), F.col("user_id").cast("string"),
                    F.lit(" k="), F.get_json_object("props", "$.k"))
    t = e.select("event_id", line.alias("line"))
    return extract_patterns(t, "line", EVENT_PATTERNS, "EVENT")
