"""Name queries on part / lineitem.

Author lists are rendered from one ``part`` row each (one to nine names, repeats
among them, by the part's size), never by grouping rows: no group of a hot key is
ever gathered into one array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarweave.functions import names as N
from scholarweave.operators.name_join import join_equivalent_names
from scholarweave.plans.registry import query
from scholarweave.session import spread, table


def _line_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Every part with its name words, lower-cased type and brand tag."""
    p = spread(table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size"))
    w = F.split("p_name", " ")
    return p.select("p_partkey", "p_size", F.get(w, 0).alias("w1"), F.get(w, 1).alias("w2"),
                    F.lower("p_type").alias("ty"),
                    F.lower(F.replace(F.col("p_brand"), F.lit("#"), F.lit(""))).alias("br"))


def _people() -> F.Column:
    """Ordered list of 1 to 9 names (struct firstname, lastname) of a row of ``_line_parts``, some of them repeated."""
    first, last = F.array("w1", "w2", "ty"), F.array("w2", "w1")
    return F.transform(
        F.sequence(F.lit(1), F.col("p_size").cast("int") % 9 + 1),
        lambda i: N.make_name(F.get(first, ((i + i * i % 5 + F.col("p_partkey")) % 3).cast("int")),
                              F.get(last, ((i + F.col("p_size")) % 2).cast("int"))))


_SQL_LINE_PARTS = """lw AS (SELECT p_partkey, p_size, split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2,
       lower(p_type) AS ty, lower(replace(p_brand, '#', '')) AS br FROM part),
lp AS (SELECT *, list_transform(range(1, p_size % 9 + 2), lambda i:
       {'f': [w1, w2, ty][CAST((i + i * i % 5 + p_partkey) % 3 + 1 AS BIGINT)],
        'l': [w2, w1][CAST((i + p_size) % 2 + 1 AS BIGINT)]}) AS people FROM lw)"""

_FL = "string_split(p_name, ' ')"
_SQL_FIRST = f"trim(array_to_string({_FL}[1:len({_FL})-1], ' '))"
_SQL_LAST = f"trim({_FL}[-1])"


@query("name_split_first_last", f"""
SELECT p_partkey, {_SQL_FIRST} AS firstname, {_SQL_LAST} AS lastname FROM part""")
def name_split_first_last(spark: SparkSession, sf: str) -> DataFrame:
    """``first last`` split on one space, parts stripped."""
    p = table(spark, sf, "part")
    nm = N.split_name(F.col("p_name"), N.FIRST_LAST, " ")
    return p.select("p_partkey", nm["firstname"].alias("firstname"), nm["lastname"].alias("lastname"))


@query("name_split_last_first", """
WITH t AS (SELECT p_partkey, split_part(p_name, ' ', 2) || ',  ' || split_part(p_name, ' ', 1) AS s FROM part)
SELECT p_partkey, s, trim(string_split(s, ',')[-1]) AS firstname,
       trim(array_to_string(string_split(s, ',')[1:len(string_split(s, ','))-1], ' ')) AS lastname FROM t""")
def name_split_last_first(spark: SparkSession, sf: str) -> DataFrame:
    """``last,  first`` split on a comma."""
    p = table(spark, sf, "part")
    parts = F.split("p_name", " ")
    s = F.concat(F.get(parts, 1), F.lit(",  "), F.get(parts, 0))
    nm = N.split_name(s, N.LAST_FIRST, ",")
    return p.select("p_partkey", s.alias("s"), nm["firstname"].alias("firstname"),
                    nm["lastname"].alias("lastname"))


def _author_string() -> F.Column:
    """``Last, First; Last, First; `` of the row's names, with a doubled separator for even part sizes."""
    sep = F.when(F.col("p_size") % 2 == 0, F.lit(";; ")).otherwise(F.lit("; "))
    labels = F.transform(_people(), lambda n, i: F.concat(F.when(i > 0, sep).otherwise(F.lit("")), N.name_label(n)))
    return F.concat(F.array_join(labels, ""), F.lit("; "))


_SQL_NAMES = """
n AS (SELECT p_partkey, authors,
             list_transform(list_filter(list_transform(string_split_regex(authors, ';'), lambda x: trim(x)), lambda x: x <> ''),
                            lambda x: [trim(string_split(x, ',')[-1]),
                                       trim(array_to_string(string_split(x, ',')[1:len(string_split(x, ','))-1], ' '))]) AS names
      FROM (SELECT *, CASE WHEN p_size % 2 = 0
                      THEN array_to_string(list_transform(people, lambda x: x.l || ', ' || x.f), ';; ')
                      ELSE array_to_string(list_transform(people, lambda x: x.l || ', ' || x.f), '; ') END || '; ' AS authors
            FROM lp))"""


@query("name_collection", "WITH " + _SQL_LINE_PARTS + "," + _SQL_NAMES + """
SELECT p_partkey, authors, CAST(len(names) AS INTEGER) AS n_names,
       to_json(names)::VARCHAR AS names_json FROM n""")
def name_collection(spark: SparkSession, sf: str) -> DataFrame:
    """Regex list split, strip, skip blanks, ``Last, First`` each; as ``[[first,last],..]``."""
    a = _line_parts(spark, sf).withColumn("authors", _author_string())
    names = N.split_names(F.col("authors"), N.LAST_FIRST, ",", ";")
    return a.select("p_partkey", "authors", F.size(names).alias("n_names"),
                    F.to_json(N.names_to_lists(names)).alias("names_json"))


@query("author_names_json", "WITH " + _SQL_LINE_PARTS + """
SELECT p_partkey,
       to_json(list_transform(people, lambda x: [x.f, x.l]))::VARCHAR AS author_names,
       to_json(list_transform(people, lambda x, i: 'http://parts.example.org/' || CAST(p_partkey AS VARCHAR) || '/' ||
                                                   CAST(i AS VARCHAR) || '/' || br))::VARCHAR AS author_urls,
       array_to_string(list_transform(people, lambda x: x.l || ', ' || x.f), '; ') AS labels
FROM lp""")
def author_names_json(spark: SparkSession, sf: str) -> DataFrame:
    """An ordered author list and its URL list serialised as JSON, plus ``Last, First`` labels."""
    lp = _line_parts(spark, sf).withColumn("people", _people())
    urls = F.transform("people", lambda _, i: F.concat(
        F.lit("http://parts.example.org/"), F.col("p_partkey").cast("string"), F.lit("/"),
        (i + 1).cast("string"), F.lit("/"), F.col("br")))
    return lp.select("p_partkey",
                     F.to_json(N.names_to_lists(F.col("people"))).alias("author_names"),
                     F.to_json(urls).alias("author_urls"),
                     F.array_join(F.transform("people", N.name_label), "; ").alias("labels"))


@query("name_equivalence_join", """
WITH l AS (SELECT p_partkey, split_part(p_name, ' ', 1) AS f, split_part(p_name, ' ', 2) AS la FROM part),
r AS (SELECT DISTINCT substr(split_part(p_name, ' ', 1), 1, 1) || '.' AS f, split_part(p_name, ' ', 2) AS la FROM part),
c AS (SELECT l.p_partkey, r.f AS r_firstname, r.la AS r_lastname,
             regexp_replace(l.f, '[^\\p{L}\\p{N}_]', '', 'g') AS a, regexp_replace(r.f, '[^\\p{L}\\p{N}_]', '', 'g') AS b,
             l.f AS lf FROM l JOIN r ON l.la = r.la)
SELECT p_partkey, r_firstname, r_lastname FROM c
WHERE lf = r_firstname OR (CASE WHEN length(a) > length(b) THEN starts_with(a, b) ELSE starts_with(b, a) END)""")
def name_equivalence_join(spark: SparkSession, sf: str) -> DataFrame:
    """Every part name against the distinct initial forms ``s. ring``: equi on lastname + prefix."""
    p = table(spark, sf, "part")
    left = p.select("p_partkey", N.split_name(F.col("p_name"), N.FIRST_LAST).alias("name"))
    nm = N.split_name(F.col("p_name"), N.FIRST_LAST)
    right = (p.select(F.struct(F.concat(F.substring(nm["firstname"], 1, 1), F.lit(".")).alias("firstname"),
                               nm["lastname"].alias("lastname")).alias("r_name"))
              .distinct())
    j = join_equivalent_names(left, right, "name", "r_name")
    return j.select("p_partkey", F.col("r_name.firstname").alias("r_firstname"),
                    F.col("r_name.lastname").alias("r_lastname"))


@query("name_labels", """
SELECT p_partkey, split_part(p_name, ' ', 2) || ', ' || split_part(p_name, ' ', 1) AS label,
       count(*) OVER (PARTITION BY split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)) AS same_name_count
FROM part""")
def name_labels(spark: SparkSession, sf: str) -> DataFrame:
    """``Last, First`` label and how many parts carry an equal name.

    Equality is counted with a pre-aggregated group join, not a self-join, so
    a popular name never produces all pairs.
    """
    p = table(spark, sf, "part").select("p_partkey", N.split_name(F.col("p_name"), N.FIRST_LAST).alias("n"))
    counts = p.groupBy("n").agg(F.count(F.lit(1)).alias("same_name_count"))
    return (p.join(counts, "n").select("p_partkey", N.name_label("n").alias("label"), "same_name_count"))


def _link_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Per part: its author names and one to seven person-page links ``"F. Last, Dr."``.

    An initial can fit several authors (greedy takes the first); every third link names nobody on the list.
    """
    lp = _line_parts(spark, sf).withColumn("people", _people())
    authors = F.array_join(F.transform("people", N.name_label), " & ")

    def link(j):
        n = F.get("people", ((2 * j + F.col("p_size")) % F.size("people")).cast("int"))
        name = F.when(j % 3 == 0, F.concat(F.col("w1"), F.lit(" Nobody"))).otherwise(
            F.concat(F.substring(n["firstname"], 1, 1), F.lit(". "), n["lastname"], F.lit(", Dr.")))
        url = F.concat(F.lit("http://parts.example.org/"), F.col("p_partkey").cast("string"), F.lit("/"),
                       j.cast("string"))
        return F.struct(name.alias("name"), url.alias("url"))

    links = F.transform(F.sequence(F.lit(1), (F.col("p_partkey") % 7 + 1).cast("int")), link)
    return lp.select("p_partkey", authors.alias("authors"), links.alias("links"))


@query("author_link_greedy", "WITH RECURSIVE " + _SQL_LINE_PARTS + """,
t AS (SELECT p_partkey, people, list_transform(range(1, p_partkey % 7 + 2), lambda j: CASE WHEN j % 3 = 0
             THEN {'f': w1, 'l': 'Nobody', 'u': 'http://parts.example.org/' || CAST(p_partkey AS VARCHAR) || '/' || CAST(j AS VARCHAR)}
             ELSE {'f': substr(people[CAST((2 * j + p_size) % len(people) + 1 AS BIGINT)].f, 1, 1) || '.',
                   'l': people[CAST((2 * j + p_size) % len(people) + 1 AS BIGINT)].l,
                   'u': 'http://parts.example.org/' || CAST(p_partkey AS VARCHAR) || '/' || CAST(j AS VARCHAR)} END) AS links
      FROM lp),
g(p_partkey, j, rest, hit) AS (
  SELECT p_partkey, 0, people, CAST([] AS VARCHAR[]) FROM t
  UNION ALL
  SELECT p_partkey, j + 1, CASE WHEN pos > 0 THEN list_concat(rest[:pos - 1], rest[pos + 1:]) ELSE rest END,
         CASE WHEN pos > 0 THEN list_append(hit, k.u) ELSE hit END
  FROM (SELECT g.*, t.links[j + 1] AS k,
               coalesce(list_position(list_transform(rest, lambda x: x.l = t.links[j + 1].l AND
                 (starts_with(regexp_replace(x.f, '[^\\p{L}\\p{N}_]', '', 'g'),
                              regexp_replace(t.links[j + 1].f, '[^\\p{L}\\p{N}_]', '', 'g')) OR
                  starts_with(regexp_replace(t.links[j + 1].f, '[^\\p{L}\\p{N}_]', '', 'g'),
                              regexp_replace(x.f, '[^\\p{L}\\p{N}_]', '', 'g')))), true), 0) AS pos
        FROM g JOIN t USING (p_partkey) WHERE j < len(t.links)))
SELECT g.p_partkey, to_json(hit)::VARCHAR AS author_urls,
       to_json(list_transform(rest, lambda x: [x.f, x.l]))::VARCHAR AS author_names
FROM g JOIN t ON g.p_partkey = t.p_partkey AND g.j = len(t.links)""")
def author_link_greedy(spark: SparkSession, sf: str) -> DataFrame:
    """Greedy one-to-one linking of author names to person links, per publication.

    Sequential by nature, so it runs as one ``aggregate`` fold inside each row; the oracle does a
    recursion step per link.
    """
    g = _link_lists(spark, sf)
    names = N.split_names(F.col("authors"), N.LAST_FIRST, ",", "&")
    linked = N.link_authors(names, F.col("links"))
    return g.select("p_partkey", F.to_json(linked["author_urls"]).alias("author_urls"),
                    F.to_json(N.names_to_lists(linked["author_names"])).alias("author_names"))


@query("names_without_person", """
WITH l AS (SELECT p_partkey, split_part(p_name, ' ', 1) AS f, split_part(p_name, ' ', 2) AS la FROM part),
r AS (SELECT DISTINCT substr(split_part(p_name, ' ', 1), 1, 1) || '.' AS f, split_part(p_name, ' ', 2) AS la
      FROM part WHERE p_size > 45)
SELECT p_partkey, f AS firstname, la AS lastname FROM l
WHERE NOT EXISTS (
  SELECT 1 FROM r WHERE r.la = l.la AND (r.f = l.f OR (CASE
    WHEN length(regexp_replace(l.f, '[^\\p{L}\\p{N}_]', '', 'g')) > length(regexp_replace(r.f, '[^\\p{L}\\p{N}_]', '', 'g'))
    THEN starts_with(regexp_replace(l.f, '[^\\p{L}\\p{N}_]', '', 'g'), regexp_replace(r.f, '[^\\p{L}\\p{N}_]', '', 'g'))
    ELSE starts_with(regexp_replace(r.f, '[^\\p{L}\\p{N}_]', '', 'g'), regexp_replace(l.f, '[^\\p{L}\\p{N}_]', '', 'g')) END)))""")
def names_without_person(spark: SparkSession, sf: str) -> DataFrame:
    """Author names with no equivalent person: the anti form of the equivalence join.

    Persons are rendered from the parts above size 45, so that some names have none.
    """
    p = table(spark, sf, "part")
    nm = N.split_name(F.col("p_name"), N.FIRST_LAST)
    left = p.select("p_partkey", nm.alias("name"))
    right = (p.where(F.col("p_size") > 45)
              .select(F.struct(F.concat(F.substring(nm["firstname"], 1, 1), F.lit(".")).alias("firstname"),
                               nm["lastname"].alias("lastname")).alias("r_name")).distinct())
    anti = join_equivalent_names(left, right, "name", "r_name", how="left_anti")
    return anti.select("p_partkey", F.col("name.firstname").alias("firstname"), F.col("name.lastname").alias("lastname"))
