"""Site jobs on pages rendered from the driver tables, one page a row.

Only the markup is made here; fields are cut by the site modules.  The oracles are plain
projections of the rows that the pages were rendered from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarweave.functions import names as N
from scholarweave.plans.registry import query
from scholarweave.plans.sites import gesis, hiig, zbw
from scholarweave.session import spread, table
from scholarweave.sources.pages import with_nodes


def _page(template: str, *cols) -> F.Column:
    """``template`` with its %s filled from the columns, as text."""
    return F.format_string(template, *[F.col(c).cast("string") if isinstance(c, str) else c for c in cols])


@query("site_zbw_divisions", """
SELECT 'http://www.zbw.eu/de/forschung/' || s_suppkey || '/' AS source_url, 'Division ' || s_nationkey AS name,
       'Mail x' || s_suppkey || '@zbw.eu now' AS description, 'Ann ' || s_name AS contact_name, 'Ann' AS firstname,
       s_name AS lastname, 'Prof. Dr.' AS title, '+49 431 ' || s_suppkey AS phone,
       'Weg ' || s_nationkey AS street_address, '24105' AS postal_code, 'Kiel' AS city,
       'http://www.zbw.eu/de/personen/' || s_suppkey || '/' AS person_url
FROM supplier""")
def site_zbw_divisions(spark: SparkSession, sf: str) -> DataFrame:
    """Division, contact card and person link of a division page per supplier."""
    pages = spread(table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")).select(
        _page("http://www.zbw.eu/de/forschung/%s/", "s_suppkey").alias("url"),
        _page('<div id="content_main"><div class="csc-default box"><h1 class="csc-firstHeader">Division %s</h1>'
              '<p>Mail x%s@ remove-this.zbw.eu <b>now</b></p></div></div><div id="content_right"><div class="vcard">'
              '<div class="name"><span class="fn">Ann %s</span></div><span class="title">Prof. Dr.</span>'
              '<span class="tel">T:&nbsp;+49 431 %s</span><div class="adr"><span class="street-address">Weg %s</span>'
              '<span class="postal-code">24105</span><span class="locality">Kiel</span></div>'
              '<a class="url" href="/de/personen/%s/">Profil</a></div></div>',
              "s_nationkey", "s_suppkey", "s_name", "s_suppkey", "s_nationkey", "s_suppkey").alias("html"))
    return zbw.extract_division(with_nodes(pages)).select(
        "source_url", "name", "description", F.col("contact.name").alias("contact_name"),
        *[F.col(f"contact.{c}").alias(c) for c in ("firstname", "lastname", "title", "phone", "street_address",
                                                   "postal_code", "city", "person_url")])


@query("site_zbw_publications", """
SELECT 'Item ' || i || ' of ' || c_name AS title, ' ' || (1990 + i) || ', Journal' AS year,
       'http://www.zbw.eu/de/personen/' || c_custkey || '/' AS person_url
FROM (SELECT *, unnest(range(1, c_custkey % 12 + 2)) AS i FROM customer)""")
def site_zbw_publications(spark: SparkSession, sf: str) -> DataFrame:
    """Bold title and the text after it of every list item of a publications page per customer."""
    item = lambda i: F.concat(F.lit("<li>Intro <b>Item "), i.cast("string"), F.lit(" <i>of</i> "), F.col("c_name"),
                              F.lit("</b> "), (1990 + i).cast("string"), F.lit(", Journal<em>x</em></li>"))
    items = F.array_join(F.transform(F.sequence(F.lit(1), (F.col("c_custkey") % 12 + 1).cast("int")), item), "")
    pages = spread(table(spark, sf, "customer").select("c_custkey", "c_name")).select(
        _page("http://www.zbw.eu/de/publikationen/%s/", "c_custkey").alias("url"),
        _page("http://www.zbw.eu/de/personen/%s/", "c_custkey").alias("person_url"),
        _page('<div id="content"><div class="csc-default box"><ul>%s</ul></div></div>', items).alias("html"))
    return zbw.extract_publications(with_nodes(pages)).select("title", "year", "person_url")


@query("site_hiig_persons", """
SELECT 'http://www.hiig.de/personen/' || c_custkey || '/' AS source_url, 'Anna ' || c_name AS name,
       'Anna' AS firstname, c_name AS lastname, CASE WHEN c_custkey % 2 = 0 THEN 'Dr.' END AS title,
       lower(c_mktsegment) AS positions, '+49 030 ' || c_custkey || ' ' AS phone,
       'anna' || c_custkey || '@hiig.de' AS email, 'http://anna.example/' || c_custkey AS web FROM customer""")
def site_hiig_persons(spark: SparkSession, sf: str) -> DataFrame:
    """Name, title, position and contact block of a person page per customer."""
    title = F.when(F.col("c_custkey") % 2 == 0, F.lit(", Dr.")).otherwise(F.lit(""))
    pages = spread(table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")).select(
        _page("http://www.hiig.de/personen/%s/", "c_custkey").alias("url"),
        _page('<div id="main"><div><div><h1>Anna %s%s</h1></div></div></div><div id="secondary"><div class="kontakt">'
              '<div class="var_shbio">Raum 1 T. +49 030 %s <a href="mailto:anna%s|a|hiig.de">Mail</a>'
              '<a href="http://anna.example/%s">Web</a></div></div><div class="research">'
              '<div class="staff_position">%s</div></div></div>',
              "c_name", title, "c_custkey", "c_custkey", "c_custkey", F.lower("c_mktsegment")).alias("html"))
    return hiig.extract_person(with_nodes(pages)).select(
        "source_url", "name", "firstname", "lastname", "title", F.array_join("position", ";").alias("positions"),
        "phone", "email", "web")


@query("site_gesis_publications", """
SELECT '10.1/' || p_partkey AS source_url, 'Book on ' || p_name AS title, NULL AS published_in, NULL AS location,
       CAST(1950 + p_size AS VARCHAR) AS year, '10.1/' || p_partkey AS doi,
       '[["Maria","Muster"],["' || p_brand || '","Roe"]]' AS author_names,
       'http://www.gesis.org/personen/' || p_partkey || '/' AS person_url FROM part
UNION ALL
SELECT 'http://www.gesis.org/personen/' || p_partkey || '/#' ||
       md5('Muster, Maria (' || (1950 + p_size) || '): Talk on ' || p_name || '. Meeting ' || p_size ||
           '. Berlin, 05.09. ' || (1950 + p_size) || '.'),
       'Talk on ' || p_name, 'Meeting ' || p_size, ' Berlin', CAST(1950 + p_size AS VARCHAR), NULL,
       '[["Maria","Muster"]]', 'http://www.gesis.org/personen/' || p_partkey || '/' FROM part""")
def site_gesis_publications(spark: SparkSession, sf: str) -> DataFrame:
    """Books and talks of a person page per part; a talk without a place is dropped."""
    year = (F.col("p_size") + 1950).cast("string")
    pages = spread(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size")).select(
        _page("http://www.gesis.org/personen/%s/", "p_partkey").alias("url"),
        _page('<div class="gs_publication"><div class="gs_publication_list"><div class="gs_publication_list">'
              '<h3>Monographien</h3><p>Muster, Maria; Roe, %s (%s): Book on %s. Verlag, Bonn '
              '<a href="http://dx.doi.org/10.1/%s">DOI</a></p></div><div class="gs_publication_list">'
              '<h3>Vorträge und Veranstaltungen</h3>'
              '<p>Muster, Maria (%s): Talk on %s. Meeting %s. Berlin, 05.09. %s.</p>'
              '<p>Muster, Maria (%s): Only a title %s.</p></div></div></div>',
              "p_brand", year, "p_name", "p_partkey", year, "p_name", "p_size", year, year, year).alias("html"))
    return gesis.extract_publications(with_nodes(pages)).select(
        "source_url", "title", "published_in", "location", "year", "doi",
        F.to_json(N.names_to_lists(F.col("author_names"))).alias("author_names"), "person_url")
