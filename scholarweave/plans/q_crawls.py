"""Whole site crawls over pages rendered from the driver tables (E1-E4, E6, E7, E9, E10, E12, E13, E15; J1-J4, A5, A6).

Ten suppliers make one overview page, so the seed table and every hop grow with the table.  Only markup
and the page table are made here; links are followed and fields cut by the site modules.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarweave.functions import names as N
from scholarweave.plans.q_sites import _page
from scholarweave.plans.registry import query
from scholarweave.plans.sites import gesis, hiig, zbw
from scholarweave.session import table

BLOCK = 10      # suppliers on one overview page


def _overviews(rows: DataFrame, url: str, template: str, link) -> DataFrame:
    """One page per block of suppliers: the template around the block's links, in key order."""
    blocks = rows.groupBy(F.floor(F.col("s_suppkey") / BLOCK).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("s_suppkey", link.alias("link")))).alias("links"))
    body = F.array_join(F.transform("links", lambda x: x["link"]), "")
    return blocks.select(_page(url, "block").alias("url"), _page(template, body).alias("html"))


def _crawl_input(kinds: dict[str, DataFrame], linked: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(pages, seeds) of a crawl that starts from ``kinds`` (kind -> pages) and may reach ``linked``."""
    pages = reduce(DataFrame.unionByName, [*kinds.values(), *linked])
    seeds = reduce(DataFrame.unionByName, [p.select("url", F.lit(kind).alias("kind")) for kind, p in kinds.items()])
    return pages, seeds


def _items(entities: dict[str, DataFrame], columns: dict[str, list]) -> DataFrame:
    """Rows (item_type, source_url, name, f1, f2, f3, f4): each type's own fields, in the order given."""
    def rows(item_type, cols):
        fields = [F.col(c) if isinstance(c, str) else c for c in cols]
        fields += [F.lit(None)] * (6 - len(fields))
        return entities[item_type].select(F.lit(item_type).alias("item_type"), *[
            f.cast("string").alias(n) for f, n in zip(fields, ("source_url", "name", "f1", "f2", "f3", "f4"), strict=True)])
    return reduce(DataFrame.unionByName, [rows(t, c) for t, c in columns.items()])


@query("site_gesis_crawl", f"""
WITH s AS (SELECT *, 'http://www.gesis.org/abt' || s_suppkey || '/' AS div_url,
                  'http://www.gesis.org/personen/' || s_suppkey || '/' AS person_url FROM supplier),
links AS (SELECT s_suppkey, s_name, person_url, div_url, 'Prof. Dr.' AS title FROM s
          UNION ALL SELECT p.s_suppkey, p.s_name, p.person_url, d.div_url, 'Dr.'
          FROM s p JOIN s d ON d.s_suppkey = p.s_suppkey + 1),
fetched AS (SELECT * FROM links WHERE s_suppkey % 7 <> 0)
SELECT 'Organization' AS item_type, 'http://www.gesis.org/standort/' || s_suppkey || '/' AS source_url,
       '{gesis.ORG_NAME}' AS name, 'Weg ' || s_nationkey AS f1, CAST(50000 + s_suppkey AS VARCHAR) AS f2, 'Stadt' AS f3,
       ' +49 (0)221 ' || s_suppkey || '-0' || ' +49 (0)221 ' || s_suppkey || '-9' AS f4 FROM s
UNION ALL SELECT 'Division', div_url, 'Abt ' || s_name, 'We do ' || s_nationkey || '.More.', NULL, NULL, NULL FROM s
UNION ALL SELECT 'DivisionRole', div_url, 'Leiter', person_url, div_url, NULL, NULL FROM fetched
UNION ALL SELECT 'Person', person_url, s_name || ', Maria', 'Maria', s_name, arg_min(title, div_url), NULL
          FROM fetched GROUP BY person_url, s_name
UNION ALL SELECT 'Person', NULL, 'H' || s_suppkey || ', Hans', 'Hans', 'H' || s_suppkey, '', NULL FROM s""")
def site_gesis_crawl(spark: SparkSession, sf: str) -> DataFrame:
    """Overview -> divisions -> contacts -> persons and roles, and the address pages.

    Person k is linked by the divisions of suppliers k and k + 1 with different titles: the first division
    counts.  Every seventh person page is missing, which leaves neither person nor role.
    """
    s = table(spark, sf, "supplier")
    orgs = s.select(
        _page("http://www.gesis.org/standort/%s/", "s_suppkey").alias("url"),
        _page('<div id="col3"><div class="csc-default"><p>Weg %s<br>%s&nbsp;Stadt</p>'
              '<p>Tel.: +49 (0)221 %s-0<br>Fax: +49 (0)221 %s-9</p></div></div>',
              "s_nationkey", F.col("s_suppkey") + 50000, "s_suppkey", "s_suppkey").alias("html"))
    overviews = _overviews(s, "http://www.gesis.org/bereich%s/", '<div id="c12546"><ul>%s</ul></div>',
                           _page('<li><a href="../abt%s/">A</a></li><li><a href="/abt%s/">B</a></li>',
                                 "s_suppkey", "s_suppkey"))
    before = s.select((F.col("s_suppkey") + 1).alias("_next"), F.col("s_suppkey").alias("k0"), F.col("s_name").alias("n0"))
    deputy = F.when(F.col("k0").isNotNull(), _page(
        '<div class="contact"><p><strong><a href="personen/%s/">Dr. Maria %s</a></strong></p></div>', "k0", "n0"))
    divisions = s.join(before, s["s_suppkey"] == before["_next"], "left").select(
        _page("http://www.gesis.org/abt%s/", "s_suppkey").alias("url"),
        _page('<div id="main"><div id="col3"><div class="csc-default"><h1>Abt %s</h1><p>We do <b>%s</b>.</p>'
              '<div><p>More.</p></div></div></div><div id="col2"><div class="contact"><p><strong>'
              '<a href="personen/%s/">Prof. Dr. Maria %s</a></strong></p></div>%s'
              '<div class="contact"><p><strong><a>Hans H%s</a></strong></p></div></div></div>',
              "s_name", "s_nationkey", "s_suppkey", "s_name", F.coalesce(deputy, F.lit("")), "s_suppkey").alias("html"))
    persons = s.where("s_suppkey % 7 <> 0").select(
        _page("http://www.gesis.org/personen/%s/", "s_suppkey").alias("url"), F.lit("<p>Profil</p>").alias("html"))
    pages, seeds = _crawl_input({"organization": orgs, "overview": overviews}, [divisions, persons])
    return _items(gesis.crawl(pages, seeds=seeds), {
        "Organization": ["source_url", "name", "street_address", "postal_code", "city", F.concat("phone", "fax")],
        "Division": ["source_url", "name", "description"],
        "DivisionRole": ["source_url", "name", "person_url", "division_url"],
        "Person": ["source_url", "name", "firstname", "lastname", "title"]})


@query("site_hiig_crawl", """
WITH s AS (SELECT *, 'http://www.hiig.de/personen/' || s_suppkey || '/' AS person_url,
                  'http://www.hiig.de/publication/' || s_suppkey || '/' AS pub_url FROM supplier)
SELECT 'Organization' AS item_type, 'http://www.hiig.de/organisation/' || s_suppkey || '/' AS source_url,
       'HIIG ' || s_name AS name, NULL AS f1, NULL AS f2, NULL AS f3, NULL AS f4 FROM s
UNION ALL SELECT 'Person', person_url, 'Anna ' || s_name, 'Anna', s_name, 'Dr.', 'anna' || s_suppkey || '@hiig.de'
          FROM s WHERE s_suppkey % 5 <> 0
UNION ALL SELECT 'Publication', pub_url, ' A study of ' || s_nationkey || '. ',
       CASE WHEN s_suppkey % 3 = 0 THEN '2014' ELSE '2015' END || CASE WHEN s_suppkey % 2 = 0 THEN ' Academic Article'
            WHEN s_suppkey % 3 = 0 THEN '' ELSE ' Blogbeitrag' END,
       'Journal ' || s_nationkey, CASE WHEN s_suppkey % 3 <> 0 THEN person_url END,
       CASE WHEN s_suppkey % 3 = 0 THEN '[["A","Schmidt"],["B.","Jones"]]' ELSE '[["Bob","Jones"]]' END ||
       CASE WHEN s_suppkey % 3 <> 0 THEN 'About ' || s_name ELSE '' END FROM s""")
def site_hiig_crawl(spark: SparkSession, sf: str) -> DataFrame:
    """Staff menu -> persons, list pages -> details, organisation titles.

    Every third detail page is missing (the list row stays as it is), and so is every fifth person page.
    """
    s = table(spark, sf, "supplier")
    orgs = s.select(_page("http://www.hiig.de/organisation/%s/", "s_suppkey").alias("url"),
                    _page("<html><head><title>Organisation | HIIG %s</title></head><body></body></html>", "s_name")
                    .alias("html"))
    staff = _overviews(s, "http://www.hiig.de/team%s/",
                       '<ul id="menu-staff"><li><a href="http://www.hiig.de/x/">Team</a><ul>%s</ul></li></ul>',
                       _page('<li><a href="http://www.hiig.de/personen/%s/">P</a></li>', "s_suppkey"))
    persons = s.where("s_suppkey % 5 <> 0").select(
        _page("http://www.hiig.de/personen/%s/", "s_suppkey").alias("url"),
        _page('<div id="main"><div><div><h1>Anna %s, Dr.</h1></div></div></div><div id="secondary"><div class="kontakt">'
              '<div class="var_shbio"><a href="mailto:anna%s|a|hiig.de">Mail</a></div></div></div>',
              "s_name", "s_suppkey").alias("html"))
    heading = F.when(F.col("s_suppkey") % 2 == 0, "Wissenschaftliche Artikel").otherwise("Sonstige Publikationen")
    lists = _overviews(s, "http://www.hiig.de/publi%s/", '<div id="content">%s</div>', _page(
        '<h3>%s</h3><div class="publication-APA">Schmidt, A., &amp; Jones, B. (2014). A study of %s. <em>Journal %s</em>'
        '<a href="http://www.hiig.de/publication/%s/">more</a></div>',
        heading, "s_nationkey", "s_nationkey", "s_suppkey"))
    details = s.where("s_suppkey % 3 <> 0").select(
        _page("http://www.hiig.de/publication/%s/", "s_suppkey").alias("url"),
        _page('<div id="content"><div><table><tr><td>A</td><td><span>%s, Anna &amp; Jones, Bob</span></td></tr>'
              '<tr><td>Q</td><td><span>x</span></td></tr><tr><td>J</td><td><span> 2015 </span></td></tr>'
              '<tr><td>T</td><td><span>Blogbeitrag</span></td></tr></table><article><p>About %s</p></article></div></div>'
              '<div id="secondary"><ul><li><a href="http://www.hiig.de/personen/%s/">Anna %s, Dr.</a></li></ul></div>',
              "s_name", "s_name", "s_suppkey", "s_name").alias("html"))
    pages, seeds = _crawl_input({"organization": orgs, "overview": staff, "publications": lists}, [persons, details])
    return _items(hiig.crawl(pages, seeds=seeds), {
        "Organization": ["source_url", "name"],
        "Person": ["source_url", "name", "firstname", "lastname", "title", "email"],
        "Publication": ["source_url", "title", F.concat_ws(" ", "year", "publication_type"), "published_in",
                        F.array_join("author_urls", ","),
                        F.concat(F.to_json(N.names_to_lists(F.col("author_names"))), F.coalesce("abstract", F.lit("")))]})


@query("site_zbw_crawl", """
WITH s AS (SELECT *, 'http://www.zbw.eu/de/forschung/' || s_suppkey || '/' AS div_url,
                  'http://www.zbw.eu/de/personen/' || (s_suppkey - s_suppkey % 2) || '/' AS person_url FROM supplier),
p AS (SELECT DISTINCT person_url, s_suppkey - s_suppkey % 2 AS k FROM s)
SELECT 'Organization' AS item_type, 'http://www.zbw.eu/de/impressum/' || s_suppkey || '/' AS source_url,
       'ZBW ' || s_name AS name, 'Weg ' || s_nationkey AS f1, CAST(24000 + s_suppkey AS VARCHAR) AS f2, 'Kiel' AS f3,
       'i' || s_suppkey || '@zbw.eu' AS f4 FROM s
UNION ALL SELECT 'Division', div_url, 'Division ' || s_nationkey, 'Text ' || s_suppkey, NULL, NULL, NULL FROM s
UNION ALL SELECT 'DivisionRole', div_url, 'Leiter', person_url, div_url, NULL, NULL FROM s
UNION ALL SELECT 'Person', person_url, 'Ann ' || arg_min(s_name, div_url), 'Ann', arg_min(s_name, div_url), 'Prof. Dr.',
       'Direktor ' || (any_value(s_suppkey) - any_value(s_suppkey) % 2) || ';Professor;Leiter' FROM s GROUP BY person_url
UNION ALL SELECT 'Publication', NULL, 'Item ' || i || ' of ' || k, ' ' || (1990 + i) || ', Journal', person_url, NULL, NULL
          FROM p, range(1, 3) r(i)""")
def site_zbw_crawl(spark: SparkSession, sf: str) -> DataFrame:
    """Overview -> divisions -> persons -> publications, and the imprints.

    Two divisions share a person: the first division's contact box counts, the person's pages are read once.
    """
    s = table(spark, sf, "supplier").withColumn("k", F.col("s_suppkey") - F.col("s_suppkey") % 2)
    orgs = s.select(
        _page("http://www.zbw.eu/de/impressum/%s/", "s_suppkey").alias("url"),
        _page('<div id="c165"><p>ZBW %s<br>Stiftung</p><p> Weg %s <br> %s Kiel </p><p>Tel: +49 431<br>Fax: +49 431<br>'
              '<a href="mailto:i%s@zbw.eu">i%s@zbw.eu</a></p></div>',
              "s_name", "s_nationkey", F.col("s_suppkey") + 24000, "s_suppkey", "s_suppkey").alias("html"))
    overviews = _overviews(s, "http://www.zbw.eu/de/forschung-%s/",
                           '<div id="content_main"><div class="csc-default box"><p class="bodytext">%s</p></div></div>',
                           _page('<a href="/de/forschung/%s/">D</a>, ', "s_suppkey"))
    divisions = s.select(
        _page("http://www.zbw.eu/de/forschung/%s/", "s_suppkey").alias("url"),
        _page('<div id="content_main"><div class="csc-default box"><h1 class="csc-firstHeader">Division %s</h1>'
              '<p>Text <i>%s</i></p></div></div><div id="content_right"><div class="vcard">'
              '<div class="name"><span class="fn">Ann %s</span></div><span class="title">Prof. Dr.</span>'
              '<a class="url" href="/de/personen/%s/">Profil</a></div></div>',
              "s_nationkey", "s_suppkey", "s_name", "k").alias("html"))
    keys = s.select("k").distinct()
    persons = keys.select(
        _page("http://www.zbw.eu/de/personen/%s/", "k").alias("url"),
        _page('<div id="content_main"><div class="csc-default box"><div class="csc-header"><h2>Funktion</h2></div>'
              '<p>Direktor <b>%s</b></p><ul><li>Professor</li><li>Leiter</li></ul></div><div class="csc-default box">'
              '<p><a href="/de/publikationen/%s/">Publikationen</a></p></div></div>', "k", "k").alias("html"))
    pubs = keys.select(
        _page("http://www.zbw.eu/de/publikationen/%s/", "k").alias("url"),
        _page('<div id="content"><div class="csc-default box"><ul><li><b>Item 1 of %s</b> 1991, Journal</li>'
              '<li>See <b>Item <i>2</i> of %s</b> 1992, Journal<em>x</em></li></ul></div></div>', "k", "k").alias("html"))
    pages, seeds = _crawl_input({"organization": orgs, "overview": overviews}, [divisions, persons, pubs])
    return _items(zbw.crawl(pages, seeds=seeds), {
        "Organization": ["source_url", "name", "street_address", "postal_code", "city", "email"],
        "Division": ["source_url", "name", "description"],
        "DivisionRole": ["source_url", "name", "person_url", "division_url"],
        "Person": ["source_url", "name", "firstname", "lastname", "title", F.array_join("position", ";")],
        "Publication": [F.lit(None), "title", "year", "person_url"]})
