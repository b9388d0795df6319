"""Contact, citation, hCard and merge queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarweave.functions import citations as C
from scholarweave.functions import html as H
from scholarweave.functions import names as N
from scholarweave.functions import text as T
from scholarweave.operators import triples as tr
from scholarweave.plans.pipeline import unite
from scholarweave.plans.q_graph import render_divisions, render_orgs, render_persons
from scholarweave.plans.q_records import _class_sql, _heading, _heading_sql
from scholarweave.plans.registry import query
from scholarweave.session import spread, table
from scholarweave.sources.html_nodes import parse_pages
from scholarweave.sources.pages import follow_links, merge_detail

NBSP = " "
W1 = "split_part(p_name, ' ', 1)"
W2 = "split_part(p_name, ' ', 2)"


def _contacts(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    key = F.col("c_custkey").cast("string")
    mailto = F.when(F.col("c_mktsegment") != "HOUSEHOLD",
                    F.concat(F.lit("mailto:c"), key, F.lit("|a|example.org")))
    web = F.concat(F.lit("http://people.example.org/c/"), key)
    sep = F.when(F.col("c_acctbal") > 0, F.lit(NBSP)).otherwise(F.lit(" "))
    return c.select(
        "c_custkey", "c_name", "c_mktsegment", "c_acctbal",
        F.concat(F.lit("T:"), sep, F.lit("+49 30 "), key).alias("tel_text"),
        F.filter(F.array(mailto, web), lambda x: x.isNotNull()).alias("hrefs"),
        F.concat(F.lit("  Kontakt\n T"), sep, F.lit(" +49 030 "), key, F.lit("-0 \nRaum 1")).alias("block"),
        F.concat(F.lit("c"), key, F.lit("@ remove-this.example.org")).alias("guarded"),
        F.concat(F.lit(" Hauptstr. "), key, F.lit(" ")).alias("street_line"),
        F.concat(F.lit(" "), (F.col("c_nationkey") + 10000).cast("string"), sep, F.lit("Berlin ")).alias("city_line"),
        F.concat(F.lit("Tel. "), key, F.lit(" (0) / Fax")).alias("phone_line"),
    )


@query("contact_view", """
SELECT c_custkey, replace(c_name, '#', ' ') AS name,
       CASE WHEN c_acctbal > 5000 THEN 'Dr.' ELSE '' END AS title, c_mktsegment AS position,
       CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'c' || CAST(c_custkey AS VARCHAR) || '@example.org' END AS email,
       '+49 30 ' || CAST(c_custkey AS VARCHAR) AS phone,
       'http://people.example.org/c/' || CAST(c_custkey AS VARCHAR) AS web,
       regexp_extract('Tel. ' || CAST(c_custkey AS VARCHAR) || ' (0) / Fax', '[-+0-9]+', 0) AS phone_narrow,
       regexp_extract('Tel. ' || CAST(c_custkey AS VARCHAR) || ' (0) / Fax', '[-+0-9() ]+', 0) AS phone_wide
FROM customer""")
def contact_view(spark: SparkSession, sf: str) -> DataFrame:
    """Contact projection (F6): T:-label strip (T5), mailto de-obfuscation vs web (T6), phone runs."""
    c = _contacts(spark, sf)
    hrefs = F.col("hrefs")
    mails = F.filter(hrefs, lambda h: h.contains("mailto:"))
    webs = F.filter(hrefs, lambda h: ~h.contains("mailto:"))
    return c.select(
        "c_custkey", F.replace("c_name", F.lit("#"), F.lit(" ")).alias("name"),
        F.when(F.col("c_acctbal") > 5000, F.lit("Dr.")).otherwise(F.lit("")).alias("title"),
        F.col("c_mktsegment").alias("position"),
        T.deobfuscate_email(F.try_element_at(mails, F.lit(-1))).alias("email"),
        T.strip_phone_label("tel_text").alias("phone"),
        F.try_element_at(webs, F.lit(-1)).alias("web"),
        T.first_match("phone_line", T.PHONE_RUN_NARROW).alias("phone_narrow"),
        T.first_match("phone_line", T.PHONE_RUN_WIDE).alias("phone_wide"))


_WS = "[\\s\\x{00A0}\\x{2000}-\\x{200A}\\x{3000}\\x{1680}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{0085}]"


@query("contact_cleanup", f"""
WITH c AS (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS k,
                  CASE WHEN c_acctbal > 0 THEN chr(160) ELSE ' ' END AS sep, c_nationkey FROM customer),
r AS (SELECT c_custkey, k,
             '  Kontakt' || chr(10) || ' T' || sep || ' +49 030 ' || k || '-0 ' || chr(10) || 'Raum 1' AS block,
             ' ' || CAST(c_nationkey + 10000 AS VARCHAR) || sep || 'Berlin ' AS city_line FROM c),
s AS (SELECT *, regexp_split_to_array(regexp_replace(city_line, '^{_WS}+|{_WS}+$', '', 'g'), '{_WS}+') AS parts FROM r)
SELECT c_custkey,
       regexp_replace(block, '(?s).*T.\\s+(\\+49.0.[-0-9 ]+).*$', '\\1') AS phone,
       'c' || k || '@example.org' AS email,
       'Hauptstr. ' || k AS street_address, parts[1] AS postal_code, parts[2] AS city,
       parts[-1] AS last_part, len(parts) > 1 AS has_city
FROM s""")
def contact_cleanup(spark: SparkSession, sf: str) -> DataFrame:
    """Phone out of a block (T4), spam guard (T7), NBSP-aware address split (T2, T9), presence (F4), index."""
    c = _contacts(spark, sf)
    addr = T.address_parts("street_line", "city_line")
    parts = T.ws_split(T.strip("city_line"))
    return c.select(
        "c_custkey", T.phone_from_block("block").alias("phone"), T.remove_spam_guard("guarded").alias("email"),
        addr["street_address"].alias("street_address"), addr["postal_code"].alias("postal_code"),
        addr["city"].alias("city"), T.nth(parts, -1).alias("last_part"),
        T.present(T.nth(parts, 1)).alias("has_city"))


def _hcard_html(s: DataFrame) -> DataFrame:
    k = F.col("s_suppkey").cast("string")
    html = F.concat(
        F.lit('<div id="content_right"><div class="vcard"><div class="name"><span class="fn">'),
        F.replace("s_name", F.lit("#"), F.lit(" ")), F.lit('</span></div><span class="title">'),
        F.when(F.col("s_acctbal") > 5000, F.lit("Prof.")).otherwise(F.lit("")),
        F.lit('</span><span class="tel">T:&nbsp;+49 40 '), k,
        F.lit('</span><div class="adr"><span class="street-address">Kai '), k,
        F.lit('</span> <span class="postal-code">'), (F.col("s_nationkey") + 20000).cast("string"),
        F.lit('</span> <span class="locality">Kiel</span></div><a class="url" href="/p/'), k,
        F.lit('">mehr</a><a class="url extra" href="/x">x</a></div></div>'))
    return s.select("s_suppkey", html.alias("html"))


@query("hcard_fields", """
SELECT s_suppkey, replace(s_name, '#', ' ') AS fn, CASE WHEN s_acctbal > 5000 THEN 'Prof.' ELSE '' END AS title,
       '+49 40 ' || CAST(s_suppkey AS VARCHAR) AS phone, 'Kai ' || CAST(s_suppkey AS VARCHAR) AS street_address,
       CAST(s_nationkey + 20000 AS VARCHAR) AS postal_code, 'Kiel' AS city,
       'http://www.zbw.eu/p/' || CAST(s_suppkey AS VARCHAR) AS person_url,
       split_part(replace(s_name, '#', ' '), ' ', 1) AS firstname, split_part(replace(s_name, '#', ' '), ' ', 2) AS lastname
FROM supplier""")
def hcard_fields(spark: SparkSession, sf: str) -> DataFrame:
    """hCard fields selected by class from parsed HTML."""
    n = parse_pages(_hcard_html(spread(table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal", "s_nationkey"))), "html", "nodes")
    # Selector chains resolve through each node's ancestor list (no nested re-filtering).
    vcard = H.all_of(H.has_class("vcard"), H.under(H.has_id("content_right")))

    def field(*classes):
        return H.direct_text("nodes", H.all_of(H.has_class(*classes), H.under(vcard)))

    def nested(outer, inner):
        return H.direct_text("nodes", H.all_of(
            H.has_class(inner), H.under(H.all_of(H.has_class(outer), H.under(vcard)))))

    fn = nested("name", "fn")
    url = F.get(H.attr(H.select("nodes", H.all_of(H.element("a"), H.attr_is("class", "url"), H.parent_is(vcard))),
                       "href"), 0)
    nm = N.split_name(fn, N.FIRST_LAST)
    return n.select("s_suppkey", fn.alias("fn"), field("title").alias("title"),
                    T.strip_phone_label(field("tel")).alias("phone"),
                    nested("adr", "street-address").alias("street_address"),
                    nested("adr", "postal-code").alias("postal_code"), nested("adr", "locality").alias("city"),
                    T.resolve_url(url, None, "http://www.zbw.eu").alias("person_url"),
                    nm["firstname"].alias("firstname"), nm["lastname"].alias("lastname"))


@query("organ_publisher_join", f"""
SELECT p_partkey, p_type || ', ' || p_brand AS organ, CASE WHEN p_size % 3 = 0 THEN p_brand ELSE p_type END AS publisher,
       CASE WHEN p_size % 3 = 0 THEN to_json([[{W2}, {W1}]])::VARCHAR ELSE to_json([[{W2}, {W1}], [p_type, '']])::VARCHAR END AS authors
FROM part""")
def organ_publisher_join(spark: SparkSession, sf: str) -> DataFrame:
    """List joins: organ with ', ', publisher = last element, authors scalar-or-list."""
    from scholarweave.operators.features import FEED_HOOKS
    p = table(spark, sf, "part")
    scalar = F.col("p_size") % 3 == 0
    organ_v = F.to_json(F.array("p_type", "p_brand"))
    pub_v = F.when(scalar, F.col("p_brand")).otherwise(F.to_json(F.array("p_brand", "p_type")))
    auth_v = F.when(scalar, F.col("p_name")).otherwise(F.to_json(F.array("p_name", "p_type")))
    nul = F.lit(None)
    return p.select("p_partkey", FEED_HOOKS["organ"](organ_v, nul).alias("organ"),
                    FEED_HOOKS["publisher"](pub_v, nul).alias("publisher"),
                    F.to_json(N.names_to_lists(FEED_HOOKS["authors"](auth_v, nul))).alias("authors"))


def _article_text(p: DataFrame) -> DataFrame:
    w = F.split("p_name", " ")
    first = F.concat(F.get(w, 1), F.lit(", "), F.substring(F.get(w, 0), 1, 1), F.lit("., & "), F.col("p_type"),
                     F.lit(", Z. ("), (F.col("p_size") + 1990).cast("string"), F.lit("). "),
                     F.initcap("p_name"), F.lit(" In der Praxis (2). Band "), F.col("p_size").cast("string"),
                     F.lit(". In "))
    second = F.concat(F.lit(", pp."), F.col("p_size").cast("string"), F.lit("-"),
                      (F.col("p_size") + 10).cast("string"), F.lit(". Berlin: "), F.col("p_brand"))
    return p.select("p_partkey", "p_type", "p_size", first.alias("t1"), second.alias("t2"),
                    F.concat(F.col("p_brand"), F.lit(" Journal")).alias("em"), _heading(1).alias("heading"))


def _sql_names(x: str, sep_rx: str) -> str:
    parts = f"list_filter(list_transform(regexp_split_to_array({x}, '{sep_rx}'), lambda s: trim(s)), lambda s: s <> '')"
    return (f"to_json(list_transform({parts}, lambda s: [trim(string_split(s, ',')[-1]), "
            f"trim(array_to_string(string_split(s, ',')[1:len(string_split(s, ','))-1], ' '))]))::VARCHAR")


@query("citation_parse_article", f"""
WITH p AS (SELECT p_partkey, p_size, p_brand, {_heading_sql(1)} AS heading,
  {W2} || ', ' || substr({W1}, 1, 1) || '., & ' || p_type || ', Z. (' || CAST(p_size + 1990 AS VARCHAR) || '). ' ||
  upper(substr({W1}, 1, 1)) || substr({W1}, 2) || ' ' || upper(substr({W2}, 1, 1)) || substr({W2}, 2) ||
  ' In der Praxis (2). Band ' || CAST(p_size AS VARCHAR) || '. In ' AS t1,
  ', pp.' || CAST(p_size AS VARCHAR) || '-' || CAST(p_size + 10 AS VARCHAR) || '. Berlin: ' || p_brand AS t2,
  p_brand || ' Journal' AS em FROM part),
c AS (SELECT *, {_class_sql('heading', C.HIIG_TYPES)} AS ptype,
  CASE WHEN regexp_matches(heading, 'Wissenschaftliche Artikel') THEN 0 WHEN regexp_matches(heading, 'B.+cher') THEN 1
       WHEN regexp_matches(heading, 'Buchbeitr.+ge') THEN 2 WHEN regexp_matches(heading, 'Sonstige Publikationen') THEN 3 END AS idx,
  string_split(t1, ').')[2] AS after_close FROM p)
SELECT p_partkey, {_sql_names("string_split(t1, '(')[1]", "\\.,|&")} AS author_names,
  nullif(regexp_extract(string_split(t1, '(')[2], '([0-9]{{4}})\\)', 1), '') AS year,
  CASE idx WHEN 0 THEN after_close WHEN 1 THEN em WHEN 2 THEN string_split(after_close, 'In')[1]
           WHEN 3 THEN regexp_replace(t1, '^.*?\\d\\)\\.', '') END AS title,
  CASE WHEN idx IN (0, 2, 3) THEN em END AS published_in, ptype AS publication_type,
  CASE WHEN idx = 2 THEN nullif(regexp_extract(t2, 'pp.([0-9]+)\\-([0-9]+)', 1), '') END AS startpage,
  CASE WHEN idx = 2 THEN nullif(regexp_extract(t2, 'pp.([0-9]+)\\-([0-9]+)', 2), '') END AS endpage,
  idx IS NOT NULL AS parsed_ok, split_part(t2, ':', 2) AS publisher
FROM c""")
def citation_parse_article(spark: SparkSession, sf: str) -> DataFrame:
    """``A, B. & C (1998). Title. In ...`` cut by section type; pages; publisher."""
    a = _article_text(table(spark, sf, "part"))
    c = C.hiig_citation("t1", "t2", "em", "heading")
    return a.select("p_partkey", F.to_json(N.names_to_lists(c["author_names"])).alias("author_names"),
                    c["year"].alias("year"), c["title"].alias("title"), c["published_in"].alias("published_in"),
                    c["publication_type"].alias("publication_type"), c["startpage"].alias("startpage"),
                    c["endpage"].alias("endpage"), c["parsed_ok"].alias("parsed_ok"),
                    C.publisher_of("t2").alias("publisher"))


def _talk_text(o: DataFrame) -> DataFrame:
    d = F.date_format("o_orderdate", "dd.MM. yyyy")
    place = F.when(F.col("o_orderstatus") == "F", F.lit("Berlin")).otherwise(F.lit("Bonn, Germany"))
    txt = F.concat(F.lit("Vortrag "), F.col("o_orderkey").cast("string"), F.lit(" über Daten. "),
                   F.col("o_orderpriority"), F.lit(" Konferenz. "), place, F.lit(", "), d, F.lit("."))
    no_loc = F.concat(F.lit("Nur Titel "), F.col("o_orderkey").cast("string"), F.lit(" 2011."))
    return o.select("o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", no_loc).otherwise(txt).alias("text"))


_TALK_SQL_RX = C.TALK_DATE_AT_END


@query("citation_parse_talk", f"""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'Nur Titel ' || CAST(o_orderkey AS VARCHAR) || ' 2011.'
  ELSE 'Vortrag ' || CAST(o_orderkey AS VARCHAR) || ' über Daten. ' || o_orderpriority || ' Konferenz. ' ||
       CASE WHEN o_orderstatus = 'F' THEN 'Berlin' ELSE 'Bonn, Germany' END || ', ' || strftime(o_orderdate, '%d.%m. %Y') || '.' END AS text
  FROM orders),
a AS (SELECT o_orderkey, regexp_replace(text, '{_TALK_SQL_RX}', '') AS t2 FROM o),
b AS (SELECT *, regexp_matches(t2, '([^.]+?)[\\s.,]+$') AS loc_ok, regexp_extract(t2, '([^.]+?)[\\s.,]+$', 1) AS loc,
             replace(t2, regexp_extract(t2, '([^.]+?)[\\s.,]+$', 0), '') AS t3 FROM a),
c AS (SELECT *, regexp_matches(t3, '.\\s*([^.]+)\\.?$') AS pub_ok FROM b)
SELECT o_orderkey,
  CASE WHEN loc_ok AND pub_ok THEN trim(replace(t3, regexp_extract(t3, '.\\s*([^.]+)\\.?$', 0), '')) END AS title,
  CASE WHEN loc_ok AND pub_ok THEN trim(regexp_extract(t3, '.\\s*([^.]+)\\.?$', 1)) END AS published_in,
  CASE WHEN loc_ok AND pub_ok THEN loc END AS location
FROM c WHERE loc_ok AND pub_ok""")
def citation_parse_talk(spark: SparkSession, sf: str) -> DataFrame:
    """Talk citation: trailing date cut, location, source, title; unparsable records dropped."""
    t = C.keep_parsed_talks(_talk_text(table(spark, sf, "orders")), "text", "c")
    return t.select("o_orderkey", "title", "published_in", "location")


@query("citation_parse_monograph", f"""
WITH p AS (SELECT p_partkey, {_heading_sql(0)} AS heading,
  {W2} || ', ' || {W1} || '; ' || p_brand || ', Kim (' || CAST(p_size + 1990 AS VARCHAR) || '): ' ||
  CASE WHEN p_size % 2 = 0 THEN 'Titel ' || p_type || '. In: ' || p_brand || ' Zeitschrift, 12, S. 3-4'
       ELSE 'Beitrag ' || p_type || '. In: Muster, M. (Hrsg.): Handbuch ' || p_brand || ', Bonn' END AS text FROM part),
g AS (SELECT *, regexp_extract(text, '{C.GESIS_AUTHORS_YEAR}', 1) AS au, regexp_extract(text, '{C.GESIS_AUTHORS_YEAR}', 2) AS year,
             regexp_replace(regexp_replace(text, '{C.GESIS_AUTHORS_YEAR}', ''), '^[\\s).:,]+', '') AS rest FROM p),
c AS (SELECT *, {_class_sql('heading', C.GESIS_TYPES)} AS ptype,
  CASE WHEN regexp_matches(heading, '{C.GESIS_TYPES[0][0]}') THEN 0 WHEN regexp_matches(heading, '{C.GESIS_TYPES[1][0]}') THEN 1
       WHEN regexp_matches(heading, '{C.GESIS_TYPES[2][0]}') THEN 2 END AS idx FROM g)
SELECT p_partkey, {_sql_names('au', ';')} AS author_names, year,
  CASE idx WHEN 0 THEN trim(string_split(rest, '.')[1]) WHEN 1 THEN trim(string_split(rest, 'In:')[1]) END AS title,
  CASE WHEN idx = 1 THEN CASE WHEN regexp_matches(rest, '(Hrsg.)') THEN trim(string_split(rest, '):')[2])
                              ELSE trim(string_split(string_split(rest, 'In:')[2], ',')[1]) END END AS published_in,
  ptype AS publication_type
FROM c""")
def citation_parse_monograph(spark: SparkSession, sf: str) -> DataFrame:
    """GESIS citations: ``Last, First; ... (Year): rest``, then title/source by section."""
    p = table(spark, sf, "part")
    w = F.split("p_name", " ")
    text = F.concat(F.get(w, 1), F.lit(", "), F.get(w, 0), F.lit("; "), F.col("p_brand"), F.lit(", Kim ("),
                    (F.col("p_size") + 1990).cast("string"), F.lit("): "),
                    F.when(F.col("p_size") % 2 == 0,
                           F.concat(F.lit("Titel "), F.col("p_type"), F.lit(". In: "), F.col("p_brand"),
                                    F.lit(" Zeitschrift, 12, S. 3-4")))
                    .otherwise(F.concat(F.lit("Beitrag "), F.col("p_type"), F.lit(". In: Muster, M. (Hrsg.): Handbuch "),
                                        F.col("p_brand"), F.lit(", Bonn"))))
    t = p.select("p_partkey", text.alias("text"), _heading(0).alias("heading"))
    ay = C.gesis_authors_year("text")
    t = t.select("p_partkey", "heading", ay.alias("ay"))
    cit = C.gesis_citation(F.col("ay.rest"), F.col("heading"))
    return t.select("p_partkey", F.to_json(N.names_to_lists("ay.author_names")).alias("author_names"),
                    F.col("ay.year").alias("year"), cit["title"].alias("title"),
                    cit["published_in"].alias("published_in"), cit["publication_type"].alias("publication_type"))


@query("publisher_of_chapter", """
SELECT p_partkey, split_part(s, ':', 2) AS publisher,
       nullif(regexp_extract(s, 'pp.([0-9]+)\\-([0-9]+)', 1), '') AS startpage,
       nullif(regexp_extract(s, 'pp.([0-9]+)\\-([0-9]+)', 2), '') AS endpage
FROM (SELECT p_partkey, 'pp.' || CAST(p_size AS VARCHAR) || '-' || CAST(p_size * 2 AS VARCHAR) || '. ' ||
             split_part(p_name, ' ', 1) || ': ' || p_brand || ' Verlag' AS s FROM part)""")
def publisher_of_chapter(spark: SparkSession, sf: str) -> DataFrame:
    """``pp.1-9. City: Publisher`` -> publisher, pages."""
    p = table(spark, sf, "part")
    s = F.concat(F.lit("pp."), F.col("p_size").cast("string"), F.lit("-"), (F.col("p_size") * 2).cast("string"),
                 F.lit(". "), F.get(F.split("p_name", " "), 0), F.lit(": "), F.col("p_brand"), F.lit(" Verlag"))
    pr = C.page_range(s)
    return p.select("p_partkey", C.publisher_of(s).alias("publisher"), pr["startpage"].alias("startpage"),
                    pr["endpage"].alias("endpage"))


@query("following_text", f"""
SELECT p_partkey, p_name || ' ' || p_brand AS title, ' ' || CAST(p_size + 1990 AS VARCHAR) || ', ' AS year
FROM part""")
def following_text(spark: SparkSession, sf: str) -> DataFrame:
    """``<li><b>title</b> year</li>``: bold text = title, first following text sibling = year."""
    p = spread(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size"))
    html = F.concat(F.lit('<div class="csc-default box"><ul><li><b>'), F.col("p_name"), F.lit(" <i>"),
                    F.col("p_brand"), F.lit("</i></b> "), (F.col("p_size") + 1990).cast("string"),
                    F.lit(", <em>Verlag</em> Seiten</li></ul></div>"))
    n = parse_pages(p.select("p_partkey", html.alias("html")), "html", "nodes")
    items = n.select("p_partkey", "nodes", F.explode(H.select("nodes", H.element("li"))).alias("li"))
    b = H.select("nodes", H.all_of(H.element("b"), H.self_or_within(H.one(F.col("li")))))
    return items.select("p_partkey", H.all_text("nodes", b).alias("title"),
                        H.following_text_sibling("nodes", H.first(b))["text"].alias("year"))


@query("contact_page_merge", """
WITH c AS (SELECT c_custkey, c_acctbal, c_mktsegment,
                  CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN 'http://people.example.org/c/' || CAST(c_custkey AS VARCHAR) END AS link
           FROM customer),
pages AS (SELECT 'http://people.example.org/c/' || CAST(c_custkey AS VARCHAR) AS url FROM customer WHERE c_acctbal > 0)
SELECT c_custkey, NULL::VARCHAR AS source_url, NULL::VARCHAR AS role_name, NULL::VARCHAR AS division_url FROM c WHERE link IS NULL
UNION ALL
SELECT c_custkey, pages.url, 'Leiter', 'http://org.example.org/division/' || c_mktsegment FROM c JOIN pages ON pages.url = c.link""")
def contact_page_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Contact + linked person page (J3, F7): merged when the page exists, unlinked contacts emitted as they are."""
    c = table(spark, sf, "customer")
    url = F.concat(F.lit("http://people.example.org/c/"), F.col("c_custkey").cast("string"))
    contacts = c.select("c_custkey", "c_mktsegment",
                        F.when(F.col("c_mktsegment") != "AUTOMOBILE", url).alias("link"))
    pages = c.where(F.col("c_acctbal") > 0).select(url.alias("url"))
    unlinked = contacts.where(F.col("link").isNull()).select(
        "c_custkey", F.lit(None).cast("string").alias("source_url"), F.lit(None).cast("string").alias("role_name"),
        F.lit(None).cast("string").alias("division_url"))
    merged = follow_links(contacts.where(F.col("link").isNotNull()), pages, "link", "inner").select(
        "c_custkey", F.col("link").alias("source_url"), F.lit("Leiter").alias("role_name"),
        F.concat(F.lit("http://org.example.org/division/"), F.col("c_mktsegment")).alias("division_url"))
    return unlinked.unionByName(merged)


@query("detail_merge_left_outer", """
WITH l AS (SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS year,
                  CASE WHEN o_orderstatus = 'F' THEN 'Book' END AS ptype FROM orders),
d AS (SELECT l_orderkey, CAST(year(min(l_shipdate)) AS VARCHAR) AS year, 'Article' AS ptype FROM lineitem
      WHERE l_returnflag = 'R' GROUP BY l_orderkey)
SELECT o_orderkey, CASE WHEN d.l_orderkey IS NOT NULL THEN d.year ELSE l.year END AS year,
       coalesce(l.ptype, d.ptype) AS publication_type, d.l_orderkey IS NOT NULL AS has_detail
FROM l LEFT JOIN d ON d.l_orderkey = l.o_orderkey""")
def detail_merge_left_outer(spark: SparkSession, sf: str) -> DataFrame:
    """List rows kept when the detail page is missing (J2); detail year wins, type only if unset."""
    o = table(spark, sf, "orders")
    lst = o.select("o_orderkey", F.year("o_orderdate").cast("string").alias("l_year"),
                   F.when(F.col("o_orderstatus") == "F", F.lit("Book")).alias("l_type"))
    li = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    det = li.groupBy("l_orderkey").agg(F.year(F.min("l_shipdate")).cast("string").alias("d_year")) \
            .withColumn("d_type", F.lit("Article"))
    items = lst.withColumnsRenamed({"l_year": "year", "l_type": "publication_type"})
    return merge_detail(items, det, "o_orderkey", "l_orderkey", {"year": "d_year"}, {"publication_type": "d_type"})


@query("academic_titles", """
WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal > 7000 THEN 'Prof. Dr. ' WHEN c_acctbal > 3000 THEN 'Dr.  '
                                  WHEN c_acctbal < 0 THEN 'M. A. ' ELSE '' END || 'Max ' || replace(c_name, '#', '') AS raw,
                  replace(c_name, '#', ' ') || CASE WHEN c_mktsegment = 'BUILDING' THEN ', Dipl.-Ing.' ELSE '' END AS nt
           FROM customer),
t AS (SELECT *, regexp_extract(raw, '^((Prof.|Dr.|M.\\s*A.)\\s*)*', 0) AS pre FROM c)
SELECT c_custkey, trim(pre) AS title, CASE WHEN pre = '' THEN raw ELSE replace(raw, pre, '') END AS name,
       CASE WHEN contains(nt, ',') THEN split_part(nt, ', ', 1) ELSE nt END AS n9_name,
       CASE WHEN contains(nt, ',') THEN split_part(nt, ', ', 2) END AS n9_title
FROM t""")
def academic_titles(spark: SparkSession, sf: str) -> DataFrame:
    """Title prefix out of a name (N8) and ``Name, Title``."""
    c = table(spark, sf, "customer")
    pre = (F.when(F.col("c_acctbal") > 7000, F.lit("Prof. Dr. ")).when(F.col("c_acctbal") > 3000, F.lit("Dr.  "))
           .when(F.col("c_acctbal") < 0, F.lit("M. A. ")).otherwise(F.lit("")))
    raw = F.concat(pre, F.lit("Max "), F.replace("c_name", F.lit("#"), F.lit("")))
    nt = F.concat(F.replace("c_name", F.lit("#"), F.lit(" ")),
                  F.when(F.col("c_mktsegment") == "BUILDING", F.lit(", Dipl.-Ing.")).otherwise(F.lit("")))
    t, n9 = N.split_academic_title(raw), N.split_name_title(nt)
    return c.select("c_custkey", t["title"].alias("title"), t["name"].alias("name"),
                    n9["name"].alias("n9_name"), n9["title"].alias("n9_title"))


@query("entity_union", """
SELECT 'customer' AS source, 'http://people.example.org/c/' || CAST(c_custkey AS VARCHAR) AS source_url,
       replace(c_name, '#', ' ') AS name, c_mktsegment AS position, NULL::VARCHAR AS phone FROM customer
UNION ALL
SELECT 'supplier', 'http://people.example.org/s/' || CAST(s_suppkey AS VARCHAR), replace(s_name, '#', ' '),
       NULL, '+49 40 ' || CAST(s_suppkey AS VARCHAR) FROM supplier""")
def entity_union(spark: SparkSession, sf: str) -> DataFrame:
    """Items of one type from several sources in one table; missing fields NULL."""
    c = table(spark, sf, "customer").select(
        F.concat(F.lit("http://people.example.org/c/"), F.col("c_custkey").cast("string")).alias("source_url"),
        F.replace("c_name", F.lit("#"), F.lit(" ")).alias("name"), F.array("c_mktsegment").alias("position"))
    s = table(spark, sf, "supplier").select(
        F.concat(F.lit("http://people.example.org/s/"), F.col("s_suppkey").cast("string")).alias("source_url"),
        F.replace("s_name", F.lit("#"), F.lit(" ")).alias("name"),
        F.concat(F.lit("+49 40 "), F.col("s_suppkey").cast("string")).alias("phone"))
    people = unite(spark, {"customer": {"Person": c}, "supplier": {"Person": s}}, "Person")
    return people.select("source", "source_url", "name", F.get("position", 0).alias("position"), "phone")


@query("unexported_counts", """
WITH per AS (SELECT c_acctbal, c_mktsegment FROM customer)
SELECT 'Organization' AS item_type, (SELECT count(*) FROM region) AS n_items, true AS exported,
       (SELECT CAST(sum(8 + CASE WHEN r_name LIKE 'A%' THEN 2 + 2 ELSE 0 END + CASE WHEN r_name LIKE '%A' THEN 1 ELSE 0 END
                   + CASE WHEN r_name LIKE '%A' AND r_name NOT LIKE 'A%' THEN 2 ELSE 0 END) AS BIGINT) FROM region) AS n_triples
UNION ALL SELECT 'Division', (SELECT count(*) FROM nation), true, (SELECT 3 * count(*) FROM nation)
UNION ALL SELECT 'Person', (SELECT count(*) FROM customer), true,
       (SELECT CAST(sum(8 + 4 + CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 4 ELSE 0 END
                   + CASE WHEN c_acctbal > 5000 THEN 3 ELSE 0 END + CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 3 ELSE 0 END)
                     AS BIGINT) FROM customer)
UNION ALL SELECT 'Publication', (SELECT count(*) FROM orders), false, CAST(NULL AS BIGINT)""")
def unexported_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Per-type item counts; exporters exist for three types only, the rest are counted.

    Triple counts are taken before dedup and follow the §2.11 invariants.
    """
    orgs = render_orgs(spark, sf).withColumn("id", F.col("source") + 1)
    divs = render_divisions(spark, sf).withColumn("id", F.lit(1)).withColumn("organization_id", F.lit(1))
    pers = render_persons(spark, sf).withColumn("id", F.col("c_custkey") + 1).withColumn("organization_id", F.lit(1))
    pubs = table(spark, sf, "orders")
    parts = [("Organization", orgs, tr.organization_triples), ("Division", divs, tr.division_triples),
             ("Person", pers, tr.person_triples), ("Publication", pubs, None)]
    rows = []
    for name, df, exporter in parts:
        rows.append(df.select(F.lit(name).alias("item_type"), F.lit(1).alias("i"), F.lit(0).alias("t")))
        if exporter is not None:
            rows.append(exporter(df).select(F.lit(name).alias("item_type"), F.lit(0).alias("i"), F.lit(1).alias("t")))
    exported = F.col("item_type").isin(*[n for n, _, e in parts if e is not None])
    g = reduce(lambda a, b: a.unionByName(b), rows).groupBy("item_type").agg(
        F.sum("i").alias("n_items"), F.sum("t").alias("n_triples"))
    return g.select("item_type", "n_items", exported.alias("exported"),
                    F.when(exported, F.col("n_triples")).alias("n_triples"))
