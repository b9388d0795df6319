"""Record-level queries: URLs, hashes, JSON features, types, contacts, citations.

Each ``render_*`` builds stand-in input rows (strings in the shape a site
would show) from real columns; the operators under test come from the library.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarweave.functions import citations as C
from scholarweave.functions import names as N
from scholarweave.functions import text as T
from scholarweave.operators.features import (FEED_PAGE_BASE, feature_value, feed_publications, parse_document,
                                             publication_type_of)
from scholarweave.plans.registry import query
from scholarweave.session import ensure_checkpoint_dir, spread, table
from scholarweave.sources.feed_ranges import read_feed

W1 = "split_part(p_name, ' ', 1)"
W2 = "split_part(p_name, ' ', 2)"


def _quote_sql(x: str) -> str:
    return f"replace(replace(url_encode({x}), '%2F', '/'), '~', '%7E')"


@query("url_quote", f"""
SELECT p_partkey, '{FEED_PAGE_BASE}' || {_quote_sql("p_name || ' ' || p_brand || ' *~/x'")} || '.html' AS url
FROM part""")
def url_quote(spark: SparkSession, sf: str) -> DataFrame:
    """``urljoin(base, quote(value) + '.html')`` with quote's safe set (L2)."""
    p = table(spark, sf, "part")
    v = F.concat_ws(" ", "p_name", "p_brand", F.lit("*~/x"))
    return p.select("p_partkey", T.quoted_page_url(v, FEED_PAGE_BASE).alias("url"))


def _doc_links(d: DataFrame) -> DataFrame:
    doi = F.when(F.col("lang").isin("de", "fr"),
                 F.struct(F.concat(F.lit(T.DOI_PROXY + "10.1000/"), F.col("doc_id").cast("string")).alias("href"),
                          F.lit("DOI").alias("text")))
    dl = F.when(F.col("n_chars") > 5000,
                F.struct(F.concat(F.lit("http://files.example.org/"), F.col("doc_id").cast("string"),
                                  F.lit(".pdf")).alias("href"), F.lit("Download (PDF)").alias("text")))
    more = F.struct(F.lit("http://docs.example.org/more").alias("href"), F.lit("mehr").alias("text"))
    return d.withColumn("links", F.filter(F.array(dl, more, doi), lambda x: x.isNotNull()))


def _link_fields(links) -> tuple:
    """Last DOI link wins for ``doi``; last 'Download' link (that is not a DOI) for the URL."""
    doi = F.try_element_at(F.filter(F.transform(links, lambda l: T.doi_of(l["href"])), lambda x: x.isNotNull()),
                           F.lit(-1))
    dl = F.try_element_at(F.transform(F.filter(links, lambda l: T.doi_of(l["href"]).isNull()
                                               & T.is_download_link(l["text"])), lambda l: l["href"]), F.lit(-1))
    return doi, dl


_SQL_DOC_FIELDS = f"""
  CASE WHEN lang IN ('de', 'fr') THEN '10.1000/' || CAST(doc_id AS VARCHAR) END AS doi,
  CASE WHEN n_chars > 5000 THEN 'http://files.example.org/' || CAST(doc_id AS VARCHAR) || '.pdf' END AS download,
  'http://docs.example.org/' || source || '#' AS base"""


@query("content_hash_key", f"""
WITH d AS (SELECT doc_id, text, {_SQL_DOC_FIELDS} FROM documents)
SELECT doc_id, md5(text) AS text_md5, coalesce(download, doi, base || md5(text)) AS source_url FROM d""")
def content_hash_key(spark: SparkSession, sf: str) -> DataFrame:
    """md5 of the whole text; key falls back download -> DOI -> base + md5."""
    d = _doc_links(table(spark, sf, "documents"))
    doi, dl = _link_fields(F.col("links"))
    base = F.concat(F.lit("http://docs.example.org/"), F.col("source"), F.lit("#"))
    return d.select("doc_id", T.content_hash("text").alias("text_md5"),
                    T.publication_key(dl, doi, base, F.col("text")).alias("source_url"))


@query("doi_download_key", f"""
WITH d AS (SELECT doc_id, text, source, lang, n_chars, {_SQL_DOC_FIELDS} FROM documents)
SELECT doc_id, doi, download, coalesce(download, doi, base || md5(text)) AS source_url,
       'http://docs.example.org/' || source || '/#' ||
         upper(md5(concat_ws(chr(31), coalesce('=' || lang, ''), coalesce('=' || CAST(n_chars AS VARCHAR), '')))) AS record_key
FROM d""")
def doi_download_key(spark: SparkSession, sf: str) -> DataFrame:
    """DOI and download link out of a link list, key fallback, stable record hash."""
    d = _doc_links(table(spark, sf, "documents"))
    doi, dl = _link_fields(F.col("links"))
    base = F.concat(F.lit("http://docs.example.org/"), F.col("source"), F.lit("#"))
    page = F.concat(F.lit("http://docs.example.org/"), F.col("source"), F.lit("/"))
    return d.select("doc_id", doi.alias("doi"), dl.alias("download"),
                    T.publication_key(dl, doi, base, F.col("text")).alias("source_url"),
                    T.stable_record_key(page, "lang", F.col("n_chars").cast("string")).alias("record_key"))


def _jstr(c) -> F.Column:
    """JSON string literal of a column."""
    return F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")


def _obj(c) -> F.Column:
    return F.to_json(F.struct(c.alias("value")))


def render_feature_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Each part as a feed document; mixed value shapes, a duplicate and an unknown feature."""
    p = spread(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))
    words = F.split("p_name", " ")

    def feat(fid, values):
        return F.concat(F.lit('{"@id":"' + fid + '","values":'), values, F.lit("}"))

    authors = F.when(F.col("p_size") % 2 == 0, _obj(F.col("p_name"))) \
               .otherwise(_obj(F.array(F.col("p_name"), F.col("p_brand"))))
    feats = F.array(
        feat("title_DE", _obj(F.lit("Entwurf"))),
        feat("publisher", _obj(F.array("p_brand", "p_type"))),
        feat("organ", _obj(F.array("p_type", "p_brand"))),
        feat("vispagename", _obj(F.concat_ws(" ", "p_name", "p_brand"))),
        feat("documentPhrases", _obj(F.array(F.col("p_type"), F.get(words, 0)))),
        feat("phrases", _obj(F.array("p_brand"))),
        feat("year", _jstr((F.col("p_size") + 1990).cast("string"))),
        feat("band", _obj(F.col("p_size"))),
        feat("location", _jstr(F.lit(""))),
        feat("authors", authors),
        feat("publicationTypeId", _obj(F.col("p_size"))),
        feat("publicationType_EN", _obj(F.lit("Article"))),
        feat("internalNote", _obj(F.lit("x"))),
        feat("title_DE", _obj(F.col("p_name"))),
    )
    doc = F.concat(F.lit('{"features":{"feature":['), F.array_join(feats, ","), F.lit("]}}"))
    return p.select("p_partkey", doc.alias("doc"))


_TYPE_CASE = "CASE p_size " + " ".join(
    f"WHEN {k} THEN '{v}'" for k, v in {1: "Academic Article", 2: "Conference Paper", 3: "Academic Article",
                                        4: "Conference Paper", 5: "Chapter", 6: "Conference Poster",
                                        7: "Edited Book", 8: "Proceedings"}.items()) + " ELSE 'Academic Article' END"


@query("feature_pivot", f"""
SELECT p_partkey, p_name AS title, p_type AS published_in, p_type || ', ' || p_brand AS organ,
       '{FEED_PAGE_BASE}' || {_quote_sql("p_name || ' ' || p_brand")} || '.html' AS source_url,
       p_type || ',' || {W1} || ',' || p_brand AS phrases, CAST(p_size + 1990 AS VARCHAR) AS year,
       CAST(NULL AS VARCHAR) AS download_link, CAST(p_size AS VARCHAR) AS issue, CAST(NULL AS VARCHAR) AS location,
       CASE WHEN p_size % 2 = 0 THEN to_json([[{W2}, {W1}]])::VARCHAR
            ELSE to_json([[{W2}, {W1}], [p_brand, '']])::VARCHAR END AS author_names,
       {_TYPE_CASE} AS publication_type, 1 AS unknown_features
FROM part""")
def feature_pivot(spark: SparkSession, sf: str) -> DataFrame:
    """Feature list -> wide publication: rename/drop map, hooks, last duplicate wins."""
    docs = render_feature_docs(spark, sf).select("p_partkey", parse_document("doc").alias("features"))
    pubs = feed_publications(docs, "features", keep=["p_partkey"])
    return (pubs.withColumn("author_names", F.to_json(N.names_to_lists("author_names")))
                .select("p_partkey", "title", "published_in", "organ", "source_url", "phrases", "year",
                        "download_link", "issue", "location", "author_names", "publication_type",
                        "unknown_features"))


FEED_SIZE = 500      # documents of one rendered feed


@query("feed_document_ranges", f"""
SELECT p_partkey // {FEED_SIZE} AS feed,
       row_number() OVER (PARTITION BY p_partkey // {FEED_SIZE} ORDER BY p_partkey) - 1 AS doc_pos,
       p_name AS title, CAST(p_size + 1990 AS VARCHAR) AS year, {_TYPE_CASE} AS publication_type,
       '{FEED_PAGE_BASE}' || {_quote_sql("p_name || ' ' || p_brand")} || '.html' AS source_url, 1 AS unknown_features
FROM part""")
def feed_document_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Publications of feed files, each read by several tasks."""
    docs = render_feature_docs(spark, sf).withColumn("feed", F.floor(F.col("p_partkey") / FEED_SIZE))
    listed = docs.groupBy("feed").agg(F.array_sort(F.collect_list(F.struct("p_partkey", "doc"))).alias("d"))
    body = F.concat(F.lit('{"DataSet":{"documents":{"document":['),
                    F.array_join(F.transform("d", lambda x: x["doc"]), ","), F.lit("]}}}"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/feeds-{uuid.uuid4().hex}"
    listed.select("feed", body.alias("value")).write.partitionBy("feed").text(path)
    pubs = feed_publications(read_feed(spark, path, range_bytes=64 << 10), keep=["url", "doc_pos"])
    return pubs.select(F.regexp_extract("url", "feed=([0-9]+)", 1).cast("long").alias("feed"), "doc_pos", "title", "year",
                       "publication_type", "source_url", "unknown_features")


@query("json_feature_value", """
SELECT event_id, props->>'$.k' AS k FROM events""")
def json_feature_value(spark: SparkSession, sf: str) -> DataFrame:
    """A feature's value as text, scalars unquoted, whether it comes as an object or as a plain string (S3)."""
    e = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k"))
    values = F.when(F.col("event_id") % 3 == 0, F.col("k")).otherwise(F.to_json(F.struct(F.col("k").alias("value"))))
    return e.select("event_id", feature_value(values).alias("k"))


# Fixed stand-in headings per part type (test input only).
HEADINGS = {"STANDARD": ("Monographien", "Wissenschaftliche Artikel"),
            "MEDIUM": ("Referierte Zeitschriftenaufsätze", "Bücher"),
            "PROMO": ("Vorträge und Veranstaltungen", "Buchbeiträge"),
            "LARGE": ("Sammelwerksbeiträge", "Sonstige Publikationen"),
            "SMALL": ("Sonstige Veröffentlichungen", "Interviews"),
            "ECONOMY": ("Presse", "Blogbeiträge")}


def _heading(i: int) -> F.Column:
    out = None
    for k, v in HEADINGS.items():
        out = F.when(F.col("p_type") == k, F.lit(v[i])) if out is None else out.when(F.col("p_type") == k, F.lit(v[i]))
    return out


def _heading_sql(i: int) -> str:
    return "CASE p_type " + " ".join(f"WHEN '{k}' THEN '{v[i]}'" for k, v in HEADINGS.items()) + " END"


def _class_sql(h: str, classes) -> str:
    return "CASE " + " ".join(
        f"WHEN regexp_matches({h}, '{rx}') THEN {repr(lbl) if lbl else 'NULL'}" for rx, lbl in classes) + " END"


@query("publication_type_map", f"""
SELECT p_partkey, {_TYPE_CASE} AS type_by_code,
       {_class_sql(_heading_sql(0), C.GESIS_TYPES)} AS gesis_type,
       {_class_sql(_heading_sql(1), C.HIIG_TYPES)} AS hiig_type FROM part""")
def publication_type_map(spark: SparkSession, sf: str) -> DataFrame:
    """Code -> label with default (F9); ordered regex classes on section headings."""
    p = table(spark, sf, "part")
    return p.select("p_partkey", publication_type_of(F.col("p_size").cast("string")).alias("type_by_code"),
                    C.type_label(_heading(0), C.GESIS_TYPES).alias("gesis_type"),
                    C.type_label(_heading(1), C.HIIG_TYPES).alias("hiig_type"))
