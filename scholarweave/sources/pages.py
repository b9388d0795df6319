"""Page sources: scan, seeds, domain filter, routing.

Predicates on ``url`` run before any HTML is parsed so that only the pages an
extractor needs reach the Python parse stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarweave.functions.text import _c
from scholarweave.operators.counters import Counters
from scholarweave.sources.html_nodes import parse_pages

SOURCES_SCHEMA = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("domain", T.StringType(), False),
    T.StructField("seed_url", T.StringType(), False),
    T.StructField("kind", T.StringType(), True),
])

# The four sites, their allowed domains and seed URLs.
SEEDS = [
    ("gesis", "www.gesis.org", "http://www.gesis.org/das-institut/adresse-und-anreise/standort-koeln/", "organization"),
    ("gesis", "www.gesis.org", "http://www.gesis.org/forschung/angewandte-informatik-und-informationswissenschaft/", "overview"),
    ("hiig", "www.hiig.de", "http://www.hiig.de/institute/organisation/", "organization"),
    ("hiig", "www.hiig.de", "http://www.hiig.de/personen/", "overview"),
    ("hiig", "www.hiig.de", "http://www.hiig.de/publikationen-des-hiig/", "publications"),
    ("knowcenter", "oldknowsite.know-center.tugraz.at", "http://oldknowsite.know-center.tugraz.at/", "feed"),
    ("zbw", "www.zbw.eu", "http://www.zbw.eu/de/forschung/", "overview"),
    ("zbw", "www.zbw.eu", "http://www.zbw.eu/de/impressum/", "organization"),
]


def sources_table(spark: SparkSession, rows=None) -> DataFrame:
    """Seed URLs and allowed domains per source (S2): a small fixed table."""
    return spark.createDataFrame(rows if rows is not None else SEEDS, SOURCES_SCHEMA)


def host_of(url) -> Column:
    return F.lower(F.try_parse_url(_c(url), F.lit("HOST")))


def domain_source(url_col, domains: list[tuple[str, str]]) -> Column:
    """Source whose allowed domain equals the host or is a parent domain of it, else NULL (F1).

    ``domains`` is the configured ``(source, domain)`` list: a ``when`` chain,
    no join and no Python.
    """
    h = host_of(url_col)
    out = None
    for source, dom in domains:
        ok = (h == dom) | h.endswith("." + dom)
        out = F.when(ok, F.lit(source)) if out is None else out.when(ok, F.lit(source))
    return out if out is not None else F.lit(None).cast("string")


def domain_filter(pages: DataFrame, domains: list[tuple[str, str]], url_col: str = "url") -> DataFrame:
    """Pages on an allowed domain, with ``host`` and ``source`` attached (F1)."""
    return (pages.withColumn("source", domain_source(url_col, domains))
                 .where(F.col("source").isNotNull())
                 .withColumn("host", host_of(url_col)))


def seed_urls(source: str) -> list[str]:
    """The URLs that a source's crawl starts from."""
    return [url for s, _, url, _ in SEEDS if s == source]


def seed_domains() -> list[tuple[str, str]]:
    return list(dict.fromkeys((s, d) for s, d, _, _ in SEEDS))


def route(url_col, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """First substring rule that matches names the page kind (F2)."""
    u = _c(url_col)
    out = None
    for needle, kind in rules:
        out = F.when(u.contains(needle), F.lit(kind)) if out is None else out.when(u.contains(needle), F.lit(kind))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def seed_pages(pages: DataFrame, source: str, rules: list[tuple[str, str]], default: str | None = None,
               seeds: DataFrame | None = None) -> DataFrame:
    """The pages that a source's crawl starts from, with their ``kind``.

    The source's own few seed URLs are routed by rules; a table ``seeds(url, kind)`` of any size, each URL
    once, takes their place.
    """
    if seeds is None:
        return pages.where(F.col("url").isin(seed_urls(source))).withColumn("kind", route("url", rules, default))
    return pages.join(seeds.select("url", "kind"), "url")


def with_nodes(pages: DataFrame, html: str = "html", counters: Counters | None = None) -> DataFrame:
    """Parse each page once into its node array (H0); other columns are carried through.

    ``counters`` counts ``unparsable_pages``: pages with a text that yields no nodes.
    """
    if counters is None:
        return parse_pages(pages, html, "nodes")
    parsed = parse_pages(pages.withColumn("_has_html", F.col(html).isNotNull()), html, "nodes")
    return counters.watch(parsed, unparsable_pages=F.col("_has_html") & F.col("nodes").isNull()).drop("_has_html")


def dedup_requests(frontier: DataFrame, url_col: str = "url", dont_filter: bool = False) -> DataFrame:
    """Each URL is requested once unless ``dont_filter`` (A5)."""
    return frontier if dont_filter else frontier.dropDuplicates([url_col])


def first_of(rows: DataFrame, key: str, order: list[str], fields: list[str]) -> DataFrame:
    """One entity per ``key``: the ``fields`` of its first row by ``order``, rest of a tie by the fields.

    An aggregate with map-side combine; a key may have any number of rows.  ``order`` columns sort nulls first.
    """
    by = [F.col(c).alias(f"_by{i}") for i, c in enumerate(order)]
    return rows.groupBy(key).agg(F.min(F.struct(*by, *fields)).alias("_first")).select(
        key, *[F.col(f"_first.{f}").alias(f) for f in fields])


def follow_links(frontier: DataFrame, pages: DataFrame, url_col: str = "url",
                 how: str = "inner", page_url: str = "url") -> DataFrame:
    """``Request(url, meta=...)`` -> the fetched page row plus the carried columns.

    An equi join on the URL; ``how='left'`` keeps frontier rows whose page is
    missing (the errback path).  Depth is fixed per site, so hops are chained
    joins rather than a loop.
    """
    p = pages.withColumnRenamed(page_url, "_page_url")
    return frontier.join(p, frontier[url_col] == p["_page_url"], how).drop("_page_url")


def merge_detail(items: DataFrame, details: DataFrame, item_key: str, detail_key: str, wins: dict[str, str],
                 fills: dict[str, str], adds: dict[str, str] | None = None) -> DataFrame:
    """List rows with what their detail page says; a row whose detail is missing is kept as it is.

    Item column -> detail column: ``wins`` takes the detail's value whenever there is a detail, ``fills``
    only where the item has none, ``adds`` are new columns.  ``has_detail`` tells if there was one.
    """
    hit = F.col("_hit").isNotNull()
    d = details.select(F.col(detail_key).alias("_key"), F.lit(True).alias("_hit"),
                       *[F.col(c).alias(f"_d_{c}") for c in {*wins.values(), *fills.values(), *(adds or {}).values()}])
    merged = {**{c: F.when(hit, F.col(f"_d_{v}")).otherwise(F.col(c)) for c, v in wins.items()},
              **{c: F.coalesce(F.col(c), F.col(f"_d_{v}")) for c, v in fills.items()}}
    return items.join(d, items[item_key] == d["_key"], "left").select(
        *[merged.get(c, F.col(c)).alias(c) for c in items.columns],
        *[F.col(f"_d_{v}").alias(c) for c, v in (adds or {}).items()], hit.alias("has_detail"))
