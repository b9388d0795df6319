"""Sites, end to end: crawl -> IDs -> organisation -> roles -> RDF, CSV, registry.

The batch counterpart of running the sites' spiders with the ID, organisation and
RDF pipelines enabled and the per-type CSV feed on (§3.1, §3.2).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarweave.operators.counters import Counters
from scholarweave.plans.graph import Graph, build_graph
from scholarweave.plans.sites import gesis, hiig, knowcenter, zbw
from scholarweave.schemas import ENTITY_FIELDS, conform
from scholarweave.session import cut_lineage
from scholarweave.sources.pages import domain_source, seed_domains
from scholarweave.sinks.registry import append_registry, read_registry
from scholarweave.sinks.writers import write_entities, write_n3, write_ntriples

SITES = {"gesis": gesis, "hiig": hiig, "zbw": zbw}
# Item types a site run can emit; each run rewrites all of them for its source (K2).
OUTPUT_TYPES = ("Organization", "Division", "DivisionRole", "Person", "Publication")


# Item types with a triple exporter of their own; roles are exported with their person.
EXPORTED_TYPES = ("Organization", "Division", "Person")


@dataclass
class SiteRun:
    entities: dict[str, DataFrame]
    graph: Graph
    paths: dict[str, str]
    counts: DataFrame        # F5: source, item_type, n_items, exported
    # per site: pages that did not parse, headings and features of no known class, talks that could not
    # be cut, items without a key (they get no ID); gathered by the jobs that write the items
    problems: dict[str, dict[str, int]]


def _empty(spark: SparkSession, item_type: str) -> DataFrame:
    return conform(spark.createDataFrame([], "source_url string"), item_type)


def crawl_site(spark: SparkSession, site: str, pages: DataFrame,
               counters: Counters | None = None) -> dict[str, DataFrame]:
    """The entities of one site from its ``pages(url, html)`` (the feed site: ``feeds(url, body)``).

    Pages off the site's domains are neither extracted nor followed (F1).  The crawl runs once:
    each item type is a written table that IDs, triples and files are made from.  ``counters`` counts
    what the site's jobs could not use, and the items without a key.
    """
    counters = counters or Counters()
    if site == "knowcenter":
        ents = knowcenter.crawl(pages, counters)
    else:
        domains = [(s, d) for s, d in seed_domains() if s == site]
        ents = SITES[site].crawl(pages.where(domain_source("url", domains).isNotNull()), counters)
    return {item_type: cut_lineage(counters.watch(df, items_without_key=F.col("source_url").isNull()),
                                   f"{site}-{item_type}") for item_type, df in ents.items()}


def unite(spark: SparkSession, crawled: dict[str, dict[str, DataFrame]], item_type: str) -> DataFrame:
    """One item type of several sites in one table with its schema's fields and ``source``."""
    fields = ENTITY_FIELDS[item_type].items()
    parts = [conform(df, item_type).select(*[F.col(name).cast(dtype).alias(name) for name, dtype in fields],
                                           F.lit(site).alias("source"))
             for site, df in [(s, e.get(item_type, _empty(spark, item_type))) for s, e in crawled.items()]]
    return reduce(DataFrame.unionByName, parts)


def item_counts(crawled: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """Items per source and type, and whether the type is exported as triples."""
    parts = [df.select(F.lit(site).alias("source"), F.lit(item_type).alias("item_type"))
             for site, ents in crawled.items() for item_type, df in ents.items()]
    return (reduce(DataFrame.unionByName, parts).groupBy("source", "item_type").agg(F.count("*").alias("n_items"))
            .withColumn("exported", F.col("item_type").isin(*EXPORTED_TYPES)))


def run_sites(spark: SparkSession, inputs: dict[str, DataFrame], out_dir: str | None = None,
              registry_path: str | None = None) -> SiteRun:
    """Crawl several sites (``site -> pages``) into one ID space and one graph.

    Entities of all sites are united per type (U1), numbered against the registry, attached to
    their site's organisation and exported together.  With ``out_dir`` the CSV files per source
    and type (K1, K2) and the N-Triples graph (K5) are written under it; with ``registry_path``
    new IDs are appended there (K6) before any output, so a second run keeps every existing ID.
    """
    counters = {site: Counters() for site in inputs}
    crawled = {site: crawl_site(spark, site, pages, counters[site]) for site, pages in inputs.items()}
    ents = {item_type: unite(spark, crawled, item_type) for item_type in OUTPUT_TYPES}
    registry = read_registry(spark, registry_path) if registry_path else None
    graph = build_graph(ents["Organization"], ents["Division"], ents["Person"], ents["DivisionRole"].drop("source"),
                        registry, publications=ents["Publication"])
    paths: dict[str, str] = {}
    if registry_path:
        # IDs are registered before anything that holds them is published
        append_registry(graph.new_registry_rows, registry_path)
    if out_dir:
        graph.triples = cut_lineage(graph.triples, "triples")     # two files hold the graph
        # Every type is rewritten, empty when this run found none, so nothing from a
        # previous run of this source survives (the reference deleted its files first).
        for site, found in crawled.items():
            for item_type in OUTPUT_TYPES:
                paths[f"{site}_{item_type}"] = write_entities(found.get(item_type, _empty(spark, item_type)),
                                                              out_dir, site, item_type)
        name = "_".join(sorted(crawled))
        paths["rdf"] = write_ntriples(graph.triples, f"{out_dir.rstrip('/')}/{name}_items.nt")
        paths["n3"] = write_n3(graph.triples, f"{out_dir.rstrip('/')}/{name}_items.n3")
    return SiteRun(ents, graph, paths, item_counts(crawled), {site: c.totals() for site, c in counters.items()})


def run_site(spark: SparkSession, site: str, pages: DataFrame, out_dir: str | None = None,
             registry_path: str | None = None, feeds: DataFrame | None = None) -> SiteRun:
    """``run_sites`` for one site; ``paths`` are keyed by item type."""
    source = feeds if site == "knowcenter" and feeds is not None else pages
    run = run_sites(spark, {site: source}, out_dir, registry_path)
    run.paths = {k.removeprefix(f"{site}_"): v for k, v in run.paths.items()}
    return run
