"""GESIS: organisation (E1), division links (E2), division + contacts (E3),
person page + role (E4), publication list (E5, the evident intent of dead code)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarweave.functions import citations as C
from scholarweave.functions import html as H
from scholarweave.functions import names as N
from scholarweave.functions import text as T
from scholarweave.operators.counters import Counters
from scholarweave.plans.sites._sel import NODES, desc, el, find, hrefs, kids, nodes_of, nth_el, text, texts
from scholarweave.session import cut_lineage
from scholarweave.sources.pages import dedup_requests, first_of, follow_links, seed_pages, with_nodes

ROOT = "http://www.gesis.org/"
ROUTES = [("institut", "organization")]
# Fixed value: the organisation's name as the site job sets it.
ORG_NAME = "GESIS - Leibniz-Institut für Sozialwissenschaften"


def extract_organization(pages: DataFrame) -> DataFrame:
    content = desc(find(H.has_id("col3")), H.has_class("csc-default"))
    address, contact = texts(kids(content, nth_el("p", 1))), texts(kids(content, nth_el("p", 2)))
    cp = T.ws_split(T.strip(F.get(address, 1)))
    return pages.select(
        F.col("url").alias("source_url"), F.lit(ORG_NAME).alias("name"),
        T.strip(F.get(address, 0)).alias("street_address"),
        F.get(cp, 0).alias("postal_code"), F.get(cp, 1).alias("city"),
        T.first_match(T.strip(F.get(contact, 0)), T.PHONE_RUN_WIDE).alias("phone"),
        T.first_match(T.strip(F.get(contact, 1)), T.PHONE_RUN_WIDE).alias("fax"))


def division_links(pages: DataFrame) -> DataFrame:
    links = desc(desc(find(H.has_id("c12546")), el("li")), el("a"))
    return pages.select("url", F.explode(hrefs(links)).alias("href")).select(
        T.resolve_url(F.col("href"), F.col("url"), ROOT).alias("url"))


def extract_division(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Division row, and one contact row per ``#main #col2 .contact``."""
    main = find(H.has_id("main"))
    info = desc(desc(main, H.has_id("col3")), H.has_class("csc-default"))
    desc_nodes = H.select(NODES, H.any_of(H.under(kids(info, el("p"))),
                                         H.under(kids(kids(info, el("div")), el("p")))))
    contacts = desc(desc(main, H.has_id("col2")), H.has_class("contact"))

    def contact(c):
        a = H.step(NODES, H.step(NODES, H.children(NODES, c, el("p")), el("strong")), el("a"))
        return F.struct(H.step_text(NODES, a).alias("a_text"), F.array_join(H.attr(a, "href"), "").alias("more"))

    # each division page is parsed once; both results come from what was cut out of it
    cut = cut_lineage(pages.select(
        F.col("url").alias("source_url"), text(desc(info, el("h1"))).alias("name"),
        F.array_join(F.transform(F.filter(desc_nodes, lambda n: n["kind"] == "text"), lambda n: n["text"]), "")
         .alias("description"),
        F.transform(nodes_of(contacts), contact).alias("contacts")), "divisions")
    division = cut.select("source_url", "name", "description")
    rows = cut.select("source_url", F.posexplode("contacts").alias("contact_pos", "c")) \
        .select("source_url", "contact_pos", "c.*")
    t = N.split_academic_title("a_text")
    nm = N.split_name(t["name"], N.FIRST_LAST)
    people = rows.select(
        F.col("source_url").alias("division_url"), "contact_pos", t["title"].alias("title"),
        F.concat(nm["lastname"], F.lit(", "), nm["firstname"]).alias("name"),
        nm["firstname"].alias("firstname"), nm["lastname"].alias("lastname"),
        F.when(F.col("more") != "", T.resolve_url(F.col("more"), None, ROOT)).alias("link"))
    return division, people


def extract_publications(pages: DataFrame, counters: Counters | None = None) -> DataFrame:
    """Sections under ``.gs_publication > .gs_publication_list .gs_publication_list``; one row per ``p``."""
    outer = kids(find(H.has_class("gs_publication")), H.has_class("gs_publication_list"))
    lists = desc(outer, H.has_class("gs_publication_list"))

    def item(p):
        links = F.transform(H.children(NODES, p, el("a")), lambda a: F.struct(
            a["attrs"]["href"].alias("href"), F.array_join(H.child_texts(NODES, a), "").alias("text")))
        return F.struct(F.get(H.child_texts(NODES, p), 0).alias("text"), links.alias("links"))

    def section(s):
        return F.struct(H.step_text(NODES, H.children(NODES, s, el("h3"))).alias("heading"),
                        F.transform(H.children(NODES, s, el("p")), item).alias("items"))

    # only finished items are exploded, never the page's nodes
    sec = pages.select("url", F.inline(F.transform(nodes_of(lists), section)))
    t = sec.select("url", "heading", F.inline("items"))
    ay = C.gesis_authors_year("text")
    t = t.withColumn("ay", ay)
    cit = C.gesis_citation(F.col("ay.rest"), F.col("heading"))
    doi = F.try_element_at(F.filter(F.transform("links", lambda l: T.doi_of(l["href"])), lambda x: x.isNotNull()),
                           F.lit(-1))
    dl = F.try_element_at(F.transform(F.filter("links", lambda l: T.doi_of(l["href"]).isNull()
                                               & T.is_download_link(l["text"])), lambda l: l["href"]), F.lit(-1))
    base = T.fragment_base(F.col("url"))
    t = C.parse_talks(t.withColumn("rest", F.col("ay.rest")), "rest", "talk")
    kind = C.classify(F.col("heading"), C.GESIS_TYPES)
    is_talk = kind == 2
    if counters is not None:
        t = counters.watch(t, unknown_headings=kind.isNull(), unparsed_talks=is_talk & ~F.col("talk.ok"))
    out = t.select(
        T.publication_key(dl, doi, base, F.col("text")).alias("source_url"),
        F.when(is_talk, F.col("talk.title")).otherwise(cit["title"]).alias("title"),
        F.when(is_talk, F.col("talk.published_in")).otherwise(cit["published_in"]).alias("published_in"),
        F.when(is_talk, F.col("talk.location")).alias("location"),
        cit["publication_type"].alias("publication_type"),
        F.col("ay.author_names").alias("author_names"), F.col("ay.year").alias("year"),
        doi.alias("doi"), F.when(is_talk, F.col("talk.ok")).otherwise(F.lit(True)).alias("_keep"),
        F.col("url").alias("person_url"))
    # Drop unparsable talks with a generator: a filter here would be pushed below the
    # staged regex columns and re-run them.
    row = F.struct(*[F.col(c) for c in out.columns])
    kept = out.select(F.inline(F.filter(F.array(row), lambda r: r["_keep"])))
    return kept.drop("_keep")


def crawl(pages: DataFrame, counters: Counters | None = None, seeds: DataFrame | None = None) -> dict[str, DataFrame]:
    """All GESIS entities from a page table ``(url, html)``; ``seeds`` as in ``seed_pages``."""
    p = pages.select("url", "html")
    seeds = cut_lineage(with_nodes(seed_pages(p, "gesis", ROUTES, "overview", seeds), counters=counters), "seeds")
    orgs = extract_organization(seeds.where(F.col("kind") == "organization"))
    div_pages = with_nodes(follow_links(dedup_requests(division_links(seeds.where(F.col("kind") == "overview")),
                                                       "url"), p, "url"), counters=counters)
    division, people = extract_division(div_pages)
    linked = people.where(F.col("link").isNotNull())
    # Each person page is fetched and parsed once, however many contacts link to it.
    person_pages = follow_links(dedup_requests(linked.select(F.col("link").alias("url")), "url"), p, "url")
    fetched = person_pages.select(F.col("url").alias("source_url"))
    merged = linked.join(fetched, linked.link == fetched.source_url, "inner")
    # a person linked by several contacts is one person: the first contact of the first division counts
    once = first_of(merged, "source_url", ["division_url", "contact_pos"], ["name", "firstname", "lastname", "title"])
    persons = (once
               .unionByName(people.where(F.col("link").isNull())
                            .select(F.lit(None).cast("string").alias("source_url"), "name", "firstname",
                                    "lastname", "title")))
    roles = merged.select(F.col("division_url").alias("source_url"), F.lit("Leiter").alias("name"),
                          F.col("source_url").alias("person_url"), "division_url")
    pubs = extract_publications(with_nodes(person_pages, counters=counters), counters)
    return {"Organization": orgs, "Division": division, "DivisionRole": roles, "Person": persons,
            "Publication": pubs}
