"""HIIG: staff links (E6), organisation (E7), person (E8), publication list (E9),
publication detail merged onto the list row with a left join (E10, J2, J4, J5)."""

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
from scholarweave.sources.pages import dedup_requests, follow_links, merge_detail, seed_pages, with_nodes

ROUTES = [("organisation", "organization"), ("publi", "publications")]
# Fixed value: the site prefix cut from the organisation page title.
TITLE_PREFIX = "Organisation | "


def extract_organization(pages: DataFrame) -> DataFrame:
    html_el = find(H.all_of(H.element("html"), lambda n: n["parent"] == -1))
    title = text(kids(kids(html_el, el("head")), el("title")))
    return pages.select(F.col("url").alias("source_url"), T.cut_prefix(title, TITLE_PREFIX).alias("name"))


def staff_links(pages: DataFrame) -> DataFrame:
    menu = find(H.all_of(H.element("ul"), H.attr_is("id", "menu-staff")))
    a = kids(kids(kids(kids(menu, el("li")), el("ul")), el("li")), el("a"))
    return pages.select(F.explode(hrefs(a)).alias("url"))


def extract_person(pages: DataFrame) -> DataFrame:
    secondary = find(H.all_of(H.element("div"), H.attr_is("id", "secondary")))
    contact = kids(kids(secondary, el("div", H.attr_is("class", "kontakt"))), el("div", H.attr_is("class", "var_shbio")))
    main = find(H.all_of(H.element("div"), H.attr_is("id", "main")))
    name_full = text(kids(kids(kids(main, el("div")), el("div")), el("h1")))
    position = text(kids(kids(secondary, el("div", H.attr_is("class", "research"))),
                         el("div", H.attr_is("class", "staff_position"))))
    contact_text = text(contact)
    nt = N.split_name_title(name_full)
    nm = N.split_name(nt["name"], N.FIRST_LAST)
    links = hrefs(kids(contact, el("a")))
    mails = F.filter(links, lambda h: h.contains("mailto:"))
    webs = F.filter(links, lambda h: ~h.contains("mailto:"))
    return pages.select(
        F.col("url").alias("source_url"), nt["name"].alias("name"), nm["firstname"].alias("firstname"),
        nm["lastname"].alias("lastname"), nt["title"].alias("title"), F.array(position).alias("position"),
        T.phone_from_block(contact_text).alias("phone"),
        T.deobfuscate_email(F.try_element_at(mails, F.lit(-1))).alias("email"),
        F.try_element_at(webs, F.lit(-1)).alias("web"), nt["malformed"].alias("name_malformed"))


def extract_publication_list(pages: DataFrame) -> DataFrame:
    items = desc(find(H.has_id("content")), H.has_class("publication-APA"))

    def item(it, head):
        return F.struct(
            H.child_texts(NODES, it).alias("t"), H.step_text(NODES, H.children(NODES, it, el("em"))).alias("em"),
            F.get(H.children(NODES, it, el("a")), 0)["attrs"]["href"].alias("source_url"),
            F.coalesce(F.when(head.isNotNull(), F.array_join(H.child_texts(NODES, head), "")), F.lit("")).alias("heading"))

    # only finished items are exploded, never the page's nodes
    cut = H.with_preceding(NODES, items, H.element("h3"), item)           # H10
    rows = pages.select(F.posexplode(cut).alias("item_pos", "it")).select("item_pos", "it.*")
    cit = C.hiig_citation(F.get("t", 0), F.get("t", 1), F.col("em"), F.col("heading"))
    return rows.select(
        "source_url", "item_pos",
        cit["author_names"].alias("author_names"), cit["year"].alias("year"), cit["title"].alias("title"),
        cit["published_in"].alias("published_in"), cit["publication_type"].alias("publication_type"),
        cit["startpage"].alias("startpage"), cit["endpage"].alias("endpage"), cit["parsed_ok"].alias("parsed_ok"),
        C.classify(F.col("heading"), C.HIIG_TYPES).isNull().alias("unknown_heading"))


def extract_publication_detail(pages: DataFrame) -> DataFrame:
    table = kids(kids(find(H.has_id("content")), el("div")), el("table"))

    def cell(k: int):
        return kids(kids(kids(table, nth_el("tr", k)), nth_el("td", 2)), el("span"))

    authors = text(cell(1))
    names = N.split_names(authors, N.LAST_FIRST, r",\s*", r"\.,|&")
    pubtype = T.strip(text(cell(4)))
    src = texts(cell(2))
    chapter = pubtype.rlike(r"Buchbeitr.+ge")
    author_links = kids(kids(kids(find(H.has_id("secondary")), nth_el("ul", 1)), el("li")), el("a"))
    links = F.transform(nodes_of(author_links), lambda a: F.struct(
        F.get(H.direct_texts(NODES, F.array(a)), 0).alias("name"), a["attrs"]["href"].alias("url")))
    linked = N.link_authors(names, links)
    abstract = T.strip(text(kids(kids(kids(find(H.has_id("content")), el("div")), el("article")), el("p"))))
    return pages.select(
        F.col("url").alias("d_url"), T.strip(text(cell(3))).alias("d_year"), pubtype.alias("d_type"),
        F.when(chapter, C.publisher_of(F.get(src, 1))).alias("d_publisher"),
        F.when(chapter, F.array_join(texts(kids(cell(2), el("em"))), "")).alias("d_published_in"),
        linked["author_urls"].alias("d_author_urls"), linked["author_names"].alias("d_author_names"),
        abstract.alias("d_abstract"))


def crawl(pages: DataFrame, counters: Counters | None = None, seeds: DataFrame | None = None) -> dict[str, DataFrame]:
    """All HIIG entities from a page table ``(url, html)``; ``seeds`` as in ``seed_pages``."""
    p = pages.select("url", "html")
    seeds = cut_lineage(with_nodes(seed_pages(p, "hiig", ROUTES, "overview", seeds), counters=counters), "seeds")
    orgs = extract_organization(seeds.where(F.col("kind") == "organization"))
    person_pages = with_nodes(follow_links(dedup_requests(staff_links(seeds.where(F.col("kind") == "overview")),
                                                          "url"), p, "url"), counters=counters)
    persons = extract_person(person_pages)
    lst = extract_publication_list(seeds.where(F.col("kind") == "publications"))
    if counters is not None:
        lst = counters.watch(lst, unknown_headings=F.col("unknown_heading"))
    lst = cut_lineage(lst, "publications")
    # Details are requested per list item (dont_filter): fetch each URL's page once, join back per item.
    detail_pages = with_nodes(follow_links(lst.select(F.col("source_url").alias("url")).distinct(), p, "url"), counters=counters)
    det = cut_lineage(extract_publication_detail(detail_pages), "details")
    # The detail's year, authors and, if it names one, place of publication win; its type fills in
    pubs = merge_detail(lst, det, "source_url", "d_url",
                        wins={"year": "d_year", "author_names": "d_author_names"},
                        fills={"publication_type": "d_type"},
                        adds={"d_in": "d_published_in", "publisher": "d_publisher", "author_urls": "d_author_urls",
                              "abstract": "d_abstract"})
    pubs = pubs.withColumn("published_in", F.coalesce("d_in", "published_in")).select(
        "source_url", "title", "year", "publication_type", "published_in", "publisher", "startpage", "endpage",
        "author_urls", "author_names", "abstract", "parsed_ok")
    return {"Organization": orgs, "Person": persons, "Publication": pubs}
