"""ZBW: organisation (E12), division links (E13), division + contact + role (E14),
person positions (E15), publications (E16).  Hops: overview -> division -> person
-> publications, as chained equi joins (J1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarweave.functions import html as H
from scholarweave.functions import names as N
from scholarweave.functions import text as T
from scholarweave.operators.counters import Counters
from scholarweave.plans.sites._sel import NODES, all_text, desc, el, find, hrefs, kids, nodes_of, nth_el, text, texts
from scholarweave.session import cut_lineage
from scholarweave.sources.pages import dedup_requests, first_of, follow_links, seed_pages, with_nodes

ROOT = "http://www.zbw.eu"
ROUTES = [("impressum", "organization")]


def _fix(url) -> F.Column:
    return T.resolve_url(url, None, ROOT)


def _boxes(scope) -> F.Column:
    return desc(scope, H.has_class("csc-default", "box"))


def extract_organization(pages: DataFrame) -> DataFrame:
    content = find(H.has_id("c165"))
    names, address, contact = texts(kids(content, nth_el("p", 1))), texts(kids(content, nth_el("p", 2))), \
        texts(kids(content, nth_el("p", 3)))
    a1 = T.strip(F.get(address, 1))
    return pages.select(
        F.col("url").alias("source_url"), T.strip(F.get(names, 0)).alias("name"),
        T.strip(F.get(address, 0)).alias("street_address"),
        F.get(F.split(a1, " "), 0).alias("postal_code"), F.get(F.split(a1, " "), 1).alias("city"),
        T.first_match(T.strip(F.get(contact, 0)), T.PHONE_RUN_NARROW).alias("phone"),
        T.first_match(T.strip(F.get(contact, 1)), T.PHONE_RUN_NARROW).alias("fax"),
        text(kids(kids(content, nth_el("p", 3)), el("a"))).alias("email"))


def division_links(pages: DataFrame) -> DataFrame:
    box = _boxes(find(H.has_id("content_main")))
    links = desc(desc(box, H.has_class("bodytext")), el("a"))
    return pages.select(F.explode(hrefs(links)).alias("href")).select(_fix(F.col("href")).alias("url"))


def extract_division(pages: DataFrame) -> DataFrame:
    """One row per division page: division fields, contact person fields, role."""
    info = _boxes(find(H.has_id("content_main")))
    vcard = desc(find(H.has_id("content_right")), H.has_class("vcard"))
    fn = text(desc(desc(vcard, H.has_class("name")), H.has_class("fn")))
    adr = desc(vcard, H.has_class("adr"))
    url = _fix(F.array_join(hrefs(kids(vcard, el("a", H.attr_is("class", "url")))), ""))
    nm = N.split_name(fn, N.FIRST_LAST)
    return pages.select(
        F.col("url").alias("source_url"),
        text(desc(info, H.has_class("csc-firstHeader"))).alias("name"),
        T.remove_spam_guard(all_text(kids(info, el("p")))).alias("description"),
        F.struct(fn.alias("name"), nm["firstname"].alias("firstname"), nm["lastname"].alias("lastname"),
                 text(desc(vcard, H.has_class("title"))).alias("title"),
                 T.strip_phone_label(text(desc(vcard, H.has_class("tel")))).alias("phone"),
                 text(desc(adr, H.has_class("street-address"))).alias("street_address"),
                 text(desc(adr, H.has_class("postal-code"))).alias("postal_code"),
                 text(desc(adr, H.has_class("locality"))).alias("city"),
                 url.alias("person_url")).alias("contact"))


def extract_person_page(pages: DataFrame) -> DataFrame:
    """Positions under the box headed ``Funktion`` (last such box wins) and the publications link."""
    boxes = _boxes(find(H.has_id("content_main")))
    per_box = F.transform(nodes_of(boxes), lambda b: F.struct(
        text(desc(desc(F.array(b), H.has_class("csc-header")), el("h2"))).alias("title"),
        all_text(kids(F.array(b), el("p"))).alias("p_text"),
        texts(kids(kids(F.array(b), el("ul")), el("li"))).alias("li_texts")))
    funk = F.try_element_at(F.filter(per_box, lambda x: x["title"] == "Funktion"), F.lit(-1))
    positions = F.when(funk.isNotNull(), F.concat(
        F.when(funk["p_text"] != "", F.array(funk["p_text"])).otherwise(F.array().cast("array<string>")),
        funk["li_texts"]))
    main_boxes = kids(find(H.has_id("content_main")), el("div", H.attr_is("class", "csc-default box")))
    link = F.get(hrefs(kids(kids(main_boxes, el("p")), el("a"))), 0)
    return pages.select(F.col("url").alias("source_url"), positions.alias("position"),
                        _fix(link).alias("publications_url"))


def extract_publications(pages: DataFrame) -> DataFrame:
    """``li`` items: bold text = title, first text after the bold = year."""
    lis = desc(_boxes(find(H.has_id("content"))), el("li"))

    def item(li):
        bold = F.filter(H.subtree(NODES, li), H.element("b"))
        year = F.transform(bold, lambda x: F.coalesce(H.following_text_sibling(NODES, x)["text"], F.lit("")))
        title = F.transform(bold, lambda x: H.subtree_text(NODES, x))
        return F.struct(F.array_join(title, "").alias("title"), F.array_join(year, "").alias("year"))

    # only finished items are exploded, never the page's nodes
    out = pages.select("url", "person_url", F.inline(F.transform(nodes_of(lis), item)))
    return out.select(T.stable_record_key(F.col("url"), F.col("title"), F.col("year")).alias("source_url"),
                      "title", "year", "person_url")


def crawl(pages: DataFrame, counters: Counters | None = None, seeds: DataFrame | None = None) -> dict[str, DataFrame]:
    """All ZBW entities from a page table ``(url, html)``; ``seeds`` as in ``seed_pages``."""
    p = pages.select("url", "html")
    seeds = cut_lineage(with_nodes(seed_pages(p, "zbw", ROUTES, "overview", seeds), counters=counters), "seeds")
    orgs = extract_organization(seeds.where(F.col("kind") == "organization"))
    div_urls = dedup_requests(division_links(seeds.where(F.col("kind") == "overview")), "url")
    div_pages = with_nodes(follow_links(div_urls, p, "url"), counters=counters)
    divs = cut_lineage(extract_division(div_pages), "divisions")
    division = divs.select("source_url", "name", "description")
    roles = divs.select(F.col("source_url"), F.lit("Leiter").alias("name"),
                        F.col("contact.person_url").alias("person_url"), F.col("source_url").alias("division_url"))
    contacts = divs.select(F.col("contact.*"), F.col("source_url").alias("division_url"))
    person_pages = with_nodes(follow_links(dedup_requests(contacts.select(F.col("person_url").alias("url")), "url"),
                                           p, "url"), counters=counters)
    pinfo = cut_lineage(extract_person_page(person_pages), "persons")
    # a person linked from several divisions is one person: the first division's contact box counts
    fields = ["name", "firstname", "lastname", "title", "phone", "street_address", "postal_code", "city"]
    contacts = first_of(contacts, "person_url", ["division_url"], fields)
    persons = contacts.join(pinfo, contacts.person_url == pinfo.source_url, "inner").select(
        "source_url", "name", "firstname", "lastname", "title", "phone", "street_address", "postal_code", "city",
        "position")
    pub_req = pinfo.select(F.col("publications_url").alias("url"), F.col("source_url").alias("person_url"))
    # a publications page that several persons share is requested once (A5)
    pub_req = pub_req.groupBy("url").agg(F.min("person_url").alias("person_url"))
    pub_pages = with_nodes(follow_links(pub_req, p, "url"), counters=counters)
    pubs = extract_publications(pub_pages)
    return {"Organization": orgs, "Division": division, "DivisionRole": roles, "Person": persons,
            "Publication": pubs}
