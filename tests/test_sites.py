"""Hand-written mini-sites for the four extraction jobs (FIXTURES.md D; SURVEY §5 f)."""

import json

import pytest

from scholarweave.plans.sites import gesis, hiig, knowcenter, zbw
from scholarweave.sources.pages import seed_urls

ZBW = {
    "http://www.zbw.eu/de/impressum/":
        '<html><body><div id="c165"><p>ZBW - Leibniz-Informationszentrum Wirtschaft<br>Stiftung</p>'
        '<p> Düsternbrooker Weg 120 <br> 24105 Kiel </p>'
        '<p>Tel: +49 431 8814-555<br>Fax: +49 431 8814-520<br><a href="mailto:info@zbw.eu">info@zbw.eu</a></p>'
        '</div></body></html>',
    "http://www.zbw.eu/de/forschung/":
        '<div id="content_main"><div class="csc-default box"><p class="bodytext">'
        '<a href="/de/forschung/div1/">Div 1</a> and <a href="http://www.zbw.eu/de/forschung/div2/">Div 2</a>'
        '</p></div></div>',
    "http://www.zbw.eu/de/forschung/div1/":
        '<div id="content_main"><div class="csc-default box"><h1 class="csc-firstHeader">Web Science</h1>'
        '<p>Mail x@ remove-this.zbw.eu <b>now</b></p></div></div>'
        '<div id="content_right"><div class="vcard"><div class="name"><span class="fn">Klaus Tochtermann</span></div>'
        '<span class="title">Prof. Dr.</span><span class="tel">T:&nbsp;+49 431 8814-333</span>'
        '<div class="adr"><span class="street-address">Weg 1</span><span class="postal-code">24105</span>'
        '<span class="locality">Kiel</span></div><a class="url" href="/de/personen/kt/">Profil</a></div></div>',
    "http://www.zbw.eu/de/forschung/div2/":
        '<div id="content_main"><div class="csc-default box"><h1 class="csc-firstHeader">Data</h1></div></div>'
        '<div id="content_right"><div class="vcard"><div class="name"><span class="fn">Ann Gone</span></div>'
        '<a class="url" href="/de/personen/missing/">Profil</a></div></div>',
    "http://www.zbw.eu/de/personen/kt/":
        '<div id="content_main"><div class="csc-default box"><div class="csc-header"><h2>Funktion</h2></div>'
        '<p>Direktor <b>ZBW</b></p><ul><li>Professor</li><li>Leiter</li></ul></div>'
        '<div class="csc-default box"><p><a href="/de/publikationen/kt/">Publikationen</a></p></div></div>',
    "http://www.zbw.eu/de/publikationen/kt/":
        '<div id="content"><div class="csc-default box"><ul><li><b>Open Data</b> 2012, Journal</li>'
        '<li>Intro <b>Linked <i>Science</i></b> 2013 <em>x</em></li></ul></div></div>',
}

GESIS_PERSON = "http://www.gesis.org/personen/mm/"
GESIS = {
    seed_urls("gesis")[0]:
        '<div id="col3"><div class="csc-default"><p>Unter Sachsenhausen 6-8<br>50667&nbsp;Köln</p>'
        '<p>Tel.: +49 (0)221 47694-0<br>Fax: +49 (0)221 47694-199</p></div></div>',
    seed_urls("gesis")[1]:
        '<div id="c12546"><ul><li><a href="../ki/">KI</a></li></ul></div>',
    "http://www.gesis.org/forschung/ki/":
        '<div id="main"><div id="col3"><div class="csc-default"><h1>Knowledge Technologies</h1>'
        '<p>We do <b>KT</b>.</p><div><p>More.</p></div></div></div>'
        '<div id="col2"><div class="contact"><p><strong><a href="personen/mm/">Prof. Dr. Maria Muster</a>'
        '</strong></p></div><div class="contact"><p><strong><a>Hans Ohnelink</a></strong></p></div></div></div>',
    GESIS_PERSON:
        '<div class="gs_publication"><div class="gs_publication_list"><div class="gs_publication_list">'
        '<h3>Monographien</h3><p>Muster, Maria; Roe, Jane (2012): Ein Buch. Verlag, Bonn '
        '<a href="http://dx.doi.org/10.1/abc">DOI</a></p></div><div class="gs_publication_list">'
        '<h3>Vorträge und Veranstaltungen</h3>'
        '<p>Muster, Maria (2013): Talk title. Big Conference. Berlin, 05.09. 2013.</p>'
        '<p>Muster, Maria (2014): Nur Titel 2014.</p></div></div></div>',
}

HIIG = {
    seed_urls("hiig")[0]: "<html><head><title>Organisation | HIIG Institut </title></head><body></body></html>",
    seed_urls("hiig")[1]:
        '<ul id="menu-staff"><li><a>Team</a><ul><li><a href="http://www.hiig.de/personen/anna/">Anna</a></li>'
        '<li><a href="http://www.hiig.de/personen/bob/">Bob</a></li></ul></li></ul>',
    "http://www.hiig.de/personen/anna/":
        '<div id="main"><div><div><h1>Anna Schmidt, Dr.</h1></div></div></div>'
        '<div id="secondary"><div class="kontakt"><div class="var_shbio">Raum 1 T. +49 030 200760-1 '
        '<a href="mailto:anna|a|hiig.de">Mail</a><a href="http://anna.example">Web</a></div></div>'
        '<div class="research"><div class="staff_position">Researcher</div></div></div>',
    "http://www.hiig.de/personen/bob/": '<div id="main"><div><div><h1>Bob Jones</h1></div></div></div>',
    seed_urls("hiig")[2]:
        '<div id="content"><h3>Wissenschaftliche Artikel</h3>'
        '<div class="publication-APA">Schmidt, A., &amp; Jones, B. (2014). A study. <em>Journal X</em>'
        '<a href="http://www.hiig.de/publication/a-study/">more</a></div>'
        '<h3>Sonstige Publikationen</h3>'
        '<div class="publication-APA">Roe, J. (2015). Blog post 1). Remark. <em>Blog</em>'
        '<a href="http://www.hiig.de/publication/blog/">more</a></div>'
        '<h3>Buchbeiträge</h3>'
        '<div class="publication-APA">Jones, B. (2013). Chapter title In Editors (Eds.), <em>Book</em>, pp.12-34.'
        ' Berlin.<a href="http://www.hiig.de/publication/missing/">more</a></div></div>',
    "http://www.hiig.de/publication/a-study/":
        '<div id="content"><div><table><tr><td>A</td><td><span>Schmidt, Anna &amp; Jones, Bob</span></td></tr>'
        '<tr><td>Q</td><td><span>x</span></td></tr><tr><td>J</td><td><span> 2014 </span></td></tr>'
        '<tr><td>T</td><td><span>Zeitschriftenartikel</span></td></tr></table>'
        '<article><p>Abstract text.</p></article></div></div>'
        '<div id="secondary"><ul><li><a href="http://www.hiig.de/personen/anna/">Anna Schmidt, Dr.</a></li></ul></div>',
    "http://www.hiig.de/publication/blog/":
        '<div id="content"><div><table><tr><td>A</td><td><span>Roe, Jim</span></td></tr>'
        '<tr><td>Q</td><td><span>x</span></td></tr><tr><td>J</td><td><span>2015</span></td></tr>'
        '<tr><td>T</td><td><span>Blogbeitrag</span></td></tr></table></div></div>',
}


def _pages(spark, site):
    return spark.createDataFrame(sorted(site.items()), "url string, html string")


_CRAWLS = {}


def _crawl(spark, name):
    """Each mini-site is crawled once per test session; outputs are cached."""
    if name not in _CRAWLS:
        mod, site = {"zbw": (zbw, ZBW), "gesis": (gesis, GESIS), "hiig": (hiig, HIIG)}[name]
        _CRAWLS[name] = {k: v.cache() for k, v in mod.crawl(_pages(spark, site)).items()}
    return _CRAWLS[name]


def _rows(df, key="source_url"):
    return {r[key]: r.asDict(recursive=True) for r in df.collect()}


def test_zbw(spark):
    out = _crawl(spark, "zbw")
    org = out["Organization"].collect()[0]
    assert (org.name, org.street_address, org.postal_code, org.city) == \
        ("ZBW - Leibniz-Informationszentrum Wirtschaft", "Düsternbrooker Weg 120", "24105", "Kiel")
    assert (org.phone, org.fax, org.email) == ("+49", "+49", "info@zbw.eu")
    divs = _rows(out["Division"])
    assert divs["http://www.zbw.eu/de/forschung/div1/"]["name"] == "Web Science"
    assert divs["http://www.zbw.eu/de/forschung/div1/"]["description"] == "Mail x@zbw.eu now"
    assert set(divs) == {"http://www.zbw.eu/de/forschung/div1/", "http://www.zbw.eu/de/forschung/div2/"}
    roles = {r.person_url for r in out["DivisionRole"].collect()}
    assert roles == {"http://www.zbw.eu/de/personen/kt/", "http://www.zbw.eu/de/personen/missing/"}
    persons = _rows(out["Person"])
    assert list(persons) == ["http://www.zbw.eu/de/personen/kt/"]     # the missing page yields no person
    kt = persons["http://www.zbw.eu/de/personen/kt/"]
    assert (kt["firstname"], kt["lastname"], kt["title"], kt["phone"]) == ("Klaus", "Tochtermann", "Prof. Dr.",
                                                                         "+49 431 8814-333")
    assert kt["position"] == ["Direktor ZBW", "Professor", "Leiter"]
    pubs = sorted((r.title, r.year, r.person_url) for r in out["Publication"].collect())
    assert pubs == [("Linked Science", " 2013 ", "http://www.zbw.eu/de/personen/kt/"),
                    ("Open Data", " 2012, Journal", "http://www.zbw.eu/de/personen/kt/")]
    keys = [r.source_url for r in out["Publication"].collect()]
    assert all(k.startswith("http://www.zbw.eu/de/publikationen/kt/#") for k in keys) and len(set(keys)) == 2


def test_gesis(spark):
    out = _crawl(spark, "gesis")
    org = out["Organization"].collect()[0]
    assert (org.name, org.street_address, org.postal_code, org.city) == \
        (gesis.ORG_NAME, "Unter Sachsenhausen 6-8", "50667", "Köln")
    assert org.phone == " +49 (0)221 47694-0" and org.fax == " +49 (0)221 47694-199"
    div = out["Division"].collect()[0]
    assert (div.source_url, div.name, div.description) == \
        ("http://www.gesis.org/forschung/ki/", "Knowledge Technologies", "We do KT.More.")
    persons = sorted((r.source_url or "", r.firstname, r.lastname, r.title) for r in out["Person"].collect())
    assert persons == [("", "Hans", "Ohnelink", ""), (GESIS_PERSON, "Maria", "Muster", "Prof. Dr.")]
    role = out["DivisionRole"].collect()
    assert [(r.source_url, r.name, r.person_url) for r in role] == \
        [("http://www.gesis.org/forschung/ki/", "Leiter", GESIS_PERSON)]
    pubs = _rows(out["Publication"], "title")
    assert set(pubs) == {"Ein Buch", "Talk title"}
    book, talk = pubs["Ein Buch"], pubs["Talk title"]
    assert book["source_url"] == "10.1/abc" and book["year"] == "2012" and book["publication_type"] == "Academic Article"
    assert [tuple(x.values()) for x in book["author_names"]] == [("Maria", "Muster"), ("Jane", "Roe")]
    assert (talk["published_in"], talk["location"], talk["publication_type"]) == \
        ("Big Conference", " Berlin", "Conference Paper")
    assert talk["source_url"].startswith(GESIS_PERSON + "#") and len(talk["source_url"]) == len(GESIS_PERSON) + 33


def test_hiig(spark):
    out = _crawl(spark, "hiig")
    assert [r.name for r in out["Organization"].collect()] == ["HIIG Institut"]
    persons = _rows(out["Person"])
    anna = persons["http://www.hiig.de/personen/anna/"]
    assert (anna["firstname"], anna["lastname"], anna["title"]) == ("Anna", "Schmidt", "Dr.")
    assert (anna["phone"], anna["email"], anna["web"], anna["position"]) == \
        ("+49 030 200760-1 ", "anna@hiig.de", "http://anna.example", ["Researcher"])
    assert persons["http://www.hiig.de/personen/bob/"]["title"] is None
    pubs = _rows(out["Publication"])
    study = pubs["http://www.hiig.de/publication/a-study/"]
    assert (study["title"], study["year"], study["publication_type"], study["published_in"]) == \
        (" A study. ", "2014", "Academic Article", "Journal X")
    assert study["author_urls"] == ["http://www.hiig.de/personen/anna/"]
    assert [tuple(x.values()) for x in study["author_names"]] == [("Bob", "Jones")]
    assert study["abstract"] == "Abstract text."
    blog = pubs["http://www.hiig.de/publication/blog/"]
    assert (blog["title"], blog["publication_type"], blog["year"]) == (" Blog post 1). Remark. ", "Blogbeitrag", "2015")
    chap = pubs["http://www.hiig.de/publication/missing/"]          # detail page missing: list row kept
    assert (chap["title"], chap["startpage"], chap["endpage"], chap["year"]) == (" Chapter title ", "12", "34", "2013")
    assert chap["author_urls"] is None and chap["publication_type"] == "Article"


def test_knowcenter(spark):
    def f(i, v):
        return {"@id": i, "values": v}
    feed = {"DataSet": {"documents": {"document": [
        {"features": {"feature": [
            f("title_DE", {"value": "Erster"}), f("authors", {"value": ["Roe Jane", "Doe John"]}),
            f("publicationTypeId", {"value": 5}), f("vispagename", {"value": "a b/c"}),
            f("publisher", {"value": ["P1", "P2"]}), f("organ", {"value": ["O1", "O2"]}),
            f("documentPhrases", {"value": ["x", "y"]}), f("phrases", {"value": ["z"]}),
            f("year", "2011"), f("location", ""), f("mystery", {"value": 1}), f("title_DE", {"value": "Final"})]}},
        {"features": {"feature": [f("authors", {"value": "Solo Han"}), f("publicationTypeId", {"value": 42})]}},
    ]}}}
    feeds = spark.createDataFrame([(knowcenter.FEED_URL, json.dumps(feed))], "url string, body string")
    pubs = {r.doc_pos: r.asDict(recursive=True) for r in knowcenter.crawl(feeds)["Publication"].collect()}
    a = pubs[0]
    assert a["title"] == "Final" and a["publication_type"] == "Chapter" and a["year"] == "2011"
    assert a["source_url"] == "http://oldknowsite.know-center.tugraz.at/publikationen/a%20b/c.html"
    assert (a["published_in"], a["organ"], a["phrases"], a["location"]) == ("P2", "O1, O2", "x,y,z", None)
    assert [tuple(x.values()) for x in a["author_names"]] == [("Jane", "Roe"), ("John", "Doe")]
    assert a["unknown_features"] == 1
    b = pubs[1]
    assert b["publication_type"] == "Academic Article"
    assert [tuple(x.values()) for x in b["author_names"]] == [("Han", "Solo")]


@pytest.mark.parametrize("name", ["zbw", "gesis", "hiig"])
def test_site_entities_feed_the_graph(spark, name):
    """Site output plugs into the ID/organisation/RDF pipeline unchanged."""
    from pyspark.sql import functions as F

    from scholarweave.plans.graph import build_graph
    out = _crawl(spark, name)
    org = out["Organization"].withColumn("source", F.lit("s"))
    empty_div = spark.createDataFrame([], "source_url string, name string")
    div = out.get("Division", empty_div).withColumn("source", F.lit("s"))
    pers = out["Person"]
    for c in ("email", "phone", "title"):
        if c not in pers.columns:
            pers = pers.withColumn(c, F.lit(None).cast("string"))
    if "position" not in pers.columns:
        pers = pers.withColumn("position", F.array().cast("array<string>"))
    pers = pers.withColumn("source", F.lit("s"))
    roles = out.get("DivisionRole", spark.createDataFrame([], "source_url string, name string, person_url string, "
                                                              "division_url string"))
    g = build_graph(org, div, pers, roles)
    assert g.triples.count() > 8


def test_run_site_end_to_end_and_stable_ids(spark):
    import os
    import tempfile

    from scholarweave.plans.pipeline import run_site
    out = tempfile.mkdtemp(prefix="sw-site-", dir="/tmp")
    reg = f"{out}/registry"
    first = run_site(spark, "zbw", _pages(spark, ZBW), out, reg)
    ids1 = {(r.source_url, r.item_type): r.id for r in spark.read.parquet(reg).collect()}
    assert ("http://www.zbw.eu/de/impressum/", "Organization") in ids1
    assert ("http://www.zbw.eu/de/personen/kt/", "Person") in ids1
    lines = spark.read.text(first.paths["rdf"]).collect()
    assert any("foaf/0.1/NonFacultyAcademic" in r.value for r in lines)
    assert os.path.isdir(first.paths["Person"]) and os.path.isdir(first.paths["Publication"])
    second = run_site(spark, "zbw", _pages(spark, ZBW), None, reg)       # a second run: no new IDs
    assert second.graph.new_registry_rows.count() == 0
    ids2 = {(r.source_url, r.item_type): r.id for r in spark.read.parquet(reg).collect()}
    assert ids2 == ids1
    assert sorted(r.value for r in lines) == sorted(
        r.line for r in __import__("scholarweave.operators.triples", fromlist=["x"]).ntriples_lines(
            second.graph.triples).collect())


def test_run_site_replaces_previous_output_of_the_source(spark):
    import tempfile

    from scholarweave.plans.pipeline import run_site
    out = tempfile.mkdtemp(prefix="sw-site-", dir="/tmp")
    run_site(spark, "hiig", _pages(spark, HIIG), out)
    pub_dir = f"{out}/hiig_Publication"
    opts = {"header": True, "escape": '"'}
    assert spark.read.options(**opts).csv(pub_dir).count() == 3
    no_pubs = {k: v for k, v in HIIG.items() if "publi" not in k}
    run_site(spark, "hiig", _pages(spark, no_pubs), out)
    assert spark.read.schema("source_url string").options(**opts).csv(pub_dir).count() == 0


def test_long_list_pages_are_cut_in_linear_time(spark):
    """2,000 list items under 40 headings on one page; only those under every other heading have a page range."""
    import time

    from scholarweave.sources.pages import with_nodes
    n, heads = 2000, ("Buchbeiträge", "Sonstige Publikationen")
    body = "".join((f"<h3>{heads[k // 50 % 2]}</h3>" if k % 50 == 0 else "") +
                   f'<div class="publication-APA">Roe, J. (2015). T{k} In E, <em>B{k}</em>, pp.{k}-{k + 1}. X.'
                   f'<a href="http://www.hiig.de/publication/{k}/">m</a></div>' for k in range(n))
    pages = spark.createDataFrame([(seed_urls("hiig")[2], f'<div id="content">{body}</div>')], "url string, html string")
    start = time.monotonic()
    rows = hiig.extract_publication_list(with_nodes(pages)).collect()
    assert time.monotonic() - start < 60
    got = {(r.item_pos, r.source_url, r.published_in, r.startpage) for r in rows}
    assert got == {(k, f"http://www.hiig.de/publication/{k}/", f"B{k}", None if k // 50 % 2 else str(k))
                   for k in range(n)}


def test_problems_are_counted_by_the_jobs_themselves(spark):
    """Exact counts of what a crawl could not use; a site without pages has counts of 0."""
    from scholarweave.operators.counters import Counters
    from scholarweave.plans.pipeline import crawl_site

    def problems(site, pages):
        counters = Counters()
        crawl_site(spark, site, pages, counters)
        return counters.totals()

    broken = "<p>a<![bad[x]]>b</p>"       # a marked section that no parser state knows
    hiig_site = {url: html.replace("<h3>Wissenschaftliche Artikel</h3>", "<h3>Neues</h3>") for url, html in HIIG.items()}
    changed = sum(hiig_site[u] != HIIG[u] for u in HIIG)
    gesis_site = {**GESIS, GESIS_PERSON: GESIS[GESIS_PERSON].replace("Monographien", "Neues")}
    zbw_site = {**ZBW, "http://www.zbw.eu/de/publikationen/kt/": broken,
                "http://www.zbw.eu/de/forschung/div2/": None}       # no text is no unparsable page
    feed = {"DataSet": {"documents": {"document": [
        {"features": {"feature": [{"@id": i, "values": "v"} for i in ("title_DE", "mystery", "mystery", "other")]}},
        {"features": {"feature": [{"@id": "vispagename", "values": "p"}]}}]}}}
    feeds = spark.createDataFrame([(knowcenter.FEED_URL, json.dumps(feed))], "url string, body string")
    p = {site: problems(site, pages) for site, pages in (
        ("zbw", _pages(spark, zbw_site)), ("gesis", _pages(spark, gesis_site)), ("hiig", _pages(spark, hiig_site)),
        ("knowcenter", feeds))}
    assert p["zbw"]["unparsable_pages"] == 1
    assert p["gesis"] == {"unparsable_pages": 0, "unknown_headings": 1, "unparsed_talks": 1, "items_without_key": 1}
    assert changed == 1 and p["hiig"]["unknown_headings"] == 1 and p["hiig"]["unparsable_pages"] == 0
    assert p["knowcenter"] == {"unknown_features": 3, "items_without_key": 1}
    # no page at all: every count is there, and nothing waits for a hop that Spark found empty
    assert set(problems("hiig", spark.createDataFrame([], "url string, html string")).values()) == {0}


def test_publications_get_ids(spark):
    from scholarweave.plans.pipeline import run_site
    run = run_site(spark, "zbw", _pages(spark, ZBW))
    keys = {r.source_url for r in run.graph.ids.where("item_type = 'Publication'").collect()}
    assert keys == {r.source_url for r in run.entities["Publication"].collect()} and len(keys) == 2


def test_sites_share_one_registry_and_one_graph(spark, tmp_path):
    from scholarweave.plans.pipeline import run_sites
    off = {"http://evil.example.com/d3": "<html><head><title>x</title></head></html>"}
    inputs = {"zbw": _pages(spark, {**ZBW, **off}), "hiig": _pages(spark, HIIG), "gesis": _pages(spark, GESIS)}
    run = run_sites(spark, inputs, str(tmp_path / "out"), str(tmp_path / "registry"))
    ids = [(r.item_type, r.source_url, r.id) for r in run.graph.ids.collect()]
    assert len({(t, i) for t, _, i in ids}) == len(ids) == len({(t, u) for t, u, _ in ids})
    assert {u for _, u, _ in ids} >= {r.source_url for r in run.entities["Publication"].collect()}
    counts = {(r.source, r.item_type): (r.n_items, r.exported) for r in run.counts.collect()}
    assert {s for s, _ in counts} == {"zbw", "hiig", "gesis"}
    assert counts["zbw", "Publication"] == (2, False) and counts["hiig", "Person"] == (2, True)
    people = {r.source_url: r.organization_id for r in run.graph.persons.collect()}
    orgs = {r.source: r.id for r in run.graph.organizations.collect()}
    assert len(orgs) == 3 and people["http://www.hiig.de/personen/bob/"] == orgs["hiig"]
    assert people["http://www.zbw.eu/de/personen/kt/"] == orgs["zbw"]
    again = run_sites(spark, inputs, None, str(tmp_path / "registry"))
    assert again.graph.new_registry_rows.count() == 0
    assert sorted((r.item_type, r.source_url, r.id) for r in again.graph.ids.collect()) == sorted(ids)
