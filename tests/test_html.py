"""Selector semantics H1-H12 on one crafted page."""

from pyspark.sql import functions as F

from scholarweave.functions import html as H
from scholarweave.sources.html_nodes import parse_pages

PAGE = ('<html><body><div id="main" class="box wide">'
        '<h3>Head A</h3><ul><li>one</li><li>two <b>bold</b> tail</li></ul>'
        '<div class="box"><p>p1 <i>x</i></p><p>p2</p></div>'
        '<h3>Head B</h3><section><h3>Inner</h3><p class="apa">cite</p></section>'
        '<a href="/x" class="link">L</a></div></body></html>')


def _one(spark, *cols):
    df = parse_pages(spark.createDataFrame([(1, PAGE)], "page_id int, html string"))
    return df.select(*cols).first()


def test_class_membership_vs_exact_attribute(spark):
    r = _one(spark, F.size(H.select("nodes", H.has_class("box"))).alias("member"),
             F.size(H.select("nodes", H.attr_is("class", "box"))).alias("exact"),
             F.size(H.select("nodes", H.has_class("box", "wide"))).alias("both"))
    assert (r.member, r.exact, r.both) == (2, 1, 1)


def test_descendant_child_and_position(spark):
    main = H.has_id("main")
    r = _one(spark,
             H.direct_texts("nodes", H.all_of(H.element("li"), H.parent_is(H.element("ul")))).alias("li_text"),
             H.all_text("nodes", H.all_of(H.element("li"), H.nth(2))).alias("li2_all"),
             F.size(H.select("nodes", H.all_of(H.element("p"), H.under(main)))).alias("p_desc"),
             F.size(H.select("nodes", H.all_of(H.element("h3"), H.parent_is(main)))).alias("h3_child"),
             H.direct_text("nodes", H.all_of(H.element("p"), H.nth(2))).alias("p2"))
    assert r.li_text == ["one", "two ", " tail"]
    assert r.li2_all == "two bold tail"
    assert (r.p_desc, r.h3_child, r.p2) == (3, 2, "p2")


def test_union_document_order_no_duplicates(spark):
    sel = H.any_of(H.element("h3"), H.all_of(H.element("p"), H.has_class("apa")), H.element("h3"))
    r = _one(spark, F.transform(H.select("nodes", sel), lambda n: n["tag"]).alias("tags"))
    assert r.tags == ["h3", "h3", "h3", "p"]


def test_preceding_heading_excludes_ancestors_and_following_text(spark):
    cite = F.get(H.select("nodes", H.has_class("apa")), 0)
    bold = F.get(H.select("nodes", H.element("b")), 0)
    r = _one(spark, H.subtree_text("nodes", H.preceding("nodes", cite, H.element("h3"))).alias("head"),
             H.following_text_sibling("nodes", bold)["text"].alias("after_bold"))
    assert r.head == "Inner" and r.after_bold == " tail"


def test_attribute_values_and_absent_attribute(spark):
    r = _one(spark, H.attr(H.select("nodes", H.element("a")), "href").alias("hrefs"),
             H.attr(H.select("nodes", H.element("li")), "href").alias("none"))
    assert r.hrefs == ["/x"] and r.none == [None, None]


def test_large_pages_are_parsed_in_slices():
    import pyarrow as pa

    from scholarweave.sources.html_nodes import _slices
    batch = pa.RecordBatch.from_pydict({"k": [0, 1, 2, 3, 4], "html": ["x" * 3, None, "y" * 9, "", "z"]})
    assert [b.column("k").to_pylist() for b in _slices(batch, "html", 5)] == [[0, 1], [2], [3, 4]]
    assert [b.num_rows for b in _slices(batch.slice(0, 0), "html", 5)] == []


def test_parse_of_a_large_batch_takes_little_memory_at_once():
    import tracemalloc

    import pyarrow as pa

    from scholarweave.sources import html_nodes as P

    page = "<ul>" + "<li>a <a href='/x'>b</a></li>" * 200 + "</ul>"
    batch = pa.RecordBatch.from_arrays([pa.array([page] * 700)], names=["html"])
    nodes = 0
    tracemalloc.start()
    for part in P._slices(batch, "html", P.PARSE_BYTES):
        nodes += len(P.nodes_arrow(part.column("html").to_pylist()).flatten())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert nodes == 700 * 801 and peak < 100 << 20
