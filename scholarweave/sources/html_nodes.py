"""Page -> node array (H0): the one Python stage of the page pipeline.

Each page's HTML is parsed once, in a ``mapInArrow`` stage (``parse_pages``), into
``array<struct<pos, parent, end, depth, nth, kind, tag, attrs, text>>`` in
document order.  Elements and text nodes are separate nodes (``kind``), so
"first text child" stays addressable.  ``end`` is the position of an element's
last descendant: ``n`` is inside ``e`` iff ``e.pos < n.pos <= e.end``.  ``nth``
is the 1-based position among same-tag element siblings (XPath ``tag[k]``).
``anc`` lists ancestor positions from the root down; ``pos`` equals the array
index, so an ancestor is an O(1) lookup ``nodes[a]``.  Below depth ``LEVELS`` it
holds only the ancestors past the last multiple of ``LEVELS``, and ``far`` the
last ancestor before each multiple, whose own ``anc`` goes on from there: all
ancestors stay reachable and no node stores more than its share of a deep chain.

Tree building follows the usual HTML recovery rules: void elements never
open, ``script``/``style`` are raw text, ``p``/``li``/``tr``/``td``/``dt``/
``dd``/``option`` close implicitly, and an end tag with no open element of
that name is ignored instead of draining the stack.  Comments are dropped.
A page that cannot be parsed yields NULL nodes; the job keeps going.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

NODE_TYPE = T.ArrayType(T.StructType([
    T.StructField("pos", T.IntegerType()), T.StructField("parent", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("depth", T.IntegerType()),
    T.StructField("nth", T.IntegerType()), T.StructField("kind", T.StringType()),
    T.StructField("tag", T.StringType()), T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("text", T.StringType()), T.StructField("anc", T.ArrayType(T.IntegerType())),
    T.StructField("far", T.ArrayType(T.IntegerType())),
]))

LEVELS = 512    # ancestors a node lists itself; a storage unit, not a limit
PARSE_BYTES = 1 << 20     # page text parsed at once: its nodes take several hundred times that in Python objects

# HTML element classes that drive tree recovery.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr", "keygen", "command", "basefont", "frame", "isindex"}
CLOSES_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form",
            "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "menu", "nav", "ol", "p", "pre",
            "section", "table", "ul", "figure", "figcaption", "main", "details", "dd", "dt", "li"}
P_SCOPE_STOP = {"button", "td", "th", "table", "caption", "marquee", "object", "html", "body",
                "li", "div", "article", "section", "nav", "aside", "header", "footer", "blockquote",
                "form", "dd", "dt"}
IMPLIED = {  # opening tag -> (tags it closes, tags that stop the search)
    "li": ({"li"}, {"ul", "ol", "menu", "table", "body"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "body"}),
    "dd": ({"dt", "dd"}, {"dl", "table", "body"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist", "body"}),
}


class _TreeBuilder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[dict] = []
        self.stack: list[int] = []           # positions of open elements
        self.child_tags: list[dict] = [{}]   # per open element (and root): tag -> count
        self.barrier = True                  # a node or comment since the last text

    def _parent(self) -> int:
        return self.stack[-1] if self.stack else -1

    def _ancestors(self) -> dict:
        depth = len(self.stack)
        return {"anc": self.stack[depth - depth % LEVELS:], "far": self.stack[LEVELS - 1::LEVELS]}

    def _close_to(self, idx: int) -> None:
        """Pop the open elements down to and including stack index ``idx``."""
        last = len(self.nodes) - 1
        while len(self.stack) > idx:
            pos = self.stack.pop()
            self.child_tags.pop()
            self.nodes[pos]["end"] = last

    def _find_open(self, tags: set[str], stop: set[str]) -> int | None:
        for i in range(len(self.stack) - 1, -1, -1):
            t = self.nodes[self.stack[i]]["tag"]
            if t in tags:
                return i
            if t in stop:
                return None
        return None

    def handle_comment(self, data):
        self.barrier = True

    def handle_starttag(self, tag, attrs):
        tag = tag.lower()
        self.barrier = True
        if tag in CLOSES_P:
            i = self._find_open({"p"}, P_SCOPE_STOP)
            if i is not None:
                self._close_to(i)
        if tag in IMPLIED:
            closes, stop = IMPLIED[tag]
            i = self._find_open(closes, stop)
            if i is not None:
                self._close_to(i)
        counts = self.child_tags[-1]
        counts[tag] = counts.get(tag, 0) + 1
        pos = len(self.nodes)
        amap = {}
        for k, v in attrs:
            if k not in amap:
                amap[k] = "" if v is None else v
        self.nodes.append({"pos": pos, "parent": self._parent(), "end": pos, "depth": len(self.stack),
                           "nth": counts[tag], "kind": "element", "tag": tag, "attrs": amap, "text": None,
                           **self._ancestors()})
        if tag not in VOID:
            self.stack.append(pos)
            self.child_tags.append({})

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag.lower() not in VOID and self.stack and self.nodes[self.stack[-1]]["tag"] == tag.lower():
            self._close_to(len(self.stack) - 1)

    def handle_endtag(self, tag):
        tag = tag.lower()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.nodes[self.stack[i]]["tag"] == tag:
                self._close_to(i)
                self.barrier = True
                return
        # unmatched end tag: ignored, the open elements stay open

    def handle_data(self, data):
        if not data:
            return
        last = self.nodes[-1] if self.nodes else None
        if not self.barrier and last is not None and last["kind"] == "text" \
                and last["parent"] == self._parent():
            last["text"] += data   # text split only by an ignored tag is one DOM text node
            return
        self.barrier = False
        pos = len(self.nodes)
        self.nodes.append({"pos": pos, "parent": self._parent(), "end": pos, "depth": len(self.stack),
                           "nth": None, "kind": "text", "tag": None, "attrs": None, "text": data,
                           **self._ancestors()})

    def finish(self) -> list[dict]:
        self.close()
        self._close_to(0)
        return self.nodes


def parse_html(html: str | None) -> list[dict] | None:
    """Plain-Python parse of one page (also used by tests)."""
    if html is None:
        return None
    try:
        b = _TreeBuilder()
        b.feed(html)
        return b.finish()
    except Exception:  # noqa: BLE001 - one malformed page must not fail the job
        return None


_INT_FIELDS = ("pos", "parent", "end", "depth", "nth")


def nodes_arrow(htmls: list) -> pa.Array:
    """Parse a batch of pages straight into an Arrow ``NODE_TYPE`` column.

    Fields are gathered into flat per-field lists and assembled with offsets,
    so no per-node Python dict is converted by Arrow.  Text nodes get an empty
    attribute map; an unparsable page gets a NULL node list.
    """
    ints = {f: [] for f in _INT_FIELDS}
    kinds, tags, texts = [], [], []
    a_off, a_keys, a_vals = [0], [], []
    lists = {f: ([0], []) for f in ("anc", "far")}
    node_off, page_null = [0], []
    for h in htmls:
        nodes = parse_html(h)
        if nodes is None:
            node_off.append(node_off[-1])
            page_null.append(True)
            continue
        for n in nodes:
            for f in _INT_FIELDS:
                ints[f].append(n[f])
            kinds.append(n["kind"])
            tags.append(n["tag"])
            texts.append(n["text"])
            if n["attrs"]:
                a_keys.extend(n["attrs"].keys())
                a_vals.extend(n["attrs"].values())
            a_off.append(len(a_keys))
            for f, (offsets, values) in lists.items():
                values.extend(n[f])
                offsets.append(len(values))
        node_off.append(node_off[-1] + len(nodes))
        page_null.append(False)
    struct = pa.StructArray.from_arrays(
        [pa.array(ints[f], pa.int32()) for f in _INT_FIELDS]
        + [pa.array(kinds, pa.string()), pa.array(tags, pa.string()),
           pa.MapArray.from_arrays(pa.array(a_off, pa.int32()), pa.array(a_keys, pa.string()),
                                   pa.array(a_vals, pa.string())),
           pa.array(texts, pa.string())]
        + [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
           for offsets, values in lists.values()],
        names=[*_INT_FIELDS, "kind", "tag", "attrs", "text", *lists])
    return pa.ListArray.from_arrays(pa.array(node_off, pa.int32()), struct, mask=pa.array(page_null))


def _slices(batch: pa.RecordBatch, column: str, limit: int):
    """Parts of a batch with at most ``limit`` bytes in a column each, or one longer value."""
    lo = total = 0
    for i, size in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        if i > lo and total + (size or 0) > limit:
            yield batch.slice(lo, i - lo)
            lo, total = i, 0
        total += size or 0
    if lo < batch.num_rows:
        yield batch.slice(lo)


def parse_pages(df: DataFrame, html: str = "html", out: str = "nodes") -> DataFrame:
    """Replace the ``html`` column by its node array with ``mapInArrow`` (H0).

    Arrow record batches go to the Python worker and come back with the
    ``nodes`` column built from flat arrays; every other column passes through.
    A batch of large pages is parsed in slices of about PARSE_BYTES.
    """
    keep = [f for f in df.schema.fields if f.name != html]
    schema = T.StructType(keep + [T.StructField(out, NODE_TYPE, True)])
    names = [f.name for f in keep]

    def run(batches):
        for batch in batches:
            for b in _slices(batch, html, PARSE_BYTES):
                cols = [b.column(n) for n in names]
                nodes = nodes_arrow(b.column(html).to_pylist())
                yield pa.RecordBatch.from_arrays(cols + [nodes], names=names + [out])

    return df.mapInArrow(run, schema)
