"""Selectors over a page's node array (H1-H12), as higher-order functions.

A selector is a predicate ``node -> Column``; ``select`` filters the node
array with it.  Contexts are arrays of nodes, so ``within(ctxs)`` /
``child_of(ctxs)`` express descendant and child steps.  Everything is narrow:
no selector adds an exchange.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Pred = Callable[[Column], Column]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- predicates

def element(tag: str | None = None) -> Pred:
    if tag is None:
        return lambda n: n["kind"] == "element"
    return lambda n: (n["kind"] == "element") & (n["tag"] == tag.lower())


def text_node() -> Pred:
    return lambda n: n["kind"] == "text"


def has_id(value: str) -> Pred:
    """``#id`` (H1)."""
    return lambda n: F.coalesce(n["attrs"]["id"] == value, F.lit(False))


def has_class(*classes: str) -> Pred:
    """``.a`` / ``.a.b``: every class is a member of the whitespace-split class list (H1)."""
    wanted = sorted(set(classes))

    def p(n):
        toks = F.split(F.coalesce(n["attrs"]["class"], F.lit("")), r"\s+")
        if len(wanted) == 1:
            return F.array_contains(toks, wanted[0])
        # one split per node: every wanted class is present iff the intersection has them all
        return F.size(F.array_intersect(toks, F.array(*[F.lit(c) for c in wanted]))) == len(wanted)
    return p


def attr_is(name: str, value: str) -> Pred:
    """``[@name='value']``: whole-string equality (H5)."""
    return lambda n: F.coalesce(n["attrs"][name] == value, F.lit(False))


def has_attr(name: str) -> Pred:
    return lambda n: F.coalesce(F.map_contains_key(n["attrs"], F.lit(name)), F.lit(False))


def nth(k: int) -> Pred:
    """``tag[k]``: k-th same-tag sibling (H4); combine with ``element(tag)``."""
    return lambda n: n["nth"] == k


def all_of(*preds: Pred) -> Pred:
    def p(n):
        out = F.lit(True)
        for q in preds:
            out = out & q(n)
        return out
    return p


def any_of(*preds: Pred) -> Pred:
    """Union of paths ``a|b`` (H9): one filter, document order, no duplicates."""
    def p(n):
        out = F.lit(False)
        for q in preds:
            out = out | q(n)
        return out
    return p


def under(pred: Pred, nodes="nodes") -> Pred:
    """Descendant step by ancestry (H2): some ancestor matches ``pred``.

    ``pred`` is a node predicate, looked up through ``anc`` by index, so a
    chain of steps costs O(depth) per node and never re-filters the array.
    """
    arr = _c(nodes)

    def ancestors(n):
        higher = F.flatten(F.transform(n["far"], lambda a: F.concat(F.array(a), F.get(arr, a)["anc"])))
        return F.when(F.size(n["far"]) == 0, n["anc"]).otherwise(F.concat(higher, n["anc"]))
    return lambda n: F.exists(ancestors(n), lambda a: pred(F.get(arr, a)))


def parent_is(pred: Pred, nodes="nodes") -> Pred:
    """Child step by ancestry (H3): the parent matches ``pred``."""
    arr = _c(nodes)
    return lambda n: (n["parent"] >= 0) & F.coalesce(pred(F.get(arr, n["parent"])), F.lit(False))


def within(ctxs: Column) -> Pred:
    """Descendant step (H2): inside any node of an explicit context array.

    Use for per-row contexts (an exploded node); for selector chains use
    ``under`` so the context is not re-evaluated for every node.
    """
    return lambda n: F.exists(ctxs, lambda c: (n["pos"] > c["pos"]) & (n["pos"] <= c["end"]))


def child_of(ctxs: Column) -> Pred:
    """Child step (H3)."""
    return lambda n: F.exists(ctxs, lambda c: n["parent"] == c["pos"])


def self_or_within(ctxs: Column) -> Pred:
    """``descendant-or-self``."""
    return lambda n: F.exists(ctxs, lambda c: (n["pos"] >= c["pos"]) & (n["pos"] <= c["end"]))


# ---------------------------------------------------------------- node sets

def select(nodes, pred: Pred) -> Column:
    return F.filter(_c(nodes), pred)


def one(node: Column) -> Column:
    """Wrap a single node as a context array."""
    return F.array(node)


def first(nodes_arr: Column) -> Column:
    return F.get(nodes_arr, 0)


def attr(nodes_arr: Column, name: str) -> Column:
    """``@name`` of each node (H6)."""
    return F.transform(nodes_arr, lambda n: n["attrs"][name])


def texts(nodes, pred: Pred) -> Column:
    """Text values of the matching text nodes, in document order."""
    return F.transform(F.filter(_c(nodes), lambda n: (n["kind"] == "text") & pred(n)), lambda n: n["text"])


def _child_test(nodes, ctxs) -> Pred:
    return child_of(ctxs) if isinstance(ctxs, Column) else parent_is(ctxs, nodes)


def _inside_test(nodes, ctxs) -> Pred:
    return within(ctxs) if isinstance(ctxs, Column) else under(ctxs, nodes)


def direct_text(nodes, ctxs) -> Column:
    """``text()`` / ``::text`` of the contexts, joined with '' (H7).

    ``ctxs`` is a node predicate (resolved through the parent index) or an
    explicit context array.
    """
    return F.array_join(texts(nodes, _child_test(nodes, ctxs)), "")


def direct_texts(nodes, ctxs) -> Column:
    """The list form of ``text()`` (one entry per text node)."""
    return texts(nodes, _child_test(nodes, ctxs))


def all_text(nodes, ctxs) -> Column:
    """``//text()``: every descendant text, in document order, joined with '' (H8)."""
    return F.array_join(texts(nodes, _inside_test(nodes, ctxs)), "")


def subtree(nodes, ctx: Column) -> Column:
    """Descendants of one node: a contiguous slice, since ``pos`` is the array index."""
    return F.slice(_c(nodes), ctx["pos"] + 2, F.greatest(ctx["end"] - ctx["pos"], F.lit(0)))


def subtree_text(nodes, ctx: Column) -> Column:
    """``//text()`` of one node, O(size of its subtree) (H8)."""
    return F.array_join(F.transform(F.filter(subtree(nodes, ctx), lambda n: n["kind"] == "text"),
                                    lambda n: n["text"]), "")


def children(nodes, ctx: Column, pred: Pred) -> Column:
    """Child step of one node, O(size of its subtree) (H3)."""
    return F.filter(subtree(nodes, ctx), lambda n: (n["parent"] == ctx["pos"]) & pred(n))


def step(nodes, ctxs: Column, pred: Pred) -> Column:
    """Child step of several nodes that do not contain each other, in document order."""
    return F.flatten(F.transform(ctxs, lambda c: children(nodes, c, pred)))


def child_texts(nodes, ctx: Column) -> Column:
    """``text()`` of one node as a list, O(size of its subtree) (H7)."""
    return F.transform(children(nodes, ctx, text_node()), lambda n: n["text"])


def step_text(nodes, ctxs: Column) -> Column:
    """``text()`` of several nodes that do not contain each other, joined with '' (H7)."""
    return F.array_join(F.flatten(F.transform(ctxs, lambda c: child_texts(nodes, c))), "")


def preceding(nodes, ctx: Column, pred: Pred) -> Column:
    """``preceding::x[1]``: nearest node ending before ``ctx`` starts."""
    before = F.slice(_c(nodes), 1, F.greatest(ctx["pos"], F.lit(0)))
    cand = F.filter(before, lambda n: pred(n) & (n["end"] < ctx["pos"]))
    return F.try_element_at(cand, F.lit(-1))


def with_preceding(nodes, items: Pred, marks: Pred, build: Callable[[Column, Column], Column]) -> Column:
    """``build(item, mark)`` of every item with the nearest mark that ends before it, or NULL.

    One pass over the page's items and marks in document order: the item at place i that is the k-th
    item has i - k marks before it, so its mark is looked up, not searched.  Only an item inside a mark
    looks among the earlier ones.
    """
    both = F.transform(F.filter(_c(nodes), any_of(items, marks)), lambda n, i: F.struct(
        n.alias("n"), i.alias("i"), F.coalesce(items(n), F.lit(False)).alias("item")))

    def build_all(b):
        heads = F.transform(F.filter(b, lambda x: ~x["item"]), lambda x: x["n"])

        def one_item(x, k):
            last = x["i"] - k
            near = F.get(heads, last - 1)
            earlier = F.filter(F.slice(heads, F.lit(1), last), lambda h: h["end"] < x["n"]["pos"])
            before = F.when(last > 0, F.when(near["end"] < x["n"]["pos"], near).otherwise(
                F.try_element_at(earlier, F.lit(-1))))
            return build(x["n"], before)
        return F.transform(F.filter(b, lambda x: x["item"]), one_item)
    return F.flatten(F.transform(F.array(both), build_all))


def following_text_sibling(nodes, ctx: Column) -> Column:
    """``following-sibling::text()[1]``."""
    arr = _c(nodes)
    last = F.coalesce(F.get(arr, ctx["parent"])["end"], F.size(arr) - 1)
    after = F.slice(arr, ctx["end"] + 2, F.greatest(last - ctx["end"], F.lit(0)))
    return F.get(F.filter(after, lambda n: (n["kind"] == "text") & (n["parent"] == ctx["parent"])), 0)
