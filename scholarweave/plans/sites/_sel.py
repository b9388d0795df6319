"""Small composition helpers over a row's ``nodes`` array (steps of H1-H12).

A *selection* is either a node predicate (built with ``find``/``desc``/``kids``;
steps resolve through the ancestor chain, O(depth) per node) or an explicit
context array Column (e.g. ``H.one(col)`` for an exploded node).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scholarweave.functions import html as H

NODES = "nodes"   # resolved lazily: no session is needed at import


def find(pred):
    """``//x`` over the whole page."""
    return pred


def _step(ctx, pred_by_pred, pred_by_arr, preds):
    if isinstance(ctx, Column):
        return H.all_of(*preds, pred_by_arr(ctx))
    return H.all_of(*preds, pred_by_pred(ctx))


def desc(ctx, *preds):
    """Descendant step (H2)."""
    return _step(ctx, H.under, H.within, preds)


def kids(ctx, *preds):
    """Child step (H3)."""
    return _step(ctx, H.parent_is, H.child_of, preds)


def nodes_of(sel) -> Column:
    """The matching nodes as an array, in document order."""
    return sel if isinstance(sel, Column) else H.select(NODES, sel)


def texts(sel) -> Column:
    """``x/text()`` as a list (one entry per text node)."""
    parent = (H.child_of(sel) if isinstance(sel, Column) else H.parent_is(sel))
    return H.texts(NODES, parent)


def text(sel) -> Column:
    """``x/text()`` joined with '' (H7)."""
    return F.array_join(texts(sel), "")


def all_text(sel) -> Column:
    """``x//text()`` joined with '' (H8)."""
    inside = (H.within(sel) if isinstance(sel, Column) else H.under(sel))
    return F.array_join(H.texts(NODES, inside), "")


def hrefs(sel) -> Column:
    return H.attr(nodes_of(sel), "href")


def el(tag: str, *more):
    return H.all_of(H.element(tag), *more)


def nth_el(tag: str, k: int):
    return H.all_of(H.element(tag), H.nth(k))
