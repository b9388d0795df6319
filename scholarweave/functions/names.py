"""Personal names as ``struct<firstname,lastname>`` Columns.

A name list is ``array<struct<firstname,lastname>>``; every operation here is a
higher-order function over one row's arrays, so none of it shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scholarweave.functions.text import _c, present, strip

FIRST_LAST = "first_last"
LAST_FIRST = "last_first"

NAME_TYPE = "struct<firstname:string,lastname:string>"


def make_name(first: Column, last: Column) -> Column:
    return F.struct(first.alias("firstname"), last.alias("lastname"))


def split_name(c, order: str = FIRST_LAST, sep: str = " ") -> Column:
    """Split on the regex ``sep``: the last part vs. all others joined with one space.

    ``first_last``: firstname = others, lastname = last part.
    ``last_first``: the other way round.  Both parts are stripped.
    """
    parts = F.split(_c(c), sep)
    rest = F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), " ")
    last = F.try_element_at(parts, F.lit(-1))
    if order == FIRST_LAST:
        return make_name(strip(rest), strip(last))
    if order == LAST_FIRST:
        return make_name(strip(last), strip(rest))
    raise ValueError(f"unknown name order {order!r}")


def split_names(c, order: str = LAST_FIRST, name_sep: str = ",", list_sep: str = ",") -> Column:
    """Regex-split a list of names, strip, skip blanks, split each."""
    items = F.filter(F.transform(F.split(_c(c), list_sep), strip), lambda x: x != "")
    return F.transform(items, lambda x: split_name(x, order, name_sep))


def names_to_lists(names) -> Column:
    """``[[first, last], ...]``."""
    return F.transform(_c(names), lambda n: F.array(n["firstname"], n["lastname"]))


def name_label(name) -> Column:
    """``"Last, First"``."""
    n = _c(name)
    return F.concat(n["lastname"], F.lit(", "), n["firstname"])


def names_equal(a, b) -> Column:
    """All fields equal."""
    a, b = _c(a), _c(b)
    return (a["firstname"] == b["firstname"]) & (a["lastname"] == b["lastname"])


def _word_chars(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\W", "")


def names_equivalent(a, b) -> Column:
    """Equal, or same lastname and the shorter word-char firstname prefixes the longer."""
    a, b = _c(a), _c(b)
    fa, fb = _word_chars(a["firstname"]), _word_chars(b["firstname"])
    prefix = F.when(F.length(fa) > F.length(fb), fa.startswith(fb)).otherwise(fb.startswith(fa))
    return F.coalesce(names_equal(a, b) | ((a["lastname"] == b["lastname"]) & prefix), F.lit(False))


def first_equivalent(names, name) -> Column:
    """First name of the list equivalent to ``name``, else NULL."""
    return F.get(F.filter(_c(names), lambda n: names_equivalent(n, _c(name))), 0)


def name_or_split_list(raw_json_or_text, order: str = LAST_FIRST, sep: str = " ") -> Column:
    """A JSON value that is a scalar or a list of author strings -> name array."""
    v = _c(raw_json_or_text)
    as_list = F.from_json(v, "array<string>")
    scalar = F.coalesce(F.get_json_object(v, "$"), v)
    values = F.coalesce(as_list, F.array(scalar))
    return F.transform(values, lambda x: split_name(x, order, sep))


def link_authors(names, links, link_order: str = FIRST_LAST) -> Column:
    """Greedy one-to-one author linking in list order.

    ``links`` is ``array<struct<name,url>>``.  Each link's text is cut at its first
    comma and split ``first last``; the first remaining author equivalent to it is
    removed from the list and the link URL is recorded.  Returns
    ``struct(author_urls array<string>, author_names array<name>)``: the
    unmatched names are what is left in the list.

    Word-char firstnames are computed once per name and per link before the
    fold, so the sequential part only compares strings.
    """
    def prep(n):
        return F.struct(n["firstname"].alias("firstname"), n["lastname"].alias("lastname"),
                        _word_chars(n["firstname"]).alias("fw"))

    def equiv(a, b):
        prefix = F.when(F.length(a["fw"]) > F.length(b["fw"]), a["fw"].startswith(b["fw"])) \
                  .otherwise(b["fw"].startswith(a["fw"]))
        same = (a["firstname"] == b["firstname"]) & (a["lastname"] == b["lastname"])
        return F.coalesce(same | ((a["lastname"] == b["lastname"]) & prefix), F.lit(False))

    cands = F.transform(_c(links), lambda l: F.struct(
        prep(split_name(F.substring_index(l["name"], ",", 1), link_order, " ")).alias("n"), l["url"].alias("url")))
    init = F.struct(F.transform(_c(names), prep).alias("left"), F.array().cast("array<string>").alias("hit"))

    def step(acc, link):
        idx = F.array_position(F.transform(acc["left"], lambda n: equiv(n, link["n"])), True)  # 1-based, 0 = none
        return F.when(idx == 0, acc).otherwise(F.struct(
            F.filter(acc["left"], lambda n, i: i != idx - 1).alias("left"),
            F.concat(acc["hit"], F.array(link["url"])).alias("hit")))

    out = F.aggregate(cands, init, step)
    left = F.transform(out["left"], lambda n: make_name(n["firstname"], n["lastname"]))
    return F.struct(out["hit"].alias("author_urls"), left.alias("author_names"))


# Fixed value: the academic-title prefix recognised before a person's name.
ACADEMIC_TITLE_PREFIX = r"^((Prof.|Dr.|M.\s*A.)\s*)*"


def split_academic_title(c) -> Column:
    """Title prefix -> ``title``; every occurrence of it removed from the name."""
    raw = _c(c)
    prefix = F.regexp_extract(raw, ACADEMIC_TITLE_PREFIX, 0)
    rest = F.when(prefix == "", raw).otherwise(F.replace(raw, prefix, F.lit("")))
    return F.struct(strip(prefix).alias("title"), rest.alias("name"))


def split_name_title(c) -> Column:
    """``"Name, Title"`` on ``", "`` (N9).  Not exactly two parts is flagged."""
    raw = _c(c)
    parts = F.split(raw, ", ")
    has_comma = raw.contains(",")
    return F.struct(
        F.when(has_comma, F.get(parts, 0)).otherwise(raw).alias("name"),
        F.when(has_comma, F.get(parts, 1)).alias("title"),
        (has_comma & (F.size(parts) != 2)).alias("malformed"),
    )


__all__ = [
    "FIRST_LAST", "LAST_FIRST", "split_name", "split_names", "names_to_lists", "name_label",
    "names_equal", "names_equivalent", "first_equivalent", "name_or_split_list",
    "link_authors", "split_academic_title", "split_name_title", "present",
]
