"""Citation cutting and publication-type classification.

All of it is regex/split Column expressions; ``get`` keeps a missing split
part as NULL (the reference aborted the page) and ``*_ok`` flags count them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scholarweave.functions.names import LAST_FIRST, split_names
from scholarweave.functions.text import _c, strip

# Section-heading classes per site, in the order they are tried.
GESIS_TYPES = [
    (r"Monographien|Forschungs- und Arbeitsberichte|Sonstige Ver.+ffentlichungen|Herausgeberwerke", "Academic Article"),
    (r"Referierte Zeitschriftenaufs.+tze|Sammelwerksbeitr.+ge|Zeitschriftenaufs.+tze", "Article"),
    (r"Vortr.+ge und Veranstaltungen", "Conference Paper"),
]
HIIG_TYPES = [
    (r"Wissenschaftliche Artikel", "Academic Article"),
    (r"B.+cher", "Book"),
    (r"Buchbeitr.+ge", "Article"),
    (r"Sonstige Publikationen", None),  # type left unset; the detail page fills it
]

# Fixed value: a date (or semester) at the end of a talk citation.
TALK_DATE_AT_END = r"(((\d{2}\.\s*)?\d{2}\.?\s*-\s*)?(\d{2}\.\s*)?(\d{1,2}\.?|Januar|Februar|M.+rz|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember)\s*|[WS]S (\d{4}/)?)?\d{4}[.\s]+$"  # noqa: E501


def classify(heading, classes: list[tuple[str, str | None]]) -> Column:
    """Index of the first class whose regex is found in the heading, else NULL."""
    h = _c(heading)
    out = None
    for i, (rx, _) in enumerate(classes):
        out = F.when(h.rlike(rx), F.lit(i)) if out is None else out.when(h.rlike(rx), F.lit(i))
    return out


def type_label(heading, classes: list[tuple[str, str | None]]) -> Column:
    idx = classify(heading, classes)
    labels = F.array(*[F.lit(lbl).cast("string") for _, lbl in classes])
    return F.get(labels, idx)


def page_range(text) -> Column:
    """``pp.12-34`` -> struct(startpage, endpage)."""
    t = _c(text)
    rx = r"pp.([0-9]+)\-([0-9]+)"
    hit = t.rlike(rx)
    return F.struct(F.when(hit, F.regexp_extract(t, rx, 1)).alias("startpage"),
                    F.when(hit, F.regexp_extract(t, rx, 2)).alias("endpage"))


def publisher_of(text) -> Column:
    """Part after the first ``:`` (P10)."""
    return F.get(F.split(_c(text), ":"), 1)


def hiig_citation(first_text, second_text, em_text, heading) -> Column:
    """List-page citation ``Authors (Year). Title. In ...``.

    Authors are everything before the first ``(``, split on ``\\.,|&`` and each
    ``Last, First``; year is ``NNNN)``; the title cut depends on the section.
    """
    t = _c(first_text)
    em = F.coalesce(_c(em_text), F.lit(""))
    idx = classify(heading, HIIG_TYPES)
    after_paren = F.get(F.split(t, r"\("), 1)
    year = F.nullif(F.regexp_extract(after_paren, r"([0-9]{4})\)", 1), F.lit(""))
    after_close = F.get(F.split(t, r"\)\."), 1)
    other_title = F.get(F.split(t, r"\d\)\.", 2), 1)
    pr = page_range(second_text)
    title = (F.when(idx == 0, after_close).when(idx == 1, em)
             .when(idx == 2, F.get(F.split(after_close, "In"), 0)).when(idx == 3, other_title))
    published_in = F.when(idx.isin(0, 2, 3), em)
    return F.struct(
        split_names(F.get(F.split(t, r"\("), 0), LAST_FIRST, ",", r"\.,|&").alias("author_names"),
        year.alias("year"),
        title.alias("title"),
        published_in.alias("published_in"),
        type_label(heading, HIIG_TYPES).alias("publication_type"),
        F.when(idx == 2, pr["startpage"]).alias("startpage"),
        F.when(idx == 2, pr["endpage"]).alias("endpage"),
        (after_paren.isNotNull() & idx.isNotNull()).alias("parsed_ok"),
    )


# Authors, then the year (optionally in parentheses) at the start of a GESIS citation.
GESIS_AUTHORS_YEAR = r"^(.+?)\s*\(?(\d{4})\)?"


def gesis_authors_year(text) -> Column:
    """``Last, First; Last, First (2012): rest`` -> authors, year, rest (P11, intent)."""
    t = _c(text)
    rx = GESIS_AUTHORS_YEAR
    hit = t.rlike(rx)
    rest = F.regexp_replace(F.regexp_replace(t, rx, ""), r"^[\s).:,]+", "")
    return F.struct(
        F.when(hit, split_names(F.regexp_extract(t, rx, 1), LAST_FIRST, ",", ";")).alias("author_names"),
        F.when(hit, F.regexp_extract(t, rx, 2)).alias("year"),
        F.when(hit, rest).otherwise(t).alias("rest"),
    )


def gesis_citation(title_and_source, heading) -> Column:
    """Monograph / article citation cut."""
    t = _c(title_and_source)
    idx = classify(heading, GESIS_TYPES)
    in_parts = F.split(t, "In:")
    src = F.when(t.rlike(r"(Hrsg.)"), strip(F.get(F.split(t, r"\):"), 1))) \
           .otherwise(strip(F.get(F.split(F.get(in_parts, 1), ","), 0)))
    return F.struct(
        F.when(idx == 0, strip(F.get(F.split(t, r"\."), 0)))
         .when(idx == 1, strip(F.get(in_parts, 0))).alias("title"),
        F.when(idx == 1, src).alias("published_in"),
        type_label(heading, GESIS_TYPES).alias("publication_type"),
    )


# The location and the source at the end of a talk citation.
TALK_LOCATION_RX = r"([^.]+?)[\s.,]+$"
TALK_SOURCE_RX = r".\s*([^.]+)\.?$"
# Anchored forms of the two searches.  An unanchored search retries from every
# start position (quadratic or worse on long citations); but the leftmost match
# of TALK_LOCATION_RX can only start right after the last '.' before the trailing
# run of [\s.,], and that of TALK_SOURCE_RX only at the last '.' (ignoring one
# final '.') or at 0.  One anchored attempt finds that same span; when it finds
# nothing the original search runs, so the result is always the original's.
_TALK_LOCATION_FAST = r"^(?s:.*\.)?([^.]*[^\s.,][\s.,]+)$"
_TALK_SOURCE_TAIL = r"^.\s*([^.]+)\.?$"


def parse_talks(df, col: str, out: str = "talk"):
    """Talk citation: strip the trailing date, last sentence = location, the one
    before = published_in, the rest = title; no location or source -> not ok (P7).

    Staged with ``withColumn`` so each regex runs once per row: Catalyst does not
    inline a non-cheap expression that is referenced twice.  Capture groups are
    read from the (short) matched text with the anchored pattern.
    """
    t2, l0, t3, p0 = (f"_{out}_{x}" for x in ("t2", "l0", "t3", "p0"))
    d = df.withColumn(t2, F.regexp_replace(F.col(col), TALK_DATE_AT_END, ""))
    fast_l0 = F.regexp_extract(F.col(t2), _TALK_LOCATION_FAST, 1)
    d = d.withColumn(l0, F.when(fast_l0 != "", fast_l0)
                         .otherwise(F.regexp_extract(F.col(t2), TALK_LOCATION_RX, 0)))
    d = d.withColumn(t3, F.replace(F.col(t2), F.col(l0), F.lit("")))
    u = F.regexp_replace(F.col(t3), r"\.$", "")
    k = F.locate(".", F.reverse(u))                           # 1-based from the end, 0 = none
    start = F.when(k == 0, F.lit(0)).otherwise(F.length(u) - k)  # 0-based start of the match
    cand = F.substring(F.col(t3), start + 1, 1 << 30)
    d = d.withColumn(p0, F.when(cand.rlike(_TALK_SOURCE_TAIL), cand)
                         .otherwise(F.regexp_extract(F.col(t3), TALK_SOURCE_RX, 0)))
    ok = (F.col(l0) != "") & (F.col(p0) != "")
    res = F.struct(
        F.when(ok, strip(F.replace(F.col(t3), F.col(p0), F.lit("")))).alias("title"),
        F.when(ok, strip(F.regexp_extract(F.col(p0), "^" + TALK_SOURCE_RX, 1))).alias("published_in"),
        F.when(ok, F.regexp_extract(F.col(l0), "^" + TALK_LOCATION_RX, 1)).alias("location"),
        F.lit("Conference Paper").alias("publication_type"),
        ok.alias("ok"),
    )
    return d.withColumn(out, res).drop(t2, l0, t3, p0)


def keep_parsed_talks(df, col: str, out: str = "talk"):
    """``parse_talks`` and drop the records the reference dropped.

    The drop is a generator over a 0/1-element array rather than a filter: a
    filter on these columns would be pushed below the projections with every
    regex inlined, running the chain twice.
    """
    d = parse_talks(df, col, out)
    keep = [c for c in d.columns if c != out]
    return d.select(*keep, F.inline(F.filter(F.array(F.col(out)), lambda t: t["ok"])))
