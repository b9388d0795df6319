"""String, URL and hash helpers (T1-T11, L1-L8, F4) as Catalyst Column expressions.

Every function takes and returns ``Column``s, so the work stays inside whole-stage
codegen.  ANSI mode is on: indexing goes through ``get`` / ``try_element_at``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The characters Python's ``str.strip()`` removes, from Python's own definition.
STRIP_CHARS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def strip(c: ColumnOrName) -> Column:
    """Python ``str.strip()`` (T1): ``btrim`` over the Unicode whitespace set.

    Plain ``trim`` removes only U+0020; ``btrim`` with the full set is exact and
    runs without a regex.
    """
    return F.btrim(_c(c), F.lit(STRIP_CHARS))


def ws_split(c: ColumnOrName) -> Column:
    """Split on runs of Unicode whitespace, NBSP included."""
    return F.split(_c(c), r"(?U)\s+")


def present(c: ColumnOrName) -> Column:
    """Field is set and not the empty string."""
    col = _c(c)
    return col.isNotNull() & (col != F.lit(""))


def blank_to_null(c: ColumnOrName) -> Column:
    col = _c(c)
    return F.when(present(col), col)


def first_match(c: ColumnOrName, pattern: str) -> Column:
    """First substring matching ``pattern`` ('' when none) -- phone/fax runs."""
    return F.regexp_extract(_c(c), pattern, 0)


# The two phone/fax character runs used by the two sites.
PHONE_RUN_WIDE = r"[-+0-9() ]+"
PHONE_RUN_NARROW = r"[-+0-9]+"


def phone_from_block(c: ColumnOrName) -> Column:
    """Phone out of a contact text block; no match leaves the whole text (T4)."""
    return F.regexp_replace(_c(c), r"(?s).*T.\s+(\+49.0.[-0-9 ]+).*$", "$1")


def strip_phone_label(c: ColumnOrName) -> Column:
    """Strip then drop a leading ``T:`` label (T5)."""
    return F.regexp_replace(strip(c), r"(?U)^T:\s*", "")


def deobfuscate_email(href: ColumnOrName) -> Column:
    """``|a|`` -> ``@`` and drop ``mailto:``."""
    return F.replace(F.replace(_c(href), F.lit("|a|"), F.lit("@")), F.lit("mailto:"), F.lit(""))


def remove_spam_guard(c: ColumnOrName) -> Column:
    """``name@ remove-this.host`` -> ``name@host``."""
    return F.regexp_replace(_c(c), r"@\s*remove-this.\s*", "@")


def cut_prefix(c: ColumnOrName, prefix: str) -> Column:
    """Remove every occurrence of a site prefix, then strip."""
    return strip(F.replace(_c(c), F.lit(prefix), F.lit("")))


def nth(arr: Column, k: int) -> Column:
    """0-based element ``k`` of an array, negative from the end, NULL when missing."""
    if k >= 0:
        return F.get(arr, k)
    return F.try_element_at(arr, F.lit(k))


def address_parts(street_line: ColumnOrName, city_line: ColumnOrName,
                  nbsp_aware: bool = True) -> Column:
    """Street line + "postal city" line -> struct(street_address, postal_code, city)."""
    city = strip(city_line)
    parts = ws_split(city) if nbsp_aware else F.split(city, " ")
    return F.struct(
        strip(street_line).alias("street_address"),
        F.get(parts, 0).alias("postal_code"),
        F.get(parts, 1).alias("city"),
    )


# ----------------------------------------------------------------------------- URLs

def _dot_segments(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments with a stack fold over the path segments.

    Leading/excess ``..`` that cannot pop a real segment are kept, as a
    classic ``urljoin`` does.  A trailing ``.``/``..`` leaves a trailing slash.
    """
    segs = F.split(path, "/")
    acc0 = F.array().cast("array<string>")

    def step(acc, s):
        top = F.try_element_at(acc, F.lit(-1))
        can_pop = (F.size(acc) > 1) & (top != "..") & (top != "")
        popped = F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))
        return (F.when(s == ".", acc)
                .when((s == "..") & can_pop, popped)
                .otherwise(F.concat(acc, F.array(s))))

    folded = F.aggregate(segs, acc0, step)
    last = F.try_element_at(segs, F.lit(-1))
    trailing = F.when((last == ".") | (last == ".."), F.lit("/")).otherwise(F.lit(""))
    # Only paths with a '.' or '..' segment need the fold; the rest pass unchanged.
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.concat(F.array_join(folded, "/"), trailing)).otherwise(path)


def url_join(base: ColumnOrName, ref: ColumnOrName) -> Column:
    """RFC-style relative reference resolution in Catalyst (``urljoin``)."""
    b, r = _c(base), _c(ref)
    scheme = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    authority = F.regexp_extract(b, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    base_path = F.regexp_extract(b, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    base_nofrag = F.regexp_extract(b, r"^[^#]*", 0)
    base_noquery = F.regexp_extract(b, r"^[^?#]*", 0)
    base_dir = F.regexp_extract(base_path, r"^(.*/)?", 0)
    ref_path = F.regexp_extract(r, r"^[^?#]*", 0)
    ref_tail = F.substring(r, F.length(ref_path) + 1, 1 << 30)
    merged_dir = F.when(base_dir == "", F.lit("/")).otherwise(base_dir)
    return (
        F.when(r.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), r)
        .when(r.startswith("//"), F.concat(scheme, F.lit(":"), r))
        .when(r == "", base_nofrag)
        .when(r.startswith("#"), F.concat(base_nofrag, r))
        .when(r.startswith("?"), F.concat(base_noquery, r))
        .when(r.startswith("/"), F.concat(authority, _dot_segments(ref_path), ref_tail))
        .otherwise(F.concat(authority, _dot_segments(F.concat(merged_dir, ref_path)), ref_tail))
    )


def resolve_url(url: ColumnOrName, current: ColumnOrName | None, root: str) -> Column:
    """Make a link absolute (L1).

    Absolute when its first four characters are ``http``; ``../`` links resolve
    against the current page when one is given; anything else against ``root``.
    """
    u = _c(url)
    out = F.when(F.substring(u, 1, 4) == "http", u)
    if current is not None:
        cur = _c(current)
        out = out.when(present(cur) & (F.substring(u, 1, 3) == "../"), url_join(cur, u))
    return out.otherwise(url_join(F.lit(root), u))


def quote_path(c: ColumnOrName) -> Column:
    """Percent-encode like ``quote(s, safe='/')`` on UTF-8 bytes (L2).

    ``url_encode`` form-encodes, so fix ``+``, ``%2F`` and ``*`` afterwards.
    """
    enc = F.url_encode(_c(c))
    enc = F.replace(enc, F.lit("+"), F.lit("%20"))
    enc = F.replace(enc, F.lit("%2F"), F.lit("/"))
    return F.replace(enc, F.lit("*"), F.lit("%2A"))


def quoted_page_url(c: ColumnOrName, base: str, suffix: str = ".html") -> Column:
    """``urljoin(base, quote(value) + suffix)`` (L2)."""
    return url_join(F.lit(base), F.concat(quote_path(c), F.lit(suffix)))


def fragment_base(url: ColumnOrName) -> Column:
    """URL without fragment, plus ``#`` (L3)."""
    return F.concat(F.substring_index(_c(url), "#", 1), F.lit("#"))


def synthetic_key(url: ColumnOrName, title: ColumnOrName) -> Column:
    """``url#title`` (L4)."""
    return F.concat(_c(url), F.lit("#"), _c(title))


def content_hash(c: ColumnOrName) -> Column:
    """md5 hex of the UTF-8 text."""
    return F.md5(_c(c))


def stable_record_key(base_url: ColumnOrName, *fields: ColumnOrName) -> Column:
    """Process-independent hash key ``base#HEX`` over a canonical field concat.

    The reference hashed a Python tuple, which differs between processes; an
    md5 over the fields joined with a unit separator is stable.  A present field
    is led by ``=``, so NULL and the empty text give different keys.
    """
    canon = F.concat_ws("\u001f", *[F.coalesce(F.concat(F.lit("="), _c(f)), F.lit("")) for f in fields])
    return url_join(_c(base_url), F.concat(F.lit("#"), F.upper(F.md5(canon))))


# Fixed value: the DOI proxy prefix recognised in publication links.
DOI_PROXY = "http://dx.doi.org/"


def doi_of(href: ColumnOrName) -> Column:
    """DOI when the link starts with the proxy URL, else NULL."""
    h = _c(href)
    return F.when(h.startswith(DOI_PROXY), F.replace(h, F.lit(DOI_PROXY), F.lit("")))


def is_download_link(link_text: ColumnOrName) -> Column:
    return F.coalesce(_c(link_text).contains("Download"), F.lit(False))


def publication_key(download_url: ColumnOrName, doi: ColumnOrName, base: ColumnOrName,
                    text: ColumnOrName) -> Column:
    """Key fallback: download link, else DOI, else base + md5(text)."""
    return F.coalesce(blank_to_null(download_url), blank_to_null(doi),
                      F.concat(_c(base), content_hash(text)))
