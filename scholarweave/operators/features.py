"""JSON feature lists -> wide publication rows.

A feed is ``{"DataSet":{"documents":{"document":[{"features":{"feature":[{"@id":..,
"values":..}]}}]}}}``; ``values`` is ``{"value": scalar-or-list}`` or a plain
string.  ``values`` is declared ``string`` so whichever shape it has arrives
as raw JSON text.  Documents are exploded (one row each) and dealt over the
tasks; the pivot is then one fold over the row's own feature array -- "a later
duplicate wins" -- and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarweave.functions.names import LAST_FIRST, name_or_split_list
from scholarweave.functions.text import quoted_page_url

FEATURE = "struct<`@id`:string,values:string>"
DOCUMENT = f"struct<features:struct<feature:array<{FEATURE}>>>"
FEED = f"struct<DataSet:struct<documents:struct<document:array<{DOCUMENT}>>>>"

Hook = Callable[[Column, Callable[[str], Column]], Column]   # (value, value of another feature id) -> value


def explode_feed(df: DataFrame, json_col: str = "doc") -> DataFrame:
    """One row per document of a nested feed, with its position in the feed (S3).

    A feed is one input row: its documents are dealt over the tasks by feed and position, so that neither
    one large feed nor many feeds of one document end up in one task.
    """
    parsed = df.withColumn("_feed", F.from_json(json_col, FEED)).withColumn("_hash", F.xxhash64(json_col))
    return (parsed.select("*", F.posexplode("_feed.DataSet.documents.document").alias("doc_pos", "_d"))
                  .select(*[c for c in df.columns if c != json_col], "doc_pos",
                          F.col("_d.features.feature").alias("features"), F.xxhash64("_hash", "doc_pos").alias("_deal"))
                  .repartition("_deal").drop("_deal"))


def parse_document(json_col: str = "doc") -> Column:
    """Feature array of a single-document JSON ``{"features":{"feature":[..]}}`` (S3)."""
    return F.from_json(F.col(json_col), DOCUMENT)["features"]["feature"]


def feature_value(values: Column) -> Column:
    """``values.value`` when ``values`` is an object, else the non-empty plain string.

    Scalars come back unquoted; lists stay JSON text (``["a","b"]``).
    """
    is_obj = F.ltrim(values).startswith("{")
    return F.when(is_obj, F.get_json_object(values, "$.value")).otherwise(
        F.when(values != "", values))


def last_values(features: Column, feature_ids: list[str]) -> Column:
    """struct(v0, v1, ...): ``values`` of the last feature with each id, in one fold over the list (A1)."""
    def take(acc, f):
        return F.struct(*[F.when(f["@id"] == fid, f["values"]).otherwise(acc[f"v{k}"]).alias(f"v{k}")
                          for k, fid in enumerate(feature_ids)])
    none = F.struct(*[F.lit(None).cast("string").alias(f"v{k}") for k in range(len(feature_ids))])
    return F.aggregate(features, none, take)


def json_list(v: Column) -> Column:
    """A JSON list value as ``array<string>``, else NULL."""
    return F.when(F.ltrim(v).startswith("["), F.from_json(v, "array<string>"))


def as_list(v: Column) -> Column:
    """List value, else empty list (the phrases hook's rule)."""
    return F.coalesce(json_list(v), F.array().cast("array<string>"))


def unknown_features(features: Column, field_map: dict[str, str | None]) -> Column:
    """Feature ids not in the field map (the reference raised; we drop and count)."""
    known = F.array(*[F.lit(k) for k in field_map])
    return F.filter(F.transform(features, lambda f: f["@id"]), lambda i: ~F.array_contains(known, i))


def pivot_features(docs: DataFrame, features_col: str, field_map: dict[str, str | None],
                   hooks: dict[str, Hook] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Wide rows: one column per mapped feature, ``None`` targets dropped.

    ``hooks[feature_id](value, value_of)`` turns a value into the column value;
    the default is identity.  ``unknown_features`` is added for counting.  The
    list is folded once and each value parsed once, as columns of their own.
    """
    hooks = hooks or {}
    ids = list(field_map)
    value_of = lambda fid: F.col(f"_value{ids.index(fid)}")
    staged = docs.select(*[F.col(c) for c in (keep or [])], last_values(F.col(features_col), ids).alias("_last"),
                         F.size(unknown_features(F.col(features_col), field_map)).alias("unknown_features"))
    staged = staged.withColumns({f"_value{k}": feature_value(F.col(f"_last.v{k}")) for k in range(len(ids))})
    identity: Hook = lambda value, _: value
    return staged.select(
        *[F.col(c) for c in (keep or [])],
        *[hooks.get(fid, identity)(value_of(fid), value_of).alias(target)
          for fid, target in field_map.items() if target is not None],
        "unknown_features")


# --------------------------------------------------------------------------- the feed's fixed values

# Publication type ids and their labels; default label.
PUBLICATION_TYPE_IDS = {1: "Academic Article", 2: "Conference Paper", 3: "Academic Article",
                        4: "Conference Paper", 5: "Chapter", 6: "Conference Poster",
                        7: "Edited Book", 8: "Proceedings"}
DEFAULT_PUBLICATION_TYPE = "Academic Article"

# Feed feature id -> publication field (None = dropped).
FEED_FIELDS: dict[str, str | None] = {
    "title_DE": "title", "publisher": "published_in", "publicationType_DE": None, "organ": "organ",
    "vispagename": "source_url", "documentPhrases": "phrases", "phrases": None, "year": "year",
    "downloadLink": "download_link", "band": "issue", "publicationType_EN": None,
    "location": "location", "authors": "author_names", "publicationTypeId": "publication_type",
}
FEED_PAGE_BASE = "http://oldknowsite.know-center.tugraz.at/publikationen/"


def publication_type_of(code: Column) -> Column:
    """Code -> label, unknown or non-numeric -> default."""
    m = F.create_map(*[x for k, v in PUBLICATION_TYPE_IDS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, code.try_cast("int")), F.lit(DEFAULT_PUBLICATION_TYPE))


def _hook_type(v: Column, _other) -> Column:
    return publication_type_of(v)


def _hook_page(v: Column, _other) -> Column:
    return quoted_page_url(v, FEED_PAGE_BASE)


def _hook_authors(v: Column, _other) -> Column:
    return name_or_split_list(v, LAST_FIRST, " ")


def _hook_publisher(v: Column, _other) -> Column:
    lst = json_list(v)
    return F.when(F.size(lst) > 0, F.try_element_at(lst, F.lit(-1))).otherwise(v)


def _hook_phrases(v: Column, value_of: Callable[[str], Column]) -> Column:
    return F.array_join(F.concat(as_list(v), as_list(value_of("phrases"))), ",")


def _hook_organ(v: Column, _other) -> Column:
    return F.coalesce(F.array_join(json_list(v), ", "), v)


FEED_HOOKS: dict[str, Hook] = {
    "publicationTypeId": _hook_type, "vispagename": _hook_page, "authors": _hook_authors,
    "publisher": _hook_publisher, "documentPhrases": _hook_phrases, "organ": _hook_organ,
}


def feed_publications(docs: DataFrame, features_col: str = "features", keep: list[str] | None = None) -> DataFrame:
    """The feed's publications with its field map and hooks."""
    return pivot_features(docs, features_col, FEED_FIELDS, FEED_HOOKS, keep)
