"""Entity schemas (§1.2): fixed field names; a missing field is NULL, never ''."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_S = "string"
NAME = "struct<firstname:string,lastname:string>"

ENTITY_FIELDS: dict[str, dict[str, str]] = {
    "Person": {**{f: _S for f in [
        "source_url", "name", "firstname", "lastname", "title", "email", "web", "phone", "street_address",
        "postal_code", "city", "country", "job_description", "picture", "person_type", "department",
        "organization_url"]}, "position": "array<string>", "id": "bigint", "organization_id": "bigint"},
    "Division": {**{f: _S for f in ["source_url", "name", "description", "subject_field"]},
                 "id": "bigint", "organization_id": "bigint"},
    "DivisionRole": {f: _S for f in ["source_url", "name", "division_url", "person_url"]},
    "Organization": {**{f: _S for f in ["source_url", "name", "description", "web", "phone", "fax",
                                        "street_address", "postal_code", "city", "country", "email"]},
                     "id": "bigint"},
    "Publication": {**{f: _S for f in [
        "source_url", "title", "publication_date", "year", "publication_location", "published_in", "publisher",
        "organ", "startpage", "endpage", "volume", "issue", "download_link", "doi", "phrases", "thesis_type",
        "publication_type", "abstract", "location"]},
        "author_urls": "array<string>", "author_names": f"array<{NAME}>", "id": "bigint"},
    "Lecture": {f: _S for f in ["source_url", "title", "location", "event_id", "lecturer_id", "vispagename",
                                "vislocs"]},
    "Event": {f: _S for f in ["source_url", "title", "location"]},
}


def conform(df: DataFrame, item_type: str, keep_extra: bool = True) -> DataFrame:
    """Add the type's missing fields as typed NULLs; extra columns are kept by default."""
    fields = ENTITY_FIELDS[item_type]
    have = set(df.columns)
    out = df
    for name, dtype in fields.items():
        if name not in have:
            out = out.withColumn(name, F.lit(None).cast(dtype))
    if not keep_extra:
        out = out.select(*fields)
    return out
