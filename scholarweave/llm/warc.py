"""Operator 9: content-addressed WARC archive.

An archive is two tables under one folder: ``payloads`` holds every distinct payload once under its
SHA-256 digest, ``headers`` holds the exact WARC/1.0 header block of every record.  Reading verifies
each stored payload against its digest and rebuilds whole records with a join on the digest.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarweave.llm.registry import query
from scholarweave.session import ensure_checkpoint_dir, table

MIN_REVISIT_BYTES = 100
WARC_DATE = "1970-01-01T00:00:00Z"
_END = "\r\n"


def _hash_payload(pages: DataFrame) -> DataFrame:
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))


def _header(response, date: str):
    """Header block of a record: WARC/1.0 lines, ended by an empty line."""
    uri = F.regexp_replace("url", "[\\r\\n]", " ")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    lines = F.concat_ws(
        _END, F.lit("WARC/1.0"),
        line("WARC-Type", F.when(response, "response").otherwise("revisit")),
        line("WARC-Target-URI", uri),
        F.lit(f"WARC-Date: {date}"),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        F.when(~response, F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")),
        line("Page-Id", F.col("page_id").cast("string")),
        F.when(~response, line("Refers-To-Page-Id", F.col("keeper").cast("string"))),
        line("Payload-Length", F.col("n_bytes").cast("string")),
        line("Content-Length", F.when(response, F.col("n_bytes")).otherwise(F.lit(0)).cast("string")))
    return F.concat(lines, F.lit(_END + _END))


def write_archive(pages: DataFrame, path: str, date: str = WARC_DATE) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) under ``path``, which must be new.

    Among payloads that are equal and at least MIN_REVISIT_BYTES long, rows of the smallest page_id
    are responses and the others revisits of it; shorter payloads are all responses.  A null html is
    an empty payload, a null url leaves its header line out, line ends in a url become spaces.  Rows
    that repeat the smallest page_id are responses too.  A null page_id has no Page-Id line and is
    never referred to; equal payloads that all have a null page_id are responses.  Other columns are
    ignored; an empty table gives an empty archive.
    """
    hashed = _hash_payload(pages)
    (hashed.groupBy("digest").agg(F.first("payload").alias("payload"), F.min("page_id").alias("keeper"))
     .write.mode("error").parquet(f"{path}/payloads"))
    keepers = pages.sparkSession.read.parquet(f"{path}/payloads").select("digest", "keeper")
    rows = hashed.select("page_id", "url", "digest", F.octet_length("payload").cast("long").alias("n_bytes")) \
        .join(keepers, "digest")
    response = (F.col("n_bytes") < MIN_REVISIT_BYTES) | F.col("keeper").isNull() | F.col("page_id").eqNullSafe(
        F.col("keeper"))
    (rows.select("digest", _header(response, date).alias("header"))
     .write.mode("error").parquet(f"{path}/headers"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Whole records of an archive: header (string), digest, payload, record (the exact bytes).

    Every stored payload is checked against its digest; a damaged one fails the job.  ``payload`` of
    a revisit is that of the record it refers to; its own record block is empty.
    """
    stored = spark.read.parquet(f"{path}/payloads").select("digest", "payload")
    good = F.sha2("payload", 256) == F.col("digest")
    verified = stored.select("digest", F.when(good, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), "digest")).cast("binary")).alias("payload"))
    block = F.when(F.col("header").contains("\r\nWARC-Type: response\r\n"), F.col("payload")).otherwise(
        F.encode(F.lit(""), "UTF-8"))
    return (spark.read.parquet(f"{path}/headers").join(verified, "digest")
            .select("header", "digest", "payload",
                    F.concat(F.encode("header", "UTF-8"), block, F.encode(F.lit(_END + _END), "UTF-8")).alias("record")))


def _field(name: str):
    return F.nullif(F.regexp_extract("header", f"\\r\\n{name}: ([^\\r\\n]*)\\r\\n", 1), F.lit(""))


def record_index(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of rebuilt records."""
    return records.select(
        _field("Page-Id").cast("long").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        _field("WARC-Type").alias("record_type"),
        _field("Refers-To-Page-Id").cast("long").alias("refers_to"))


_ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS n, sha256(h) AS x FROM p),
k AS (SELECT *, min(page_id) OVER (PARTITION BY x) AS m FROM d)
SELECT page_id, n AS payload_bytes, x AS payload_digest,
       CASE WHEN n >= {MIN_REVISIT_BYTES} AND page_id <> m THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {MIN_REVISIT_BYTES} AND page_id <> m THEN m END AS refers_to
FROM k"""


@query("op9_warc", _ORACLE)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every row of ``pages``, read the archive back and index the rebuilt records."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archive(table(spark, sf_dir, "pages"), path)
    return record_index(read_archive(spark, path))
