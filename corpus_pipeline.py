"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

quality classifier -> line dedup -> near dedup -> benchmark decontamination -> BPE round trip.
Every stage takes (spark, docs, sf_dir); all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarweave.llm.bpe import default_path, digests
from scholarweave.llm.decontam import drop_contaminated
from scholarweave.llm.linededup import drop_recurring_lines
from scholarweave.llm.neardup import near_duplicates
from scholarweave.llm.quality_gam import classify
from scholarweave.session import ensure_checkpoint_dir, table


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose doc_id is not in ``ids`` (doc_id); rows with a null doc_id stay."""
    gone = ids.select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; rows with a null doc_id stay."""
    return _without(docs, classify(docs, table(spark, sf_dir, "labels")).where("predicted = 0"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their recurring template lines taken out of text, n_chars of the new text."""
    out = drop_recurring_lines(docs)
    changed = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed).select(*docs.columns)


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (similarity 0.8): that with the smallest doc_id."""
    return _without(docs, near_duplicates(docs).where("not kept"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text of every document left."""
    return digests(docs, default_path())


STAGES = [("quality", quality), ("lines", lines), ("near_dups", near_dups), ("decontaminate", decontaminate),
          ("tokens", tokens)]

#: SQL cannot express the classifier, the templates or the edit-distance search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's output is a table in the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.mode("error").parquet(f"{base}/{k}-{name}")
        docs = spark.read.parquet(f"{base}/{k}-{name}")
    return docs
