"""Registered queries of this subpackage: ``opN_<name>`` and ``pipeline``, with their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``; ``sql`` is its DuckDB oracle if there is one."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every operator module and the corpus pipeline, which register their queries."""
    import corpus_pipeline
    from scholarweave.llm import (bpe, decontam, lexical_search, licenses, linededup, mixing, neardup, pii,  # noqa: F401
                                  prefix_trie, quality_gam, quality_rules, sharding, warc)

    if "pipeline" not in QUERIES:
        query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
