"""Streaming IDs (X2): ``readStream`` over page files, then ``foreachBatch`` calling the batch functions.

What a micro-batch writes is keyed by ``batchId``, so a replayed one rewrites
its own folder with the same rows.  Steps that need keyed state are in ``state.py``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarweave.operators import ids as idops
from scholarweave.session import ensure_checkpoint_dir
from scholarweave.sinks.registry import append_registry, read_registry


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def id_batch_writer(registry_path: str, url_col: str, item_type: str):
    """``foreachBatch`` body: register the batch's keys, idempotent per batchId."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        registry = read_registry(spark, registry_path, batch_id)
        keys = batch.select(F.col(url_col).alias("source_url"), F.lit(item_type).alias("item_type"))
        _, new_rows = idops.assign_ids(keys, registry)
        append_registry(new_rows, registry_path, batch_id)
    return run


def stream_entity_ids(spark: SparkSession, source_dir: str, schema, registry_path: str, checkpoint: str,
                      url_col: str = "url", item_type: str = "Page", glob: str | None = None,
                      max_files_per_trigger: int | None = None):
    """Start the ID stream with ``availableNow`` and return the ``StreamingQuery``."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    return (stream.writeStream.foreachBatch(id_batch_writer(registry_path, url_col, item_type))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Rewrite one batch's folder, also when ``df`` is empty, so nothing of an earlier run of it stays."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={int(batch_id)}")
