"""ID registry as a bucketed table.

The registry is one parquet folder with a ``batch_id=`` folder per writer, bucketed on its key.  A run's
keys are shuffled to the buckets and joined there: the IDs of all earlier runs are read in place and
never shuffled.  The number of buckets is kept beside the data and stays for the registry's life.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarweave.operators.ids import KEY, empty_registry

# Registry folder of batch runs; micro-batches are numbered from 0.
BATCH_RUNS = -1


def _buckets(spark: SparkSession, path: str) -> int | None:
    """Buckets of the registry at ``path``; None if nothing has been registered there yet."""
    try:
        return spark.read.schema("buckets int").json(f"{path.rstrip('/')}.layout").first().buckets
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return None


def _table(spark: SparkSession, path: str, buckets: int) -> str:
    """Name of the external table over ``path`` in this session's catalog."""
    path = path.rstrip("/")
    name = f"sw_registry_{hashlib.md5(path.encode()).hexdigest()}"
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {name} (source_url STRING, item_type STRING, id BIGINT, batch_id BIGINT)
                  USING parquet PARTITIONED BY (batch_id) CLUSTERED BY (source_url, item_type)
                  SORTED BY (source_url, item_type) INTO {buckets} BUCKETS LOCATION '{path}'""")
    spark.catalog.refreshTable(name)        # another session may have registered IDs since
    return name


def read_registry(spark: SparkSession, path: str | None, before_batch: int | None = None) -> DataFrame:
    """Registry table at ``path``, or an empty one.

    ``before_batch`` leaves that micro-batch's own IDs out, so that a replay finds what the first run found.
    """
    buckets = _buckets(spark, path) if path else None
    if buckets is None:
        return empty_registry(spark)
    rows = spark.table(_table(spark, path, buckets))
    if before_batch is not None:
        rows = rows.where(F.col("batch_id") != before_batch)
    return rows.select(*KEY, "id")


def append_registry(new_rows: DataFrame, path: str, batch_id: int | None = None, buckets: int | None = None) -> None:
    """Add newly assigned IDs to the registry (K6).

    Batch runs append to ``BATCH_RUNS``; a micro-batch overwrites its own folder as a whole, so replaying
    it writes the same rows again.  ``buckets`` counts for a new registry only; if not given it is
    ``spark.sql.shuffle.partitions``.
    """
    spark = new_rows.sparkSession
    have = _buckets(spark, path)
    if have is None:
        have = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.createDataFrame([(have,)], "buckets int").coalesce(1).write.mode("overwrite").json(
            f"{path.rstrip('/')}.layout")
    name = _table(spark, path, have)
    # dealt as the buckets are, so that a task writes one file
    view = f"{name}_new"
    new_rows.select(*KEY, "id").repartition(have, *KEY).sortWithinPartitions(*KEY).createOrReplaceTempView(view)
    how, batch = ("INTO", BATCH_RUNS) if batch_id is None else ("OVERWRITE", int(batch_id))
    spark.sql(f"INSERT {how} {name} PARTITION (batch_id = {batch}) SELECT * FROM {view}")
    spark.catalog.dropTempView(view)
