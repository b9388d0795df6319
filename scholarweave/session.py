"""Spark session and lineage helpers shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

SPREAD_ROWS = 20_000      # rows of a task that does much work for each
SPREAD_LEAST = 500        # rows that are worth a task of their own


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "scholarweave", driver_memory: str | None = None) -> SparkSession:
    """Session with AQE on, UI off and UTC time.

    On a cluster the master, memory and ``spark.checkpoint.dir`` come from
    the submit configuration; locally we fill in what is unset.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    # Sizes are the cluster's to set; only what the caller or the environment names is passed on.
    for key, value in (("spark.sql.shuffle.partitions", shuffle_partitions or os.environ.get("SW_SHUFFLE_PARTITIONS")),
                       ("spark.sql.execution.arrow.maxRecordsPerBatch", os.environ.get("SW_ARROW_BATCH")),
                       ("spark.driver.memory", os.environ.get("SW_DRIVER_MEMORY") or driver_memory)):
        if value:
            builder = builder.config(key, str(value))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, setting it from the session config.

    ``spark.checkpoint.dir`` names the shared folder on a cluster.  Only a
    local-mode session (tests, bench) may fall back to a fresh temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3)")
    local = tempfile.mkdtemp(prefix="sw-ckpt-", dir="/tmp")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder and read it back.

    The written table survives executor loss, cuts the lineage, and -- unlike
    an RDD checkpoint -- is columnar and carries file-size statistics, so later
    joins against it can be planned as broadcasts when it is small.
    """
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, rows: int = SPREAD_ROWS) -> DataFrame:
    """The rows of a narrow table dealt evenly over tasks, about ``rows`` each, before work that is large per row.

    A table of short rows is a file or two, so as many tasks, however many rows it has; the work that each
    row makes would all be theirs.  Rows are counted first, which a stored table answers from its footers.
    """
    n = df.count()
    tasks = max(-(-n // rows), min(df.sparkSession.sparkContext.defaultParallelism, -(-n // SPREAD_LEAST)))
    return df.repartition(tasks) if tasks > 1 else df


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by Python workers: add it once per application as a zip file."""
    sc = spark.sparkContext
    if getattr(sc, "_scholarweave_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="sw-ship-")
    archive = os.path.join(folder, "scholarweave.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for base, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(base, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._scholarweave_shipped = True
