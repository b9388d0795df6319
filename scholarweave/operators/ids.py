"""Stable surrogate IDs per ``(source_url, item_type)``.

IDs are dense per item type, start at 1, never change once registered, and new
keys of one run are numbered ``max + 1, max + 2, ...`` in ``source_url`` order.

No item type is funnelled into one task, whatever its size: new keys are range-partitioned on ``(item_type, source_url)``, each
partition numbers its rows locally, and a tiny per-(partition, type) count table
gives every partition its offset.  The numbered keys are written out between the
two passes because a re-evaluated range shuffle may place rows differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarweave.functions.text import present
from scholarweave.operators.skew import skew_join
from scholarweave.session import cut_lineage

KEY = ["source_url", "item_type"]

REGISTRY_SCHEMA = T.StructType([
    T.StructField("source_url", T.StringType(), False),
    T.StructField("item_type", T.StringType(), False),
    T.StructField("id", T.LongType(), False),
])


def empty_registry(spark: SparkSession) -> DataFrame:
    """Registry created when absent."""
    return spark.createDataFrame([], REGISTRY_SCHEMA)


def needed_keys(*frames: DataFrame) -> DataFrame:
    """Union of ``(source_url, item_type)`` key frames, blanks dropped, distinct."""
    out = None
    for f in frames:
        k = f.select(*KEY)
        out = k if out is None else out.unionByName(k)
    return out.where(present("source_url")).distinct()


def max_ids(registry: DataFrame) -> DataFrame:
    """``MAX(id)`` per item type (A3)."""
    return registry.groupBy("item_type").agg(F.max("id").alias("base_id"))


def _dense_number(new_keys: DataFrame, base: DataFrame, partitions: int | None) -> DataFrame:
    """Number distinct new keys densely per type after ``base_id`` in source_url order."""
    spark = new_keys.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (new_keys.repartitionByRange(n, "item_type", "source_url")
              .sortWithinPartitions("item_type", "source_url")
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = cut_lineage(ranged, "ids-ranged")
    stats = ranged.groupBy("_pid", "item_type").agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_min_mid"))
    w = Window.partitionBy("item_type").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (stats
               .withColumn("_before", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
               .join(base, "item_type", "left")
               .select("_pid", "item_type", "_min_mid",
                       (F.coalesce("base_id", F.lit(0)) + F.col("_before")).alias("_start")))
    return (ranged.join(offsets, ["_pid", "item_type"])
            .select(*KEY, (F.col("_start") + F.col("_mid") - F.col("_min_mid") + 1)
                    .cast("bigint").alias("id")))


def assign_ids(keys: DataFrame, registry: DataFrame | None = None,
               partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """IDs for every needed key: ``(keys_with_id, new_registry_rows)``.

    Existing keys keep their registered ID (equi join on the primary key);
    new keys are the anti join (U4) and get dense IDs after the per-type max.
    """
    spark = keys.sparkSession
    # The distinct key set is materialised once: it feeds two joins and two jobs,
    # and its upstream (page parsing, renders) must not run again for each.
    keys = cut_lineage(keys.select(*KEY).where(present("source_url")).distinct(), "ids-keys")
    if registry is None:                       # first run: every key is new
        new_rows = cut_lineage(_dense_number(keys, max_ids(empty_registry(spark)), partitions),
                               "ids-new")
        return new_rows, new_rows
    # one pass over the registry; the result is split into old and new keys
    matched = cut_lineage(keys.join(registry.select(*KEY, "id"), KEY, "left"), "ids-matched")
    existing = matched.where(F.col("id").isNotNull())
    new_keys = matched.where(F.col("id").isNull()).select(*KEY)
    new_rows = cut_lineage(_dense_number(new_keys, max_ids(registry), partitions), "ids-new")
    # The ID table is read by several joins downstream: materialise it once.
    return cut_lineage(existing.unionByName(new_rows), "ids-all"), new_rows


def attach_id(df: DataFrame, ids: DataFrame, item_type: str, url_col: str = "source_url",
              out: str = "id") -> DataFrame:
    """Left-join the ID of ``(df[url_col], item_type)``."""
    sub = (ids.where(F.col("item_type") == item_type)
              .select(F.col("source_url").alias("_k_url"), F.col("id").alias(out)))
    return (df.join(sub, df[url_col] == sub["_k_url"], "left").drop("_k_url"))


def resolve_roles(roles: DataFrame, persons: DataFrame, ids: DataFrame) -> DataFrame:
    """Role -> role id, person id, division id.

    A role with a blank ``person_url`` or ``division_url`` is dropped (the
    reference nulls it).  The role's key is its ``source_url`` (the division
    URL in both sites that emit roles), so contacts of one division share it.
    Only roles of persons that exist (and have IDs) survive.

    One division, or one person, may have a third of all roles: heavy URLs are split.
    """
    named = roles.where(present("person_url") & present("division_url")).select(
        "name", "source_url", "division_url", "person_url")
    for item_type, url, out in (("DivisionRole", "source_url", "role_id"), ("Division", "division_url", "division_id")):
        known = ids.where(F.col("item_type") == item_type).select(F.col("source_url").alias("_url"), F.col("id").alias(out))
        named = skew_join(named, known, F.col(url), F.col("_url"), "left").drop("_url")
    p = persons.select(F.col("source_url").alias("_url"), F.col("id").alias("person_id"))
    return skew_join(named, p, F.col("person_url"), F.col("_url")).select(
        "role_id", "name", "source_url", "division_url", "person_url", "division_id", "person_id")


def assign_organization(entities: DataFrame, orgs: DataFrame, on: str = "source",
                        org_id_col: str = "id") -> DataFrame:
    """Each entity gets its source's organisation id, regardless of arrival order.

    One organisation per source, and one source may own a third of all
    entities: the join is left to AQE, which broadcasts the organisations where
    their measured size allows and otherwise splits the hot source's partition.
    """
    o = orgs.select(F.col(on).alias("_org_src"), F.col(org_id_col).alias("organization_id"))
    base = entities.drop("organization_id") if "organization_id" in entities.columns else entities
    return base.join(o, base[on] == o["_org_src"], "left").drop("_org_src")
