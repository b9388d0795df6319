"""Operator 2 [native]: placement of documents on shards through a permutation-filled lookup table.

Every shard has its own permutation of the slots of a prime-sized table (an offset and a step from a
digest of its name).  Shards take turns, each claiming the first slot of its permutation that is
still free, until the table is full.  The table has ``table_size`` entries whatever the data size;
it is broadcast, and a row's shard is one hash, one remainder and one lookup.  Shards own equal
numbers of slots to within one, and removing a shard moves few keys of the others.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarweave.llm.registry import query
from scholarweave.session import table

TABLE_SIZE = 65537      # prime; about a thousand slots a shard keep loads within a few percent
SHARDS = 64
_DIGITS = 15            # hex digits of md5 that make a key's hash, below 2**60


def _digest(name: str, salt: str) -> int:
    return int(hashlib.md5(f"{salt}:{name}".encode()).hexdigest()[:_DIGITS], 16)


def fill_table(shards: list[str], table_size: int = TABLE_SIZE) -> list[int]:
    """slot -> index of the shard that owns it.  ``table_size`` must be prime, and not below the shard count."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, at least one")
    if table_size < max(2, len(shards)) or any(table_size % d == 0 for d in range(2, int(table_size ** 0.5) + 1)):
        raise ValueError("table_size must be a prime not below the number of shards")
    at = [_digest(s, "offset") % table_size for s in shards]
    step = [_digest(s, "step") % (table_size - 1) + 1 for s in shards]
    owner = [-1] * table_size
    free = table_size
    while True:
        for i in range(len(shards)):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % table_size
            owner[at[i]] = i
            free -= 1
            if free == 0:
                return owner


def slot_of(key: Column, table_size: int = TABLE_SIZE) -> Column:
    """Table slot of a key: md5 of its text modulo the table size; a null key hashes as the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return (F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("long") % table_size).cast("int")


def place(df: DataFrame, key: str, shards: list[str], table_size: int = TABLE_SIZE) -> DataFrame:
    """``df`` plus ``slot`` (int) and ``shard`` (string); columns of those names are replaced.

    Equal keys get equal shards; null keys share one.  An empty table gives an empty result.
    """
    owner = ",".join(map(str, fill_table(shards, table_size)))
    names = F.split(F.lit("\x1f".join(shards)), "\x1f")
    lookup = (df.sparkSession.range(1)
              .select(F.posexplode(F.split(F.lit(owner), ",")).alias("slot", "owner"))
              .select("slot", F.get(names, F.col("owner").cast("int")).alias("shard")))
    keyed = df.drop("slot", "shard") if key not in ("slot", "shard") else df.withColumnRenamed(key, f"{key}_key")
    key = key if key not in ("slot", "shard") else f"{key}_key"
    return keyed.withColumn("slot", slot_of(F.col(f"`{key}`"), table_size)).join(F.broadcast(lookup), "slot")


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 1) -> None:
    """Write one ``shard=`` folder per shard; rows of a shard are dealt over ``files_per_shard`` tasks."""
    salt = F.pmod(F.xxhash64(*placed.columns), F.lit(files_per_shard))
    (placed.withColumn("_deal", salt).repartition("shard", "_deal").drop("_deal")
     .write.mode("error").partitionBy("shard").parquet(path))


def _names() -> list[str]:
    return [f"shard-{i:03d}" for i in range(SHARDS)]


def _oracle() -> str:
    owner = ",".join(map(str, fill_table(_names())))
    return f"""
WITH s AS (
  SELECT doc_id, CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {_DIGITS}) AS BIGINT)
                      % {TABLE_SIZE} AS INTEGER) AS slot FROM documents),
t AS (SELECT string_split('{owner}', ',') AS owner)
SELECT doc_id, slot, 'shard-' || lpad(owner[slot + 1], 3, '0') AS shard FROM s, t"""


@query("op2_sharding", _oracle())
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, slot and shard of every row of ``documents``, keyed by doc_id over 64 shards."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return place(docs, "doc_id", _names()).select("doc_id", "slot", "shard")
