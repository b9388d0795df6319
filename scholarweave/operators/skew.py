"""Equi joins that split heavy hitters.

A frequency sketch (one map-side combined aggregate) names the keys that may hold more than a small
part of a partition; their rows are counted exactly, and only these keys are split, into as many lanes
as their own count asks for.  All other rows go by their key as in a plain join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANES_A_PARTITION = 8       # a lane is this part of a mean partition, so that lanes fill partitions evenly
_MOST_TRACKED = 1_000_000   # Spark's limit for items of a sketch


def heavy_hitters(df: DataFrame, key: Column, partitions: int) -> DataFrame:
    """(key, lanes) of the keys that hold more rows than a lane; at most ``LANES_A_PARTITION * partitions`` rows.

    The sketch tracks four times as many keys as can be heavy; what it names beyond is dropped by the exact
    count, and a key just above the bound that it misses stays unsplit.  Null keys match nothing and are left out.
    """
    rows = df.select(key.alias("key")).where("key is not null")
    most = min(LANES_A_PARTITION * partitions, _MOST_TRACKED // 4)
    found = rows.agg(F.expr(f"approx_top_k(key, {most}, {4 * most})").alias("top"), F.count("*").alias("n"))
    named = found.select(F.explode("top").alias("t"), "n").select(F.col("t.item").alias("key"), "n")
    lane = F.greatest(F.col("n") / most, F.lit(1))
    counted = rows.join(F.broadcast(named), "key").groupBy("key", "n").agg(F.count("*").alias("rows"))
    return counted.where(F.col("rows") > lane).select("key", F.ceil(F.col("rows") / lane).cast("int").alias("lanes"))


def _broadcast(df: DataFrame) -> bool:
    """The planner will broadcast ``df``: by its statistics it is within ``spark.sql.autoBroadcastJoinThreshold``."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def skew_join(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, how: str = "inner",
              residual: Column | None = None, partitions: int | None = None) -> DataFrame:
    """``left`` joined to ``right`` on equal keys (and ``residual``); inner, left, left_semi or left_anti.

    A key that is heavy on the left is split into lanes: a left row takes one by its hash, right rows go
    to each.  In an inner join a key heavy on the right is split too, and then left rows go to each of
    those lanes.  Both tables are read twice, so cut the lineage of dear ones first.  A right side that is
    small enough to be broadcast is joined plainly: nothing is dealt by key then.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot split the rows of a {how} join")
    spark = left.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = left_key == right_key if residual is None else (left_key == right_key) & residual
    if _broadcast(right):
        return left.join(right, plain, how)
    # one row a heavy key, so never more than LANES_A_PARTITION * n of a side
    a = {r.key: r.lanes for r in heavy_hitters(left, left_key, n).collect()}
    b = {r.key: r.lanes for r in heavy_hitters(right, right_key, n).collect()} if how == "inner" else {}
    if not a and not b:
        return left.join(right, plain, how)
    kind = left.select(left_key.alias("key")).schema["key"].dataType.simpleString()
    lanes = spark.createDataFrame([(k, a.get(k, 1), b.get(k, 1)) for k in {**a, **b}], f"key {kind}, a int, b int")

    def dealt(df: DataFrame, key: Column, own: str, other: str, side: str) -> DataFrame:
        """Own lane by the row's hash, all lanes of the other side."""
        known = lanes.select(F.col("key").alias(f"_k{side}"), F.col(own).alias("_own"), F.col(other).alias("_other"))
        rows = df.withColumn(f"_key{side}", key).join(F.broadcast(known), F.col(f"_key{side}") == F.col(f"_k{side}"), "left")
        mine = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.monotonically_increasing_id()),
                      F.coalesce("_own", F.lit(1))).cast("int")
        all_ = F.sequence(F.lit(0), F.coalesce(F.col("_other") - 1, F.lit(0)))
        rows = rows.withColumn(f"_mine{side}", mine).withColumn(f"_all{side}", F.explode(all_))
        return rows.drop(f"_k{side}", "_own", "_other")

    x, y = dealt(left, left_key, "a", "b", "l"), dealt(right, right_key, "b", "a", "r")
    on = [F.col("_keyl") == F.col("_keyr"), F.col("_minel") == F.col("_allr"), F.col("_alll") == F.col("_miner")]
    on += [] if residual is None else [residual]
    added = [f"_{c}{s}" for c in ("key", "mine", "all") for s in "lr"]
    return x.join(y, reduce(Column.__and__, on), how).drop(*added)
