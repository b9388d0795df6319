"""Joins that split heavy keys: same rows as a plain join, no task far above the median."""

import collections

import pytest
from pyspark.sql import functions as F

from scholarweave.operators.skew import heavy_hitters, skew_join


@pytest.fixture
def plain(spark):
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _left(spark, n=40_000):
    """A third of the rows under one key, a tenth under another, the rest under 4,000 keys."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, "warm").otherwise(
        F.concat(F.lit("k"), (F.col("id") % 4000).cast("string")))
    return spark.range(n).select("id", key.alias("k"))


def test_heavy_keys_get_lanes_by_their_own_count(spark):
    got = {r.key: r.lanes for r in heavy_hitters(_left(spark), F.col("k"), 8).collect()}
    assert got.keys() == {"hot", "warm"}
    assert got["hot"] == pytest.approx(64 / 3, abs=1) and got["warm"] == pytest.approx(64 / 15, abs=1)
    assert heavy_hitters(spark.range(1000).select(F.col("id").cast("string").alias("k")), F.col("k"), 8).collect() == []


def test_no_task_reads_three_times_the_median(spark, plain):
    left = _left(spark)
    right = left.select(F.col("k").alias("r")).distinct().withColumn("v", F.length("r"))
    joined = skew_join(left, right, F.col("k"), F.col("r"))
    sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
    assert sum(sizes) == 40_000 and sizes[-1] <= 3 * sizes[len(sizes) // 2]
    unsplit = sorted(r["count"] for r in left.join(right, F.col("k") == F.col("r")).groupBy(
        F.spark_partition_id()).count().collect())
    assert unsplit[-1] > 3 * unsplit[len(unsplit) // 2]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_rows_as_a_plain_join(spark, plain, how):
    left = _left(spark, 3000).unionByName(spark.createDataFrame([(-1, None), (-1, None), (-2, "alone"), (7, "k7")], "id long, k string"))
    right = _left(spark, 500).where("k <> 'warm'").select(F.col("k").alias("r"), F.col("id").alias("v")).unionByName(
        spark.createDataFrame([(None, 1), ("k7", 2), ("k7", 2)], "r string, v long"))
    want = left.join(right, (F.col("k") == F.col("r")) & (F.col("v") % 2 == F.col("id") % 2), how)
    got = skew_join(left, right, F.col("k"), F.col("r"), how, F.col("v") % 2 == F.col("id") % 2)
    assert got.columns == want.columns
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(map(tuple, want.collect()))
    if how == "left":
        with pytest.raises(ValueError):
            skew_join(left, right, F.col("k"), F.col("r"), "full")


def test_empty_sides(spark):
    left, right = _left(spark, 10), _left(spark, 10).select(F.col("k").alias("r"))
    assert skew_join(left.where("false"), right, F.col("k"), F.col("r")).collect() == []
    assert skew_join(left, right.where("false"), F.col("k"), F.col("r")).collect() == []
    assert skew_join(left, right.where("false"), F.col("k"), F.col("r"), "left").count() == 10
