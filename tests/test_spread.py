"""Work that is large per row of a narrow table is dealt over tasks, whatever the number of the table's files."""

import pytest
from pyspark.sql import functions as F

from scholarweave.plans.registry import QUERIES, load_all
from scholarweave.session import spread

ROWS = 2_500
TABLES = {
    "customer": ["id c_custkey", "concat('Name', id) c_name", "'BUILDING' c_mktsegment"],
    "part": ["id p_partkey", "concat('blue ring ', id) p_name", "'Brand#11' p_brand", "'PROMO' p_type",
             "cast(id % 50 + 1 as int) p_size"],
    "supplier": ["id s_suppkey", "concat('Name', id) s_name", "cast(id % 25 as int) s_nationkey", "1.0D s_acctbal"],
}


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("sf"))
    for name, columns in TABLES.items():
        spark.range(ROWS).selectExpr(*columns).coalesce(1).write.parquet(f"{out}/{name}.parquet")
    return out


@pytest.mark.parametrize("name", ["site_gesis_publications", "site_zbw_publications", "site_hiig_persons", "site_zbw_divisions",
                                  "author_link_greedy", "feature_pivot", "following_text", "hcard_fields"])
def test_one_file_is_worked_on_by_several_tasks(spark, sf, name):
    load_all()
    rows = QUERIES[name](spark, sf).withColumn("task", F.spark_partition_id())
    got = rows.agg(F.count("*").alias("n"), F.countDistinct("task").alias("tasks")).first()
    assert got.n >= ROWS and got.tasks >= 4


def test_spread_keeps_every_row(spark):
    odd = spark.createDataFrame([(None,), (1,), (1,)], "k int")
    assert sorted(map(str, spread(odd, 1).collect())) == sorted(map(str, odd.collect()))
    assert spread(spark.range(100), 10).rdd.getNumPartitions() == 10
    assert spread(odd.limit(0)).count() == 0


def test_triples_are_made_from_a_bounded_number_of_rows_a_task(spark, monkeypatch):
    from scholarweave.plans import graph

    monkeypatch.setattr(graph, "ROWS_PER_TASK", 100, raising=False)
    url = "concat('http://p/', id) as source_url"
    people = spark.range(1_000).coalesce(1).selectExpr("'a' as source", url, "concat('N ', id) as name")
    orgs = spark.createDataFrame([("a", "http://a/", "A")], "source string, source_url string, name string")
    roles = spark.range(1_000).coalesce(1).selectExpr("'http://a/d' as source_url", "'lead' as name",
                                                      "'http://a/d' as division_url", "concat('http://p/', id) as person_url")
    divisions = orgs.selectExpr("source", "'http://a/d' as source_url", "name")
    g = graph.build_graph(orgs, divisions, people, roles)
    plan = g.triples._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Repartition 11, true") == 2
    assert g.triples.count() == g.triples.distinct().count() > 1_000 * 8
