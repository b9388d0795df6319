"""Streaming and iterative queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarweave.operators.residual import residual_nodes
from scholarweave.plans import q_graph as G
from scholarweave.plans.registry import query
from scholarweave.schemas import ENTITY_FIELDS
from scholarweave.session import table
from scholarweave.sinks.registry import read_registry
from scholarweave.streaming import state
from scholarweave.streaming.incremental import scratch_dir, stream_entity_ids as start_id_stream

STATE_PARTITIONS = 4


@query("stream_entity_ids", """
SELECT url AS source_url, 'Page' AS item_type,
       CAST(row_number() OVER (ORDER BY url) AS BIGINT) AS id
FROM (SELECT DISTINCT url FROM pages WHERE url IS NOT NULL AND url <> '')""")
def stream_entity_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Page files streamed with ``availableNow``; IDs registered per micro-batch via
    ``foreachBatch`` with the batch functions; equals the batch answer (X1, X2).

    The table may be one file or a folder of files: as a glob, either is listed down to its files."""
    schema = table(spark, sf, "pages").schema
    work = scratch_dir(spark, "stream-ids")
    q = start_id_stream(spark, f"{sf.rstrip('/')}/pages.parque[t]", schema, f"{work}/registry", f"{work}/checkpoint",
                        url_col="url", item_type="Page")
    q.awaitTermination()
    return read_registry(spark, f"{work}/registry")


@query("stream_organization_backfill", f"""
WITH o AS (SELECT r_regionkey AS source,
                  CAST(row_number() OVER (ORDER BY '{G.ORG_ROOT}' || lower(r_name) || '/') AS BIGINT) AS id
           FROM region)
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, o.id AS organization_id
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN o ON o.source = n_regionkey
WHERE n_regionkey <> 4""")
def stream_organization_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """Persons and organisations as files that arrive in three parts, most persons before their
    organisation (X3): keyed state gives each its organisation once; one organisation never comes."""
    work = scratch_dir(spark, "stream-orgs")
    ids, _ = G.idops.assign_ids(G.render_orgs(spark, sf).select("source_url", F.lit("Organization").alias("item_type")))
    orgs = G.idops.attach_id(G.render_orgs(spark, sf), ids, "Organization").select(
        F.col("source").cast("string").alias("source"), "id").where("source <> '4'")
    people = G.render_persons(spark, sf).select(F.col("source").cast("string").alias("source"),
                                                F.col("c_custkey").cast("bigint").alias("c_custkey"), "position")
    for k in range(3):
        people.where(f"c_custkey % 3 = {k}").write.mode("append").parquet(f"{work}/people")
        orgs.where(f"(source + 1) % 3 = {k}").write.mode("append").parquet(f"{work}/orgs")
        state.stream_organization_backfill(spark, f"{work}/people", people.schema, f"{work}/orgs", f"{work}/out",
                                           f"{work}/checkpoint", partitions=STATE_PARTITIONS)
    return spark.read.parquet(f"{work}/out").select("c_custkey", "organization_id")


# --------------------------------------------------------------------------- the ordered pipeline as a stream

ARRIVALS = 3
_NUMBER = "CAST(regexp_extract({}, '([0-9]+)$', 1) AS BIGINT)"
_STREAM_RENDER = G.SQL_RENDER.replace(
    "'+49 30 ' || CAST", "CASE WHEN c_custkey % 7 = 0 AND c_custkey % 3 <> 2 THEN '+49 40 ' ELSE '+49 30 ' END || CAST")
_STREAM_IDS = G.sql_ids(f"""
    SELECT source_url, 'Organization' AS item_type, (source + 1) % 3 AS arrival FROM orgs
    UNION ALL SELECT source_url, 'Division', {_NUMBER.format('source_url')} % 3 FROM divs
    UNION ALL SELECT source_url, 'Person', {_NUMBER.format('source_url')} % 3 FROM pers
    UNION ALL SELECT source_url, 'DivisionRole', ({_NUMBER.format('person_url')} + 1) % 3 FROM roles
              WHERE person_url <> '' AND division_url <> ''
    UNION ALL SELECT division_url, 'Division', ({_NUMBER.format('person_url')} + 1) % 3 FROM roles
              WHERE person_url <> '' AND division_url <> ''""")


def _items(df: DataFrame, item_type: str, arrival) -> DataFrame:
    """Rows of one type as the stream's items: type, source, JSON of the type's fields."""
    fields = [F.col(f) for f in ENTITY_FIELDS[item_type] if f in df.columns]
    source = F.col("source").cast("string") if "source" in df.columns else F.lit(None).cast("string")
    return df.select(F.lit(item_type).alias("item_type"), source.alias("source"),
                     F.to_json(F.struct(*fields)).alias("item"), arrival.cast("int").alias("arrival"))


def _number(url: str):
    return F.regexp_extract(url, "([0-9]+)$", 1).cast("bigint")


@query("stream_rdf_deltas", "WITH t AS (" + G.triples_sql(_STREAM_RENDER, _STREAM_IDS) + ")\n" + G.LINES_OF_T)
def stream_rdf_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """Items that arrive in three parts through IDs, references and triples (X1, A4): the sum of the delta log.

    Roles come before or after their persons, persons before or after their organisations, and the last
    part changes the phone of every seventh earlier person, which withdraws and adds triples.
    """
    persons = G.render_persons(spark, sf)
    arrival = F.col("c_custkey") % ARRIVALS
    changed = persons.where((F.col("c_custkey") % 7 == 0) & (arrival != ARRIVALS - 1)).withColumn(
        "phone", F.replace("phone", F.lit("+49 30 "), F.lit("+49 40 ")))
    items = [_items(G.render_orgs(spark, sf), "Organization", (F.col("source") + 1) % ARRIVALS),
             _items(G.render_divisions(spark, sf), "Division", _number("source_url") % ARRIVALS),
             _items(persons, "Person", arrival), _items(changed, "Person", F.lit(ARRIVALS - 1)),
             _items(G.render_roles(persons), "DivisionRole", (_number("person_url") + 1) % ARRIVALS)]
    work = scratch_dir(spark, "stream-rdf")
    partitions = max(STATE_PARTITIONS, spark.sparkContext.defaultParallelism)     # a task for every core
    for k in range(ARRIVALS):
        for part in items:
            part.where(F.col("arrival") == k).drop("arrival").write.mode("append").parquet(f"{work}/items")
        deltas = state.run_pipeline(spark, f"{work}/items", work, partitions)
    return state.graph_of(deltas)


@query("edge_residual_nodes", """
WITH RECURSIVE back AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem
                        WHERE l_returnflag = 'R' AND l_linenumber = 1),
fwd AS (SELECT DISTINCT l_partkey AS p, l_suppkey AS s FROM lineitem),
hop AS (SELECT DISTINCT back.s AS a, fwd.s AS b FROM back JOIN fwd ON back.p = fwd.p),
reach(a, b) AS (SELECT a, b FROM hop UNION SELECT r.a, hop.b FROM reach r JOIN hop ON hop.a = r.b),
hot AS (SELECT DISTINCT b AS s FROM reach WHERE a IN (SELECT a FROM reach WHERE a = b))
SELECT 's' || CAST(s AS VARCHAR) AS node FROM hot
UNION SELECT 'p' || CAST(p AS VARCHAR) FROM back WHERE s IN (SELECT s FROM hot)""")
def edge_residual_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes on a cycle or reachable from one: part -> supplier edges for every line,
    supplier -> part back edges for returned first lines (P3).  Iterative peel; the
    oracle takes the transitive closure instead."""
    li = table(spark, sf, "lineitem")
    fwd = li.select(F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("src"),
                    F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("dst"))
    back = (li.where((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1))
              .select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("src"),
                      F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dst")))
    return residual_nodes(fwd.unionByName(back))
