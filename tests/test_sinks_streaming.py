"""Sinks, registry persistence and streaming IDs."""

import os
import tempfile

from pyspark.sql import functions as F

from scholarweave.operators import ids as idops
from scholarweave.sinks import registry as R
from scholarweave.sinks import writers as W
from scholarweave.streaming import incremental as S


def _tmp():
    return tempfile.mkdtemp(prefix="sw-test-", dir="/tmp")


def test_csv_serializers_and_per_source_overwrite(spark):
    out = _tmp()
    pubs = spark.createDataFrame(
        [("u1", [("Jane", "Roe")], ["http://p/1"], "")],
        "source_url string, author_names array<struct<firstname:string,lastname:string>>, "
        "author_urls array<string>, doi string")
    W.write_entities(pubs, out, "hiig", "Publication")
    other = spark.createDataFrame([("o1",)], "source_url string")
    W.write_entities(other, out, "zbw", "Organization")
    back = spark.read.option("header", True).option("escape", "\"").csv(W.entity_path(out, "hiig", "Publication")).collect()[0]
    assert back.author_names == '[["Jane","Roe"]]' and back.author_urls == '["http://p/1"]'
    d = W.entity_path(out, "hiig", "Publication")
    lines = [ln for f in sorted(os.listdir(d)) if f.endswith(".csv") for ln in open(os.path.join(d, f)).read().splitlines()]
    data = [ln for ln in lines if ln.startswith("u1,")]
    assert data and data[0].endswith(",")                 # '' written as empty, not ""
    W.write_entities(pubs.limit(0), out, "hiig", "Publication")    # K2: a new run replaces hiig only
    assert spark.read.option("header", True).csv(W.entity_path(out, "hiig", "Publication")).count() == 0
    assert spark.read.option("header", True).csv(W.entity_path(out, "zbw", "Organization")).count() == 1


def test_name_struct_serializer(spark):
    df = spark.createDataFrame([(("Jane", "Roe"),)], "name struct<firstname:string,lastname:string>")
    assert W.serialize_columns(df).first().name == "Roe, Jane"


def test_json_lines_and_ntriples(spark):
    out = _tmp()
    df = spark.createDataFrame([("u1", ["a", "b"])], "source_url string, position array<string>")
    W.write_entities(df, out, "zbw", "Person", fmt="json")
    assert spark.read.json(W.entity_path(out, "zbw", "Person")).first().position == ["a", "b"]
    t = spark.createDataFrame([("http://s", "http://p", "x", "literal", None)],
                              "s string, p string, o string, o_kind string, o_datatype string")
    W.write_ntriples(t, f"{out}/g.nt")
    assert spark.read.text(f"{out}/g.nt").first().value == '<http://s> <http://p> "x" .'
    assert W.prefix_lines()[0] == "@prefix foaf: <http://xmlns.com/foaf/0.1/> ."


def test_n3_parts_share_one_set_of_bindings(spark):
    import re

    from scholarweave.operators.triples import PREFIXES
    foaf, local = PREFIXES["foaf"], "http://vivo.mydomain.edu/individual/"
    rows = [(f"{local}{k}", f"{foaf}firstName", f'a"{k}\n', "literal", None) for k in range(40)]
    rows += [(f"{local}0", "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", f"{foaf}Person", "iri", None),
             (f"{local}0", f"{foaf}9x", f"{foaf}a/b", "iri", None),                       # no valid short names
             (f"{local}0", f"{foaf}page", "http://x", "literal", "http://www.w3.org/2001/XMLSchema#anyURI")]
    t = spark.createDataFrame(rows, "s string, p string, o string, o_kind string, o_datatype string").repartition(4)
    path = W.write_n3(t, f"{_tmp()}/g.n3")
    parts = [open(os.path.join(path, f)).read().splitlines() for f in sorted(os.listdir(path)) if f.startswith("part-")]
    assert parts[0] == W.prefix_lines() and len(parts) > 2
    lines = [line for p in parts[1:] for line in p]
    assert not any(line.startswith("@prefix") for line in lines)
    # expanding the bound names gives the N-Triples lines again
    bound = dict(re.fullmatch(r"@prefix (\w+): <(.*)> \.", line).groups() for line in parts[0])
    name = re.compile(r"(?<=[ ^])(\w+):(\w+)(?= )")
    full = [re.sub(name, lambda m: f"<{bound[m[1]]}{m[2]}>", line) for line in lines]
    assert sorted(full) == sorted(r.line for r in W.ntriples_lines(t).collect())
    assert any(" foaf:firstName " in line for line in lines) and any(f"<{foaf}9x> <{foaf}a/b> ." in line for line in lines)
    empty = W.write_n3(t.limit(0), f"{_tmp()}/e.n3")
    assert [r.value for r in spark.read.text(empty).collect()] == W.prefix_lines()


def test_registry_append_and_second_run(spark):
    reg_path = f"{_tmp()}/registry"
    assert R.read_registry(spark, reg_path).count() == 0                  # S5
    keys = spark.createDataFrame([("b", "T"), ("a", "T")], "source_url string, item_type string")
    _, new = idops.assign_ids(keys, R.read_registry(spark, reg_path))
    R.append_registry(new, reg_path)
    more = spark.createDataFrame([("c", "T"), ("a", "T")], "source_url string, item_type string")
    ids, new2 = idops.assign_ids(more, R.read_registry(spark, reg_path))
    R.append_registry(new2, reg_path)
    got = {r.source_url: r.id for r in R.read_registry(spark, reg_path).collect()}
    assert got == {"a": 1, "b": 2, "c": 3}
    assert {r.source_url: r.id for r in ids.collect()} == {"a": 1, "c": 3}


def test_stream_ids_replay_is_idempotent(spark):
    src = _tmp()
    # one file per micro-batch, with increasing modification times (the file source's order)
    spark.createDataFrame([("http://x/2",), ("http://x/1",)], "url string").coalesce(1).write.parquet(f"{src}/f1")
    spark.createDataFrame([("http://x/3",), ("http://x/1",)], "url string").coalesce(1).write.parquet(f"{src}/f2")
    flat = _tmp()
    for i, d in enumerate(("f1", "f2")):
        f = [x for x in os.listdir(f"{src}/{d}") if x.endswith(".parquet")][0]
        os.link(f"{src}/{d}/{f}", f"{flat}/part-{i}.parquet")
        os.utime(f"{flat}/part-{i}.parquet", (1_700_000_000 + i * 100, 1_700_000_000 + i * 100))
    work = _tmp()
    q = S.stream_entity_ids(spark, flat, "url string", f"{work}/reg", f"{work}/ckpt", max_files_per_trigger=1)
    q.awaitTermination()
    got = {r.source_url: r.id for r in spark.read.parquet(f"{work}/reg").collect()}
    assert got == {"http://x/1": 1, "http://x/2": 2, "http://x/3": 3}
    # replaying batch 1 rewrites the same rows instead of appending new IDs
    batch1 = spark.read.parquet(f"{flat}/part-1.parquet")
    S.id_batch_writer(f"{work}/reg", "url", "Page")(batch1, 1)
    again = sorted((r.source_url, r.id) for r in spark.read.parquet(f"{work}/reg").collect())
    assert again == [("http://x/1", 1), ("http://x/2", 2), ("http://x/3", 3)]


def test_lookup_leaves_the_registry_in_its_buckets(spark):
    reg_path = f"{_tmp()}/registry"
    keys = spark.range(500).selectExpr("concat('u', id) source_url", "if(id % 3 = 0, 'A', 'B') item_type")
    for part in (keys.where("source_url < 'u3'"), keys):
        _, new = idops.assign_ids(part, R.read_registry(spark, reg_path))
        R.append_registry(new, reg_path, buckets=16)
    got = R.read_registry(spark, reg_path)
    assert got.count() == 500 and got.dropDuplicates(["item_type", "id"]).count() == 500
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = keys.join(got, ["source_url", "item_type"], "left")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    scan = next(i for i, line in enumerate(plan.splitlines()) if "FileScan" in line)
    lines = plan.splitlines()
    assert sum("Exchange" in line for line in lines) == 1                # of the run's keys
    assert "Bucketed: true" in lines[scan] and not any("Exchange" in line for line in lines[scan - 3:scan])


def test_a_replayed_micro_batch_replaces_its_ids(spark):
    reg_path = f"{_tmp()}/registry"
    rows = lambda *r: spark.createDataFrame(list(r), "source_url string, item_type string, id long")
    R.append_registry(rows(("a", "T", 1)), reg_path)
    R.append_registry(rows(("b", "T", 2), ("c", "T", 3)), reg_path, 0)
    R.append_registry(rows(("d", "T", 4)), reg_path, 1)
    R.append_registry(rows(("b", "T", 2)), reg_path, 0)
    ids = lambda b=None: sorted(r.id for r in R.read_registry(spark, reg_path, b).collect())
    assert ids() == [1, 2, 4] and ids(0) == [1, 4]
    R.append_registry(rows().limit(0), reg_path, 0)
    assert ids() == [1, 4]


def test_stream_query_reads_a_table_of_several_files(spark):
    from scholarweave.plans.q_stream import stream_entity_ids

    for files in (1, 3):
        sf = _tmp()
        rows = spark.createDataFrame([(f"http://x/{k % 5}",) for k in range(9)] + [(None,), ("",)], "url string")
        rows.repartition(files).write.parquet(f"{sf}/pages.parquet")
        got = stream_entity_ids(spark, sf)
        assert got.columns == ["source_url", "item_type", "id"]
        assert sorted(map(tuple, got.collect())) == [(f"http://x/{k}", "Page", k + 1) for k in range(5)]
    empty = _tmp()
    rows.limit(0).write.parquet(f"{empty}/pages.parquet")
    assert stream_entity_ids(spark, empty).count() == 0
