"""Keyed state of the streams (X1, X3, A4): late references, replays, timeouts, triple deltas of any batch split."""

import json
import os
import random
import tempfile

from pyspark.sql import Row
from pyspark.sql import functions as F

from scholarweave.operators import triples as tr
from scholarweave.plans.graph import build_graph
from scholarweave.streaming import state as S

ENTITY, ORG = "source string, source_url string, position array<string>", "source string, id bigint"


def _tmp():
    return tempfile.mkdtemp(prefix="sw-state-", dir="/tmp")


def _arrive(spark, work, entities=(), orgs=(), **kw):
    spark.createDataFrame([(s, u, ["a", "b"]) for s, u in entities], ENTITY).write.mode("append").parquet(f"{work}/entities")
    spark.createDataFrame(list(orgs), ORG).write.mode("append").parquet(f"{work}/orgs")
    S.stream_organization_backfill(spark, f"{work}/entities", ENTITY, f"{work}/orgs", f"{work}/out", f"{work}/ckpt",
                                   partitions=2, **kw)
    rows = spark.read.parquet(f"{work}/out").collect()
    assert all(r.position == ["a", "b"] for r in rows)
    return sorted((r.source_url, r.organization_id) for r in rows)


def test_entities_wait_for_their_organization_in_any_order(spark):
    work = _tmp()
    assert _arrive(spark, work, [("zbw", "p1"), ("hiig", "h1"), (None, "x")], [("hiig", 3)]) == [("h1", 3)]
    assert _arrive(spark, work, [], [("zbw", 9), ("zbw", 7), ("hiig", 1)]) == [("h1", 3), ("p1", 7)]
    assert _arrive(spark, work, [("zbw", "p2"), ("zbw", "p2")], [("zbw", 5)]) == [
        ("h1", 3), ("p1", 7), ("p2", 7), ("p2", 7)]              # the first registered id of a source stays


def test_a_replayed_batch_writes_the_same_rows(spark):
    work = _tmp()
    _arrive(spark, work, [("a", f"a{i}") for i in range(20)] + [("b", "b0")], [("b", 2)])
    before = _arrive(spark, work, [("a", "late")], [("a", 1)])
    assert len(before) == 22
    os.remove(f"{work}/ckpt/commits/1")                          # as if the driver had died before the commit
    if os.path.exists(f"{work}/ckpt/commits/.1.crc"):
        os.remove(f"{work}/ckpt/commits/.1.crc")
    assert _arrive(spark, work) == before


def test_what_waits_is_bounded_by_state_not_by_the_log(spark):
    work = _tmp()
    _arrive(spark, work, [("a", f"a{i}") for i in range(50)], [("a", 1)])
    for name in ("entities", "orgs"):                            # everything that has been read may go
        for f in os.listdir(f"{work}/{name}"):
            os.truncate(f"{work}/{name}/{f}", 0) if f.startswith("part") else None
    assert len(_arrive(spark, work, [("a", "next")])) == 51


def test_an_entity_is_released_when_its_time_is_over(spark):
    work = _tmp()
    assert _arrive(spark, work, [("a", "p")], wait_ms=1) == []
    assert _arrive(spark, work, [("b", "q")], wait_ms=1) == [("p", None)]


def test_old_and_repeated_versions_change_nothing(spark):
    work = _tmp()
    batches = [[("k", 1, ["x", "y"]), ("m", 1, ["x"])], [("k", 3, ["y", "z"])], [("k", 2, ["old"]), ("k", 3, ["y", "z"])],
               [("m", 2, []), ("k", 4, [])]]
    schema = "key string, version bigint, lines array<string>"
    seen = []
    for b in batches:
        spark.createDataFrame(b, schema).write.mode("append").parquet(f"{work}/in")
        stream = S._read(spark, f"{work}/in", schema, None)
        S._run(spark, S.triple_deltas(stream, 2), S.write_to(f"{work}/out"), f"{work}/ckpt", 2)
        log = spark.read.parquet(f"{work}/out")
        seen.append(sorted((r.line, r.sign) for r in log.where(f"batch_id = {len(seen)}").collect()))
    assert seen == [[("x", 1), ("y", 1)], [("z", 1)], [], [("x", -1), ("y", -1), ("z", -1)]]
    assert S.graph_of(log).collect() == []


def _site():
    orgs = [("a", "http://a/", "Org A"), ("b", "http://b/", "Org B")]
    divs = [(s, f"http://{s}/d{k}", f"D{k}") for s in "ab" for k in range(3)]
    people = [("ab"[k % 2], f"http://p/{k}", f"Person {k}") for k in range(20)]
    roles = [(f"http://{s}/d{int(u[-1]) % 3}", f"http://{s}/d{int(u[-1]) % 3}", u) for s, u, _ in people]
    return orgs, divs, people, roles + [("http://a/d0", "", "http://p/1"), ("http://a/d0", "http://a/d0", "http://p/none")]


def _item(item_type, source, **fields):
    return item_type, source, json.dumps(fields)


def _renamed(lines, ids):
    """Lines with each entity's IRI number replaced by its URL, so that runs with other ids compare."""
    out = set()
    for line in lines:
        for number, url in ids.items():
            line = line.replace(number, url)
        out.add(line)
    return out


def test_deltas_of_any_split_sum_to_the_batch_graph(spark):
    orgs, divs, people, roles = _site()
    old = [_item("Person", s, source_url=u, name=n + " old", phone="1") for s, u, n in people[:5]]
    items = [_item("Organization", s, source_url=u, name=n) for s, u, n in orgs]
    items += [_item("Division", s, source_url=u, name=n) for s, u, n in divs]
    items += [_item("Person", s, source_url=u, name=n, position=["x"]) for s, u, n in people]
    items += [_item("DivisionRole", None, source_url=d, name="lead", division_url=v, person_url=p) for d, v, p in roles]
    graph = build_graph(
        spark.createDataFrame(orgs, "source string, source_url string, name string"),
        spark.createDataFrame(divs, "source string, source_url string, name string"),
        spark.createDataFrame([(s, u, n, ["x"]) for s, u, n in people],
                              "source string, source_url string, name string, position array<string>"),
        spark.createDataFrame([(d, "lead", v, p) for d, v, p in roles],
                              "source_url string, name string, division_url string, person_url string"))
    types = {"Person": ("p", "i", "m"), "Division": ("od",), "Organization": ("o", "oi"), "DivisionRole": ("dm",)}

    def names(ids):
        return {f"individual/{x}{r.id:08d}": f"{x}:{r.source_url}" for r in ids.collect() for x in types[r.item_type]}
    want = _renamed([r.line for r in tr.ntriples_lines(graph.triples).collect()], names(graph.ids))
    newer = {u for _, u, _ in people[:5]}                        # their old version comes first
    last = [i for i in items if i[0] == "Person" and json.loads(i[2])["source_url"] in newer]
    rest = [i for i in items if i not in last]
    random.Random(1).shuffle(rest)
    orgs_first = sorted(rest, key=lambda i: i[0] != "Organization")
    for batches, signs in (([old, rest + last], {1}), ([orgs_first[:15] + old, orgs_first[15:25], orgs_first[25:] + last], {0, 1})):
        work = _tmp()
        for batch in batches:
            spark.createDataFrame(batch, S.ITEMS).write.mode("append").parquet(f"{work}/items")
            deltas = S.run_pipeline(spark, f"{work}/items", work, 2)
        got = _renamed([r.line for r in S.graph_of(deltas).collect()], names(spark.read.parquet(f"{work}/registry")))
        assert (got - want, want - got) == (set(), set())
        # a line is added at most once; in the second split the old versions were out and are withdrawn
        assert {r.n for r in deltas.groupBy("line").agg(F.sum("sign").alias("n")).collect()} == signs


def test_support_is_summed_by_spark_and_counted_once(spark):
    """Most lines are one entity's: the pipeline keeps no Python state for each, and a replayed step adds nothing."""
    orgs, divs, people, roles = _site()
    work = _tmp()
    items = [_item("Organization", s, source_url=u, name=n) for s, u, n in orgs]
    items += [_item("Person", s, source_url=u, name=n) for s, u, n in people]
    for batch in (items[:6], items[6:] + [_item("Person", "a", source_url="http://p/0", name="New name")]):
        spark.createDataFrame(batch, S.ITEMS).write.mode("append").parquet(f"{work}/items")
        deltas = S.run_pipeline(spark, f"{work}/items", work, 2)
    assert not os.path.exists(f"{work}/deltas") and spark.read.parquet(f"{work}/support").columns == ["line", "n", "batch_id"]
    first = sorted((r.line, r.sign) for r in deltas.collect())
    assert {s for _, s in first} == {1, -1} and any("New name" in line for line, _ in first)
    for step in ("changes", "support"):
        for name in ("1", ".1.crc"):
            if os.path.exists(f"{work}/checkpoint-{step}/commits/{name}"):
                os.remove(f"{work}/checkpoint-{step}/commits/{name}")
    again = S.run_pipeline(spark, f"{work}/items", work, 2)
    assert sorted((r.line, r.sign) for r in again.collect()) == first


class _Handle:
    """State of one bucket in Python, counting the calls on it."""

    def __init__(self):
        self.calls, self.values, self.lists = 0, {}, {}

    def getValueState(self, name, schema):
        return _Value(self, name)

    def getListState(self, name, schema):
        return _List(self, name)


class _Value:
    def __init__(self, handle, name):
        self.handle, self.name = handle, name

    def get(self):
        self.handle.calls += 1
        return self.handle.values.get(self.name)

    def update(self, value):
        self.handle.calls += 1
        self.handle.values[self.name] = value


class _List:
    def __init__(self, handle, name):
        self.handle, self.name = handle, name

    def get(self):
        self.handle.calls += 1
        return iter(list(self.handle.lists.get(self.name, [])))

    def appendList(self, values):
        self.handle.calls += 1
        self.handle.lists.setdefault(self.name, []).extend(values)

    def clear(self):
        self.handle.calls += 1
        self.handle.lists.pop(self.name, None)


def _given(processor, handle, names, rows):
    before = handle.calls
    out = list(processor.handleInputRows((0,), iter([Row(*names)(*r) for r in rows]), None))
    return out, handle.calls - before


def test_state_is_called_once_a_bucket_not_once_a_key():
    keys = [f"k{i}" for i in range(2500)]
    diff, handle = S.EntityDiff(), _Handle()
    diff.init(handle)
    names = ("key", "version", "value")
    out, calls = _given(diff, handle, names, [(k, 1, "a") for k in keys] + [("k0", 1, "b")])
    assert calls == 2 and sorted((r.key, *r.new, *r.old) for r in out) == sorted(
        [(k, "a") for k in keys[1:]] + [("k0", "a", "b")])
    out, calls = _given(diff, handle, names, [(k, 2, "a") for k in keys] + [("k1", 3, "c"), ("k2", 1, "late")])
    assert calls == 2 and [(r.key, r.new, r.old) for r in out] == [("k0", ["a"], ["a", "b"]), ("k1", ["c"], ["a"])]
    assert _given(diff, handle, names, [("k1", 3, "c")]) == ([], 1)

    wait, handle = S.AwaitReference(), _Handle()
    wait.init(handle)
    names = ("key", "entity", "ref")
    assert _given(wait, handle, names, [(k, f"{k} first", None) for k in keys]) == ([], 2)
    out, calls = _given(wait, handle, names, [(k, None, i) for i, k in enumerate(keys[:2000])] + [
        ("k7", None, 5), ("k0", "k0 too", None), ("k2499", "last", None)])
    assert calls <= 7 and sorted((r.entity, r.ref) for r in out) == sorted(
        [(f"{k} first", 5 if k == "k7" else i) for i, k in enumerate(keys[:2000])] + [("k0 too", 0)])
    out, _ = _given(wait, handle, names, [("k7", None, 1), ("k7", "later", None)] + [(k, None, 9) for k in keys[2000:]])
    assert sorted((r.entity, r.ref) for r in out) == sorted(
        [("later", 5), ("last", 9)] + [(f"{k} first", 9) for k in keys[2000:]])


def test_lines_of_persons_and_organizations_are_theirs_alone(spark):
    """Ids of eight and more digits too, whose numbers run into the suffixes of other nodes."""
    ids = [1, 2, 12, 18, 1234567, 12345678, 12345681, 123456781, 123456788, 1234567881]
    full = {"name": "N", "firstname": "F", "lastname": "L", "title": "T", "email": "E", "phone": "P", "position": ["Q"],
            "street_address": "S", "postal_code": "Z", "city": "C", "country": "D", "source_url": "U"}
    rows = [(f"{t}|{i}", json.dumps(full | {"item_type": t, "id": i, "role_id": i, "division_id": 1, "person_id": p,
                                            "organization_id": 1}))
            for t in ("Person", "Organization", "Division", "DivisionRole") for i in ids
            for p in (ids if t == "DivisionRole" else [1])]
    lines = spark.createDataFrame(rows, "key string, value string").select(
        "key", S.alone_in(F.col("key")).alias("alone"), F.array("value").alias("values")).select(
        "key", "alone", F.explode(S.entity_lines_of()("values")[0]).alias("line")).distinct()
    shared = lines.groupBy("line").agg(F.count("*").alias("n"), F.max("alone").alias("alone")).where("n > 1")
    assert shared.where("alone").collect() == [] and shared.count() > 0
    assert {r.kind for r in lines.where("alone").select(F.split("key", r"\|")[0].alias("kind")).distinct().collect()} == {
        "Person", "Organization"}


def test_of_equal_versions_in_a_batch_the_greatest_lines_count(spark):
    work = _tmp()
    schema = "key string, version bigint, lines array<string>"
    spark.createDataFrame([("k", 1, ["a"]), ("k", 1, ["b", "a"]), ("k", 1, ["b"])], schema).write.parquet(f"{work}/in")
    S._run(spark, S.triple_deltas(S._read(spark, f"{work}/in", schema, None), 2), S.write_to(f"{work}/out"), f"{work}/ckpt", 2)
    assert sorted((r.line, r.sign) for r in spark.read.parquet(f"{work}/out").collect()) == [("a", 1), ("b", 1)]
