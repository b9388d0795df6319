"""Keyed state for the continuous pipeline (X1, X3, A4): what a micro-batch costs follows its own rows.

Three processors run under ``transformWithState`` with the RocksDB state store:

- ``AwaitReference``: an entity waits under its key until the reference it needs (an organisation's or
  a person's id) arrives, in whatever order the two come;
- ``EntityDiff``: the last version of an entity; a newer version gives the signed difference of their triples;
- ``SupportCount``: how many entities assert a triple; only its first and its last assertion change the graph.

A call on state is a trip from Python to the JVM, far dearer than a row.  The first two keep the keys of one
of ``BUCKETS`` together, so that trips follow the buckets that a batch touches, not its keys.

State is replayed by Spark, so a batch that runs again starts from the state before it.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from scholarweave.functions.text import present
from scholarweave.operators import ids as idops
from scholarweave.operators.triples import LOCAL, entity_lines
from scholarweave.schemas import ENTITY_FIELDS
from scholarweave.sinks.registry import append_registry, read_registry
from scholarweave.streaming.incremental import write_batch

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PARTITIONS = "spark.sql.shuffle.partitions"


@contextmanager
def state_store(spark: SparkSession, partitions: int | None = None):
    """Queries started inside keep their state in RocksDB, dealt over ``partitions`` (fixed by the first start)."""
    wanted = {_PROVIDER: _ROCKSDB, **({_PARTITIONS: str(partitions)} if partitions else {})}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


BUCKETS = 8192          # of keys that share their state; part of the state, so it must stay
LANES = 128             # buckets of one source's entities; part of the state too
_PART = 1000            # waiting entities that are stored together


def bucket_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _packed(value) -> bytes:
    return zlib.compress(json.dumps(value, ensure_ascii=False, separators=(",", ":")).encode(), 1)


def _unpacked(data: bytes):
    return json.loads(zlib.decompress(data))


class AwaitReference(StatefulProcessor):
    """Rows (bucket, key, entity, ref): a ref (a key's first one stays) releases the key's waiting and later entities.

    With ``wait_ms`` an entity that has waited that long in processing time is released without a ref.
    """

    def __init__(self, wait_ms: int | None = None):
        self.wait_ms = wait_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.refs = handle.getValueState("refs", "refs binary")                 # {key: ref}
        self.waiting = handle.getListState("waiting", "entities binary")        # [[key, entity, since], ...]

    def _wait(self, entities: list) -> None:
        if entities:
            self.waiting.appendList([(_packed(entities[i:i + _PART]),) for i in range(0, len(entities), _PART)])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        stored = self.refs.get()
        refs = _unpacked(stored[0]) if stored is not None else {}
        entities, new = [], {}
        for r in rows:
            k, entity, ref = r["key"], r["entity"], r["ref"]
            if entity is not None:
                if k in refs:
                    yield Row(entity=entity, ref=refs[k])
                else:
                    entities.append((k, entity))
            elif ref is not None and k not in refs:
                new[k] = min(ref, new.get(k, ref))
        if new:
            refs.update(new)
            self.refs.update((_packed(refs),))
            released, rest = False, []
            for part in self.waiting.get():
                for k, entity, since in _unpacked(part[0]):
                    if k in new:
                        released = True
                        yield Row(entity=entity, ref=new[k])
                    else:
                        rest.append((k, entity, since))
            if released:
                self.waiting.clear()
                self._wait(rest)
        since = timerValues.getCurrentProcessingTimeInMs() if self.wait_ms is not None else 0
        rest = []
        for k, entity in entities:
            if k in new:
                yield Row(entity=entity, ref=new[k])
            else:
                rest.append((k, entity, since))
        self._wait(rest)
        if rest and self.wait_ms is not None:
            self.handle.registerTimer(since + self.wait_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        due = expiredTimerInfo.getExpiryTimeInMs() - self.wait_ms
        rest = []
        for part in self.waiting.get():
            for k, entity, since in _unpacked(part[0]):
                if since <= due:
                    yield Row(entity=entity, ref=None)
                else:
                    rest.append((k, entity, since))
        self.waiting.clear()
        self._wait(rest)

    def close(self) -> None:
        pass


class EntityDiff(StatefulProcessor):
    """Rows (bucket, key, version, value): the values of a key's newest version and of the one that it replaces.

    A version that is not newer than the stored one changes nothing, so rows may come twice or late.  Equal
    versions in one batch may have several values; which of them counts is told by their lines (``_greatest``).
    """

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", "last binary")                 # {key: [version, [value, ...]]}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        newest: dict = {}
        for r in rows:
            k, version, value = r["key"], r["version"], r["value"]
            seen = newest.get(k)
            if seen is None or version > seen[0]:
                newest[k] = (version, [value])
            elif version == seen[0] and value not in seen[1]:
                seen[1].append(value)
        stored = self.last.get()
        last = _unpacked(stored[0]) if stored is not None else {}
        changed = False
        for k, (version, values) in newest.items():
            before, old = last.get(k, (None, []))
            if before is not None and version <= before:
                continue
            values.sort()
            last[k], changed = (version, values), True
            if values != old:
                yield Row(key=k, new=values, old=old)
        if changed:
            self.last.update((_packed(last),))

    def close(self) -> None:
        pass


class SupportCount(StatefulProcessor):
    """Rows (line, sign): 1 when a line gets its first support, -1 when it loses its last."""

    def init(self, handle) -> None:
        self.support = handle.getValueState("support", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = (self.support.get() or (0,))[0]
        after = before + sum(r.sign for r in rows)
        if after:
            self.support.update((after,))
        elif before:
            self.support.clear()
        if (before > 0) != (after > 0):
            yield Row(line=key[0], sign=1 if after > 0 else -1)

    def close(self) -> None:
        pass


# --------------------------------------------------------------------------- stream operators


def await_references(messages: DataFrame, wait_ms: int | None = None) -> DataFrame:
    """Streaming (key, lane, entity, ref) -> (entity, ref): see ``AwaitReference``."""
    bucket = F.col("lane") * BUCKETS + bucket_of(F.col("key"))
    return messages.select(bucket.alias("bucket"), "key", "entity", "ref").groupBy("bucket").transformWithState(
        AwaitReference(wait_ms), "entity string, ref bigint", "append", "none" if wait_ms is None else "processingTime")


def _greatest(values: str, lines_of: Callable[[str], Column]) -> Column:
    """The lines of a version: of several values that came at once, the greatest lines."""
    return F.coalesce(F.array_max(lines_of(values)), F.array().cast("array<string>")).alias(values)


def line_changes(entities: DataFrame, lines_of: Callable[[str], Column]) -> DataFrame:
    """Streaming (key, version, value) -> (key, line, sign): what each new version asserts and withdraws.

    ``value`` is the entity as text, which state holds; ``lines_of`` makes of an array of values, a column's
    name, an array of the lines of each.
    """
    versions = entities.withColumn("bucket", bucket_of(F.col("key"))).groupBy("bucket").transformWithState(
        EntityDiff(), "key string, new array<string>, old array<string>", "append", "none")
    both = versions.select("key", _greatest("new", lines_of), _greatest("old", lines_of))

    def signed(lines: Column, but: Column, sign: int) -> Column:
        return F.transform(F.array_except(lines, but), lambda x: F.struct(x.alias("line"), F.lit(sign).alias("sign")))

    new, old = F.col("new"), F.col("old")
    return both.select("key", F.inline(F.concat(signed(new, old, 1), signed(old, new, -1))))


def line_support(changes: DataFrame) -> DataFrame:
    """Streaming (line, sign) -> (line, n) of the lines that a batch touches: how many entities assert each by now.

    For output mode ``update``, as ``run_pipeline`` runs it: Spark's own sum keeps the lines without a call to
    Python each; a line of very many entities is summed before the shuffle.
    """
    return changes.groupBy("line").agg(F.sum("sign").alias("n"))


def support_deltas(log: DataFrame) -> DataFrame:
    """(line, n, batch_id) of all batches -> (line, sign) of the lines that came into the graph or went."""
    held = (F.col("n") > 0).cast("int")
    before = F.coalesce(F.lag(held).over(Window.partitionBy("line").orderBy("batch_id")), F.lit(0))
    return log.select("line", "batch_id", (held - before).alias("sign")).where("sign <> 0").select("line", "sign")


def triple_deltas(entities: DataFrame, lanes: int) -> DataFrame:
    """Streaming (key, version, lines) -> (line, sign): additions to and withdrawals from the set of all lines.

    A line that very many entities assert is counted in ``lanes`` parts first; only the parts' first and
    last support go on to the line's own count.
    """
    versions = entities.select("key", "version", F.to_json("lines").alias("value"))
    changes = line_changes(versions, lambda values: F.transform(values, lambda v: F.from_json(v, "array<string>")))
    parts = changes.withColumn("lane", F.pmod(F.xxhash64("key"), F.lit(lanes)).cast("int")).groupBy(
        "line", "lane").transformWithState(SupportCount(), "line string, sign int", "append", "none")
    return parts.groupBy("line").transformWithState(SupportCount(), "line string, sign int", "append", "none")


def graph_of(deltas: DataFrame) -> DataFrame:
    """The lines of the graph after all deltas of a log (line, sign)."""
    return deltas.groupBy("line").agg(F.sum("sign").alias("n")).where("n > 0").select("line")


def lanes_of(sources: Column, lane_of: Column, lanes: int) -> Column:
    """Lanes of a message: one for an entity, all for a reference."""
    return F.when(sources, F.array(F.pmod(lane_of, F.lit(lanes)).cast("int"))).otherwise(
        F.sequence(F.lit(0), F.lit(lanes - 1)))


def organization_backfill(stream: DataFrame, on: str, lanes: int, wait_ms: int | None = None) -> DataFrame:
    """Streaming (entity struct, organization struct), one of the two set -> (entity, organization_id).

    ``lanes`` parts a source's entities over that many keys, so a source with most of the entities is no
    hot key; its organisation goes to each.  The number is part of the state and must stay.
    """
    schema = stream.schema["entity"].dataType
    rows = stream.select(
        F.coalesce(F.col(f"entity.{on}"), F.col(f"organization.{on}")).cast("string").alias("key"),
        F.when(F.col("entity").isNotNull(), F.to_json("entity")).alias("entity"),
        F.when(F.col("entity").isNull(), F.col("organization.id")).cast("bigint").alias("ref")).where(
        F.col("key").isNotNull())
    messages = rows.withColumn("lane", F.explode(lanes_of(F.col("entity").isNotNull(), F.xxhash64("entity"), lanes)))
    out = await_references(messages, wait_ms)
    return out.select(F.from_json("entity", schema).alias("e"), F.col("ref").alias("organization_id")).select(
        "e.*", "organization_id")


# --------------------------------------------------------------------------- the ordered pipeline 100 -> 150 -> 800

ITEMS = "item_type string, source string, item string"
_IDENTIFIED = (f"version bigint, {ITEMS}, url string, person_url string, id bigint, division_id bigint")
_ORGANIZED = f"{_IDENTIFIED}, ref bigint"
_EXPORTED = "item_type string, id bigint, division_id bigint, role_id bigint, organization_id bigint, person_id bigint"
_CHANGES = "line string, alone boolean, sign int"


def _names(ddl: str) -> list[str]:
    return [c.split()[0].strip("`") for c in ddl.split(", ")]


def _all_fields() -> str:
    fields = {}
    for t in ("Person", "Division", "DivisionRole", "Organization"):
        fields |= ENTITY_FIELDS[t]
    return ", ".join(f"`{n}` {d}" for n, d in fields.items() if n not in ("id", "organization_id"))


def identify_writer(registry_path: str, out_path: str):
    """``foreachBatch`` body of step 100: IDs of the batch's items, registered before they are passed on."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        field = lambda f: F.get_json_object("item", f"$.{f}")
        rows = batch.select("item_type", "source", "item", field("source_url").alias("url"),
                            field("person_url").alias("person_url"), field("division_url").alias("division_url"))
        role = F.col("item_type") == "DivisionRole"
        rows = rows.where(present("url") & (~role | (present("person_url") & present("division_url"))))
        keys = idops.needed_keys(rows.select(F.col("url").alias("source_url"), "item_type"),
                                 rows.where(role).select(F.col("division_url").alias("source_url"),
                                                         F.lit("Division").alias("item_type")))
        ids, new = idops.assign_ids(keys, read_registry(spark, registry_path, batch_id))
        append_registry(new, registry_path, batch_id)
        own = ids.select(F.col("source_url").alias("url"), "item_type", "id")
        division = ids.where("item_type = 'Division'").select(F.col("source_url").alias("division_url"),
                                                              F.col("id").alias("division_id"))
        out = rows.join(own, ["url", "item_type"]).join(division, "division_url", "left")
        write_batch(out.withColumn("version", F.lit(int(batch_id)).cast("bigint")).select(
            *_names(_IDENTIFIED)), out_path, batch_id)
    return run


def organize(identified: DataFrame, lanes: int) -> DataFrame:
    """Step 150: persons and divisions wait for their source's organisation, roles for their person."""
    payload = F.to_json(F.struct(*_names(_IDENTIFIED)))
    kind, none = F.col("item_type"), F.lit(None)

    def message(when: Column, prefix: str, key: str, entity: Column, ref: Column) -> Column:
        lane = F.pmod(F.xxhash64("url"), F.lit(lanes)).cast("int")
        return F.when(when & F.col(key).isNotNull(), F.struct(
            F.concat(F.lit(prefix), F.col(key)).alias("key"), lane.alias("lane"), entity.cast("string").alias("entity"),
            ref.cast("bigint").alias("ref")))

    member, org = kind.isin("Person", "Division"), kind == "Organization"
    every = F.when(org & F.col("source").isNotNull(), F.transform(
        F.sequence(F.lit(0), F.lit(lanes - 1)), lambda n: F.struct(
            F.concat(F.lit("source|"), F.col("source")).alias("key"), n.alias("lane"),
            none.cast("string").alias("entity"), F.col("id").alias("ref"))))
    waits = F.array(message(member, "source|", "source", payload, none),
                    message(kind == "Person", "person|", "url", none, F.col("id")).withField("lane", F.lit(0)),
                    message(kind == "DivisionRole", "person|", "person_url", payload, none).withField("lane", F.lit(0)))
    messages = identified.select(F.explode(F.filter(F.concat(waits, F.coalesce(every, F.array())), lambda m: m.isNotNull())).alias("m")).select("m.*")
    waited = await_references(messages).select(F.from_json("entity", _IDENTIFIED).alias("e"), "ref").select("e.*", "ref")
    alone = identified.where(org | (member & F.col("source").isNull()))
    return waited.unionByName(alone.withColumn("ref", none.cast("bigint")))


def entity_versions(organized: DataFrame) -> DataFrame:
    """Step 800: (key, version, value) of every item; a role's ref is its person's id, else the organisation's."""
    role = F.col("item_type") == "DivisionRole"
    rows = organized.select(
        "version", "item_type", "id", "division_id", F.col("id").alias("role_id"), F.col("ref").alias("organization_id"),
        F.col("ref").alias("person_id"), F.concat_ws("|", "item_type", "url", F.when(role, F.col("person_url"))).alias("key"),
        F.from_json("item", _all_fields()).alias("i")).select("*", "i.*")
    return rows.select("key", "version", F.to_json(F.struct(*_names(_EXPORTED), *_names(_all_fields()))).alias("value"))


def entity_lines_of(base: str = LOCAL) -> Callable[[str], Column]:
    """The lines of an array of values of ``entity_versions``."""
    return lambda values: entity_lines(f"transform({values}, v -> from_json(v, '{_EXPORTED}, {_all_fields()}'))", base)


def alone_in(key: Column) -> Column:
    """Whether an entity's lines are its alone: they tell of nodes with its own id, of which no other exporter
    writes such a line.  Their support is 1 or 0, which is what the entity's state holds.  A role's and a
    division's lines may be other roles' too.
    """
    return F.substring_index(key, "|", 1).isin("Person", "Organization")


def _read(spark: SparkSession, path: str, schema: str, files: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(path)


def _run(spark: SparkSession, df: DataFrame, run, checkpoint: str, partitions: int | None, timers: bool = False,
         mode: str = "append") -> None:
    """All that is available, batch after batch; with ``timers``, which would ask for ever more batches, one batch.

    ``run`` is a ``foreachBatch`` body, or the folder of a parquet sink, whose log tells a reader each batch once.
    """
    with state_store(spark, partitions):
        writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        writer = writer.format("parquet").option("path", run) if isinstance(run, str) else writer.foreachBatch(run)
        q = (writer.trigger(once=True) if timers else writer.trigger(availableNow=True)).start()
    q.awaitTermination()


def write_to(path: str):
    """``foreachBatch`` body that rewrites the batch's own folder."""
    def run(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id)
    return run


def run_pipeline(spark: SparkSession, items_dir: str, work: str, partitions: int | None = None,
                 files_per_trigger: int | None = None, base: str = LOCAL) -> DataFrame:
    """Take all new item files through IDs (100), references (150) and triples (800); the delta log so far.

    Each step is a streaming query with a checkpoint of its own under ``work`` and reads what the step
    before wrote; call again when files have arrived.  A batch that is written twice after a failure
    changes nothing downstream: versions that are known are skipped, and the changes between versions go
    through a sink that lists each batch's files once.  Changes of lines that are one entity's alone are
    deltas as they are; the others come from their support.
    """
    changes, support = f"{work}/changes", f"{work}/support"
    steps = [
        (items_dir, ITEMS, lambda s: s, identify_writer(f"{work}/registry", f"{work}/identified"), "identified"),
        (f"{work}/identified", _IDENTIFIED, lambda s: organize(s, LANES), write_to(f"{work}/organized"), "organized"),
        (f"{work}/organized", _ORGANIZED,
         lambda s: line_changes(entity_versions(s), entity_lines_of(base)).select(
             "line", alone_in(F.col("key")).alias("alone"), "sign"), changes, "changes"),
        (changes, _CHANGES, lambda s: line_support(s.where("NOT alone")), write_to(support), "support"),
    ]
    for path, schema, plan, run, name in steps:
        _run(spark, plan(_read(spark, path, schema, files_per_trigger).select(*_names(schema))), run,
             f"{work}/checkpoint-{name}", partitions, mode="update" if name == "support" else "append")
    alone = spark.read.parquet(changes).where("alone").select("line", "sign")
    return alone.unionByName(support_deltas(spark.read.parquet(support)))


def stream_organization_backfill(spark: SparkSession, entities_dir: str, schema, orgs_dir: str, out_path: str,
                                 checkpoint: str, on: str = "source", partitions: int | None = None,
                                 files_per_trigger: int | None = None, wait_ms: int | None = None) -> None:
    """Run X3 over all new files of entities (``schema``) and organisations (``on`` string, id bigint).

    Both are sources of one query, so an organisation that comes after the last entity still releases
    those that wait.  A batch rewrites its own folder of ``out_path``.
    """
    lanes = partitions or int(spark.conf.get(_PARTITIONS))
    entities = _read(spark, entities_dir, schema, files_per_trigger).select(F.struct("*").alias("entity"))
    orgs = _read(spark, orgs_dir, f"{on} string, id bigint", files_per_trigger).select(
        F.struct("*").alias("organization"))
    none = lambda df, name: F.lit(None).cast(df.schema[name].dataType).alias(name)
    both = entities.select("entity", none(orgs, "organization")).unionByName(
        orgs.select(none(entities, "entity"), "organization"))
    _run(spark, organization_backfill(both, on, lanes, wait_ms), write_to(out_path), checkpoint, partitions,
         wait_ms is not None)
