"""Operator 11: prefix trie of conversations over range-partitioned, locally sorted shards.

A conversation is one row: its path is the 16-byte digests of its turns, end to end, so byte order is
the order of the trie.  Cuts taken from a sample part the order of (path, conv_id) into shards of
about equal size; a group of equal conversations is cut by conv_id.  The trie of the cut paths, the
skeleton, is broadcast: only its nodes can have members in several shards.  A shard is read once in
sorted order with one open node a depth, and finishes every other node by itself; of a skeleton node
it gives a partial aggregate, and these are summed and rolled up along the skeleton.

Size of what is broadcast: a cut keeps just the turns that part it from the sampled path before it,
and all conversations between the two share the turns before that; so the cuts hold at most
``OVERSAMPLE * shards * (mean turns + 1)`` digests, whatever the lengths and repeats.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scholarweave.llm.registry import query
from scholarweave.llm.sampling import smallest_hash
from scholarweave.session import cut_lineage, ship_package, table

HOST_STEP = 100         # conversation c takes its head from c - c % HOST_STEP
HEAD_TURNS = 6          # of h = crc32(c) % HEAD_TURNS turns
OVERSAMPLE = 16         # sampled conversations a shard
DIGEST = 16             # bytes of a turn's digest
SEGMENT_IDS = 8192
BATCH_ROWS = 8192
NO_ENDS = hashlib.sha256(b"").hexdigest()
_LOWEST = -(1 << 63)

_OUT = ("shard int, seq long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, chars long, ends_sha256 string, skeleton int, parent_skeleton int, "
        "segment binary")
_SKELETON = ("skeleton int, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
             "n_leaves long, saved_tokens long, ends_sha256 string")
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


# ---------------------------------------------------------------- conversations

def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, host, turn, digest, role, text of the rows that have a conv_id."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    conv = F.col("conv_id").cast("long")
    return (conversations.select(conv.alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 role.alias("role"), text.alias("text")).where("conv_id is not null")
            .select("conv_id", (F.col("conv_id") - F.col("conv_id") % HOST_STEP).alias("host"), "turn",
                    F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
                    .alias("digest"), "role", "text"))


def _head_turns():
    return (F.crc32(F.col("conv_id").cast("string")) % HEAD_TURNS).cast("int")


def rebuilt_paths(conversations: DataFrame) -> DataFrame:
    """conv_id, path (digests end to end), chars (code points of each turn's text) of rebuilt conversations.

    Turns are ordered by turn, nulls first, equal turns by digest.  One shuffle, of digests only: the
    at most ``HOST_STEP`` conversations of a host are dealt to one partition, where its head reaches them.
    """
    rows = _turns(conversations).select("host", "conv_id", F.struct(
        "turn", "digest", F.length("text").alias("chars")).alias("t")).repartition("host")
    own = rows.groupBy("host", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("own"))
    head = F.max(F.when(F.col("conv_id") == F.col("host"), F.slice("own", 1, HEAD_TURNS))).over(
        Window.partitionBy("host"))
    none = F.slice("own", 1, 0)
    h = F.col("h")
    path = F.concat(F.slice(F.coalesce("head", none), F.lit(1), h),
                    F.slice("own", h + 1, F.greatest(F.size("own") - h, F.lit(0))))
    rebuilt = own.withColumns({"head": head, "h": _head_turns()}).select("conv_id", path.alias("p"))
    return rebuilt.select("conv_id", F.unhex(F.array_join(F.transform("p", lambda x: F.hex(x["digest"])), ""))
                          .alias("path"), F.transform("p", lambda x: x["chars"]).alias("chars"))


def rebuilt_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, depth (from 1), role and text of every turn of the rebuilt conversations."""
    n = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest"))
    turns = _turns(conversations).withColumns({"n": n, "h": _head_turns()})
    heads = turns.where(f"conv_id = host and n < {HEAD_TURNS}").select("host", "n", "role", "text")
    convs = turns.select("conv_id", "host", "h").distinct()
    taken = heads.groupBy("host").agg(F.count("*").alias("has"))
    own = turns.where("n > h").join(taken, "host", "left").select(
        "conv_id", (F.col("n") - F.col("h") + F.least("h", F.coalesce("has", F.lit(0)))).cast("long").alias("depth"),
        "role", "text")
    return convs.join(heads, "host").where("n <= h").select(
        "conv_id", F.col("n").cast("long").alias("depth"), "role", "text").unionByName(own)


def node_turns(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """``nodes`` below the root with the role and text of their last turn."""
    return nodes.join(rebuilt_turns(conversations), ["conv_id", "depth"])


# ---------------------------------------------------------------- cuts and skeleton

def shared_turns(a: bytes, b: bytes) -> int:
    """How many leading turns two paths share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // DIGEST
    at = 0
    while a[at:at + DIGEST] == b[at:at + DIGEST]:
        at += DIGEST
    return at // DIGEST


def choose_cuts(sample: list[tuple[bytes, int]], shards: int) -> list[tuple[bytes, int]]:
    """Increasing (path, conv_id): shard k holds the rows from cut k - 1 on, up to cut k."""
    sample = sorted(sample)
    cuts = set()
    for k in range(1, shards):
        i = k * len(sample) // shards
        if i == 0:
            continue
        (before, _), (path, conv_id) = sample[i - 1], sample[i]
        if before == path:
            cuts.add((path, conv_id))
        else:
            cuts.add((path[:(shared_turns(before, path) + 1) * DIGEST], _LOWEST))
    return sorted(cuts)


def skeleton_ids(cuts: list[tuple[bytes, int]]) -> list[list[int]]:
    """For each cut and depth, the first cut whose path has that prefix: with the depth, the node's name."""
    ids: list[list[int]] = []
    for k, (path, _) in enumerate(cuts):
        shared = shared_turns(cuts[k - 1][0], path) if k else -1
        ids.append((ids[-1][:shared + 1] if k else []) + [k] * (len(path) // DIGEST - shared))
    return ids


class _Rows:
    """Output rows of a task, given out in batches."""

    def __init__(self):
        self.rows = []

    def add(self, *row) -> None:
        self.rows.append(row)

    def batches(self, schema: pa.Schema, least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least:
            columns = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
                                             schema=schema)
            self.rows = []


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


class _Shard:
    """The open nodes of the last path read, by depth; nodes are given out when they close, children first."""

    def __init__(self, cuts: list[tuple[bytes, int]], segment_ids: int):
        self.cuts, self.ids, self.out, self.segment_ids = cuts, skeleton_ids(cuts), _Rows(), segment_ids
        self.shard: int | None = None

    def start(self, shard: int) -> None:
        self.shard, self.seq, self.chunk, self.path = shard, 0, 0, b""
        self.edges = [k for k in (shard - 1, shard) if 0 <= k < len(self.cuts)]
        self.low, self.n, self.kids, self.leaves, self.saved, self.chars = [None], [0], [0], [0], [0], [0]
        self.sha, self.ends = [None], [[]]
        self.frame()

    def frame(self) -> None:
        """Skeleton name of each depth of the current path that lies on an edge of the shard."""
        self.names = [0]
        for k in self.edges:
            d = shared_turns(self.cuts[k][0], self.path)
            if d + 1 > len(self.names) or len(self.names) == 1:
                self.names = self.ids[k][:d + 1]

    def segment(self, depth: int) -> None:
        ids = self.ends[depth]
        if ids:
            self.out.add(self.shard, -1, depth, None, None, self.chunk, None, None, None, None, None,
                         self.names[depth], None, ",".join(map(str, ids)).encode())
            self.chunk += 1
            self.ends[depth] = []

    def close(self) -> None:
        """Give out the deepest open node and add it to its parent."""
        d = len(self.n) - 1
        low, n, kids, leaves, saved = self.low.pop(), self.n.pop(), self.kids.pop(), self.leaves.pop(), self.saved.pop()
        chars, sha = self.chars.pop(), self.sha.pop()
        done = d >= len(self.names)
        if done:
            leaves, saved = leaves or 1, saved + (n - 1) * chars
            self.out.add(self.shard, self.seq, d, low, None, n, kids, leaves, saved, None,
                         sha.hexdigest() if sha else NO_ENDS, None,
                         self.names[d - 1] if d == len(self.names) else None, None)
        else:
            self.segment(d)
            self.out.add(self.shard, self.seq, d, low, None, n, kids, leaves, saved, chars, None, self.names[d], None,
                         None)
        self.ends.pop()
        self.seq += 1
        if d:
            self.n[-1] += n
            self.low[-1] = low if self.low[-1] is None else min(low, self.low[-1])
            if done:
                self.kids[-1] += 1
                self.leaves[-1] += leaves
                self.saved[-1] += saved

    def close_all(self) -> None:
        while self.shard is not None and self.n:
            self.close()

    def read(self, shard: int, path: bytes, conv_id: int, chars: list[int]) -> None:
        if shard != self.shard:
            self.close_all()
            self.start(shard)
        if path != self.path:
            shared = shared_turns(path, self.path)
            while len(self.n) - 1 > shared:
                self.close()
            for d in range(shared, len(path) // DIGEST):
                self.low.append(None)
                self.n.append(0)
                self.kids.append(0)
                self.leaves.append(0)
                self.saved.append(0)
                self.chars.append(chars[d])
                self.sha.append(None)
                self.ends.append([])
            self.path = path
            self.frame()
        d = len(self.n) - 1
        self.n[d] += 1
        self.low[d] = conv_id if self.low[d] is None else min(conv_id, self.low[d])
        if d < len(self.names):
            self.ends[d].append(conv_id)
            if len(self.ends[d]) >= self.segment_ids:
                self.segment(d)
        elif self.sha[d] is None:
            self.sha[d] = hashlib.sha256(str(conv_id).encode())
        else:
            self.sha[d].update(b",%d" % conv_id)


def _deal(cuts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = zip(b.column("path").to_pylist(), b.column("conv_id").to_pylist(), strict=True)
            shard = pa.array([bisect_right(cuts.value, k) for k in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([shard, *b.columns], names=["shard", *b.schema.names])
    return run


def _finish(cuts, segment_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, shard = _schema(_OUT), _Shard(cuts.value, segment_ids)
        for b in batches:
            columns = (b.column(c).to_pylist() for c in ("shard", "path", "conv_id", "chars"))
            for row in zip(*columns, strict=True):
                shard.read(*row)
                yield from shard.out.batches(schema, BATCH_ROWS)
        shard.close_all()
        yield from shard.out.batches(schema)
    return run


def _parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parents of the nodes that shards finished: read in the order that closed them, backwards, parents come first."""
    at, last = {}, None
    column = [c.split()[0] for c in _OUT.split(", ")].index("parent_conv_id")
    for b in batches:
        parent = []
        for shard, depth, conv_id, skeleton, up in zip(*(b.column(c).to_pylist() for c in (
                "shard", "depth", "conv_id", "skeleton", "parent_skeleton")), strict=True):
            if shard != last:
                at, last = {}, shard
            if skeleton is None:
                at[depth] = conv_id
            parent.append(at[depth - 1] if skeleton is None and up is None else None)
        columns = list(b.columns)
        columns[column] = pa.array(parent, pa.int64())
        yield pa.RecordBatch.from_arrays(columns, schema=b.schema)


def _hash_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash for each skeleton node's segments, which come in order; a segment is held at a time."""
    schema, out, key, sha = _schema("skeleton int, depth long, ends_sha256 string"), _Rows(), None, None
    for b in batches:
        for name, depth, segment in zip(*(b.column(c).to_pylist() for c in ("skeleton", "depth", "segment")),
                                        strict=True):
            if (name, depth) == key:
                sha.update(b"," + segment)
                continue
            if key:
                out.add(*key, sha.hexdigest())
            key, sha = (name, depth), hashlib.sha256(segment)
        yield from out.batches(schema, BATCH_ROWS)
    if key:
        out.add(*key, sha.hexdigest())
    yield from out.batches(schema)


def _roll_up(cuts):
    """Totals of the skeleton's nodes from their own sums, deepest first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, schema = skeleton_ids(cuts.value), _schema(_SKELETON)
        rows = {(r["skeleton"], r["depth"]): r for b in batches for r in b.to_pylist()}
        order = sorted(rows, key=lambda k: -k[1])
        up = {(j, d): (ids[j][d - 1], d - 1) for j, d in order if d}
        for key in order:
            r = rows[key]
            r["n_leaves"] = r["n_leaves"] or 1
            r["saved_tokens"] += (r["n_convs"] - 1) * r["chars"]
            if key in up:
                p = rows[up[key]]
                r["parent_conv_id"] = p["conv_id"]
                p["n_children"] += 1
                p["n_leaves"] += r["n_leaves"]
                p["saved_tokens"] += r["saved_tokens"]
        for lo in range(0, len(order), BATCH_ROWS):
            part = [rows[k] | {"ends_sha256": rows[k]["ends_sha256"] or NO_ENDS} for k in order[lo:lo + BATCH_ROWS]]
            yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in schema.names} for r in part], schema=schema)
    return run


def trie_of_paths(paths: DataFrame, shards: int | None = None, segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """Nodes of the trie of ``paths`` (conv_id long, path binary, chars array<int>), one row per conv_id.

    ``shards`` is the number of range partitions, ``spark.sql.shuffle.partitions`` if not given, and
    ``segment_ids`` how many ids of a skeleton node's ends a row holds; the result depends on neither.  Returns ``COLUMNS``; no rows without paths.
    """
    spark = paths.sparkSession
    ship_package(spark)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = cut_lineage(paths.select("conv_id", "path", "chars"), "trie-paths")
    sample = smallest_hash(paths.select("conv_id", "path"), ["conv_id"], OVERSAMPLE * shards)
    cuts = spark.sparkContext.broadcast(choose_cuts([(bytes(r.path), r.conv_id) for r in sample], shards))

    dealt = paths.mapInArrow(_deal(cuts), "shard int, conv_id long, path binary, chars array<int>")
    shard = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    nodes = (shard.mapInArrow(_finish(cuts, segment_ids), _OUT).sortWithinPartitions("shard", F.desc("seq"))
             .mapInArrow(_parents, _OUT))
    nodes = cut_lineage(nodes, "trie-nodes")

    part = nodes.where("skeleton is not null and segment is null").groupBy("skeleton", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    ends = (nodes.where("segment is not null").select("skeleton", "depth", "shard", F.col("n_convs").alias("chunk"),
                                                      "segment")
            .repartition("skeleton", "depth").sortWithinPartitions("skeleton", "depth", "shard", "chunk")
            .mapInArrow(_hash_segments, "skeleton int, depth long, ends_sha256 string"))
    skeleton = cut_lineage(part.join(ends, ["skeleton", "depth"], "left").repartition(1)
                           .mapInArrow(_roll_up(cuts), _SKELETON), "trie-skeleton")

    above = skeleton.select(F.col("skeleton").alias("parent_skeleton"), (F.col("depth") + 1).alias("depth"),
                            F.col("conv_id").alias("above"))
    local = nodes.where("skeleton is null").join(F.broadcast(above), ["parent_skeleton", "depth"], "left")
    return local.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above")).select(*COLUMNS).unionByName(
        skeleton.select(*COLUMNS))


def prefix_trie(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """Trie of the rebuilt ``conversations`` (conv_id, turn, role, text): one row per node, ``COLUMNS``.

    The remainder of a negative conv_id is negative, as in SQL.  A null role or text is the empty string; rows with a null conv_id belong to no conversation; equal
    turns of a conversation, repeated rows too, are all kept, ordered by the digest of role and text.
    A conversation is one row of 16 bytes a turn, so its texts are never gathered and may be of any
    length.  Other columns are ignored; an empty table gives no nodes.
    """
    return trie_of_paths(rebuilt_paths(conversations), shards)


_ORACLE = f"""
WITH own AS (
  SELECT conv_id, conv_id - conv_id % {HOST_STEP} AS host, coalesce(role, '') AS role, coalesce(text, '') AS text,
         turn, md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS x
  FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, x) AS n, length(text) AS chars FROM own),
convs AS (
  SELECT DISTINCT conv_id, host,
         xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
             lambda c, b: list_reduce(range(8), lambda y, i: xor(y >> 1, CASE WHEN y & 1 = 1 THEN 3988292384 ELSE 0 END),
                                      xor(c, b)), 4294967295), 4294967295) % {HEAD_TURNS} AS h
  FROM numbered),
heads AS (SELECT c.conv_id, c.h, t.n AS p, t.x, t.chars FROM convs c JOIN numbered t ON t.conv_id = c.host AND t.n <= c.h),
tails AS (SELECT c.conv_id, c.h, c.h + t.n AS p, t.x, t.chars FROM convs c JOIN numbered t ON t.conv_id = c.conv_id AND t.n > c.h),
rebuilt AS (
  SELECT conv_id, x, chars, row_number() OVER (PARTITION BY conv_id ORDER BY p) AS d
  FROM (SELECT * FROM heads UNION ALL SELECT * FROM tails)),
lists AS (
  SELECT c.conv_id, coalesce(l.xs, []) AS xs, coalesce(l.cs, []) AS cs FROM convs c LEFT JOIN (
    SELECT conv_id, list(x ORDER BY d) AS xs, list(chars ORDER BY d) AS cs FROM rebuilt GROUP BY 1) l USING (conv_id)),
member AS (
  SELECT conv_id, d, len(xs) AS turns, array_to_string(xs[1:d], '') AS k,
         array_to_string(xs[1:d - 1], '') AS up, CASE WHEN d = 0 THEN 0 ELSE cs[d] END AS chars
  FROM (SELECT *, unnest(range(len(xs) + 1)) AS d FROM lists)),
node AS (
  SELECT k, d, any_value(up) AS up, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CASE WHEN turns = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends
  FROM member GROUP BY k, d),
kids AS (SELECT up AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
full_node AS (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids USING (k)),
below AS (
  SELECT a.d AS top_d, a.chars_k AS top, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
         sum((f.n_convs - 1) * f.chars) AS saved
  FROM (SELECT k, unnest(range(d + 1)) AS d, substr(k, 1, 32 * unnest(range(d + 1))) AS chars_k FROM node) a
  JOIN full_node f ON f.k = a.k GROUP BY 1, 2)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children,
       CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, f.ends AS ends_sha256
FROM full_node f JOIN below b ON b.top = f.k LEFT JOIN full_node p ON f.d > 0 AND p.k = f.up"""


@query("op11_prefix_trie", _ORACLE)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all rebuilt conversations of ``conversations``."""
    return prefix_trie(table(spark, sf_dir, "conversations"))
