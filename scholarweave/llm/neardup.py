"""Operator 4: near-duplicate groups by b-bit MinHash.

1. One pass over the texts gives each document its set size, a 128-bit digest of its shingle set,
   ``BANDS`` band keys (64-bit hashes of ``ROWS`` whole minima) and the low ``BITS`` bits of all
   minima, packed into nine longs.
2. Equal sets are one class, represented by its smallest doc_id; only representatives go on.
3. In every band bucket each member is paired with the bucket's smallest member (a star, linear in
   the bucket).  A pair goes on if the similarity estimated from the packed signatures, corrected
   for chance collisions, is not five standard errors below the threshold.
4. Full shingle sets confirm the pairs left; components are formed from confirmed links.
5. Buckets whose members are still in several components are compared exhaustively *across*
   components, in blocks of about ``2 * BLOCK`` members per task, again confirmed on full sets.
   Buckets that overlap form a family; a family is compared once as a whole where that takes fewer
   comparisons than its buckets one by one.  A block task returns a spanning forest of its links,
   never all pairs.

A bucket is compared whole, so the only loss is that of the bands: a pair at similarity 0.85
(0.80) shares no bucket with probability 7e-8 (1.5e-5).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarweave.llm import textbatch as tb
from scholarweave.llm.components import connected_components
from scholarweave.llm.registry import query
from scholarweave.session import cut_lineage, ship_package, table

SHINGLE = 5
ROWS, BANDS, BITS = 5, 28, 4
HASHES = 144                     # ROWS * BANDS, filled up to nine whole longs of low bits
WORDS = HASHES * BITS // 64
BLOCK = 256
FILTER_BITS = 1 << 23
SIGMA = 5.0

SIG_SCHEMA = "doc_id long, n_shingles long, d1 long, d2 long, sig array<long>, bands array<long>"


def _minima(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(texts, HASHES) 32-bit minima of hash functions x -> (x xor c) * a over each segment of ``flat``."""
    x = (flat >> np.uint64(32)).astype(np.uint32)
    mult = (tb.constants(HASHES, 21) >> np.uint64(16)).astype(np.uint32) | np.uint32(1)
    flip = (tb.constants(HASHES, 22) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), HASHES), dtype=np.uint32)
    h = np.empty_like(x)
    for k in range(HASHES):
        np.bitwise_xor(x, flip[k], out=h)
        np.multiply(h, mult[k], out=h)
        h ^= h >> np.uint32(15)
        out[:, k] = np.minimum.reduceat(h, starts)
    return out


def _pack(minima: np.ndarray) -> np.ndarray:
    """Low BITS bits of the minima as (texts, WORDS) uint64."""
    low = (minima & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(len(minima), WORDS, 64 // BITS)
    return (low << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))).sum(axis=2, dtype=np.uint64)


def _band_keys(minima: np.ndarray) -> np.ndarray:
    rows = minima[:, :ROWS * BANDS].astype(np.uint64).reshape(len(minima), BANDS, ROWS)
    key = (rows * tb.constants(ROWS, 23)).sum(axis=2, dtype=np.uint64)
    return tb.mix(key + tb.constants(BANDS, 24))


def _sets(batch: pa.RecordBatch) -> list[np.ndarray]:
    data, off = tb.utf8(batch.column("text"))
    start, end, woff = tb.word_bounds(data, off)
    return tb.shingle_sets(tb.span_hashes(data, start, end), woff, SHINGLE)


def _list(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))


def signatures(sets: list[np.ndarray]) -> list[pa.Array]:
    """The columns of SIG_SCHEMA after doc_id, from each document's shingle set."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    full = np.flatnonzero(size)
    d = np.zeros((len(sets), 2), dtype=np.uint64)
    sig, bands = np.zeros((0, WORDS), np.uint64), np.zeros((0, BANDS), np.uint64)
    if len(full):
        flat = np.concatenate([sets[i] for i in full])
        starts = np.concatenate([[0], np.cumsum(size[full])[:-1]])
        minima = _minima(flat, starts)
        sig, bands = _pack(minima), _band_keys(minima)
        d[full, 0] = np.add.reduceat(tb.mix(flat + np.uint64(1)), starts)
        d[full, 1] = np.add.reduceat(tb.mix(flat ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts)
    ends = np.concatenate([[0], np.cumsum(size > 0)])
    return [pa.array(size), pa.array(d[:, 0].view(np.int64).copy()), pa.array(d[:, 1].view(np.int64).copy()),
            _list(sig.ravel(), ends * WORDS), _list(bands.ravel(), ends * BANDS)]


def _signature_batches(batches):
    for batch in batches:
        for part in tb.chunks(batch, "text"):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *signatures(_sets(part))],
                                             names=["doc_id", "n_shingles", "d1", "d2", "sig", "bands"])


def _set_batches(batches):
    for batch in batches:
        for part in tb.chunks(batch, "text"):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([s.tobytes() for s in _sets(part)], pa.binary())],
                names=["doc_id", "shingles"])


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a & b| >= percent * |a | b| for sorted distinct arrays."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int(np.count_nonzero(b[at] == a))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirm_batches(percent: int):
    def confirm(batches):
        for batch in batches:
            keep = [_similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                    for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])
    return confirm


def _least_matches(percent: int) -> int:
    """Fewest equal signature positions at which a pair may still reach the threshold (SIGMA errors)."""
    chance = 2.0 ** -BITS
    p = percent / 100 + (1 - percent / 100) * chance
    return int(np.floor(HASHES * p - SIGMA * np.sqrt(HASHES * p * (1 - p))))


def _equal_low_bits(x: str, y: str):
    """Column: number of equal packed values of two signatures (array<long>), by bit counts."""
    differing = []
    for i in range(WORDS):
        d = F.col(x)[i].bitwiseXOR(F.col(y)[i])
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        differing.append(F.bit_count(d.bitwiseAND(F.lit(0x1111111111111111))))
    return F.lit(HASHES) - sum(differing[1:], differing[0])


def _block_links(percent: int):
    """applyInPandas body: links between members of different components within two blocks."""
    least = _least_matches(percent)

    def links(frame: pd.DataFrame) -> pd.DataFrame:
        i, j = int(frame["i"].iloc[0]), int(frame["j"].iloc[0])
        ids, label = frame["doc_id"].to_numpy(), frame["label"].to_numpy()
        sig = np.stack([np.asarray(s, dtype=np.int64) for s in frame["sig"]]).view(np.uint64)
        bands = np.stack([np.asarray(s, dtype=np.int64) for s in frame["bands"]])
        block = frame["block"].to_numpy()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        parent = {v: v for v in label.tolist()}

        def find(v):
            while parent[v] != v:
                parent[v] = parent[parent[v]]
                v = parent[v]
            return v

        found = []
        sets: dict[int, np.ndarray] = {}

        def of(t):
            if t not in sets:
                sets[t] = np.frombuffer(frame["shingles"].iloc[t], np.uint64)
            return sets[t]

        key_band = int(frame["band"].iloc[0])
        for u in left.tolist():
            d = sig[right] ^ sig[u]
            d |= d >> np.uint64(2)
            d |= d >> np.uint64(1)
            equal = HASHES - np.bitwise_count(d & np.uint64(0x1111111111111111)).sum(axis=1)
            near = (equal >= least) & (label[right] != label[u])
            if key_band >= 0:                                       # a pair is compared in its first common band
                near &= np.argmax(bands[right] == bands[u], axis=1) == key_band
            for t in right[near].tolist():
                if i == j and t <= u:
                    continue
                ru, rt = find(label[u]), find(label[t])
                if ru != rt and _similar(of(u), of(t), percent):
                    parent[ru] = rt
                    found.append((ids[u], ids[t]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")
    return links


def near_duplicates(docs: DataFrame, percent: int = 80, sigs: DataFrame | None = None) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept (doc_id = component_id).

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a document's set is its distinct
    5-word shingles (the whole sequence if shorter).  Documents with 100 * intersection >= percent *
    union are linked, links are transitive, and component_id is the smallest doc_id reachable.
    Null and empty texts have no shingles and are linked with nothing.  Rows that repeat a doc_id
    are all returned; if their texts differ each text is linked under that id, with its own n_shingles.
    A null doc_id is linked with nothing: component_id null, kept true.  Other columns are ignored.
    ``sigs`` may bring the stored ``signatures`` of these rows, if a pass over the texts has made them already.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if sigs is None:
        sigs = cut_lineage(docs.mapInArrow(_signature_batches, SIG_SCHEMA), "minhash")
    labels = _labels(docs, sigs, percent)
    out = (sigs.select("doc_id", "n_shingles")
           .join(labels, "doc_id", "left")
           .withColumn("component_id", F.coalesce("label", "doc_id")))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _labels(docs: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, label) of the documents that are linked with another one."""
    valid = sigs.where("n_shingles > 0 and doc_id is not null")
    classes = cut_lineage(valid.groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("rep")), "classes")
    member = cut_lineage(
        valid.select("doc_id", "n_shingles", "d1", "d2").join(classes, ["n_shingles", "d1", "d2"])
        .where("doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct(), "class")
    # a doc_id on several rows with different texts keeps one row per text
    reps = cut_lineage(
        valid.join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "n_shingles", "d1", "d2"])
        .dropDuplicates(["doc_id", "n_shingles", "d1", "d2"])
        .select("doc_id", "n_shingles", "sig", "bands"), "reps")
    banded = reps.select("doc_id", F.posexplode("bands").alias("band", "key"))

    buckets = cut_lineage(banded.groupBy("key").agg(F.min("doc_id").alias("b"), F.count("*").alias("n"))
                          .where("n > 1"), "buckets")
    shared = cut_lineage(banded.join(buckets, "key"), "shared")
    star = shared.where("doc_id != b").select(F.col("doc_id").alias("a"), "b", "n")
    star = cut_lineage(star.groupBy("a", "b").agg(F.max("n").alias("n")), "star")
    side = lambda c: reps.select(F.col("doc_id").alias(c), F.col("n_shingles").alias(f"n{c}"),
                                 F.col("sig").alias(f"sig{c}"))
    pairs = cut_lineage(
        star.join(side("a"), "a").join(side("b"), "b")
        .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        .where(_equal_low_bits("siga", "sigb") >= _least_matches(percent))
        .select("a", "b").distinct(), "pairs")
    ends = lambda df: df.select(F.explode(F.array("a", "b")).alias("doc_id"))
    wanted = ends(pairs).unionByName(ends(star.where("n > 2"))).distinct()
    sets = _shingles_of(docs, wanted)
    confirmed = cut_lineage(_confirm(sets, pairs, percent), "links")
    near = cut_lineage(connected_components(confirmed), "near")

    # buckets of three or more members in several components: compare across components, in blocks
    labelled = shared.where("n > 2").select("key", "band", "doc_id").join(near.withColumnRenamed("node", "doc_id"), "doc_id", "left") \
        .withColumn("label", F.coalesce("label", "doc_id"))
    open_keys = (labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                             F.min("doc_id").alias("first"), F.count("*").alias("n"))
                 .where("lo != hi").select("key", "first", "n"))
    members = cut_lineage(labelled.join(open_keys, "key"), "open")
    more = _block_compare(sets, reps, members, percent)
    edges = confirmed.unionByName(more).unionByName(member)
    return connected_components(edges).withColumnRenamed("node", "doc_id")


def maybe_in(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` may be in ``keys``: a hashed bitmap of FILTER_BITS bits, in words of 64, is broadcast.

    It spares most rows a shuffle.  Where keys outgrow the bitmap more rows pass; none but nulls is ever lost.
    """
    h = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    word, bit = F.shiftright(h, 6), h.bitwiseAND(F.lit(63)).cast("int")
    bits = keys.where(F.col(key).isNotNull()).groupBy(word.alias("_word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64({key}), {FILTER_BITS}) & 63 as int))")).alias("_bits"))
    return (rows.where(F.col(key).isNotNull()).withColumn("_word", word).withColumn("_at", bit)
            .join(F.broadcast(bits), "_word").where(F.getbit("_bits", F.col("_at")) == 1).select(*rows.columns))


def _shingles_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, shingles) of the documents in ``ids``; one row per distinct set of a repeated doc_id."""
    ids = cut_lineage(ids, "wanted")
    return cut_lineage(maybe_in(docs, ids, "doc_id").join(ids, "doc_id", "left_semi").mapInArrow(
        _set_batches, "doc_id long, shingles binary").distinct(), "sets")


def _confirm(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    side = lambda c: sets.select(F.col("doc_id").alias(c), F.col("shingles").alias(f"s{c}"))
    return (pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb")
            .mapInArrow(_confirm_batches(percent), "a long, b long").distinct())


def _block_compare(sets: DataFrame, reps: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Links across components inside the open buckets; each task holds two blocks of a bucket or family."""
    families = cut_lineage(connected_components(
        members.select(F.col("doc_id").alias("a"), F.col("first").alias("b")))
        .select(F.col("node").alias("doc_id"), F.col("label").alias("family")), "families")
    by_bucket = members.select("key", "first", "n").distinct() \
        .join(families.withColumnRenamed("doc_id", "first"), "first") \
        .groupBy("family").agg(F.sum(F.col("n") * F.col("n")).alias("bucket_cost"))
    plan = cut_lineage(families.groupBy("family").agg(F.count("*").alias("size")).join(by_bucket, "family")
                       .withColumn("whole", F.col("size") * F.col("size") <= F.col("bucket_cost")), "plan")
    tagged = members.join(families, "doc_id").join(plan, "family")
    groups = tagged.where("whole").select(
        F.col("family").alias("key"), F.lit(-1).alias("band"), "doc_id", "label", F.col("size").alias("n")).distinct() \
        .unionByName(tagged.where("not whole").select("key", "band", "doc_id", "label", "n"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    spread = (groups.withColumn("blocks", blocks)
              .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("key", "band", "doc_id", "label", "block",
                      F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
    return (spread.join(reps.select("doc_id", "sig", "bands"), "doc_id").join(sets, "doc_id")
            .groupBy("key", "band", "i", "j").applyInPandas(_block_links(percent), "a long, b long").distinct())


@query("op4_neardup")
def op4_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of ``documents`` at 100 * intersection >= 85 * union of 5-word shingle sets."""
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)
