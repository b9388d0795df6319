"""Operator 12: targets against their definition, exact totals, the draws, permutations, and texts of the blocks."""

import re
import struct
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from scholarweave.llm import mixing as M

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _hash(*values, seed=42):
    """Spark's xxhash64 of longs, ints and strings."""
    for v in values:
        raw = v.encode() if isinstance(v, str) else struct.pack("<i", v[0]) if isinstance(v, tuple) else struct.pack("<q", v)
        seed = xxhash.xxh64_intdigest(raw, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def _targets(sizes):
    """source -> target by resharing until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        share = {s: weight[s] * rest / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in full else share[s] for s in order}
        full |= over


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def mix(docs):
    return M.mix(docs, shard_slots=100)


def test_word_count(spark):
    rng = __import__("random").Random(4)
    texts = [None, "", " ", "a", " a b\x0bc\x1fd e\r\n"] + [
        "".join(rng.choice(" \t\n\x0b\x0c\r\x1c\x85ab é🎉") for _ in range(rng.randrange(40))) for _ in range(300)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", M.word_count(F.col("t")).alias("n"))
    assert all(r.n == len(WORD.findall(r.t or "")) for r in rows.collect())


@pytest.mark.parametrize("sizes", [{"b": 100}, {"a": 10, "b": 100, None: 1}, {"a": 0, "b": 0}, {"a": 0, "é": 5, "z": 7},
                                   {f"s{i}": 7 ** (i % 9) for i in range(40)}, {"x": 3, "y": 10 ** 15, "z": 10 ** 12}])
def test_targets_by_definition(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in M.source_targets(df).collect()}
    want = _targets(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) <= 1e-9 * max(1, want[s]) for s in want)


def test_permutations(spark):
    for n in (1, 2, 3, 10, 997):
        p = spark.range(n).select(
            "id", M.permuted(F.col("id"), F.lit(n), F.lit(5), F.lit("k")).alias("to"))
        p = p.withColumn("back", M.permuted(F.col("to"), F.lit(n), F.lit(5), F.lit("k"), inverse=True)).collect()
        assert sorted(r.to for r in p) == list(range(n)) and all(r.back == r.id for r in p)
    moves = [abs(r.to - r.id) for r in p]
    assert 280 < sum(moves) / len(moves) < 390          # a third of n for a random permutation


def test_mix_meets_every_target(docs, mix):
    rows = M.taken_words(mix).collect()
    text = {r.doc_id: (r.text or "", r.source) for r in docs.collect()}
    sizes = Counter()
    for t, s in text.values():
        sizes[s] += len(WORD.findall(t))
    want, taken = _targets(sizes), Counter()
    assert len(rows) == len(text)
    for r in rows:
        t, s = text[r.doc_id]
        assert r.size == len(WORD.findall(t)) and r.source_size == sizes[s] and 0 <= r.taken <= 3 * r.size
        assert abs(r.target - want[s]) < 1e-6
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in want)


def test_taken_words_by_brute_force(docs, mix):
    """Packing, permutations and cuts again in Python, from the hashes alone."""
    texts = [(r.doc_id, r.source, r.text or "") for r in docs.collect()]
    sources = {r.source: r for r in mix.sources.collect()}
    by_source = defaultdict(list)
    for i, s, t in texts:
        h = _hash(i, t)
        by_source[s].append((h % M.BUCKETS, h, i, len(WORD.findall(t))))
    want = Counter()
    for s, rows in by_source.items():
        src, stream = sources[s], []
        for _, _, i, n in sorted(rows):
            stream += [i] * n
        left, epoch = int(src.target + 0.5), 0
        blocks = [stream[k:k + M.BLOCK_WORDS] for k in range(0, len(stream), M.BLOCK_WORDS)]
        while left > 0:
            for place in range(len(blocks)):
                at = place
                for r in range(M.ROUNDS):
                    other = (_hash((src.sid,), epoch, (r,)) % len(blocks) - at) % len(blocks)
                    if _hash((src.sid,), epoch, (r,), max(at, other)) & 1:
                        at = other
                part = blocks[at][:left]
                want.update(part)
                left -= len(part)
                if left <= 0:
                    break
            epoch += 1
    assert {r.doc_id: r.taken for r in M.taken_words(mix).collect() if r.taken} == dict(want)


def test_shards_are_full_and_near_the_shares(mix):
    counts = mix.slots.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("d"),
                                            F.max("slot").alias("m")).collect()
    assert len(counts) > 5 and all(r.n == r.d == r.m + 1 <= 100 for r in counts)
    assert sum(r.n < 100 for r in counts) <= 1
    slots = {r.sid: r.slots for r in mix.sources.collect()}
    share = mix.slots.groupBy("shard", "sid").count().collect()
    total, big = sum(slots.values()), max(slots, key=slots.get)
    p = slots[big] / total
    have = [r["count"] for r in share if r.sid == big]
    mean, spread = sum(have) / len(have), (100 * p * (1 - p)) ** 0.5
    assert abs(mean - 100 * p) < spread and max(have) - min(have) > spread          # drawn, not dealt evenly
    assert {r.sid: r["count"] for r in mix.slots.groupBy("sid").count().collect()} == {k: v for k, v in slots.items() if v}


def test_reruns_and_partitionings_agree(docs, mix):
    again = M.mix(docs.repartition(7), shard_slots=100)
    assert sorted(map(tuple, again.slots.collect())) == sorted(map(tuple, mix.slots.collect()))
    assert sorted(map(tuple, M.taken_words(again).collect())) == sorted(map(tuple, M.taken_words(mix).collect()))


def test_texts_of_the_blocks(docs, mix):
    rows = M.mixed_blocks(docs, mix).collect()
    assert len(rows) == mix.slots.count()
    taken = sum(r.taken for r in M.taken_words(mix).collect())
    assert sum(len(r.text.split(" ")) for r in rows) == taken
    words = {r.doc_id: Counter(WORD.findall(r.text or "")) for r in docs.collect()}
    for r in rows[:200]:
        have = Counter()
        for i in r.doc_ids:
            have |= words[i] if len(set(r.doc_ids)) == 1 else have + words[i]
        assert not Counter(r.text.split(" ")) - have


def test_odd_rows(spark, odd, none):
    df = odd.selectExpr("*", "'s' sid", "1 block", "2 size", "3 slot", "4 h", "5 copies", "6 target")
    rows = M.taken_words(M.mix(df)).collect()
    texts = [r.text for r in odd.collect()]
    assert sorted(r.size for r in rows) == sorted(len(WORD.findall(t or "")) for t in texts)
    sizes = Counter()
    for r in odd.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    assert abs(sum(r.taken for r in rows) - sum(sizes.values())) <= len(sizes)
    assert sorted({round(r.target, 6) for r in rows}) == sorted({round(t, 6) for t in _targets(sizes).values()})
    empty = M.mix(none)
    assert M.taken_words(empty).collect() == [] == M.mixed_blocks(none, empty).collect()
    blank = M.taken_words(M.mix(odd.where("doc_id in (2, 3)"))).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 2


def test_equal_rows_are_one_key(spark):
    rows = [(None, "same words here", "a")] * 500 + [(i, f"doc {i} of b", "b") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = M.taken_words(M.mix(df)).collect()
    assert len(got) == 600 and sum(r.size for r in got) == 1500 + 400
    assert M.mix(df).sources.count() == 2
