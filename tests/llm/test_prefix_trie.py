"""Operator 11 against a brute-force trie: any number of shards, hot paths, odd rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from scholarweave.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"


def _digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def _rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), _digest(role, text), (role, text)))
    own = {c: [t[2] for t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(int(c / 100) * 100, [])[:h] + turns[h:]
    return out


def _brute(rows):
    members = defaultdict(list)
    convs = _rebuilt(rows)
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)

    def below(k):
        leaves, saved, todo = 0, 0, [k]
        while todo:
            x = todo.pop()
            leaves += not children[x]
            saved += (len(members[x]) - 1) * (len(x[-1][1]) if x else 0)
            todo += children[x]
        return leaves, saved

    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(k))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), *below(k),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        c = c * rng.choice([1, 3, 100])
        for t in range(rng.randrange(0, 9)):
            text = rng.choice(["hello", "hi there", "", "é🎉"]) if rng.random() < 0.9 else f"own {rng.random()}"
            rows.append((c, t, rng.choice(["user", "assistant"]) if rng.random() < 0.2 else "user", text))
    return rows


def _hot():
    """A third of the conversations are one long conversation, a third share its first turn."""
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 30000, 100) for t in range(40)]
    rows += [(c, 0, "user", "turn 0") for c in range(30000, 60000, 100)]
    return rows + [(c, t, "user", f"{c} {t}") for c in range(60000, 90000, 100) for t in range(3)]


def _got(df):
    return sorted((tuple(r) for r in df.select(*T.COLUMNS).collect()), key=str)


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_trie_equals_brute_force(spark, shards):
    rows = _rows(shards, 120)
    random.Random(1).shuffle(rows)
    assert _got(T.prefix_trie(spark.createDataFrame(rows, SCHEMA), shards)) == _brute(rows)


def test_hot_conversation_is_cut_by_id_and_segments_hash_in_order(spark):
    rows = _hot()
    every = T.rebuilt_paths(spark.createDataFrame(rows, SCHEMA))
    assert _got(T.trie_of_paths(every, 12, segment_ids=7)) == _brute(rows)
    paths = [(bytes(r.path), r.conv_id) for r in T.rebuilt_paths(spark.createDataFrame(rows, SCHEMA)).collect()]
    cuts = T.choose_cuts(paths, 12)
    assert len(cuts) == 11
    sizes = [0] * 12
    for p in paths:
        sizes[T.bisect_right(cuts, p)] += 1
    assert max(sizes) <= 1.2 * len(paths) / 12


def test_cuts_keep_only_parting_turns():
    d = [bytes([k]) * 16 for k in range(9)]
    long = d[3] + d[4] * 1000
    cuts = T.choose_cuts([(d[1], 5), (d[2], 6), (long, 7), (long, 8)], 4)
    assert cuts == [(d[2], T._LOWEST), (d[3], T._LOWEST), (long, 8)]
    assert [x[0] for x in T.skeleton_ids(cuts)] == [0, 0, 0] and T.skeleton_ids(cuts)[2][1:3] == [1, 2]
    assert T.choose_cuts([], 4) == [] == T.choose_cuts([(d[1], 5)], 1)


def test_odd_conversations(spark):
    rows = [(0, 1, "user", "b"), (0, None, "user", "a"), (0, 1, "user", "b"), (0, 1, None, None), (None, 0, "user", "x"),
            (7, 0, "", "x" * 300_000), (-3, 0, "user", "neg"), (101, 0, "user", "no host"), (205, 0, "a", "one"),
            (1, 0, None, ""), (1, 0, "", None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "'c' path", "1 shard", "2 depth", "'d' digest", "'h' host", "3 chars", "4 own", "5 n")
    assert _got(T.prefix_trie(df, 3)) == _brute(rows)
    assert T.prefix_trie(df.where("false"), 3).collect() == []


def test_turns_of_nodes(spark):
    rows = _rows(5, 60)
    df = spark.createDataFrame(rows, SCHEMA)
    want = {(c, d + 1, *t) for c, path in _rebuilt(rows).items() for d, t in enumerate(path)}
    assert {tuple(r) for r in T.rebuilt_turns(df).select("conv_id", "depth", "role", "text").collect()} == want
    nodes = T.prefix_trie(df, 3)
    turns = T.node_turns(nodes, df).collect()
    assert len(turns) == nodes.count() - 1
    assert all((r.conv_id, r.depth, r.role, r.text) in want for r in turns)
