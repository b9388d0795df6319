"""Operator 13 against brute force: tiles of any size, ties, several blocks, odd rows."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from scholarweave.llm import lexical_search as S

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _brute(docs, items, k):
    counts = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    terms = {}
    for i, t in items:
        terms.setdefault(i, set()).update(TERM.findall((t or "").translate(LOWER)))
    out = []
    for item, own in terms.items():
        w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in own if df[t]}
        scores = []
        for doc, c in counts:
            m = 50 + (50 * sum(c.values()) * n) // total
            s = sum(w[t] * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m)) for t in own if c[t])
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        for rank, (s, _, _, doc) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1):
            out.append((item, rank, doc, -s))
    return sorted(out, key=str)


def _got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("items,terms,docs,block", [(256, 4096, 1024, 1 << 20), (3, 17, 5, 1 << 20), (7, 64, 33, 300)])
def test_search_equals_brute_force(spark, items, terms, docs, block):
    d, b = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = _brute([(r.doc_id, r.text) for r in d.collect()], [(r.item_id, r.text) for r in b.collect()], 50)
    assert (len(list(S.item_blocks(b, block))) > 1) == (block == 300)
    assert _got(S.ranked_search(d.repartition(5), b, 50, S.Tile(items, terms, docs), block)) == want


def test_ties_across_tasks_go_by_doc_id(spark):
    rows = [(i, "Alpha beta" if i % 3 else "alpha Gamma delta") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    items = [(1, "BETA"), (2, "alpha gamma"), (3, "nowhere")]
    got = S.ranked_search(docs, spark.createDataFrame(items, "item_id long, text string"), 5)
    assert _got(got) == _brute(rows, items, 5)


def test_best_rows_survive_cuts():
    rng = np.random.default_rng(1)
    best = S._Best(4, 3)
    seen = []
    for t in range(40):
        s = rng.integers(0, 6, (4, 10))
        doc = rng.permutation(400)[:10] + 400 * t
        seen.append((s, doc))
        best.add(0, s, np.zeros(10, np.int64), doc)
    item, score, _, doc = best.cut()
    for i in range(4):
        every = sorted((-int(s[i, j]), int(d[j])) for s, d in seen for j in range(10) if s[i, j] > 0)[:3]
        assert sorted((-int(a), int(b)) for a, b in zip(score[item == i], doc[item == i], strict=True)) == every


def test_terms_are_never_cut(monkeypatch):
    monkeypatch.setattr(S, "SLICE_BYTES", 7)
    raw = ("ab cd-efghijklmnop " * 9 + "é" * 40 + " z").encode()
    assert [t for found in S.text_terms(raw, 0, len(raw)) for t in found] == S.TERM.findall(raw)
    assert list(S.text_terms(raw, 5, 5)) == []


def test_tile_scores_are_exact_integers():
    rng = np.random.default_rng(2)
    terms, docs, items = 50, 20, 9
    tf = rng.integers(0, 3, (terms, docs)) * rng.integers(1, 10 ** 6, (terms, docs))
    w = rng.integers(0, 44_000, (items, terms)) * (rng.random((items, terms)) < 0.5)
    t, d = np.nonzero(tf)
    i, c = np.nonzero(w)
    parts = [(np.arange(lo, lo + 25), i[(c >= lo) & (c < lo + 25)], c[(c >= lo) & (c < lo + 25)] - lo,
              w[i, c][(c >= lo) & (c < lo + 25)]) for lo in (0, 25)]
    place = np.full(terms, -1, np.int64)
    assert (S.tile_scores(items, parts, place, t, d, tf[t, d], docs) == w.astype(object) @ tf.astype(object)).all()
    assert (place == -1).all()


def test_odd_rows(spark, odd, none):
    items = [(1, "the quick BROWN fox"), (1, "river été"), (2, None), (3, ""), (None, "mail w5x"), (4, "日本語 🎉"),
             (5, "w1x " * 5000), (5, "w1x")]
    df = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'t' term", "1 doc_id", "2 rank")
    docs = odd.selectExpr("*", "'n' n", "1 terms", "2 counts", "3 item_id", "4 rank")
    want = _brute([(r.doc_id, r.text) for r in odd.collect()], items, 50)
    assert _got(S.ranked_search(docs, df)) == want
    assert S.ranked_search(none, df).collect() == [] == S.ranked_search(docs, df.where("false")).collect()
