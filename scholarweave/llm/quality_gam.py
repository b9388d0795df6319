"""Operator 10: quality classifier, a generalised additive model with pairwise interactions.

One pass over the texts measures features (byte classes, word, line and shingle repetition).  On a
bounded sample of labelled rows outside the held-out fold, cyclic boosting visits the features in
turn and adds one shallow tree of that feature alone to its lookup table; then the pairs whose joint
table explains most of what is left get boosted two-feature trees.  A score is the sum of a few
table entries, added over whole batches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarweave.llm import boosting as bo
from scholarweave.llm import textbatch as tb
from scholarweave.llm.registry import query
from scholarweave.llm.sampling import smallest_hash
from scholarweave.session import cut_lineage, ship_package, table

TRAIN_ROWS = 20_000         # bound of the training sample: the labelled rows with the smallest key hash
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 6
LEAVES, PAIR_LEAVES, RATE = 3, 4, 0.1
THRESHOLD = 0.3
FOLDS = 5

FEATURES = ("log_words", "mean_word", "upper", "digits", "symbols", "exclaim", "sentence_ends", "non_ascii",
            "line_words", "dup_lines", "distinct_words", "repeat_shingles", "longest_word", "other_marks")


def _classes() -> list[np.ndarray]:
    def of(chars):
        t = np.zeros(256, dtype=bool)
        t[[ord(c) for c in chars]] = True
        return t

    upper = of("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    other = of("\"'()-/:;=?@[]\\^_`{}~")
    high = np.zeros(256, dtype=bool)
    high[0x80:] = True
    return [upper, of("0123456789"), of("#*$%&|<>"), of("!"), of(".?"), high, other]


_CLASSES = _classes()
_CONTINUED = np.zeros(256, dtype=bool)
_CONTINUED[0x80:0xC0] = True


def _per_text(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=total[1:])
    return (total[off[1:]] - total[off[:-1]]).astype(np.float64)


def measure(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(texts, features) of UTF-8 bytes; an empty text is all zeros."""
    n_bytes = np.maximum(np.diff(off), 1).astype(np.float64)
    start, end, woff = tb.word_bounds(data, off)
    n_words = np.diff(woff).astype(np.float64)
    words = np.maximum(n_words, 1)
    upper, digits, symbols, exclaim, stops, high, other = (_per_text(c[data], off) for c in _CLASSES)
    continued = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(_CONTINUED[data], out=continued[1:])
    size = (end - start) - (continued[end] - continued[start])
    longest, chars = np.zeros(len(words)), np.zeros(len(words))
    full = np.flatnonzero(n_words)
    if len(full):
        longest[full] = np.maximum.reduceat(size, woff[:-1][full])
        chars[full] = np.add.reduceat(size, woff[:-1][full])
    # lines: spans between line feeds and text ends
    breaks = np.flatnonzero(data == 10)
    lo = np.unique(np.concatenate([off[:-1], breaks + 1]))
    lo = lo[lo < len(data)]
    hi = np.minimum(np.append(lo[1:], len(data)), len(data))
    hi = hi - (data[hi - 1] == 10) if len(hi) else hi
    lo, hi = lo[hi > lo], hi[hi > lo]
    lines = tb.span_hashes(data, lo, hi, lower=False)
    loff = np.searchsorted(lo, off)
    hashes = tb.span_hashes(data, start, end)
    shingles = tb.shingle_sets(hashes, woff, 5)
    dup, distinct, repeat = np.zeros(len(words)), np.zeros(len(words)), np.zeros(len(words))
    for i in range(len(words)):
        k = loff[i + 1] - loff[i]
        if k:
            dup[i] = 1 - len(np.unique(lines[loff[i]:loff[i + 1]])) / k
        if n_words[i]:
            # distinct share over the square root of the length, which stays comparable across lengths
            distinct[i] = len(np.unique(hashes[woff[i]:woff[i + 1]])) / words[i] ** 0.75
            repeat[i] = 1 - len(shingles[i]) / max(n_words[i] - 4, 1)
    return np.stack([np.log1p(n_words), chars / words, upper / n_bytes, digits / n_bytes, symbols / n_bytes,
                     exclaim / n_bytes, stops / words, high / n_bytes, n_words / np.maximum(np.diff(loff), 1), dup,
                     distinct, np.maximum(repeat, 0), longest, other / n_bytes], axis=1)


def _measure_batches(batches):
    for batch in batches:
        for part in tb.chunks(batch, "text"):
            x = measure(*tb.utf8(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "x"])


class Model:
    """Lookup tables: one per feature, one per chosen pair; ``score`` adds them up."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        prior = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
        self.base = float(np.log(prior / (1 - prior)))
        self.edges = bo.bin_edges(x, BINS) if len(y) else [np.zeros(0)] * len(FEATURES)
        self.coarse = bo.bin_edges(x, PAIR_BINS) if len(y) else self.edges
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        if len(np.unique(y)) < 2:
            return
        raw = np.full(len(y), self.base)
        b = bo.to_bins(x, self.edges)
        for _ in range(ROUNDS):
            for f, t in enumerate(self.tables):
                if len(t) > 1:
                    p = bo.sigmoid(raw)
                    tree = bo.grow(b[:, [f]], y - p, p * (1 - p), (0,), LEAVES)
                    t += RATE * bo.evaluate(tree, np.arange(len(t))[:, None])
                    raw = raw + RATE * bo.evaluate(tree, b[:, [f]])
        c = bo.to_bins(x, self.coarse)
        p = bo.sigmoid(raw)
        gains = []
        for i in range(len(FEATURES)):
            for j in range(i + 1, len(FEATURES)):
                cell = c[:, i] * (len(self.coarse[j]) + 1) + c[:, j]
                g, h = np.bincount(cell, y - p), np.bincount(cell, p * (1 - p))
                gains.append((float((g ** 2 / (h + bo.RIDGE)).sum()), i, j))
        chosen = [(i, j) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
        grids = [np.zeros((len(self.coarse[i]) + 1, len(self.coarse[j]) + 1)) for i, j in chosen]
        for _ in range(PAIR_ROUNDS):
            for (i, j), grid in zip(chosen, grids, strict=True):
                p = bo.sigmoid(raw)
                tree = bo.grow(c[:, [i, j]], y - p, p * (1 - p), (0, 1), PAIR_LEAVES)
                cells = np.indices(grid.shape).reshape(2, -1).T
                grid += RATE * bo.evaluate(tree, cells).reshape(grid.shape)
                raw = raw + RATE * bo.evaluate(tree, c[:, [i, j]])
        self.pairs = [(i, j, grid) for (i, j), grid in zip(chosen, grids, strict=True)]

    def score(self, x: np.ndarray) -> np.ndarray:
        b, c = bo.to_bins(x, self.edges), bo.to_bins(x, self.coarse)
        raw = np.full(len(x), self.base)
        for f, t in enumerate(self.tables):
            raw += t[b[:, f]]
        for i, j, grid in self.pairs:
            raw += grid[c[:, i], c[:, j]]
        return bo.sigmoid(raw)


def held_out(doc_id) -> F.Column:
    """The fold that training never sees: crc32 of the id's text divisible by FOLDS; a null id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted (0/1).

    Only the text is scored.  Null and empty texts have all-zero features and get a score as well.
    Labels with a null quality or doc_id are left out; without labels of both kinds every score is
    the smoothed share of label 1 (0.5 without any).  Rows that repeat are scored each; extra columns
    are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    measured = cut_lineage(docs.mapInArrow(_measure_batches, "doc_id long, x array<double>"), "features")
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")) \
        .where("quality is not null and doc_id is not null").where(~held_out(F.col("doc_id"))).distinct()
    sample = smallest_hash(measured.join(marked, "doc_id").select("doc_id", "quality", "x"), ["doc_id"], TRAIN_ROWS)
    x = np.array([r.x for r in sample], dtype=np.float64).reshape(-1, len(FEATURES))
    model = spark.sparkContext.broadcast(Model(x, np.array([float(r.quality > 0) for r in sample])))

    def run(batches):
        for batch in batches:
            flat = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.value.score(flat))],
                                             names=["doc_id", "score"])

    return measured.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


@query("op10_quality_gam")
def op10_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every row of ``documents``, trained on ``labels`` outside the held-out fold."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
