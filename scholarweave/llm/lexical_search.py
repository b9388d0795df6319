"""Operator 13: ranked lexical search by dense blocked matrix products.

Documents are read once and kept as postings of the items' vocabulary: term numbers and counts.  A tile
of items has a compact vocabulary of its own, cut into tiles of at most ``TILE_TERMS`` terms; a tile of
documents becomes a dense float64 matrix of term impacts, multiplied by the items' weights with BLAS.
Weights and impacts are integers and a product's sum stays below 2**53, so float64 is exact; tiles are
added in int64.  Each task keeps the best rows of every item, ties included, and a window ranks them.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scholarweave.llm.registry import query
from scholarweave.llm.textbatch import chunks, utf8
from scholarweave.session import cut_lineage, ship_package, table

K = 50
TILE_ITEMS = 256
TILE_TERMS = 4096
TILE_DOCS = 1024
BLOCK_ENTRIES = 1 << 20     # (item, term) pairs broadcast at once, but for a single larger item
SLICE_BYTES = 1 << 20

# Fixed values of the scoring contract.
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_APART = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
WEIGHT_SCALE = 1000
IMPACT_SCALE = 1_000_000_000
TF_SCALE = 1000
LENGTH_SCALE = 20
LENGTH_PERCENT = 50


def text_terms(raw: bytes, lo: int, hi: int) -> Iterator[list[bytes]]:
    """Terms of the lower-cased bytes lo to hi, in lists of about ``SLICE_BYTES`` of text; no term is cut."""
    while lo < hi:
        end = min(lo + SLICE_BYTES, hi)
        if end < hi:
            apart = _APART.search(raw, end, hi)
            end = apart.start() if apart else hi
        yield TERM.findall(raw, lo, end)
        lo = end


def _texts(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Array, bytes, list[int]]]:
    """(keys, lower-cased bytes, offsets) of bounded chunks of the batches' rows."""
    for batch in batches:
        for b in chunks(batch, "text"):
            data, offsets = utf8(b.column("text"))
            yield b.column(key), data.tobytes().lower(), offsets.tolist()


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for keys, raw, at in _texts(batches, "item_id"):
        rows, terms = [], []
        for i, (lo, hi) in enumerate(zip(at[:-1], at[1:], strict=True)):
            own = set().union(*text_terms(raw, lo, hi))
            rows += [i] * len(own)
            terms += own
        yield pa.RecordBatch.from_arrays([keys.take(pa.array(rows, pa.int64())), pa.array(terms, pa.binary())],
                                         names=["item_id", "term"])


@dataclass
class Block:
    """Items with their terms: item i holds the terms ``terms[first[i]:first[i + 1]]`` of ``vocabulary``."""
    items: list
    first: list[int]
    terms: list[int]
    vocabulary: dict[bytes, int]


def item_blocks(items: DataFrame, entries: int = BLOCK_ENTRIES) -> Iterator[Block]:
    """``items`` (item_id, text) in blocks of about ``entries`` pairs; the driver holds one block."""
    pairs = (items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
             .mapInArrow(_item_terms, "item_id long, term binary").distinct())
    block = None
    for r in cut_lineage(pairs, "search-items").orderBy("item_id", "term").toLocalIterator():
        if block and r.item_id != block.items[-1] and len(block.terms) >= entries:
            yield block
            block = None
        if block is None:
            block = Block([r.item_id], [0, 0], [], {})
        elif r.item_id != block.items[-1]:
            block.items.append(r.item_id)
            block.first.append(len(block.terms))
        block.terms.append(block.vocabulary.setdefault(bytes(r.term), len(block.vocabulary)))
        block.first[-1] = len(block.terms)
    if block:
        yield block


def _count(vocabulary):
    """doc_id, n (all terms) and the vocabulary's terms with their counts; documents without a term go."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for keys, raw, at in _texts(batches, "doc_id"):
            n, first, terms, counts = [], [0], [], []
            for lo, hi in zip(at[:-1], at[1:], strict=True):
                total, own = 0, Counter()
                for found in text_terms(raw, lo, hi):
                    total += len(found)
                    own.update(map(number, found))
                own.pop(None, None)
                n.append(total)
                terms += own.keys()
                counts += own.values()
                first.append(len(terms))
            offsets = pa.array(first, pa.int32())
            rows = pa.RecordBatch.from_arrays(
                [keys, pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64()))],
                names=["doc_id", "n", "terms", "counts"])
            yield rows.filter(pa.array(np.asarray(n) > 0))
    return run


class _Best:
    """The k best (score, doc) of each item so far; ``least`` is the score that a new row must reach."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.rows = [np.zeros(0, np.int64)] * 4          # item, score, doc_id is null, doc_id

    def add(self, first: int, scores: np.ndarray, null: np.ndarray, doc: np.ndarray) -> None:
        """Scores (items from ``first`` on, documents); rows equal to the k-th best stay candidates."""
        i, d = np.nonzero(scores >= self.least[first:first + len(scores), None])
        if len(i):
            new = (i + first, scores[i, d], null[d], doc[d])
            self.rows = [np.concatenate(pair) for pair in zip(self.rows, new, strict=True)]
            if len(self.rows[0]) > 4 * self.k * len(self.least):
                self.cut()

    def cut(self) -> list[np.ndarray]:
        item, score, null, doc = self.rows
        order = np.lexsort((doc, null, -score, item))
        item = item[order]
        start = np.searchsorted(item, np.arange(len(self.least)))
        rank = np.arange(len(item)) - start[item]
        last = order[rank == self.k - 1]
        self.least[self.rows[0][last]] = score[last]
        self.rows = [c[order[rank < self.k]] for c in self.rows]
        return self.rows


@dataclass(frozen=True)
class Tile:
    """Sizes of the matrices; the result does not depend on them."""
    items: int = TILE_ITEMS
    terms: int = TILE_TERMS
    docs: int = TILE_DOCS

    def __post_init__(self):
        # A weight is at most 1000 * ln(2 * 2**63 + 2) and an impact below 10**6.
        if self.terms * WEIGHT_SCALE * math.log(2.0 ** 64 + 2) * (IMPACT_SCALE // TF_SCALE) >= 2 ** 53:
            raise ValueError("a tile of so many terms could sum to 2**53")


def _tiles(block: Block, weight: np.ndarray, tile: Tile) -> list[tuple[int, int, list]]:
    """(first item, items, [(term numbers, rows, columns, weights)]) of every tile of items."""
    first, terms, out = np.asarray(block.first), np.asarray(block.terms, np.int64), []
    for lo in range(0, len(block.items), tile.items):
        hi = min(lo + tile.items, len(block.items))
        own = terms[first[lo]:first[hi]]
        row = np.repeat(np.arange(hi - lo), np.diff(first[lo:hi + 1]))
        compact, column = np.unique(own, return_inverse=True)
        parts = []
        for c in range(0, len(compact), tile.terms):
            here = (column >= c) & (column < c + tile.terms)
            parts.append((compact[c:c + tile.terms], row[here], column[here] - c, weight[own[here]]))
        out.append((lo, hi - lo, parts))
    return out


def tile_scores(items: int, parts: list, place: np.ndarray, term: np.ndarray, doc: np.ndarray, impact: np.ndarray,
                docs: int) -> np.ndarray:
    """Scores (items, docs) of a tile as int64.  ``place`` is scratch: -1 for every term of the block."""
    total = np.zeros((items, docs), np.int64)
    for terms, row, column, weight in parts:
        place[terms] = np.arange(len(terms))
        at = place[term]
        place[terms] = -1
        held = at >= 0
        present = np.flatnonzero(np.bincount(at[held], minlength=len(terms)))
        if not len(present):
            continue
        impacts = np.zeros((len(terms), docs))
        impacts[at[held], doc[held]] = impact[held]
        weights = np.zeros((items, len(terms)))
        weights[row, column] = weight
        if len(present) < len(terms):
            impacts, weights = impacts[present], weights[:, present]
        total += (weights @ impacts).astype(np.int64)
    return total


def _score(block, weight: np.ndarray, n_docs: int, n_terms: int, k: int, tile: Tile):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = block.value
        tiles, best = _tiles(b, weight, tile), _Best(len(b.items), k)
        place = np.full(len(b.vocabulary), -1, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, tile.docs):
                part = batch.slice(lo, tile.docs)
                lists = part.column("terms")
                size = np.asarray(lists.value_lengths(), np.int64)
                term = np.asarray(lists.flatten(), np.int64)
                tf = np.asarray(part.column("counts").flatten(), np.int64)
                length = 100 - LENGTH_PERCENT + (
                    LENGTH_PERCENT * np.asarray(part.column("n"), np.int64) * n_docs) // n_terms
                doc = np.repeat(np.arange(part.num_rows), size)
                impact = (IMPACT_SCALE * tf) // (TF_SCALE * tf + LENGTH_SCALE * length[doc])
                key = part.column("doc_id")
                null = np.asarray(key.is_null()).astype(np.int64)
                ids = np.asarray(key.fill_null(0), np.int64)
                for first, items, parts in tiles:
                    best.add(first, tile_scores(items, parts, place, term, doc, impact, part.num_rows), null, ids)
        item, score, null, ids = best.cut()
        if len(item):
            keys = pa.array(b.items, pa.int64()).take(pa.array(item))
            yield pa.RecordBatch.from_arrays([keys, pa.array(ids, mask=null > 0), pa.array(score)],
                                             names=["item_id", "doc_id", "score"])
    return run


def _ranked(block: Block, documents: DataFrame, k: int, tile: Tile) -> DataFrame:
    spark = documents.sparkSession
    share = spark.sparkContext.broadcast
    vocabulary, held = share(block.vocabulary), share(block)
    postings = cut_lineage(documents.mapInArrow(_count(vocabulary),
                                                "doc_id long, n long, terms array<int>, counts array<long>"), "postings")
    n_docs, n_terms = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(1))).first()
    df = np.zeros(len(block.vocabulary), np.int64)
    for r in postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect():     # one row a term
        df[r.t] = r["count"]
    weight = np.array([math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    rows = postings.mapInArrow(_score(held, weight, n_docs, n_terms, k, tile), "item_id long, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    best = cut_lineage(rows.withColumn("rank", rank).where(F.col("rank") <= k)
                       .select("item_id", "rank", "doc_id", "score"), "search-best")
    for b in (vocabulary, held):
        b.destroy()
    return best


def ranked_search(documents: DataFrame, items: DataFrame, k: int = K, tile: Tile | None = None,
                  block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """The k best ``documents`` (doc_id, text) of every item of ``items`` (item_id, text): item_id, rank, doc_id, score.

    Rows with equal item_id are one item with the terms of all of them, a null item_id too.  Every row
    of ``documents`` is a document of its own, also if it repeats another; equal scores go by doc_id,
    nulls last.  A null or empty text has no term; an item without terms, or whose terms stand in no
    document, has no rows, and so have empty tables.  Texts of any length are read in slices.  Other
    columns are ignored.  More items than one block holds are searched block after block, each with a
    pass of its own over the texts.
    """
    ship_package(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = documents.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = [_ranked(b, texts, k, tile or Tile()) for b in item_blocks(items, block_entries)]
    for rows in found:
        out = rows if len(found) == 1 else out.unionByName(rows)
    return out


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CLASS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
t AS (SELECT r, doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_CLASS}')) AS term FROM d),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_CLASS}')) AS term
      FROM benchmark),
n AS (SELECT r, count(*) AS n FROM t GROUP BY r),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM i) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM tf, s GROUP BY term),
impact AS (
  SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))) AS x
  FROM tf JOIN n USING (r) JOIN w USING (term), s),
score AS (SELECT item_id, r, any_value(doc_id) AS doc_id, CAST(sum(x) AS BIGINT) AS score
          FROM impact JOIN i USING (term) GROUP BY item_id, r HAVING sum(x) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score FROM score
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= {K}"""


@query("op13_lexical_search", _ORACLE)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best of all ``documents`` for every item of ``benchmark``."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
