"""Operator 6: recurring line templates, found with a fixed-depth log-template tree.

A line's tokens are its words, lower-cased, with words that contain a digit read as a variable.
The tree has two levels of fixed depth: token count, then the first DEPTH tokens.  Within a leaf,
identical token sequences are one variant.  A leaf holds any number of templates: each variant stands
in MASKS groups, in each with the variants that have the same tokens at MASKED_TO sampled positions
(the others are masked).  Positions on which more than half of a group's documents agree are its
template's constants and the other positions its variable fields, and variants that match enough
constants belong to the template.  Templates, and single variants, that recur in at
least MIN_DOCS documents are dropped from every document.

Documents that are copies of each other must not make their own text a template: documents count by
the near-copy group they are in (operator 4 at COPY_PERCENT, confirmed on whole shingle sets), so no
single hash of a shared passage can merge the documents that hold it.  However many documents a group
has, it counts once and takes nothing from the count of the others.

After the line pass tokens are read of one document of each variant in a leaf with several variants only.
Leaves of up to LEAF_TOKENS tokens are compared many at a time in tasks of about that size; larger ones by
aggregation and equi joins on hashes, so that no large leaf is gathered.  Both give the same templates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarweave.llm import textbatch as tb
from scholarweave.llm.neardup import SHINGLE, SIG_SCHEMA, maybe_in, near_duplicates, signatures
from scholarweave.llm.registry import query
from scholarweave.session import cut_lineage, ship_package, table

DEPTH = 3               # leading tokens that choose a leaf, after the token count
MIN_DOCS = 3            # documents, near copies counted once, in which a template recurs
COPY_PERCENT = 80       # similarity of near copies, as in the pipeline's near_dups stage
MIN_CONSTANTS = 4       # a line with fewer tokens that are not variables recurs only as it is, digits included
SHORT_DOCS = (40, 20, 10)   # documents in which such a line recurs if it has one, two, or more words
MIN_FREE = 3            # lines need so many tokens past the leading ones to be generalised
SIMILARITY = 0.7        # share of the tokens past the leading ones that must equal a constant
LEAF_TOKENS = 500_000       # tokens of the variants of a leaf that one task compares
CHUNK_BYTES = 1 << 19
MASKS, MASKED_TO = 12, 3    # a variant with that share of constants misses all groups of its template with chance 0.01

_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True
_UNSPACED = np.zeros(256, dtype=bool)
_UNSPACED[0xE3:0xEA] = True             # first bytes of Chinese and Japanese characters: each counts as a word
_LINES = "doc_id long, text_hash long, at int, least int, leaf long, line long, tokens binary"
_LINE_TYPES = {"text_hash": pa.int64(), "at": pa.int32(), "least": pa.int32(), "leaf": pa.int64(), "line": pa.int64(), "tokens": pa.binary()}
_SIGNATURE = SIG_SCHEMA.removeprefix("doc_id long, ")


def _lines(data: np.ndarray, off: np.ndarray, start: np.ndarray, end: np.ndarray, words: np.ndarray):
    """(word hashes, their hashes with variables as 0, words that are no variables, line bounds in words and bytes)."""
    lo = np.unique(np.concatenate([off[:-1], np.flatnonzero(data == 10) + 1]))
    lo = lo[lo < len(data)]
    hi = np.append(lo[1:], len(data))
    variable = _within(_DIGIT[data], start, end) > 0
    unspaced = _UNSPACED[data]
    units = np.maximum(_within(unspaced, start, end), 1) if unspaced.any() else np.ones(len(start), np.int64)
    return words, np.where(variable, np.uint64(0), words), units * ~variable, np.searchsorted(start, lo), np.searchsorted(start, hi), lo, hi


def _within(marked: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Marked bytes of each span."""
    count = np.zeros(len(marked) + 1, dtype=np.int32 if len(marked) < 1 << 31 else np.int64)
    np.cumsum(marked, out=count[1:])
    return count[end] - count[start]


def _line_keys(*parsed: np.ndarray):
    """Per line: (leaf, line, documents that make it recur, first word, last word), and the words, line starts and ends.

    A blank line has 0 for the documents and never recurs.
    """
    exact, words, units, wlo, whi, lo, hi = _lines(*parsed)
    n = whi - wlo
    fixed = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum(units, out=fixed[1:])
    short = fixed[whi] - fixed[wlo] < MIN_CONSTANTS
    least = np.where(short, np.array((0, *SHORT_DOCS), dtype=np.int32)[np.minimum(n, len(SHORT_DOCS))], MIN_DOCS)
    at = np.arange(len(words), dtype=np.int64) - np.repeat(wlo, n)
    place = tb.mix(at.astype(np.uint64) + np.uint64(77)) | np.uint64(1)
    words = np.where(np.repeat(short, n), exact, words)
    total = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(tb.mix((words + np.uint64(1)) * place), out=total[1:])
    line = tb.mix(total[whi] - total[wlo] + n.astype(np.uint64) + (short.astype(np.uint64) << np.uint64(40)))
    head = np.minimum(wlo + DEPTH, whi)
    leaf = tb.mix((total[head] - total[wlo]) * np.uint64(3) + n.astype(np.uint64))
    return np.where(short, line, leaf), line, least, wlo, whi, words, lo, hi


def _line_rows(part: pa.RecordBatch, parsed) -> list[pa.Array]:
    """The columns of _LINES: a row for each line that may recur, with its number in the text.

    ``tokens`` are 16 bits of each token; lines that no template generalises have none.
    """
    leaf, line, least, wlo, whi, words, lo, _ = _line_keys(*parsed)
    off = parsed[1]
    doc = np.searchsorted(off, lo, side="right") - 1
    number = np.arange(len(lo)) - np.searchsorted(lo, off)[doc]
    rows = np.flatnonzero(least)
    n = (whi - wlo)[rows]
    n[(leaf[rows] == line[rows]) | (n < DEPTH + MIN_FREE)] = 0
    ends = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat(wlo[rows] - ends[:-1], n) + np.arange(ends[-1])
    short = (words[at] >> np.uint64(48)).astype("<u2")         # 16 bits tell tokens of a position apart
    tokens = pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(2 * ends), pa.py_buffer(short)])
    own = pa.array(doc[rows])
    return [part.column("doc_id").take(own), part.column("text_hash").take(own), pa.array(number[rows].astype(np.int32)),
            pa.array(least[rows].astype(np.int32)), pa.array(leaf[rows].view(np.int64)), pa.array(line[rows].view(np.int64)),
            tokens.cast(pa.binary())]


def _text_batches(batches):
    """One pass over the texts: the rows of _LINES, and a row of a document's near-copy signature with no line."""
    line_names, sig_names = ([f.split()[0] for f in schema.split(", ")] for schema in (_LINES, _SIGNATURE))
    for batch in batches:
        for part in tb.chunks(batch, "text", CHUNK_BYTES):
            data, off = tb.utf8(part.column("text"))
            start, end, word_off = tb.word_bounds(data, off)
            words = tb.span_hashes(data, start, end)
            sig = signatures(tb.shingle_sets(words, word_off, SHINGLE))
            docs = pa.table([part.column("doc_id"), *sig], names=["doc_id", *sig_names])
            lines = _line_rows(part, (data, off, start, end, words)) if len(data) else []
            if lines:
                docs = pa.concat_tables([pa.table(lines, names=line_names), docs], promote_options="default")
            for name in line_names:
                if name not in docs.column_names:
                    docs = docs.append_column(name, pa.nulls(len(docs), _LINE_TYPES[name]))
            yield from docs.select([*line_names, *sig_names]).combine_chunks().to_batches()


def _without(text: str, gone: list[int]) -> str:
    """``text`` without the lines of these numbers."""
    lines, gone = text.split("\n"), set(gone)
    last = len(lines) - 1
    if last and not lines[last] and last - 1 in gone:
        gone.add(last)                  # a last line that goes takes the line feed before it along
    return "\n".join(x for i, x in enumerate(lines) if i not in gone)


def _rewrite_batches(batches):
    for batch in batches:
        for part in tb.chunks(batch, "text", CHUNK_BYTES):
            texts, drops = part.column("text").to_pylist(), part.column("drops").to_pylist()
            total = [t.count("\n") + 1 if t else 0 for t in texts]
            dropped = [len(d) if d and t else 0 for t, d in zip(texts, drops, strict=True)]
            texts = [_without(t, d) if n else t for t, d, n in zip(texts, drops, dropped, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(texts, pa.string()), pa.array(total, pa.int64()),
                 pa.array(dropped, pa.int64())], names=["row", "text", "n_lines", "n_dropped"])


def recurring_lines(lines: DataFrame, copies: DataFrame) -> DataFrame:
    """(leaf, line) of the variants to drop, from the line table and the near copies (doc_id, group) in it.

    Documents that ``copies`` does not name are groups of their own.
    """
    recurs = F.col("groups") >= MIN_DOCS
    grouped = lambda df: df.join(copies, "doc_id", "left").withColumn("group", F.coalesce("group", "doc_id"))
    variants = cut_lineage(
        grouped(lines.select("doc_id", "least", "leaf", "line"))
        .groupBy("leaf", "line", "group").agg(F.min("doc_id").alias("rep"), F.min("least").alias("least"))
        .groupBy("leaf", "line").agg(F.count("*").alias("groups"), F.min("rep").alias("doc_id"),
                                     F.min("least").alias("least")), "variants")
    alone = variants.where("groups >= least").select("leaf", "line")

    open_leaves = variants.groupBy("leaf").agg(F.count("*").alias("n"), F.sum("groups").alias("all")) \
        .where((F.col("n") > 1) & (F.col("all") >= MIN_DOCS)).select("leaf")
    open_leaves = cut_lineage(open_leaves, "leaves")
    # tokens come from one document of each variant, so the key of this join is never a hot line
    key = ["leaf", "line", "doc_id"]
    wanted = cut_lineage(maybe_in(variants, open_leaves, "leaf").join(open_leaves, "leaf").select(*key, "groups"), "wanted")
    inner = cut_lineage(
        maybe_in(lines.select(*key, "tokens").where(F.octet_length("tokens") >= 2 * (DEPTH + MIN_FREE)), wanted, "line")
        .join(wanted, key).dropDuplicates(key)
        .withColumn("n", F.expr("cast(octet_length(tokens) div 2 as int)")), "inner")
    fits = cut_lineage(_fits(inner), "fits")
    variant = ["leaf", "line"]
    met = maybe_in(lines.select("doc_id", *variant), fits, "line").join(fits.select(*variant).distinct(), variant)
    recurring = (grouped(met).select(*variant, "group").distinct().join(fits, variant)
                 .groupBy("mask").agg(F.count_distinct("group").alias("groups"))
                 .where(recurs).select("mask"))
    return alone.unionByName(fits.join(recurring, "mask").select("leaf", "line")).distinct()


def _fits(inner: DataFrame) -> DataFrame:
    """(mask, leaf, line) of the variants that match enough constants of a group, and that group's key."""
    size = inner.groupBy("leaf").agg(F.sum("n").alias("size"))
    large = F.broadcast(cut_lineage(size.where(F.col("size") > LEAF_TOKENS).select("leaf"), "large"))     # few: each has many tokens
    every = inner.agg(F.sum("n")).first()[0] or 0
    part = F.pmod(F.xxhash64("leaf"), F.lit(-(-every // LEAF_TOKENS) or 1))
    places = F.array(*[_sampled(k, j) for k in range(MASKS) for j in range(MASKED_TO)])
    small = (inner.join(large, "leaf", "left_anti")
             .select(part.alias("part"), "leaf", "line", "groups", "tokens", places.alias("places"))
             .groupBy("part").applyInArrow(_leaf_fits, "mask long, leaf long, line long"))
    return small.unionByName(_joined_fits(inner.join(large, "leaf", "left_semi")))


def _leaf_fits(rows: pa.Table) -> pa.Table:
    """``_fits`` of whole leaves."""
    tokens = np.frombuffer(b"".join(rows["tokens"].to_pylist()), "<u2").astype(np.uint64)
    n = np.asarray(pc.binary_length(rows["tokens"])).astype(np.int64) // 2
    start = np.cumsum(n) - n
    leaf, line, w = (np.asarray(rows[c]) for c in ("leaf", "line", "groups"))
    places = np.asarray(rows["places"].combine_chunks().flatten()).reshape(len(n), MASKS, MASKED_TO)
    _, leaf_no = np.unique(leaf, return_inverse=True)
    out = []
    for k in range(MASKS):
        seen = np.zeros(len(n), np.uint64)
        for j in range(MASKED_TO):
            seen = seen << np.uint64(16) | tokens[start + places[:, k, j]]
        order = np.lexsort((seen, leaf_no))
        first = np.ones(len(n), dtype=bool)
        first[1:] = (np.diff(leaf_no[order]) != 0) | (np.diff(seen[order]) != 0)
        group = np.empty(len(n), np.int64)
        group[order] = np.cumsum(first) - 1
        every = np.bincount(group, w)
        own = np.flatnonzero(((np.bincount(group) > 1) & (every >= MIN_DOCS))[group])
        free = n[own] - DEPTH
        row = np.repeat(own, free)
        pos = np.arange(len(row)) - np.repeat(np.cumsum(free) - free, free)
        vote = group[row].astype(np.uint64) << np.uint64(40) | pos.astype(np.uint64) << np.uint64(16) | tokens[start[row] + DEPTH + pos]
        _, which = np.unique(vote, return_inverse=True)
        constant = (2 * np.bincount(which, w[row]))[which] > every[group[row]] if len(row) else np.zeros(0, bool)
        same = np.bincount(row, constant, len(n))[own]
        fit = own[same >= SIMILARITY * free]
        mask = tb.mix(tb.mix(leaf[fit].view(np.uint64) + np.uint64(k)) + seen[fit])
        out.append(pa.table([pa.array(mask.view(np.int64)), pa.array(leaf[fit]), pa.array(line[fit])], names=["mask", "leaf", "line"]))
    return pa.concat_tables(out)


def _as_arrays(batches):
    for batch in batches:
        flat = np.frombuffer(b"".join(batch.column("tokens").to_pylist()), "<u2").astype(np.int32)
        n = np.asarray(batch.column("n"))
        tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(flat))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("leaf", "line", "groups")), tokens],
                                         names=["leaf", "line", "groups", "tokens"])


def _joined_fits(inner: DataFrame) -> DataFrame:
    """``_fits`` by aggregation and joins, for leaves of any size."""
    inner = inner.select("leaf", "line", "groups", "n", "tokens").mapInArrow(
        _as_arrays, "leaf long, line long, groups long, tokens array<int>")
    inner = inner.withColumn("n", F.size("tokens")).withColumn("mask", F.explode(F.array(*[_masked(k) for k in range(MASKS)])))
    shared = inner.groupBy("mask").agg(F.count("*").alias("members"), F.sum("groups").alias("all")) \
        .where((F.col("members") > 1) & (F.col("all") >= MIN_DOCS)).select("mask", "all")
    votes = inner.join(shared, "mask").select(
        "mask", "leaf", "line", "groups", "all", "n", F.posexplode("tokens").alias("pos", "token")).where(F.col("pos") >= DEPTH)
    constants = (votes.groupBy("mask", "pos", "token", "all").agg(F.sum("groups").alias("w"))
                 .where(2 * F.col("w") > F.col("all")).select("mask", "pos", "token"))
    return (votes.join(constants, ["mask", "pos", "token"]).groupBy("mask", "leaf", "line", "n")
            .agg(F.count("*").alias("same"))
            .where(F.col("same") >= SIMILARITY * (F.col("n") - DEPTH)).select("mask", "leaf", "line"))


def _sampled(k: int, j: int):
    """Column: the j-th position that the k-th group of a line and its length choose."""
    free = F.col("n") - DEPTH
    return (DEPTH + F.pmod(F.xxhash64(F.lit(k), F.lit(j), free), free)).cast("int")


def _masked(k: int):
    """Column: key of the k-th group of a line in its leaf, its tokens at the sampled positions."""
    return F.xxhash64("leaf", F.lit(k), *[F.get("tokens", _sampled(k, j)) for j in range(MASKED_TO)])


def drop_recurring_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines of recurring templates taken out of ``text``, plus n_lines and n_dropped.

    Lines are the \\n-separated parts of a text.  Lines with fewer than MIN_CONSTANTS words without a
    digit go only as they are, from SHORT_DOCS documents on; blank lines stay, and so do all lines of
    rows with a null doc_id, which count as evidence.  Every row is returned with all its
    columns (columns named n_lines or n_dropped are replaced); a text may become empty, a null text
    stays null with n_lines 0.  Repeats of a line within a document count once and go together; rows
    that repeat a doc_id count once each and lose the same lines.
    """
    ship_package(docs.sparkSession)
    docs = docs.drop("n_lines", "n_dropped")
    text = F.col("text").cast("string")
    named = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("doc_id"), text.alias("text"),
                        F.xxhash64(text).alias("text_hash"))
    parsed = cut_lineage(named.mapInArrow(_text_batches, f"{_LINES}, {_SIGNATURE}"), "lines")
    lines = parsed.where("line is not null").drop(*[f.split()[0] for f in _SIGNATURE.split(", ")])
    sigs = parsed.where("line is null").select(*[f.split()[0] for f in SIG_SCHEMA.split(", ")])
    copies = cut_lineage(near_duplicates(named, COPY_PERCENT, sigs).where("not kept")
                         .select("doc_id", F.col("component_id").alias("group")).distinct(), "copies")
    gone = recurring_lines(lines, copies)
    gone = cut_lineage(gone, "gone")
    drops = (maybe_in(lines.select("doc_id", "text_hash", "at", "leaf", "line"), gone, "line").join(gone, ["leaf", "line"])
             .groupBy(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).agg(F.collect_set("at").alias("drops")))
    rest = [c for c in docs.columns if c != "text"]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    # the numbers of the lines to drop are small beside the texts, so they are hashed and no text is sorted
    joined = docs.select(row.alias("row"), text.alias("text")).join(
        drops.hint("shuffle_hash"), (F.col("row.doc_id").cast("long") == F.col("_doc")) & (F.xxhash64("text") == F.col("_hash")),
        "left").select("row", "text", "drops")
    kind = joined.schema["row"].dataType
    out = joined.mapInArrow(_rewrite_batches, f"row {kind.simpleString()}, text string, n_lines long, n_dropped long")
    return out.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns],
                      "n_lines", "n_dropped")


@query("op6_linededup")
def op6_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with its text after the recurring lines are dropped, and line counts."""
    return drop_recurring_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "text")
