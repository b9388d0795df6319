"""Large JSON feeds, each file read by several tasks (S3).

A feed is one JSON text, so a task that starts inside it does not know whether it stands in a string, nor
how deep.  Both follow from what lies before: each byte range is summed up for either answer (quotes,
change of depth, objects opened per depth), a running sum over a file's ranges then tells where each of
them really stands and how many documents opened before it, and each range yields the documents that
open in it, reading on to the end of the last one.  Every byte is read twice, by tasks that need no more
than a range and one document at a time.
"""

from __future__ import annotations

import posixpath
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scholarweave.operators.features import parse_document
from scholarweave.session import ship_package

RANGE_BYTES = 16 << 20
TAIL_BYTES = 1 << 20        # read at once past a range's end, until its last document is closed
BATCH_BYTES = 4 << 20       # documents handed to Spark at once
LIST_DEPTH = 4              # brackets open around a document: three objects and the list of documents


def _steps(data: np.ndarray, escaped: bool, inside: int) -> tuple[np.ndarray, int]:
    """(+1 / -1 for every bracket outside strings, whether the end lies in a string) of some JSON bytes.

    ``escaped``: the first byte follows an odd run of backslashes; ``inside``: it lies in a string.
    """
    at = np.arange(len(data))
    other = np.maximum.accumulate(np.where(data != 0x5C, at, -1))      # last byte that is no backslash
    before = np.concatenate([[-1], other[:-1]])
    run = at - 1 - before + (escaped & (before < 0))
    quote = (data == 0x22) & (run % 2 == 0)
    outside = (inside + np.cumsum(quote)) % 2 == 0
    step = ((data == 0x7B) | (data == 0x5B)).astype(np.int64) - ((data == 0x7D) | (data == 0x5D))
    return step * outside, int(inside + quote.sum()) % 2


def _escaped(file, at: int) -> bool:
    """Whether the byte at ``at`` follows an odd run of backslashes."""
    run = 0
    while run < at:
        size = min(4096, at - run)
        file.seek(at - run - size)
        block = file.read(size)
        tail = len(block) - len(block.rstrip(b"\\"))
        run += tail
        if tail < size:
            break
    return run % 2 == 1


def _read(file, lo: int, hi: int) -> np.ndarray:
    file.seek(lo)
    return np.frombuffer(file.read(hi - lo), dtype=np.uint8)


def range_summary(file, lo: int, hi: int) -> list[tuple[int, list[tuple[int, int]], int]]:
    """Per answer (starts outside, starts inside a string): change of depth, objects per depth, end's state."""
    data, escaped = _read(file, lo, hi), _escaped(file, lo)
    out = []
    for inside in (0, 1):
        step, last = _steps(data, escaped, inside)
        depth = np.cumsum(step)
        levels, n = np.unique(depth[(step == 1) & (data == 0x7B)] - 1, return_counts=True)
        out.append((int(depth[-1]), list(zip(levels.tolist(), n.tolist(), strict=True)), last))
    return out


def range_documents(file, lo: int, hi: int, size: int, inside: int, depth: int) -> Iterator[bytes]:
    """The documents that open in [lo, hi) of a file of ``size`` bytes, whole."""
    at, end, escaped = lo, hi, _escaped(file, lo)
    held: list[bytes] | None = None         # pieces of the open document
    while at < end:
        data = _read(file, at, end)
        raw = data.tobytes()
        step, inside = _steps(data, escaped, inside)
        after = depth + np.cumsum(step)
        first = (step == 1) & (data == 0x7B) & (after == LIST_DEPTH + 1) & (at < hi)
        last = (step == -1) & (data == 0x7D) & (after == LIST_DEPTH)
        begin = 0
        for k in np.flatnonzero(first | last).tolist():
            if first[k]:
                held, begin = [], k
            elif held is not None:
                yield b"".join([*held, raw[begin:k + 1]])
                held = None
        if held is not None:
            held.append(raw[begin:])
        run = len(raw) - len(raw.rstrip(b"\\"))
        escaped = (run + (escaped if run == len(raw) else 0)) % 2 == 1
        at, depth = end, int(after[-1])
        end = at if held is None else min(at + TAIL_BYTES, size)


def _open(path: str):
    fs, inner = pafs.FileSystem.from_uri(path)
    return fs.open_input_file(inner)


def _files(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files under a path, hidden ones left out."""
    root = re.sub(r"^file:/+", "/", path)
    fs, inner = pafs.FileSystem.from_uri(root)
    prefix = root.rstrip("/").removesuffix(inner.rstrip("/"))
    info = fs.get_file_info(inner)
    infos = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(inner, recursive=True))
    return sorted((prefix + i.path, i.size) for i in infos
                  if i.type == pafs.FileType.File and posixpath.basename(i.path)[0] not in "._")


def _summaries(batches):
    for batch in batches:
        rows = []
        for path, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("path", "lo", "hi")), strict=True):
            with _open(path) as file:
                rows.append(range_summary(file, lo, hi))
        counts = pa.map_(pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("path", "size", "lo", "hi")),
             pa.array([r[0][2] for r in rows], pa.int64()),      # a range that starts outside: odd number of quotes
             *[pa.array([r[k][0] for r in rows], pa.int64()) for k in (0, 1)],
             *[pa.array([r[k][1] for r in rows], counts) for k in (0, 1)]],
            names=["path", "size", "lo", "hi", "odd", "delta0", "delta1", "opens0", "opens1"])


def _documents(batches):
    def out(path, pos, docs):
        return pa.RecordBatch.from_arrays(
            [pa.array([path] * len(docs), pa.string()), pa.array(range(pos, pos + len(docs)), pa.int64()),
             pa.array([d.decode("utf-8", "replace") for d in docs], pa.string())], names=["url", "doc_pos", "doc"])

    for batch in batches:
        for r in batch.to_pylist():
            with _open(r["path"]) as file:
                pos, docs, held = r["first"], [], 0
                for doc in range_documents(file, r["lo"], r["hi"], r["size"], r["inside"], r["depth"]):
                    docs.append(doc)
                    held += len(doc)
                    if held >= BATCH_BYTES:
                        yield out(r["path"], pos, docs)
                        pos, docs, held = pos + len(docs), [], 0
                if docs:
                    yield out(r["path"], pos, docs)


def read_feed(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Documents (url, doc_pos, features) of the feed files under a shared path, one row each (S3).

    Equals ``explode_feed`` on the files' texts, in any number of tasks a file; ``url`` is the file.  The
    list ``DataSet.documents.document`` must be the only value of its depth that holds objects.  An empty file
    has no documents; a document cut off by the end of its file is dropped.
    """
    ship_package(spark)
    files = [(p, size) for p, size in _files(path) if size]
    ranges = sum(-(-size // range_bytes) for _, size in files)
    if not ranges:
        return spark.createDataFrame([], "url string, doc_pos long, doc string").select(
            "url", "doc_pos", parse_document("doc").alias("features"))
    # many ranges may be short: a task takes about RANGE_BYTES of them, one at a time
    tasks = min(ranges, max(sum(size for _, size in files) // RANGE_BYTES, 2 * spark.sparkContext.defaultParallelism))
    cut = spark.createDataFrame(files, "path string, size long").select(
        "path", "size", F.explode(F.sequence(F.lit(0), F.col("size") - 1, F.lit(range_bytes))).alias("lo")) \
        .withColumn("hi", F.least(F.col("lo") + range_bytes, "size")).repartition(tasks)
    counts = "map<bigint,bigint>"
    seen = cut.mapInArrow(_summaries, "path string, size long, lo long, hi long, odd long, delta0 long, delta1 long, "
                                      f"opens0 {counts}, opens1 {counts}")
    before = Window.partitionBy("path").orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    placed = (seen.withColumn("inside", so_far("odd") % 2)
              .withColumn("depth", so_far(F.when(F.col("inside") == 0, F.col("delta0")).otherwise(F.col("delta1"))))
              .withColumn("opens", F.when(F.col("inside") == 0, F.col("opens0")).otherwise(F.col("opens1")))
              .withColumn("first", so_far(F.coalesce(
                  F.try_element_at("opens", F.lit(LIST_DEPTH) - F.col("depth")), F.lit(0)))))
    docs = placed.select("path", "size", "lo", "hi", "inside", "depth", "first").repartition(tasks) \
        .mapInArrow(_documents, "url string, doc_pos long, doc string")
    return docs.select("url", "doc_pos", parse_document("doc").alias("features"))
