"""Operator 7: byte-level BPE encoding and decoding with a given vocabulary.

Texts are cut by the vocabulary's split pattern.  A task collects the distinct pieces it has not
met yet and encodes them together with a pair occurrence index: each mergeable pair maps to all its
positions in those pieces; the lowest active rank is taken from a heap, all its occurrences are
merged from left to right, and the lists of the neighbouring pairs are updated.  Pieces are
independent, and a pair that contains a merged symbol always has a higher rank than the merge that
made it, so one ascending sweep over the ranks gives each piece its own BPE result.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarweave.llm import textbatch as tb
from scholarweave.llm.registry import query
from scholarweave.session import ship_package, table

#: Fixed value of the byte-level vocabularies: the split pattern.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

CACHE_PIECES = 150_000       # pieces a worker remembers; beyond it only those that came again (results stay equal)
CACHE_PIECE_CHARS = 64       # longer pieces are encoded where they occur and not remembered
_CHUNK = 1 << 18            # bytes of text encoded at once; its pieces and symbols in Python take many times that


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [], 0x100
    for b in range(256):
        if b in own:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


class Vocabulary:
    """A byte-level BPE vocabulary read from the JSON text of a tokenizer file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        vocab = spec["model"]["vocab"]
        symbols = _byte_symbols()
        self.byte_id = np.array([vocab[s] for s in symbols])
        self.bits = max(vocab.values()).bit_length()
        self.rank = {}                              # left << bits | right -> rank of that merge
        self.parts: list[tuple[int, int, int]] = []  # rank -> (left, right, merged symbol)
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.rank.setdefault(vocab[a] << self.bits | vocab[b], rank)
            self.parts.append((vocab[a], vocab[b], vocab[a + b]))
        self.byte_rank = np.array([[self.rank.get(a << self.bits | b, -1) for b in self.byte_id.tolist()]
                                   for a in self.byte_id.tolist()])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        byte_of = {s: b for b, s in enumerate(symbols)}
        self.bytes_of = {i: bytes(byte_of[c] for c in s) for s, i in vocab.items() if all(c in byte_of for c in s)}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.split = regex.compile(SPLIT_PATTERN)
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) \
            if self.special else None
        self.forget()

    def forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.known = 0
        self.ids = np.zeros(1 << 16, np.uint32)
        self.bounds = np.zeros(1 << 14, np.int64)
        self.again = np.zeros(1 << 14, bool)        # slots of pieces that later texts held too
        for s, i in self.special.items():
            self._store([s], np.array([i], np.uint32), np.array([1]))

    def forget_rare(self) -> None:
        """Forgets the pieces that no later texts held; all of them where more than half came again."""
        pieces = list(self.slot)
        kept = np.flatnonzero(self.again[:len(pieces)])
        ids, bounds = self.ids, self.bounds
        self.forget()
        kept = kept[kept >= len(self.slot)]         # special tokens are there already
        if 0 < len(kept) <= len(pieces) // 2:
            ids = [ids[a:b] for a, b in zip(bounds[kept].tolist(), bounds[kept + 1].tolist(), strict=True)]
            self._store([pieces[k] for k in kept.tolist()], np.concatenate(ids),
                        np.fromiter(map(len, ids), np.int64, len(ids)))

    def _store(self, pieces: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        n = len(self.slot)
        ends = self.bounds[n] + np.cumsum(counts)
        while len(self.ids) < ends[-1]:
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while len(self.bounds) < n + len(pieces) + 1:
            self.bounds = np.concatenate([self.bounds, np.zeros_like(self.bounds)])
            self.again = np.concatenate([self.again, np.zeros_like(self.again)])
        self.ids[self.bounds[n]:ends[-1]] = ids
        self.bounds[n + 1:n + 1 + len(pieces)] = ends
        self.slot.update(zip(pieces, range(n, n + len(pieces)), strict=True))

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in a row, ids per piece), by one ascending sweep over the ranks that occur."""
        raw = [p.encode() for p in pieces]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        owner = np.repeat(np.arange(len(raw)), size)
        at = np.arange(len(data)) + owner           # one gap after each piece
        symbols = np.full(len(data) + len(raw), -1)  # -1: merged away, or a gap
        symbols[at] = self.byte_id[data]
        ranks = np.where(owner[1:] == owner[:-1], self.byte_rank[data[:-1], data[1:]], -1)
        found = np.flatnonzero(ranks >= 0)
        found = found[np.argsort(ranks[found], kind="stable")]
        heap, cut = np.unique(ranks[found], return_index=True)
        heap = heap.tolist()                        # ascending, so a heap
        where = dict(zip(heap, map(np.ndarray.tolist, np.split(at[found], cut[1:])), strict=False))
        sym = symbols.tolist()
        after = list(range(1, len(sym) + 1))        # position of the next symbol
        before = list(range(-1, len(sym) - 1))
        get, bits, push, pop = self.rank.get, self.bits, heapq.heappush, heapq.heappop
        while heap:
            rank = pop(heap)
            left, right, made = self.parts[rank]
            positions = where.pop(rank)
            positions.sort()
            high = made << bits
            for i in positions:
                j = after[i]
                if sym[i] != left or sym[j] != right:       # an overlapping or lower rank took one of them
                    continue
                k = after[j]
                h = before[i]
                sym[i], sym[j] = made, -1
                after[i], before[k] = k, i
                r = get(sym[h] << bits | made)              # a gap gives a negative key, which has no rank
                if r is not None:
                    if r in where:
                        where[r].append(h)
                    else:
                        where[r] = [h]
                        push(heap, r)
                r = get(high | sym[k])
                if r is not None:
                    if r in where:
                        where[r].append(i)
                    else:
                        where[r] = [i]
                        push(heap, r)
        symbols = np.array(sym, np.int64)
        left_over = symbols >= 0
        counts = np.bincount(np.repeat(np.arange(len(raw)), size + 1)[left_over], minlength=len(raw))
        return symbols[left_over].astype(np.uint32), counts

    def pieces(self, text: str) -> list[str]:
        if self.cut is None or not self.cut.search(text):
            return self.split.findall(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += self.split.findall(text[at:m.start()])
            out.append(m.group())
            at = m.end()
        return out + self.split.findall(text[at:])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (uint32) of each text."""
        cut = [self.pieces(t) for t in texts]
        if len(self.slot) > CACHE_PIECES:
            self.forget_rare()
        self.known = len(self.slot)
        seen = set().union(*cut)
        new = [p for p in seen if p not in self.slot]
        long = {p for p in new if len(p) > CACHE_PIECE_CHARS}
        short = [p for p in new if p not in long]
        if short:
            self._store(short, *self.encode_pieces(short))
        if not long:
            return [self._gather(c) for c in cut]
        ids, counts = self.encode_pieces(list(long))
        lone = dict(zip(long, np.split(ids, np.cumsum(counts)[:-1]), strict=True))
        out = []
        for c in cut:
            parts, run = [], []
            for p in c:
                if p in lone:
                    parts += [self._gather(run), lone[p]]
                    run = []
                else:
                    run.append(p)
            out.append(np.concatenate([*parts, self._gather(run)]))
        return out

    def _gather(self, pieces: list[str]) -> np.ndarray:
        slots = np.fromiter(map(self.slot.__getitem__, pieces), np.int64, len(pieces))
        self.again[slots[slots < self.known]] = True
        lo = self.bounds[slots]
        size = self.bounds[slots + 1] - lo
        ends = np.cumsum(size)
        if not len(ends):
            return np.zeros(0, np.uint32)
        return self.ids[np.repeat(lo - ends + size, size) + np.arange(ends[-1])]

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _vocabulary(text: str) -> Vocabulary:
    return tb.kept(("vocabulary", hash(text)), lambda: Vocabulary(text))


def _spec(spark: SparkSession, tokenizer_path: str):
    """Broadcast of the vocabulary file: a few MB, whatever the data size."""
    with open(tokenizer_path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id and ids (binary: little-endian unsigned 32-bit integers) of every text of (doc_id, text).

    Special tokens of the vocabulary in a text get their own ids, and none are added.  A null or
    empty text has no ids; rows that repeat are encoded each; other columns are ignored.
    """
    ship_package(docs.sparkSession)
    spec = _spec(docs.sparkSession, tokenizer_path)

    def run(batches):
        vocab = _vocabulary(spec.value)
        for batch in batches:
            for part in tb.chunks(batch, "text", _CHUNK):
                ids = vocab.encode([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())],
                    names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, ids and decoded (string) of every row of (doc_id, ids); null ids decode to the empty text."""
    ship_package(encoded.sparkSession)
    spec = _spec(encoded.sparkSession, tokenizer_path)

    def run(batches):
        vocab = _vocabulary(spec.value)
        for batch in batches:
            for part in tb.chunks(batch, "ids", 4 * _CHUNK):
                texts = [vocab.decode(np.frombuffer(x or b"", "<u4")) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(texts, pa.string())],
                    names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded string")


def default_path() -> str:
    """The installed byte-level vocabulary of 50,257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, ids and decoded of every text of (doc_id, text): ``encode`` and ``decode`` in one worker.

    Nulls, empty texts and repeated rows as there.  Two chained stages would keep two workers, with a
    vocabulary each, for every task and send the ids through the JVM in between.
    """
    ship_package(docs.sparkSession)
    spec = _spec(docs.sparkSession, tokenizer_path)

    def run(batches):
        vocab = _vocabulary(spec.value)
        for batch in batches:
            for part in tb.chunks(batch, "text", _CHUNK):
                ids = vocab.encode([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                     pa.array([vocab.decode(x) for x in ids], pa.string())],
                    names=["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, ids binary, decoded string")


def digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Encode then decode every text: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return round_trip(docs, tokenizer_path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


@query("op7_bpe")
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round trip of every text of ``documents`` through the byte-level vocabulary."""
    return digests(table(spark, sf_dir, "documents"), default_path())
