"""Operator 5: benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit distance.

Texts and items become sequences of normalised words (runs of letters and digits, A-Z lower-cased).
The CGK walk of a sequence reads it from left to right; at output step t it emits the current word and
moves on if a random bit that depends on t and the word is 1.  Sequences at small edit distance stay
in step and their outputs have small Hamming distance.  An LSH key is a hash of SAMPLE output
positions; WALKS independent walks with TABLES keys each make up the target recall.

Items of fewer than MIN_ITEM_WORDS words are looked up by the hash of all their words.  Longer items of
[l, 2l) words (l the shortest item's length times a power of two) are one class.  Its
windows have w = l - l/2 + 1 words (l/2 rounded down); the windows of a text start at every l/2-th word and those
of an item at every word, so any occurrence of an item holds windows that are aligned with item windows (at least two from 1.5 l words on).  All
windows with an equal key are candidates, and so are all places where SEED bytes in a row of the
normalised text stand in an item, which finds passages whose words are nearly all changed.  A candidate
region that holds too few of the item's GRAM-byte substrings for SIMILARITY (a bound that rejects no
match) goes; all others are verified by the exact edit distance between the item and its best substring.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarweave.llm import textbatch as tb
from scholarweave.llm.registry import query
from scholarweave.session import ship_package, table

SIMILARITY = 0.8            # distance <= (1 - SIMILARITY) * length of the item, in characters
MIN_ITEM_WORDS = 8          # shorter items are found where exactly their words stand in a row
WALKS, TABLES, SAMPLE = 2, 14, 6
SEED = 8                    # bytes in a row that a passage shares with its item, where no walk finds it
GRAM = 3                    # length of the substrings that are counted before the exact check
SEEDS, SEED_SHARE = 4, 0.06  # seeds that make a candidate: so many, and in parts of the item's bytes
BAND = 16                   # candidates whose alignments lie so close are one
BLOCK_CHARS = 4_000_000     # items searched in one pass over the texts; more items take more passes
_BITS = 20                  # size of the table that tells most keys apart from all item keys
_GRAM_BITS = 23             # size of the table of (item, substring) pairs
LANES = 2048                # candidates whose edit distance is found at once
POOL, POOL_CHUNKS = 8192, 16    # candidates, or chunks of text, that are verified together
MAX_BLOCKS = 16             # items of more 64-character blocks are compared one at a time

_PART = np.ones(256, dtype=bool)
_PART[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def _sampled(walk: int, w: int) -> np.ndarray:
    """(TABLES, SAMPLE) output positions; a walk has read about w words after 2w steps."""
    rng = np.random.default_rng(1000 * walk + w)
    return np.stack([np.sort(rng.choice(round(1.6 * w), SAMPLE, replace=False)) for _ in range(TABLES)])


def window_keys(words: np.ndarray, at: np.ndarray, w: int, walk: int) -> np.ndarray:
    """(TABLES, windows) LSH keys of the walks that start at positions ``at`` of ``words``."""
    sampled = _sampled(walk, w)
    steps = int(sampled.max()) + 1
    weight = tb.constants(TABLES * SAMPLE, 40 + walk).reshape(TABLES, SAMPLE)
    keys = np.zeros((TABLES, len(at)), dtype=np.uint64)
    padded = np.concatenate([words, np.zeros(steps + 1, np.uint64)])
    bits, pos = padded, at.astype(np.int64)
    for t in range(steps):
        if t and t % 48 == 0:                       # a word has 48 random bits for each stretch of 48 steps
            bits = tb.mix(padded + np.uint64(t))
        symbol = padded[pos]
        for j, i in zip(*np.nonzero(sampled == t), strict=True):
            keys[j] += symbol * weight[j, i]
        turn = symbol if bits is padded else bits[pos]
        pos += ((turn >> np.uint64((t + 16 * walk) % 64)) & np.uint64(1)).view(np.int64)
    return tb.mix(keys + np.arange(TABLES, dtype=np.uint64)[:, None] + np.uint64(TABLES * walk))


def edit_distance_in(pattern: str, text: str) -> tuple[int, int]:
    """(least edit distance between ``pattern`` and a substring of ``text``, end of the first such substring).

    Bit-parallel columns (Myers 1999) on arbitrary-length integers.
    """
    m = len(pattern)
    if m == 0:
        return 0, 0
    where: dict[str, int] = {}
    for i, ch in enumerate(pattern):
        where[ch] = where.get(ch, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for at, ch in enumerate(text, 1):
        eq = where.get(ch, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        rise = down | ~(diagonal | up) & full
        fall = up & diagonal
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise, fall = (rise << 1) & full, (fall << 1) & full
        up = fall | ~(diagonal | rise) & full
        down = rise & diagonal
        if score < best:
            best, end = score, at
    return best, end


def _normal(raw: bytes, start: np.ndarray, end: np.ndarray) -> list[str]:
    return [raw[a:b].decode("utf-8", "replace").translate(_FOLD) for a, b in zip(start, end, strict=True)]


_FOLD = {c: c + 32 for c in range(65, 91)}


def _stream(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words, A-Z lower-cased, with one space after each, and where each word starts and ends in that."""
    size = end - start + 1
    ends = np.cumsum(size)
    out = np.full(int(ends[-1]) if len(ends) else 0, 0x20, dtype=np.uint8)
    at = np.arange(len(out)) + np.repeat(start - (ends - size), size)
    body = np.ones(len(out), dtype=bool)
    body[ends - 1] = False
    out[body] = tb._LOWER[data[at[body]]]
    return out, ends - size, ends - 1


def _allowed(chars: np.ndarray) -> np.ndarray:
    """Edits that SIMILARITY allows an item of so many characters."""
    return np.floor((1 - SIMILARITY) * chars + 1e-9).astype(np.int64)


def _code_points(utf8: bytes) -> np.ndarray:
    return np.frombuffer(utf8.decode("utf-8", "replace").encode("utf-32-le"), dtype="<u4")


def _grams(stream: np.ndarray, n: int) -> np.ndarray:
    """The n <= 8 bytes from each position on as one number."""
    padded = np.concatenate([stream, np.zeros(8, np.uint8)])
    whole = np.ndarray((len(stream),), dtype="<u8", buffer=padded, strides=(1,))
    return whole & np.uint64((1 << 8 * n) - 1)


def _runs(words: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n words from each position on."""
    total = np.full(len(at), n, dtype=np.uint64)
    for j, weight in enumerate(tb.constants(n, 60)):
        total += words[at + j] * weight
    return tb.mix(total)


class Index:
    """Item windows of a block of items by LSH key, and their seeds; short items by all their words."""

    def __init__(self, items: list[tuple[int, str]]):
        data, off = tb.utf8(pa.array([t for _, t in items], pa.string()))
        start, end, woff = tb.word_bounds(data, off, _PART)
        words = tb.span_hashes(data, start, end)
        raw = data.tobytes()
        self.ids = [i for i, _ in items]
        self.size = np.diff(woff)
        self.text = [" ".join(_normal(raw, start[a:b], end[a:b])) for a, b in zip(woff[:-1], woff[1:], strict=True)]
        stream, first, last = _stream(data, start, end)
        some = np.flatnonzero(self.size >= MIN_ITEM_WORDS)
        self.lo, self.bytes = np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
        self.lo[some] = first[woff[some]]
        self.bytes[some] = last[woff[some + 1] - 1] - self.lo[some]
        chars = np.array([len(t) for t in self.text], dtype=np.int64)
        wide = np.array([max((len(c.encode()) for c in set(t)), default=1) for t in self.text], dtype=np.int64)
        edits = _allowed(chars)
        self.slack = edits * wide + 2
        self.least = self.bytes - (GRAM - 1) - edits * (wide + GRAM - 1)    # an edit changes so many substrings at most
        self.holds = np.zeros(1 << _GRAM_BITS, dtype=bool)      # (item, substring) pairs
        of, at = self._places(some, GRAM)
        self.holds[self._pair(of, _grams(stream, GRAM)[at])] = True
        of, at = self._places(some, SEED)
        seeds = tb.mix(_grams(stream, SEED)[at])
        order = np.argsort(seeds, kind="stable")
        self.seeds, first = np.unique(seeds[order], return_index=True)
        self.seed_run = np.append(first, len(order))
        self.seed_item, self.seed_at = of[order], (at - self.lo[of])[order]
        self.maybe = np.zeros(1 << _GRAM_BITS, dtype=bool)
        self.maybe[seeds & np.uint64((1 << _GRAM_BITS) - 1)] = True
        self._compile(some)
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in sorted(set(self.size.tolist()) & set(range(1, MIN_ITEM_WORDS))):
            item = np.flatnonzero(self.size == n)
            keys = _runs(words, woff[item], n)
            order = np.argsort(keys, kind="stable")
            self.short[n] = keys[order], item[order]
        self.classes: dict[int, list] = {}
        sizes = [n for n in self.size.tolist() if n >= MIN_ITEM_WORDS]
        of = {k: min(sizes) << int(math.log2(n / min(sizes))) for k, n in enumerate(self.size.tolist())
              if n >= MIN_ITEM_WORDS}
        for base in sorted(set(of.values())):
            w = base - base // 2 + 1
            item = np.concatenate([np.full(self.size[k] - w + 1, k) for k in of if of[k] == base])
            shift = np.concatenate([np.arange(self.size[k] - w + 1) for k in of if of[k] == base])
            at = woff[item] + shift
            walks = []
            for walk in range(WALKS):
                keys = window_keys(words, at, w, walk)
                flat = keys.ravel()
                order = np.argsort(flat, kind="stable")
                maybe = np.zeros(1 << _BITS, dtype=bool)
                maybe[flat & np.uint64((1 << _BITS) - 1)] = True
                walks.append((flat[order], order % len(at), maybe))
            self.classes[base] = [item, shift, walks]

    def candidates(self, words: np.ndarray, woff: np.ndarray):
        """Rows (text, item, word at which the item would start), with repeats."""
        found = []
        for base, (item, shift, walks) in self.classes.items():
            w, stride = base - base // 2 + 1, base // 2
            n = np.maximum((np.diff(woff) - w) // stride + 1, 0)
            if not n.sum():
                continue
            ends = np.cumsum(n)
            text = np.repeat(np.arange(len(n)), n)
            at = woff[text] + stride * (np.arange(ends[-1]) - np.repeat(ends - n, n))
            for walk, (keys, window, maybe) in enumerate(walks):
                for row in window_keys(words, at, w, walk):
                    hit = np.flatnonzero(maybe[(row & np.uint64((1 << _BITS) - 1)).view(np.int64)])
                    lo, hi = np.searchsorted(keys, row[hit]), np.searchsorted(keys, row[hit], side="right")
                    some = hi > lo
                    hit, lo, hi = hit[some], lo[some], hi[some]
                    if len(hit):
                        size = hi - lo
                        k = window[np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())]
                        a = np.repeat(hit, size)
                        found.append(np.stack([text[a], item[k], at[a] - shift[k]], axis=1))
        return np.concatenate(found) if found else np.zeros((0, 3), np.int64)

    def short_runs(self, words: np.ndarray, woff: np.ndarray) -> list[list[int]]:
        """Rows [text, item, first word, last word + 1] where the words of a short item may stand, in order."""
        found = [np.zeros((0, 4), np.int64)]
        for n, (keys, items) in self.short.items():
            at = np.arange(max(len(words) - n + 1, 0))
            text = np.searchsorted(woff, at, side="right") - 1
            at = at[at + n <= woff[text + 1]]
            runs = _runs(words, at, n)
            lo, hi = np.searchsorted(keys, runs), np.searchsorted(keys, runs, side="right")
            size = hi - lo
            k = np.arange(size.sum()) + np.repeat(lo - np.cumsum(size) + size, size)
            at = np.repeat(at, size)
            found.append(np.stack([np.searchsorted(woff, at, side="right") - 1, items[k], at, at + n], axis=1))
        rows = np.concatenate(found)
        return rows[np.lexsort(rows.T[::-1])].tolist()

    def _places(self, items: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(item, place) of all n-byte substrings of the items."""
        size = np.maximum(self.bytes[items] - n + 1, 0)
        ends = np.cumsum(size)
        return np.repeat(items, size), np.arange(size.sum()) + np.repeat(self.lo[items] - (ends - size), size)

    @staticmethod
    def _pair(item: np.ndarray, grams: np.ndarray) -> np.ndarray:
        return tb.mix(grams + item.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64((1 << _GRAM_BITS) - 1)

    def seeded(self, stream: np.ndarray, first: np.ndarray, last: np.ndarray, woff: np.ndarray) -> np.ndarray:
        """Rows (text, item, first word, last word + 1) around the seeds of items in the texts."""
        keys = tb.mix(_grams(stream, SEED))
        hit = np.flatnonzero(self.maybe[(keys & np.uint64((1 << _GRAM_BITS) - 1)).view(np.int64)])
        run = np.searchsorted(self.seeds, keys[hit])
        real = np.append(self.seeds, 0)[run] == keys[hit]
        hit, run = hit[real & (run < len(self.seeds))], run[real & (run < len(self.seeds))]
        lo, size = self.seed_run[run], self.seed_run[run + 1] - self.seed_run[run]
        k = np.arange(size.sum()) + np.repeat(lo - np.cumsum(size) + size, size)
        hit = np.repeat(hit, size)
        text = np.searchsorted(woff, np.searchsorted(first, hit, side="right") - 1, side="right") - 1
        item, shift = self.seed_item[k], hit - self.seed_at[k]
        span = np.int64(len(stream) + int(self.bytes.max(initial=0)) + 1)       # alignments of an item in a chunk
        place = (text * len(self.ids) + item) * 2 * span + shift + span
        order = np.argsort(place, kind="stable")
        place, item = place[order], item[order]
        near = np.searchsorted(place, place + self.slack[item], side="right") - np.arange(len(place))
        some = order[near >= np.maximum(SEEDS, SEED_SHARE * self.bytes[item])]
        rows = np.unique(np.stack([text[some], self.seed_item[k[some]], shift[some] // BAND], axis=1), axis=0)
        text, item, begin = rows[:, 0], rows[:, 1], rows[:, 2] * BAND
        a = np.searchsorted(last, begin - self.slack[item], side="right")
        b = np.searchsorted(first, begin + BAND + self.bytes[item] + self.slack[item])
        return np.stack([text, item, np.maximum(a, woff[text]), np.minimum(b, woff[text + 1])], axis=1)

    def regions(self, words: np.ndarray, woff: np.ndarray, spans: tuple) -> list[list[int]]:
        """Candidates as [text, item, first word, last word + 1] whose region may hold the item."""
        stream, first, last = spans
        text, item, begin = self.candidates(words, woff).T
        slack = np.ceil((1 - SIMILARITY) * self.size[item]).astype(np.int64) + 1
        a = np.maximum(woff[text], begin - slack)
        b = np.minimum(woff[text + 1], begin + self.size[item] + slack)
        rows = np.concatenate([np.stack([text, item, a, b], axis=1), self.seeded(stream, first, last, woff)])
        rows = np.unique(rows[rows[:, 3] > rows[:, 2]], axis=0)
        held = []
        grams = _grams(stream, GRAM)
        for part in np.array_split(rows, len(rows) // 4096 + 1):
            _, item, a, b = part.T
            size = last[b - 1] - first[a]
            ends = np.cumsum(size)
            at = np.arange(size.sum()) + np.repeat(first[a] - (ends - size), size)
            found = np.append(0, np.cumsum(self.holds[self._pair(np.repeat(item, size), grams[at])]))
            held.append(part[found[ends] - found[ends - size] >= self.least[item]])
        out: list[list[int]] = []
        for row in np.concatenate(held).tolist():               # overlapping regions of an item become one
            if out and out[-1][:2] == row[:2] and row[2] <= out[-1][3]:
                out[-1][3] = max(out[-1][3], row[3])
            else:
                out.append(row)
        return out

    def _compile(self, items: np.ndarray) -> None:
        """Per number of 64-bit blocks: where each character stands in each item, as bits."""
        points = {int(k): _code_points(self.text[k].encode()) for k in items}
        alphabet = np.unique(np.concatenate([np.zeros(0, np.uint32), *points.values()]))
        self.symbol = np.zeros(0x110000, dtype=np.int32)            # 0: in no item
        self.symbol[alphabet] = np.arange(1, len(alphabet) + 1)
        self.symbols = len(alphabet) + 1
        self.chars = np.array([len(t) for t in self.text], dtype=np.int64)
        self.blocks = -(-self.chars // 64)
        self.where: dict[int, tuple[dict[int, tuple[np.ndarray, int]], np.ndarray]] = {}
        for w in sorted({int(self.blocks[k]) for k in points} & set(range(1, MAX_BLOCKS + 1))):
            rows, total, bits = {}, 1, [np.zeros((1, w), np.uint64)]
            for k in (k for k in points if self.blocks[k] == w):
                own, of = np.unique(self.symbol[points[k]], return_inverse=True)
                mask, at = np.zeros((len(own), w), np.uint64), np.arange(len(of))
                np.bitwise_or.at(mask, (of, at // 64), np.uint64(1) << (at % 64).astype(np.uint64))
                rows[k] = (own, total)
                bits.append(mask)
                total += len(own)
            self.where[w] = (rows, np.ascontiguousarray(np.concatenate(bits).T))

    def distances(self, item: np.ndarray, begin: np.ndarray, end: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Least edit distance between each item and a substring of symbols[begin:end]; 0 for very long items.

        Exact where it is within SIMILARITY; a candidate that can no longer come so near is left at a
        greater number.  The bit-parallel columns of ``edit_distance_in``, of LANES candidates at once and in 64-bit blocks.
        """
        # a long region is searched in parts twice as long as a match, each overlapping the next by its length
        reach = self.chars[item] + _allowed(self.chars[item])
        n = np.maximum(-(-(end - begin) // reach) - 1, 1)
        whole, first = np.repeat(np.arange(len(item)), n), np.cumsum(n) - n
        begin = begin[whole] + (np.arange(len(whole)) - first[whole]) * reach[whole]
        end = np.minimum(begin + 2 * reach[whole], end[whole])
        item = item[whole]
        out = np.zeros(len(item), dtype=np.int64)
        for w in self.where:
            mine = np.flatnonzero(self.blocks[item] == w)
            mine = mine[np.argsort((end - begin)[mine], kind="stable")]
            for lo in range(0, len(mine), LANES):
                part = mine[lo:lo + LANES]
                out[part] = self._columns(w, item[part], begin[part], end[part], symbols)
        return np.minimum.reduceat(out, first) if len(out) else out

    def _columns(self, w: int, item: np.ndarray, begin: np.ndarray, end: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        rows, bits = self.where[w]
        one, sign = np.uint64(1), np.uint64(63)
        own, lane = np.unique(item, return_inverse=True)
        row = np.zeros((len(own), self.symbols), dtype=np.int32)
        for i, k in enumerate(own.tolist()):
            held, first = rows[k]
            row[i, held] = np.arange(first, first + len(held))
        size, lane = end - begin, lane * self.symbols
        allowed, score = _allowed(self.chars[item]), self.chars[item]
        up = [np.full(len(item), ~np.uint64(0)) for _ in range(w)]
        down = [np.zeros(len(item), np.uint64) for _ in range(w)]
        top = ((score - 1) % 64).astype(np.uint64)
        out, best, open_ = score.copy(), score.copy(), np.arange(len(item))
        for t in range(int(size.max(initial=0))):
            if t % 16 == 0:                     # a score falls by 1 a step at most
                out[open_] = best
                on = (size > t) & (np.minimum(best, score - (size - t)) <= allowed)
                open_, size, begin, lane, top, allowed, score, best = (
                    x[on] for x in (open_, size, begin, lane, top, allowed, score, best))
                up, down = [u[on] for u in up], [d[on] for d in down]
                # past a region's end stands a character of no item, which lowers no distance
                steps = t + np.arange(16)[:, None]
                ahead = row.take(lane + symbols.take(np.minimum(begin + steps, len(symbols) - 1)) * (steps < size))
            at = ahead[t % 16]
            rise_in = fall_in = np.zeros(len(lane), np.uint64)
            for b in range(w):
                eq, u, d = bits[b].take(at), up[b], down[b]
                vertical = eq | d
                if b:
                    eq = eq | fall_in
                diagonal = (((eq & u) + u) ^ u) | eq
                rise, fall = d | ~(diagonal | u), u & diagonal
                last = top if b == w - 1 else sign
                rise_out, fall_out = (rise >> last) & one, (fall >> last) & one
                rise, fall = (rise << one) | rise_in, (fall << one) | fall_in
                up[b], down[b] = fall | ~(vertical | rise), rise & vertical
                rise_in, fall_in = rise_out, fall_out
            score += rise_in.view(np.int64) - fall_in.view(np.int64)
            np.minimum(best, score, out=best)
        out[open_] = best
        return out

    def prepare(self, column: pa.Array) -> tuple:
        """The candidates of a column of texts, with what ``verify`` needs: their own characters, the words' places."""
        data, off = tb.utf8(column)
        start, end, woff = tb.word_bounds(data, off, _PART)
        spans = _stream(data, start, end)
        words = tb.span_hashes(data, start, end)
        rows = np.array(self.regions(words, woff, spans), dtype=np.int64).reshape(-1, 4)
        stream, first, last = spans
        point = np.append(0, np.cumsum((stream & 0xC0) != 0x80))
        a, b = point[first[rows[:, 2]]], point[last[rows[:, 3] - 1]]
        ends = np.cumsum(b - a)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(a - (ends - (b - a)), b - a)
        return data, off, start, end, rows, b - a, self.symbol[_code_points(stream.tobytes())[at]], \
            self.short_runs(words, woff)

    def verify(self, prepared: list[tuple]) -> list[list[tuple[int, int, int, int, int]]]:
        """Per column (text, item, distance, start, end) of the first verified occurrence of each item in each text."""
        size = np.concatenate([p[5] for p in prepared])
        item = np.concatenate([p[4][:, 1] for p in prepared])
        ends = np.cumsum(size)
        near = self.distances(item, ends - size, ends, np.concatenate([p[6] for p in prepared])) \
            <= _allowed(self.chars[item])
        out, seen = [], 0
        for data, off, start, end, rows, _, _, short in prepared:
            out.append(self._first_matches(data, off, start, end, rows[near[seen:seen + len(rows)]].tolist() + short))
            seen += len(rows)
        return out

    def _first_matches(self, data: np.ndarray, off: np.ndarray, start: np.ndarray, end: np.ndarray,
                       rows: list[list[int]]) -> list[tuple[int, int, int, int, int]]:
        raw = data.tobytes()
        out: list[tuple[int, int, int, int, int]] = []
        done = (-1, -1)
        for text, item, a, b in rows:
            if (text, item) == done:
                continue
            pattern, region = self.text[item], _normal(raw, start[a:b], end[a:b])
            joined = " ".join(region)
            if self.size[item] < MIN_ITEM_WORDS and joined != pattern:
                continue
            distance, stop = edit_distance_in(pattern, joined)
            if distance <= _allowed(len(pattern)):
                done = (text, item)
                _, back = edit_distance_in(pattern[::-1], joined[:stop][::-1])
                lead = np.cumsum([0] + [len(r) + 1 for r in region])
                first = int(np.searchsorted(lead, stop - back, side="right")) - 1
                final = max(int(np.searchsorted(lead, stop, side="left")) - 1, first)
                points = lambda to: len(raw[off[text]:to].decode("utf-8", "replace"))  # noqa: E731, B023
                out.append((text, item, distance, points(start[a + first]), points(end[a + final])))
        return out

    def matches(self, column: pa.Array) -> list[tuple[int, int, int, int, int]]:
        """``verify`` of one column."""
        return self.verify([self.prepare(column)])[0]

    def pooled(self, parts):
        """(part, matches) of each (part, column); the candidates of many columns are verified at once."""
        held, prepared, n = [], [], 0
        for part, column in parts:
            held.append(part)
            prepared.append(self.prepare(column))
            n += len(prepared[-1][4])
            if n >= POOL or len(held) >= POOL_CHUNKS:
                yield from zip(held, self.verify(prepared), strict=True)
                held, prepared, n = [], [], 0
        if held:
            yield from zip(held, self.verify(prepared), strict=True)


def _item_blocks(benchmark: DataFrame):
    """Blocks of (item_id, text) of about BLOCK_CHARS characters each, one at a time on the driver."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_CHARS))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).distinct().collect()
        yield sorted(((r.item_id, r.text) for r in rows), key=lambda r: (r[0] is None, r[0], r[1]))


def _index(shared) -> Index:
    return tb.kept(("items", shared.id), lambda: Index(shared.value[1]))


class _Shared:
    """A broadcast block of items, with an id that tells blocks apart in a worker."""

    def __init__(self, spark: SparkSession, items: list):
        self.block = spark.sparkContext.broadcast((None, items))
        self.id = hash(tuple(items))

    @property
    def value(self):
        return self.block.value


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row and item in it: doc_id, item_id, distance, item_chars, start, end.

    ``distance`` is the edit distance in characters between the normalised item and the passage, at
    most (1 - SIMILARITY) of item_chars; [start, end) are code points of the first verified
    occurrence.  An item of fewer than MIN_ITEM_WORDS words occurs where exactly its words stand in a row
    (distance 0).  Null and empty texts and items, and items without a word, match nothing; empty tables
    give no rows.  Null ids are returned as such; equal items under several ids match each;
    repeated rows are searched each; extra columns are ignored.  The items are searched in blocks of
    BLOCK_CHARS characters, one pass over the texts per block.
    """
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = spark.createDataFrame([], _MATCHES)
    for items in _item_blocks(benchmark):
        shared = _Shared(spark, items)

        def run(batches, shared=shared):
            index = _index(shared)
            parts = ((part.column("doc_id"), part.column("text"))
                     for batch in batches for part in tb.chunks(batch, "text"))
            for ids, rows in index.pooled(parts):
                text, item, distance, start, end = (list(c) for c in zip(*rows, strict=True)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(text, pa.int64())), pa.array([index.ids[i] for i in item], pa.int64()),
                     pa.array(distance, pa.int64()), pa.array([len(index.text[i]) for i in item], pa.int64()),
                     pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                    names=["doc_id", "item_id", "distance", "item_chars", "start", "end"])

        out = out.unionByName(docs.mapInArrow(run, _MATCHES))
    return out


_MATCHES = "doc_id long, item_id long, distance long, item_chars long, start long, end long"


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_ITEM_WORDS) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item of ``min_words`` words; all columns, no shuffle.

    Items of a few words occur by chance: ``find_contamination`` reports them, but they drop a document only
    where ``min_words`` asks for it.  Rows with a null or empty text stay, and an empty benchmark drops none;
    see ``find_contamination`` for what matches.
    """
    spark = docs.sparkSession
    ship_package(spark)
    for items in _item_blocks(benchmark):
        shared = _Shared(spark, items)

        def run(batches, shared=shared):
            index = _index(shared)
            parts = ((part, part.column("_text")) for batch in batches for part in tb.chunks(batch, "_text"))
            for part, rows in index.pooled(parts):
                keep = np.ones(part.num_rows, dtype=bool)
                keep[[r[0] for r in rows if index.size[r[1]] >= min_words]] = False
                yield part.filter(pa.array(keep)).select(["row"])

        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
        tagged = docs.select(row, F.col("text").cast("string").alias("_text"))
        kind = tagged.schema["row"].dataType.simpleString()
        docs = tagged.mapInArrow(run, f"row {kind}").select(
            *[F.col("row").getField(c).alias(c) for c in docs.columns])
    return docs


@query("op5_decontam")
def op5_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of ``benchmark`` found in the texts of ``documents``."""
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
