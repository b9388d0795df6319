"""Operator 3: personal data by fixed patterns and gradient-boosted candidates.

High-recall generators propose overlapping candidate spans of four kinds.  Candidates that the fixed
patterns and checks accept are the base spans, which always stay; the model decides on all others.  Boosted trees
learn which format and context features mark personal data from all such candidates of the corpus whose
verdict is known (accepted by the fixed patterns, or of a form that cannot be personal data) and from
spellings written by rule (``pii_forms``), which are the same for every corpus.  However many candidates a
kind and verdict has, together they weigh STRATUM at most.  Platt scaling on a quarter that the trees have
not seen turns their scores into probabilities, and each kind's threshold is the least probability at which
that quarter reaches PRECISION, LEAST_PROBABILITY at least.  Equal binned candidates are counted on Spark; up
to LOCAL_ROWS distinct ones are summed on the driver, more in blocks all over the cluster, to the same trees.  Candidates at or above their threshold are added, but for those of a form that cannot be
personal data (a failed Luhn check, no valid address, a bare run of digits, a date).
"""

from __future__ import annotations

import bisect
import ipaddress
import itertools
import math
import pickle
import re

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarweave.llm import boosting as bo
from scholarweave.llm import textbatch as tb
from scholarweave.llm.pii_forms import examples
from scholarweave.llm.registry import query
from scholarweave.session import cut_lineage, ship_package, table

KINDS = ("email", "ip", "card", "phone")
STRATUM = 2_000             # weight of all the corpus's candidates of a kind and verdict, one each if they are fewer
LOCAL_ROWS = 20_000         # distinct binned candidates that the driver takes
BLOCK_ROWS = 50_000         # distinct binned candidates of a block on the cluster
RENEW = 10                  # trees after which blocks on the cluster keep their scores
LARGEST = 999.0             # features are whole numbers up to this
EXAMPLES = 400              # spellings by rule of each kind and label
TREES, LEAVES, RATE, BINS = 60, 8, 0.2, 32
PRECISION, LEAST_PROBABILITY = 0.99, 0.9
GRID = np.append(0.0, bo.sigmoid(np.linspace(-20, 20, 4001)))    # probabilities that may be thresholds
CONTEXT = 24                # characters before and after a candidate that its features see

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits is entered at its start only, which keeps long runs linear and changes no match
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT = re.compile(r"(?i:[\x20]?(?:\(at\)|\[at\]|\{at\})[\x20]?)")
_DOT_DOMAIN = re.compile(r"(?i:[A-Za-z0-9-]+(?:(?:\.|\x20\.\x20|[\x20]?(?:\(dot\)|\[dot\]|\{dot\})[\x20]?)[A-Za-z0-9-]+)+)")
_DIGIT_RUN = re.compile(r"[0-9(](?:[\x20()./_-]{0,2}[0-9])+")
_LOCAL_PHONE = re.compile(r"(?<![0-9.,+/-])(?:\([0-9]{2,5}\)[\x20]?|0[0-9]{1,4}[\x20./-]|[0-9]{3}[\x20.-])"
                          r"[0-9]{3,4}[\x20.-]?[0-9]{3,5}(?![0-9])")
_IP6 = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])")
_DATE = re.compile(r"[0-9]{1,4}([-./])[0-9]{1,2}\1[0-9]{1,4}")
_DIGITS = re.compile(r"[0-9]")
_CUES = {"email": ("mail", "e-mail", "contact"), "ip": ("ip", "host", "server", "address"),
         "card": ("card", "visa", "credit", "account"), "phone": ("tel", "phone", "call", "fax", "mobile")}


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return (odd + even) % 10 == 0


def _emails(text: str):
    """Leftmost non-overlapping local@domain: a local part reaches back to the last match at most."""
    done, at = 0, text.find("@")
    while at >= 0:
        local = _LOCAL.match(text[done:at][::-1])
        domain = _DOMAIN.match(text, at + 1) if local else None
        if domain:
            yield at - local.end(), domain.end()
            done = domain.end()
            at = text.find("@", done)
        else:
            done = at + 1
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns that pass their checks, by kind as listed and start."""
    out = []
    if "@" in text:
        out += [("email", a, b) for a, b in _emails(text)]
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:] if len(p) > 4 else p) <= 255 for p in m.group().split(".")):
                out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return out


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Overlapping candidate spans; the base patterns' matches, checked or not, are among them."""
    out: set[tuple[str, int, int]] = set()
    if "@" in text:
        out.update(("email", a, b) for a, b in _emails(text))
        done = 0
        for m in re.finditer("@", text):
            local = _LOCAL.match(text[done:m.start()][::-1])
            after = re.compile(r"[A-Za-z0-9.-]+").match(text, m.end())
            if local and after:
                out.add(("email", m.start() - local.end(), after.end()))
            done = m.end()
    done = 0
    for m in _AT.finditer(text):
        local = _LOCAL.match(text[done:m.start()][::-1])
        domain = _DOT_DOMAIN.match(text, m.end())
        if local and domain:
            out.add(("email", m.start() - local.end(), domain.end()))
        done = m.end()
    if ":" in text:
        out.update(("ip", *m.span()) for m in _IP6.finditer(text))
    if _DIGITS.search(text):
        out.update(("ip", *m.span()) for m in _IP.finditer(text))
        out.update(("card", *m.span()) for m in _CARD.finditer(text) if m.end() - m.start() >= 12)
        out.update(("phone", *m.span()) for m in _PHONE.finditer(text))
        out.update(("phone", *m.span()) for m in _LOCAL_PHONE.finditer(text))
        for m in _DIGIT_RUN.finditer(text):
            n = sum(c.isdigit() for c in m.group())
            if 7 <= n <= 15:
                out.add(("phone", *m.span()))
            if 12 <= n <= 19:
                out.add(("card", *m.span()))
    return sorted(out, key=lambda c: (KINDS.index(c[0]), c[1], c[2]))


def implausible(kind: str, s: str) -> bool:
    """Candidates outside the base spans that no spelling of personal data explains: the corpus's negative examples."""
    if kind == "email":
        return "@" in s and "." not in s.split("@")[1].strip(".")
    if kind == "ip":
        return not _valid_ip6(s)
    if kind == "card":
        digits = "".join(c for c in s if "0" <= c <= "9")
        return len(digits) > 19 or not luhn(digits)
    return s.isdigit() or _DATE.fullmatch(s) is not None


def _valid_ip6(s: str) -> bool:
    try:
        return ipaddress.IPv6Address(s) is not None
    except ValueError:
        return False


def labelled(text: str, base: list[tuple[str, int, int]]):
    """Candidates with label 1 (base), 0 (implausible) or -1 (open); other spans that overlap a base span are left out."""
    good, taken = set(base), sorted((a, b) for _, a, b in base)
    starts, reach = [a for a, _ in taken], [0, *itertools.accumulate((b for _, b in taken), max)]
    for c in candidates(text):
        if c in good:
            yield c, 1
        elif reach[bisect.bisect_left(starts, c[2])] <= c[1]:
            yield c, 0 if implausible(c[0], text[c[1]:c[2]]) else -1


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a candidate span."""
    s = text[start:end]
    before, after = text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
    digits = "".join(c for c in s if "0" <= c <= "9")
    parts = [p for p in re.split(r"[^0-9]+", s) if p]
    groups = [len(p) for p in parts]
    words = set(re.findall(r"[a-z-]+", before.lower()))
    last = re.split(r"[^A-Za-z0-9]+", s.rstrip(")]}. "))[-1]
    return [min(v, LARGEST) for v in (
        *[float(kind == k) for k in KINDS], float(len(s)), float(len(digits)), float(sum(c.isalpha() for c in s)),
        float(sum(c in " -./()_" for c in s)), float(s.count(".")), float(s.count("-")), float(s.count("(")),
        float(s[:1] == "+"), float("@" in s), float(len(set(digits))), float(luhn(digits)) if digits else -1.0,
        float(len(groups)), float(max(groups, default=0)), float(min(groups, default=0)),
        float(min(max((int(p[:6]) for p in parts), default=0), 999)),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] in "+.-/#$"),
        float(after[:1] in ".-/%"), float(sum(c.isdigit() for c in before)), float(sum(c.isdigit() for c in after)),
        *[float(any(w in words for w in _CUES[k])) for k in KINDS],
        float(_AT.search(s) is not None), float(len(last) if last.isalpha() else 0), float(_valid_ip6(s)), float(s.count(":")),
        float(sum(bool(p) for p in s.split(":"))), float(_DATE.fullmatch(s) is not None), float(s[:1] == "0"),
        float(groups == [3, 3, 4]), float(groups[0] if groups else 0), float(groups[-1] if groups else 0),
        float(len({c for c in s if not c.isalnum()})))]


_SPAN = "array<struct<kind:string,start:long,end:long>>"
_CANDIDATES = ("doc_id long, base array<struct<kind:string,start:long,end:long>>, "
               "cand array<struct<kind:string,start:long,end:long,label:int,x:array<double>>>")
_SPAN_PA = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_CAND_PA = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                               ("label", pa.int32()), ("x", pa.list_(pa.float64()))]))


def _candidate_batches(batches):
    for batch in batches:
        for part in tb.chunks(batch, "text"):
            base, cand = [], []
            for text in part.column("text").to_pylist():
                found = base_spans(text) if text else []
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
                cand.append([{"kind": k, "start": a, "end": b, "label": label, "x": features(text, k, a, b)}
                             for (k, a, b), label in (labelled(text, found) if text else ())])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(base, _SPAN_PA), pa.array(cand, _CAND_PA)],
                names=["doc_id", "base", "cand"])


def _block(x: np.ndarray, edges: list[np.ndarray], kind: np.ndarray, y: np.ndarray, weight: np.ndarray, held: np.ndarray):
    """A block of training rows: bins, kind, label, weight, whether held from the trees, raw score."""
    return (bo.to_bins(x, edges).astype(np.uint8), kind.astype(np.int64), y.astype(float), weight.astype(float), held, np.zeros(len(y)))


class Model:
    """Boosted trees, their Platt scaling and a threshold per kind."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        """From rows in memory, each of weight one; every fourth is held from the trees."""
        held = np.arange(len(y)) % 4 == 0
        edges = bo.bin_edges(x[~held], BINS)
        self._fit([_block(x, edges, x[:, :len(KINDS)].argmax(axis=1), y, np.ones(len(y)), held)], edges)

    @classmethod
    def of(cls, blocks, edges: list[np.ndarray]) -> Model:
        """From a list or an RDD of blocks (``_block``), binned by ``edges``."""
        model = cls.__new__(cls)
        model._fit(blocks, edges)
        return model

    def _fit(self, blocks, edges: list[np.ndarray]) -> None:
        self.trees, self.edges, self.scale = [], edges, (0.0, -35.0)
        self.threshold = dict.fromkeys(KINDS, math.inf)
        if (bo.total(blocks, _part_weights) == 0).any():
            return
        width = max(map(len, edges)) + 1
        recent: list = []                                      # trees that the blocks' raw scores lack
        for _ in range(TREES):
            tree = bo.grow_from(lambda tree, nodes: bo.total(blocks, _gradient_sums(tuple(recent), tree, nodes, width)), LEAVES)  # noqa: B023
            self.trees.append(tree)
            recent.append(tree)
            if isinstance(blocks, list) or len(recent) == RENEW or len(self.trees) == TREES:
                blocks, recent = bo.renewed(blocks, _with_scores(tuple(recent))), []
        slope, shift = 1.0, 0.0                                # Platt scaling by Newton steps, slightly ridged
        for _ in range(25):
            s = bo.total(blocks, _platt_sums(slope, shift))
            g = np.array([s[0] - 1e-2 * (slope - 1), s[1]])
            h = np.array([[s[2] + 1e-2, s[3]], [s[3], s[4] + 1e-2]])
            step = np.linalg.solve(h, g)
            slope, shift = slope + float(step[0]), shift + float(step[1])
        self.scale = (slope, shift)
        at_least = bo.total(blocks, _grid_sums(slope, shift))[:, ::-1].cumsum(axis=1)[:, ::-1]
        for kind, (true, every) in zip(KINDS, at_least.transpose(0, 2, 1), strict=True):
            good = np.flatnonzero((every > 0) & (true >= PRECISION * every))
            if len(good):
                self.threshold[kind] = max(float(GRID[good[0]]), LEAST_PROBABILITY)
        if not isinstance(blocks, list):
            blocks.unpersist()

    def _raw(self, x: np.ndarray) -> np.ndarray:
        b = bo.to_bins(x, self.edges)
        return sum((RATE * bo.evaluate(t, b) for t in self.trees), np.zeros(len(x)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not self.trees or not len(x):
            return np.zeros(len(x))
        return bo.sigmoid(self.scale[0] * self._raw(x) + self.scale[1])


def _part_weights(block) -> np.ndarray:
    """Weights of labels 0 and 1 among the rows that the trees see and those held from them."""
    _, _, y, w, held, _ = block
    return np.bincount(2 * held + (y == 1), w, 4)


def _with_scores(trees):
    def run(block):
        bins, kind, y, w, held, raw = block
        return bins, kind, y, w, held, sum((RATE * bo.evaluate(t, bins) for t in trees), raw)
    return run


def _gradient_sums(trees, tree, nodes, width: int):
    more = _with_scores(trees)

    def run(block):
        bins, _, y, w, held, raw = more(block)
        p, w = bo.sigmoid(raw), w * ~held
        return bo.node_sums(bins, bo.leaf_of(tree, bins), w * (y - p), w * p * (1 - p), nodes, width)
    return run


def _platt_sums(slope: float, shift: float):
    def run(block):
        _, _, y, w, held, raw = (v[block[4]] for v in block)
        p = bo.sigmoid(slope * raw + shift)
        v = w * (p * (1 - p) + 1e-9)
        return np.array([(w * (y - p) * raw).sum(), (w * (y - p)).sum(), (v * raw * raw).sum(), (v * raw).sum(), v.sum()])
    return run


def _grid_sums(slope: float, shift: float):
    """By kind and step of GRID: weight of the held rows of label 1, and of all."""
    def run(block):
        _, kind, y, w, _, raw = (v[block[4]] for v in block)
        step = np.searchsorted(GRID, bo.sigmoid(slope * raw + shift), side="right") - 1
        at = kind * len(GRID) + step
        sums = [np.bincount(at, v, len(KINDS) * len(GRID)).reshape(len(KINDS), len(GRID)) for v in (w * y, w)]
        return np.stack(sums, axis=2)
    return run


def merge(base: list[tuple], extra: list[tuple]) -> list[tuple]:
    """Base spans (kind, start, end) plus the extra (kind, start, end, score) that overlap no better extra one.

    Better scores choose first, then longer spans, then earlier ones, then kinds as listed.  Extra
    spans overlap no base span (``labelled``).
    """
    chosen: list[tuple[int, int, str]] = []
    for k, a, b, _ in sorted(extra, key=lambda e: (-e[3], e[1] - e[2], e[1], KINDS.index(e[0]))):
        at = bisect.bisect_left(chosen, (a, b, k))
        if (at == 0 or chosen[at - 1][1] <= a) and (at == len(chosen) or b <= chosen[at][0]):
            chosen.insert(at, (a, b, k))
    return sorted([*base, *((k, a, b) for a, b, k in chosen)], key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _select(model):
    def run(batches):
        for batch in batches:
            spans = []
            for base, cand in zip(batch.column("base").to_pylist(), batch.column("cand").to_pylist(), strict=True):
                fixed = [(s["kind"], s["start"], s["end"]) for s in base]
                new = [c for c in cand if c["label"] < 0]
                p = model.value.probability(np.array([c["x"] for c in new])) if new else ()
                extra = [(c["kind"], c["start"], c["end"], float(q)) for c, q in zip(new, p, strict=True)
                         if q >= model.value.threshold[c["kind"]]]
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in merge(fixed, extra)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("base"), pa.array(spans, _SPAN_PA)],
                                             names=["doc_id", "base", "spans"])
    return run


_BINNED = "kind int, label int, held boolean, bins binary"


def _binned_batches(edges):
    def run(batches):
        for batch in batches:
            x = np.asarray(batch.column("x").flatten()).reshape(batch.num_rows, len(edges))
            bins = np.ascontiguousarray(bo.to_bins(x, edges).astype(np.uint8))
            yield pa.RecordBatch.from_arrays(
                [batch.column("kind"), batch.column("label"), batch.column("held"),
                 pa.array(bins.view(f"V{len(edges)}").ravel().tolist(), pa.binary())], names=["kind", "label", "held", "bins"])
    return run


def _counted_block(rows: pa.Table, weight: dict[tuple[int, int], float], columns: int):
    """The block of distinct binned rows and their counts."""
    kind, label = np.asarray(rows["kind"]).astype(np.int64), np.asarray(rows["label"]).astype(np.int64)
    bins = np.frombuffer(b"".join(rows["bins"].to_pylist()), np.uint8).reshape(len(kind), columns)
    each = np.array([[weight.get((k, v), 0.0) for v in (0, 1)] for k in range(len(KINDS))])[kind, label]
    return (bins, kind, label.astype(float), each * np.asarray(rows["count"]), np.asarray(rows["held"]).astype(bool),
            np.zeros(len(kind)))


def _packed(weight, columns):
    def run(batches):
        held = list(batches)
        if held:
            block = pickle.dumps(_counted_block(pa.Table.from_batches(held), weight, columns))
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], names=["block"])
    return run


def training_rows(cand: DataFrame):
    """(blocks, bin edges): all labelled candidates as counted distinct rows, and the spellings by rule.

    The blocks are a list if the distinct rows are LOCAL_ROWS at most, else an RDD.  A quarter of the candidates,
    by a hash, is held from the trees.
    """
    kind = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    cand = cand.select(kind.alias("kind"), "label", (F.pmod(F.xxhash64("doc_id", "kind", "start", "end"), F.lit(4)) == 0).alias("held"), "x")
    values = (cand.select("kind", "label", F.posexplode("x").alias("column", "value"))
              .groupBy("kind", "label", "column", "value").count().toPandas())
    first = values[values["column"] == 0].groupby(["kind", "label"])["count"].sum()
    weight = {(int(k), int(v)): min(1.0, STRATUM / n) for (k, v), n in first.items()}
    values["weight"] = [n * weight[k, v] for k, v, n in zip(values["kind"], values["label"], values["count"], strict=True)]
    made = list(examples(EXAMPLES))
    x = np.array([features(text, k, a, b) for text, k, a, b, _ in made])
    edges = []
    for f in range(x.shape[1]):
        own = values[values["column"] == f].sort_values(["value", "kind", "label"])
        edges.append(bo.weighted_edges(np.append(own["value"].to_numpy(float), x[:, f]),
                                       np.append(own["weight"].to_numpy(float), np.ones(len(x))), BINS))
    block = _block(x, edges, np.array([KINDS.index(k) for _, k, _, _, _ in made]), np.array([m[4] for m in made]), np.ones(len(made)),
                   np.arange(len(made)) // (2 * len(KINDS)) % 4 == 0)
    rows = cut_lineage(cand.mapInArrow(_binned_batches(edges), _BINNED).groupBy("kind", "label", "held", "bins").count(), "binned")
    n = rows.count()
    if n <= LOCAL_ROWS:
        return [_counted_block(rows.toArrow().sort_by([(c, "ascending") for c in ("bins", "kind", "label", "held")]), weight,
                               len(edges)), block], edges
    spark = cand.sparkSession
    blocks = rows.repartition(-(-n // BLOCK_ROWS)).mapInArrow(_packed(weight, len(edges)), "block binary")
    blocks = blocks.rdd.map(lambda r: pickle.loads(r.block)).union(spark.sparkContext.parallelize([block], 1))
    return blocks.persist(StorageLevel.MEMORY_AND_DISK), edges


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, base and spans, arrays of (kind, start, end) in code points.

    ``base`` holds what the fixed patterns and checks accept, ``spans`` also what the model adds; both
    are ordered by kind as listed, then start.  Null and empty texts have none.  A corpus that holds
    few or no candidates of a kind has its spellings by rule to learn from.  Repeated rows are treated
    each; extra columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = cut_lineage(docs.mapInArrow(_candidate_batches, _CANDIDATES), "pii")
    c = found.select("doc_id", F.explode("cand").alias("c"))
    blocks, edges = training_rows(c.select("doc_id", "c.kind", "c.start", "c.end", "c.label", "c.x").where("label >= 0"))
    model = spark.sparkContext.broadcast(Model.of(blocks, edges))
    return found.mapInArrow(_select(model), f"doc_id long, base {_SPAN}, spans {_SPAN}")


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each span replaced by its kind in angle brackets; overlapping spans become one."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def _joined(spans: str):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query("op3_pii")
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text of ``documents``: base counts and digest, and all spans."""
    found = find_personal_data(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(_joined("base"), 256).alias("base_sha256"),
                        _joined("spans").alias("spans"))
