"""Secret scans: fixed rules, and Markov models of random and ordinary strings.

The rules find assignments to names such as `password`, access keys and long hex runs.
What they find is the labelled sample of secrets; all other identifiers of the corpus are
the sample of ordinary strings. Both samples give a first-order character model, counted
over all documents: P(next character | character). A run of 16 or more key characters with
letters and digits, cut where the rules found something, is a secret, too, if the models'
log-likelihood ratio exceeds MARGIN; of a run whose ordinary parts outweigh, the stretch of
greatest ratio is judged in the same way.

Only the two tables of pair counts (67 x 67 each) come to the driver.

Defined cases: a null or empty text has no spans; rows are judged one by one, whatever
their ids; a corpus without secrets leaves the random model uniform; an empty table gives
an empty result; other columns are ignored, or kept as they are by `redact`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.arrays import map_arrow, map_slices, slices, strings

# Kinds in their order, and the rules of the first three.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    rb"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]{12,}")
HEX = re.compile(rb"[0-9a-f]{32,}")
MIN_VALUE = 8

# Characters of keys and identifiers; their number in a model, 0 for any other byte.
ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"[:67]
NUMBER = np.zeros(256, np.int64)
NUMBER[np.frombuffer(ALPHABET, np.uint8)] = np.arange(1, len(ALPHABET) + 1)
SIZE = len(ALPHABET) + 1
IS_DIGIT, IS_LETTER = np.zeros(256, bool), np.zeros(256, bool)
IS_DIGIT[0x30:0x3A] = True
IS_LETTER[0x41:0x5B] = IS_LETTER[0x61:0x7B] = True

# Shortest identifier that is learned from, shortest run that is judged.
MIN_IDENTIFIER = 6
MIN_RUN = 16
# Text bytes scanned at once; a byte takes about 40 bytes on the way.
SLICE_BYTES = 1 << 20
# Log-likelihood ratio from which a run is a secret.
MARGIN = 20.0

SPANS = "array<struct<kind: string, start: int, end: int>>"


class Span(NamedTuple):
    start: int
    kind: int
    end: int


class Buffer:
    """The texts of a slice in one byte string, a zero byte after each."""

    def __init__(self, column: pa.Array):
        texts = [x.encode() for x in column.to_pylist()]
        self.data = b"\0".join(texts) + b"\0"
        self.bytes = np.frombuffer(self.data, np.uint8)
        self.first = np.cumsum([0, *[len(x) + 1 for x in texts]])
        self.rules = list(self._rules())

    def _rules(self) -> Iterator[tuple[Span, tuple[int, int]]]:
        """Spans of the fixed rules, in bytes, with the place of the secret value."""
        for match in ASSIGN.finditer(self.data):
            if match.end(2) - match.start(2) >= MIN_VALUE:
                yield Span(match.start(), 0, match.end()), match.span(2)
        for kind, rule in ((1, ACCESS), (2, HEX)):
            for match in rule.finditer(self.data):
                yield Span(match.start(), kind, match.end()), match.span()

    def runs(self, least: int, blocked: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of runs of ALPHABET, without blocked places."""
        inside = NUMBER[self.bytes] > 0
        if blocked:
            covered = np.zeros(len(self.bytes) + 1, np.int32)
            np.add.at(covered, [a for a, _ in blocked], 1)
            np.add.at(covered, [b for _, b in blocked], -1)
            inside &= np.cumsum(covered[:-1]) == 0
        edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0))
        start, end = edges[::2], edges[1::2]
        keep = end - start >= least
        start, end = start[keep], end[keep]
        return start, end

    def pairs(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all neighbouring characters inside the runs, as one value each,
        and where each run's values begin."""
        sizes = end - start - 1
        first = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum())) + np.repeat(start - first, sizes)
        return NUMBER[self.bytes[at]] * SIZE + NUMBER[self.bytes[at + 1]], first

    def per_text(self, spans: list[Span]) -> list[list[Span]]:
        """Spans in code points of their texts, by start, then kind."""
        out: list[list[Span]] = [[] for _ in range(len(self.first) - 1)]
        for span in sorted(spans):
            text = int(np.searchsorted(self.first, span.start, "right")) - 1
            begin = int(self.first[text])
            before = len(self.data[begin : span.start].decode())
            length = len(self.data[span.start : span.end].decode())
            out[text].append(Span(before, span.kind, before + length))
        return [sorted(row) for row in out]


def train(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log-likelihood ratios of character pairs, random against ordinary.

    Counts pairs over all documents: label 1 inside values found by the rules, label 0
    inside all other identifiers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, SIZE * SIZE), np.int64)
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                buffer = Buffer(strings(part, text))
                places = [(span.start, span.end) for span, _ in buffer.rules]
                ordinary, _ = buffer.pairs(*buffer.runs(MIN_IDENTIFIER, places))
                counts[0] += np.bincount(ordinary, minlength=SIZE * SIZE)
                values = sorted({value for _, value in buffer.rules})
                if values:
                    random, _ = buffer.pairs(*np.array(values, np.int64).T)
                    counts[1] += np.bincount(random, minlength=SIZE * SIZE)
        label, pair = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {"label": pa.array(label, pa.int32()), "pair": pa.array(pair, pa.int32()), "n": counts[label, pair]}
        )

    counted = map_arrow(docs.select(text), run, "label int, pair int, n long")
    counts = np.zeros((2, SIZE * SIZE))
    for label, pair, n in counted.groupBy("label", "pair").agg(F.sum("n")).collect():
        counts[label, pair] = n
    return log_ratio(counts.reshape(2, SIZE, SIZE))


def log_ratio(counts: np.ndarray) -> np.ndarray:
    """log P(pair | random) - log P(pair | ordinary), flat. The random model is an even
    mixture with the uniform one, as secrets of other alphabets exist."""
    ordinary = (counts[0] + 0.5) / (counts[0] + 0.5).sum(axis=1, keepdims=True)
    seen = counts[1].sum(axis=1, keepdims=True)
    uniform = 1 / len(ALPHABET)
    random = (counts[1] + uniform) / (seen + 1)
    return np.log((random + uniform) / 2 / ordinary).ravel()


def best_stretch(ratio: np.ndarray, margin: float) -> tuple[int, int]:
    """Characters (from, to) between which the sum of pair ratios is greatest, the first
    such; (0, 0) if that is not above `margin`."""
    so_far = np.concatenate(([0.0], np.cumsum(ratio)))
    least = np.minimum.accumulate(so_far)
    to = int(np.argmax(so_far - least))
    if so_far[to] - least[to] <= margin:
        return 0, 0
    return int(np.argmin(so_far[: to + 1])), to + 1


def find(column: pa.Array, model: np.ndarray, margin: float) -> tuple[list[list[Span]], list[list[Span]]]:
    """Per text: spans of the fixed rules, and those that the models add."""
    buffer = Buffer(column)
    rules = [span for span, _ in buffer.rules]
    start, end = buffer.runs(MIN_RUN, [(span.start, span.end) for span in rules])
    added = []
    if len(start):
        pairs, first = buffer.pairs(start, end)
        ratio = model[pairs]
        score = np.add.reduceat(ratio, first)
        at_most = np.add.reduceat(np.maximum(ratio, 0), first)
        for run in np.flatnonzero(at_most > margin).tolist():
            a, b = int(start[run]), int(end[run])
            if score[run] <= margin:
                low, high = best_stretch(ratio[first[run] : first[run] + b - a - 1], margin)
                a, b = a + low, a + high
            part = buffer.bytes[a:b]
            if b - a >= MIN_RUN and IS_DIGIT[part].any() and IS_LETTER[part].any():
                added.append(Span(a, len(KINDS) - 1, b))
    return buffer.per_text(rules), buffer.per_text(added)


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", margin: float = MARGIN) -> DataFrame:
    """(id, spans): secrets of every text in code points, end exclusive."""
    model = train(docs, text)

    def run(batch: pa.RecordBatch) -> dict:
        rules, added = find(strings(batch, text), model, margin)
        rows = [
            [{"kind": KINDS[s.kind], "start": s.start, "end": s.end} for s in sorted(a + b)]
            for a, b in zip(rules, added, strict=True)
        ]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        return {id: batch.column(0), "spans": pa.array(rows, kind)}

    schema = f"`{id}` {docs.schema[id].dataType.simpleString()}, spans {SPANS}"
    return map_slices(docs.select(id, text), run, schema, text, SLICE_BYTES)


def digest(scanned: DataFrame, id: str = "doc_id") -> DataFrame:
    """id, n_assign, n_access, n_hex, base_sha256 (of the fixed rules' spans), spans (all,
    as kind:start:end joined by commas)."""

    def of(*kinds: str):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def joined(spans):
        one = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
        return F.array_join(F.transform(spans, one), ",")

    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS[:3]]
    base = F.sha2(joined(of(*KINDS[:3])), 256).alias("base_sha256")
    return scanned.select(id, *counts, base, joined(F.col("spans")).alias("spans"))


MASK = "[SECRET]"


def redact(docs: DataFrame, text: str = "text", margin: float = MARGIN) -> DataFrame:
    """All rows and columns of `docs` with every secret in `text` replaced by MASK."""
    model = train(docs, text)
    names = [f"_{i}" for i in range(len(docs.columns))]
    place = docs.columns.index(text)
    inner = docs.toDF(*names)

    def run(batch: pa.RecordBatch) -> dict:
        rules, added = find(strings(batch, names[place]), model, margin)
        columns = {name: batch.column(i) for i, name in enumerate(names)}
        if any(rules) or any(added):
            texts = batch.column(place).to_pylist()
            for i, (a, b) in enumerate(zip(rules, added, strict=True)):
                if a or b:
                    texts[i] = masked(texts[i], a + b)
            columns[names[place]] = pa.array(texts, pa.string())
        return columns

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema.fields)
    return map_slices(inner, run, schema, names[place], SLICE_BYTES).toDF(*docs.columns)


def masked(text: str, spans: list[Span]) -> str:
    out, at = [], 0
    for span in sorted(spans):
        if span.start >= at:
            out += [text[at : span.start], MASK]
        at = max(at, span.end)
    return "".join([*out, text[at:]])
