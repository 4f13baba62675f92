"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed runs of 1 to 3 lower-case characters (anything in ASCII but a letter
counts as a space), weighted by relative frequency times inverse document frequency. The
document frequencies cover every row that may be learned from. The classifier is fitted by
follow-the-regularised-leader with L1 and L2 penalties on at most about ROWS_PER_CLASS rows
of each language (a documented bound on the sample: rows are taken by a hash of their id),
and its temperature is calibrated on a fifth of them that the fit has not seen. The whole
text of every row is then scored.

Only counts per language, 2^BITS document frequencies and the sample's features come to
the driver.

Defined cases: a text that is null or has no letter gets `und` with score 0; so does every
row if nothing can be learned; rows without an id are scored but not learned from; rows
are scored one by one, whatever their ids; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.arrays import map_arrow, map_slices, slices, strings

BITS = 15
SIZE = 1 << BITS
ORDERS = (1, 2, 3)
ROWS_PER_CLASS = 1000
UNKNOWN = "und"
# Characters scored at once; a character takes about 40 bytes on the way.
PREDICT_CHARS = 1 << 18
# Parameters of the fit.
ALPHA, BETA, L1, L2, EPOCHS, SCALE = 0.5, 1.0, 0.02, 0.5, 4, 20.0

_LETTER = re.compile(r"[^\W\d_]")
_SPACE_OUT = np.arange(128, dtype=np.uint32)
_SPACE_OUT[[c for c in range(128) if not chr(c).isalpha()]] = 32
_SPACE_OUT[0] = 0
# Odd multipliers of the characters of an n-gram.
_FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def features(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each order the features at all places of the texts, joined by zero characters
    (feature -1 if the n-gram holds one), and the offsets of the texts."""
    joined = "\0".join(texts) + "\0"
    chars = np.frombuffer(joined.lower().encode("utf-32-le", "replace"), np.uint32)
    ends = np.flatnonzero(chars == 0)
    if len(ends) != len(texts):  # zero characters inside texts
        chars = np.frombuffer(
            ("\0".join([t.replace("\0", " ") for t in texts]) + "\0").lower().encode("utf-32-le", "replace"),
            np.uint32,
        )
        ends = np.flatnonzero(chars == 0)
    chars = np.where(chars < 128, _SPACE_OUT[np.minimum(chars, 127)], chars)
    offsets = np.concatenate(([0], ends + 1))
    found, valid = [], chars > 0
    hashed, holds = np.full(len(chars), 1, np.uint32), np.ones(len(chars), bool)
    for order in ORDERS:
        shift = order - 1
        moved = np.zeros_like(chars)
        moved[: len(chars) - shift] = chars[shift:]
        hashed = hashed * np.uint32(_FACTORS[shift]) + moved
        ahead = np.zeros_like(valid)
        ahead[: len(chars) - shift] = valid[shift:]
        holds = holds & ahead
        mixed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        found.append(np.where(holds, (mixed >> np.uint32(32 - BITS)).astype(np.int32), -1))
    return found, offsets


def document_frequencies(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """In how many texts each feature occurs, and the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SIZE + 1, np.int64)
        for batch in batches:
            for part in slices(batch, text):
                texts = strings(part, text).to_pylist()
                for begin in range(0, len(texts), 128):
                    some = texts[begin : begin + 128]
                    found, offsets = features(some)
                    row = np.repeat(np.arange(len(some)), np.diff(offsets)) * SIZE
                    seen = np.zeros(len(some) * SIZE, bool)
                    for order in found:
                        seen[(row + order)[order >= 0]] = True
                    counts[:SIZE] += seen.reshape(-1, SIZE).sum(axis=0)
                    counts[SIZE] += len(some)
        feature = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"feature": pa.array(feature, pa.int32()), "n": counts[feature]})

    counted = map_arrow(docs.select(text), run, "feature int, n long")
    totals = np.zeros(SIZE + 1, np.int64)
    table = counted.groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    totals[table.column("feature").to_numpy()] = table.column("n").to_numpy()
    return totals[:SIZE], int(totals[SIZE])


def sample_rows(learned: DataFrame, id: str, label: str, rows_per_class: int) -> DataFrame:
    """About `rows_per_class` rows of each label, by a hash of the id."""
    counts = learned.groupBy(label).count().collect()
    grain = 1 << 30
    draw = F.pmod(F.xxhash64(F.col(id), F.lit(7)), F.lit(grain))
    keep: Column = F.lit(False)
    for value, n in counts:
        keep = keep | ((F.col(label) == value) & (draw < int(grain * min(1.0, rows_per_class / n))))
    return learned.where(keep)


def sparse_rows(docs: DataFrame, label: str, text: str) -> tuple[list[str], list[tuple[np.ndarray, np.ndarray]]]:
    """Labels and (features, relative frequencies) of the sample."""

    def run(batch: pa.RecordBatch) -> dict:
        found, offsets = features(strings(batch, text).to_pylist())
        rows, shares = [], []
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            values = np.concatenate([order[a:b] for order in found])
            where, n = np.unique(values[values >= 0], return_counts=True)
            rows.append(where.astype(np.int32))
            shares.append((n / max(1, n.sum())).astype(np.float32))
        return {
            "label": batch.column(0),
            "at": pa.array(rows, pa.list_(pa.int32())),
            "share": pa.array(shares, pa.list_(pa.float32())),
        }

    table = map_slices(
        docs.select(F.col(label).alias("label"), F.col(text).alias(text)), run,
        "label string, at array<int>, share array<float>", text,
    ).toArrow()
    labels = table.column("label").to_pylist()
    rows = [
        (np.array(a.values), np.array(s.values))
        for a, s in zip(table.column("at"), table.column("share"), strict=True)
    ]
    order = sorted(range(len(labels)), key=lambda i: (_shuffled(rows[i][0]), labels[i]))
    return [labels[i] for i in order], [rows[i] for i in order]


def _shuffled(where: np.ndarray) -> int:
    """An order of the sample that does not depend on partitions."""
    h = 1
    for value in where[:: max(1, len(where) // 16)].tolist():
        h = (h * 1000003 + value) & 0xFFFFFFFF
    return h


def fit(labels: list[str], rows: list, idf: np.ndarray) -> tuple[list[str], np.ndarray, float]:
    """Languages, weights (features x languages, idf included) and temperature."""
    classes = sorted(set(labels))
    truth = np.array([classes.index(x) for x in labels])
    z, n = np.zeros((SIZE, len(classes))), np.zeros((SIZE, len(classes)))
    held = np.arange(len(rows)) % 5 == 4 if len(rows) >= 50 else np.zeros(len(rows), bool)

    def weights(at):
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for i in np.flatnonzero(~held):
            at, share = rows[i]
            x = (SCALE * share * idf[at])[:, None]
            w = weights(at)
            p = softmax((x * w).sum(axis=0))
            p[truth[i]] -= 1
            g = x * p
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    full = weights(np.arange(SIZE)) * (SCALE * idf)[:, None]
    tested = np.flatnonzero(held) if held.any() else np.arange(len(rows))
    scores = np.array([(rows[i][1][:, None] * full[rows[i][0]]).sum(axis=0) for i in tested])
    return classes, full.astype(np.float32), temperature(scores, truth[tested])


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(scores: np.ndarray, truth: np.ndarray) -> float:
    """Divisor of the scores with the least log loss on rows that the fit has not seen.

    As a few rows without an error don't prove certainty, the true language counts as
    (n + 1) / (n + 2), and the rest falls on the others."""
    n, kinds = scores.shape if len(scores) else (0, 0)
    if n == 0 or kinds < 2:
        return 1.0
    wanted = np.full((n, kinds), 1 / (n + 2) / (kinds - 1))
    wanted[np.arange(n), truth] = (n + 1) / (n + 2)
    tried = np.geomspace(0.05, 20, 121)
    losses = [-(wanted * np.log(softmax(scores / t) + 1e-12)).sum() for t in tried]
    return float(tried[int(np.argmin(losses))])


def learn(
    docs: DataFrame, may_learn: Column, id: str, label: str, text: str, rows_per_class: int
) -> tuple[list[str], np.ndarray, float]:
    learned = docs.where(may_learn & F.col(label).isNotNull() & F.col(text).isNotNull())
    frequency, total = document_frequencies(learned, text)
    idf = np.log((1 + total) / (1 + frequency)) + 0.05
    sample = sample_rows(learned.select(id, label, text), id, label, rows_per_class)
    labels, rows = sparse_rows(sample, label, text)
    return fit(labels, rows, idf)


def identify(
    docs: DataFrame,
    may_learn: Column,
    id: str = "doc_id",
    text: str = "text",
    label: str = "lang",
    rows_per_class: int = ROWS_PER_CLASS,
) -> DataFrame:
    """(id, text, lang_pred, score): the likeliest language of every row and its
    calibrated probability. Learns from rows for which `may_learn` holds and `label` is
    not null.
    """
    classes, weights, heat = learn(docs, may_learn, id, label, text, rows_per_class)

    def run(batch: pa.RecordBatch) -> dict:
        texts = strings(batch, text).to_pylist()
        names, scores = predict(texts, classes, weights, heat)
        return {
            id: batch.column(0),
            text: batch.column(1),
            "lang_pred": pa.array(names, pa.string()),
            "score": pa.array(scores, pa.float64()),
        }

    kind = docs.schema[id].dataType.simpleString()
    schema = f"`{id}` {kind}, `{text}` string, lang_pred string, score double"
    return map_slices(docs.select(id, text), run, schema, text)


def keep_identified(
    docs: DataFrame,
    may_learn: Column,
    id: str = "doc_id",
    text: str = "text",
    label: str = "lang",
    rows_per_class: int = ROWS_PER_CLASS,
) -> DataFrame:
    """The rows of `docs`, all columns, whose language is not `und`."""
    classes, weights, heat = learn(docs, may_learn, id, label, text, rows_per_class)
    names = [f"_{i}" for i in range(len(docs.columns))]
    inner = docs.toDF(*names)
    place = names[docs.columns.index(text)]

    def run(batch: pa.RecordBatch) -> dict:
        found, _ = predict(strings(batch, place).to_pylist(), classes, weights, heat)
        known = [x != UNKNOWN for x in found]
        rows = batch.filter(pa.array(known, pa.bool_()))
        return dict(zip(names, rows.columns, strict=True))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema.fields)
    return map_slices(inner, run, schema, place).toDF(*docs.columns)


def predict(texts: list[str], classes: list[str], weights: np.ndarray, heat: float) -> tuple[list[str], list[float]]:
    """Language and calibrated probability of each text, about PREDICT_CHARS at once."""
    names: list[str] = []
    scores: list[float] = []
    begin, size = 0, 0
    for end, text in enumerate(texts, 1):
        size += len(text)
        if size >= PREDICT_CHARS or end == len(texts):
            some, probable = _predict(texts[begin:end], classes, weights, heat)
            names += some
            scores += probable
            begin, size = end, 0
    return names, scores


def _predict(texts: list[str], classes: list[str], weights: np.ndarray, heat: float) -> tuple[list[str], list[float]]:
    if not classes:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    found, offsets = features(texts)
    padded = np.vstack([weights, np.zeros((1, len(classes)), np.float32)])  # row -1
    sums = np.zeros((len(texts), len(classes)))
    sizes = np.zeros(len(texts))
    for order in found:
        for c in range(len(classes)):
            sums[:, c] += np.add.reduceat(padded[:, c].copy()[order], offsets[:-1], dtype=np.float64)
        sizes += np.add.reduceat(order >= 0, offsets[:-1], dtype=np.int64)
    probabilities = softmax(sums / np.maximum(sizes, 1)[:, None] / heat)
    best = probabilities.argmax(axis=1)
    names, scores = [], []
    for text, k, row in zip(texts, best.tolist(), probabilities, strict=True):
        known = _LETTER.search(text) is not None
        names.append(classes[k] if known else UNKNOWN)
        scores.append(float(row[k]) if known else 0.0)
    return names, scores
