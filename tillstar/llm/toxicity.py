"""Toxicity: nearest labelled examples by label-weighted TF-IDF cosine, block-max inverted index.

Terms are words and their first 4 to 6 bytes. The examples are a bounded sample of labelled
rows (about ROWS_PER_LABEL of each label, taken by a hash of the id). Every term of them
counts, however rare: a term's weight is its TF-IDF times how far the toxic share of the
examples that hold it is from that of all, drawn in as if PRIOR_ROWS more held it at the
common share. Terms of no example, or with exactly the common share, so weigh nothing, and
norms are over the whole text. Document frequencies cover all documents.

The examples are indexed by term. Terms of few examples are added up exactly. For those of
more than LONG_LIST examples there is each term's greatest weight in every block of BLOCK
examples that share their main term, which bounds what they can add; what terms of more than
one in MIDDLE examples add is bounded by the products of the two texts' norms over classes of
terms of like greatest weights and numbers of examples. An example whose bound is below the k-th best similarity so far cannot be nearer and is left
out; to the others what these lists add is computed from a table of their weights by example.
The cosines of the nearest are then computed over all their terms, so the k nearest are
exact. Their votes, weighted by distance, are turned
into a probability by a logistic curve fitted to a quarter of the sample that is not
indexed, with each row weighted by how many rows it was drawn for. The neighbours are the
evidence.

Defined cases: a text without a term that weighs (null and empty ones, too) has no
neighbours and gets the share of toxic rows among such texts; without labelled rows of
both kinds every score is the share of toxic rows, 0 if there are none; rows are scored
one by one, whatever their ids, and repeated labels are examples each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.arrays import CODES, LOWER, Words, map_arrow, map_slices, mix, powers, slices, strings, utf8

ROWS_PER_LABEL = 3000
PRIOR_ROWS = 4
PREFIXES = (4, 5, 6)
BLOCK = 64
LONG_LIST = 512
MIDDLE = 12
NEIGHBOURS = 15
# Examples of the greatest bounds whose cosines are computed first, as a multiple of the neighbours.
FIRST = 4
# Sums of the same products in another order differ by less; ties are rounded wider.
_SLACK = 1e-11

# A word is a run of letters a-z, digits and characters beyond ASCII.
IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True
IS_WORD = IS_WORD[LOWER]


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every term occurrence: words and their prefixes."""
    words = Words(column, IS_WORD)
    texts, hashes = [words.text_of()], [words.hash]
    data, _ = utf8(column)
    for long, prefix in prefixes(data, words.start, words.end):
        texts.append(texts[0][long])
        hashes.append(prefix)
    return np.concatenate(texts), np.concatenate(hashes)


def prefixes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size of prefix, which words are longer, and the hashes of their prefixes."""
    power = powers(max(PREFIXES))
    for size in PREFIXES:
        long = np.flatnonzero(end - start > size)
        h = np.full(len(long), size, np.uint64)
        for k in range(size):
            h += CODES[LOWER[data[start[long] + k]]] * power[k]
        yield long, mix(h ^ np.uint64(0x5555555555555555))


def known_terms(column: pa.Array, vocabulary: np.ndarray) -> np.ndarray:
    """text * len(vocabulary) + term of every occurrence of a term of the vocabulary. Each
    distinct word is looked up once."""
    words = Words(column, IS_WORD)
    coded = pa.array(words.hash).dictionary_encode()
    number, distinct = coded.indices.to_numpy(), coded.dictionary.to_numpy()
    some = np.zeros(len(distinct), np.int64)
    some[number] = np.arange(len(number))
    data, _ = utf8(column)
    everyone = np.arange(len(distinct))
    text = words.text_of() * len(vocabulary)
    found = []
    for at, term in ((everyone, distinct), *prefixes(data, words.start[some], words.end[some])):
        place = np.searchsorted(vocabulary, term)
        place[place == len(vocabulary)] = 0
        of_word = np.full(len(distinct), -1)
        of_word[at] = np.where(vocabulary[place] == term, place, -1)
        of_word = of_word[number]
        known = of_word >= 0
        found.append(text[known] + of_word[known])
    return np.concatenate(found)


def counted(column: pa.Array, vocabulary: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, times): terms of each text, of the vocabulary by number if given."""
    if vocabulary is not None:
        if not len(vocabulary):
            none = np.zeros(0, np.int64)
            return none, none, none
        both, times = np.unique(known_terms(column, vocabulary), return_counts=True)
        return both // len(vocabulary), both % len(vocabulary), times
    text, term = terms(column)
    order = np.lexsort((term, text))
    text, term = text[order], term[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (term[1:] != term[:-1])
    first = np.flatnonzero(new)
    return text[first], term[first], np.diff(np.append(first, len(text)))


def draw_sample(labels: DataFrame, id: str, label: str, rows_per_label: int) -> tuple[DataFrame, dict[int, float]]:
    """About `rows_per_label` labelled rows of each label, and the share drawn of each."""
    kinds = labels.where(F.col(label).isin(0, 1)).select(id, F.col(label).cast("int").alias("_label"))
    shares = {kind: min(1.0, rows_per_label / n) for kind, n in kinds.groupBy("_label").count().collect()}
    grain = 1 << 30
    draw = F.pmod(F.xxhash64(F.col(id), F.lit(5)), F.lit(grain))
    keep: Column = F.lit(False)
    for kind, share in shares.items():
        keep = keep | ((F.col("_label") == kind) & (draw < int(grain * share)))
    # A quarter calibrates; the others are examples.
    tested = F.pmod(F.xxhash64(F.col(id), F.lit(11)), F.lit(4)) == 0
    return kinds.where(keep).withColumn("_tested", tested), shares


def weigh_terms(examples: DataFrame, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of all terms of the examples that weigh, and how far their toxic
    shares are from the common one."""

    def run(batch: pa.RecordBatch) -> dict:
        row, term, _ = counted(strings(batch, text))
        toxic = batch.column(1).to_numpy(zero_copy_only=False)[row]
        found, place = np.unique(term, return_inverse=True)
        return {
            "term": found.view(np.int64),
            "n": np.bincount(place, minlength=len(found)),
            "toxic": np.bincount(place, weights=toxic, minlength=len(found)).astype(np.int64),
        }

    # Copies of one text tell no more than the text.
    chosen = examples.where("not _tested").select(text, "_label").dropDuplicates()
    totals = chosen.agg(F.count(F.lit(1)).alias("n"), F.sum("_label").alias("toxic")).first()
    if not totals.n or not 0 < totals.toxic < totals.n:
        return np.zeros(0, np.uint64), np.zeros(0)
    sums = map_slices(chosen, run, "term long, n long, toxic long", text).groupBy("term").agg(
        F.sum("n").alias("n"), F.sum("toxic").alias("toxic")
    )
    found = sums.toArrow()
    term, n, toxic = (found.column(i).to_numpy() for i in range(3))
    # Whole numbers, so that a term at the common share weighs exactly nothing.
    apart = np.abs(toxic * totals.n - n * totals.toxic)
    term, n, apart = (x[apart > 0] for x in (term, n, apart))
    order = np.argsort(term.view(np.uint64))
    return term.view(np.uint64)[order], (apart / totals.n / (n + PRIOR_ROWS))[order]


def document_frequencies(docs: DataFrame, text: str, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    size = len(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(size + 1, np.int64)
        for batch in batches:
            for part in slices(batch, text):
                _, term, _ = counted(strings(part, text), vocabulary)
                found[:size] += np.bincount(term, minlength=size)
                found[size] += part.num_rows
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"term": pa.array(at, pa.int32()), "n": found[at]})

    sums = map_arrow(docs.select(text), run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    totals = np.zeros(size + 1, np.int64)
    found = sums.toArrow()
    totals[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return totals[:size], int(totals[size])


class Vectors(NamedTuple):
    """Unit vectors of texts: the terms and weights of text i are at offsets[i]:offsets[i + 1]."""

    offsets: np.ndarray
    term: np.ndarray
    weight: np.ndarray


def vectors(column: pa.Array, vocabulary: np.ndarray, scale: np.ndarray) -> Vectors:
    """scale: what each term's frequency in a text is multiplied by."""
    row, term, times = counted(column, vocabulary)
    weight = (1 + np.log(np.maximum(times, 1))) * scale[term]
    norm = np.sqrt(np.bincount(row, weights=weight * weight, minlength=len(column)))
    return Vectors(np.searchsorted(row, np.arange(len(column) + 1)), term, weight / norm[row])


def _ranges(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions of several ranges, and how many each has."""
    count = end - begin
    at = np.repeat(begin - (np.cumsum(count) - count), count)
    at += np.arange(len(at))
    return at, count


class BlockMaxIndex:
    """Examples by term: short lists with their weights, long ones with the greatest weight
    in each block of examples, the weights of the longer ones by example; and terms by
    example."""

    def __init__(
        self, size: int, examples: list[tuple[int, int, np.ndarray, np.ndarray]], long_list: int = LONG_LIST
    ):
        def main(e):
            return (int(e[2][np.argmax(e[3])]), e[0])

        examples = sorted((e for e in examples if len(e[2])), key=main)
        # Of one query at a time; all 0 between queries.
        self.query = np.zeros(size)
        self.ids = np.array([e[0] for e in examples], np.int64)
        self.labels = np.array([e[1] for e in examples], np.int64)
        terms = np.concatenate([e[2] for e in examples] or [np.zeros(0)]).astype(np.int32)
        weights = np.concatenate([e[3] for e in examples] or [np.zeros(0)])
        example = np.repeat(np.arange(len(examples), dtype=np.int32), [len(e[2]) for e in examples])
        count = np.bincount(terms, minlength=size)
        self.is_long = count > long_list
        # Of those that are not added up: place in the table, else -1.
        in_table = self.is_long | (count > len(examples) // MIDDLE)
        self.place = np.where(in_table, np.cumsum(in_table) - 1, -1)
        place = self.place[terms]
        order = np.flatnonzero(place < 0)
        order = order[np.argsort(terms[order], kind="stable")]
        self.list_example, self.list_weight = example[order], weights[order]
        self.lists = np.searchsorted(terms[order], np.arange(size + 1))
        # Terms and weights of the table by example, and there in single precision as a matrix.
        order = np.flatnonzero(place >= 0)
        self.term, self.weight = terms[order], weights[order]
        self.ends = np.searchsorted(example[order], np.arange(len(examples) + 1))
        self.table = np.zeros((len(examples), int(in_table.sum())), np.float32)
        self.table[example[order], place[order]] = self.weight
        # Classes of the table's terms, those of middle lists first, and the examples' norms over
        # each, in single precision.
        greatest = np.zeros(self.table.shape[1])
        np.maximum.at(greatest, place[order], self.weight)
        of_weight = np.log2(greatest.max(initial=0) / greatest).astype(int).clip(0, 7)
        of_count = (2 * np.log2(count[in_table] / count[in_table].min(initial=size + len(examples)))).astype(int).clip(0, 7)
        kinds, self.kind = np.unique(of_weight * 8 + of_count + 64 * self.is_long[in_table], return_inverse=True)
        self.middle = int(np.searchsorted(kinds, 64))
        self.norms = np.sqrt(
            np.bincount(
                self.kind[place[order]] * len(examples) + example[order],
                weights=self.weight * self.weight,
                minlength=len(kinds) * len(examples),
            )
        ).reshape(len(kinds), len(examples)).astype(np.float32)
        # One cell for each long list in each block.
        order = np.flatnonzero(self.is_long[terms])
        order = order[np.argsort(terms[order], kind="stable")]
        term, block = terms[order], example[order] // BLOCK
        new = np.ones(len(order), bool)
        new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        first = np.flatnonzero(new)
        self.cell_block = block[first]
        self.greatest = np.maximum.reduceat(weights[order], first) if len(first) else np.zeros(0)
        self.cells = np.searchsorted(term[first], np.arange(size + 1))

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of greatest cosine, ties by number, and their cosines; only
        examples that share a term."""
        total = len(self.ids)
        if not total or not len(term):
            return np.zeros(0, np.int64), np.zeros(0)
        place = self.place.take(term)
        short, rest = np.flatnonzero(place < 0), np.flatnonzero(place >= 0)
        place, longer, longer_weight = place[rest], term[rest], weight[rest]
        is_long = self.is_long[longer]
        at, count = _ranges(self.lists[term[short]], self.lists[term[short] + 1])
        product = self.list_weight.take(at)
        product *= np.repeat(weight[short], count)
        added = np.bincount(self.list_example.take(at), weights=product, minlength=total)
        long = longer[is_long]
        at, count = _ranges(self.cells[long], self.cells[long + 1])
        blocks = np.bincount(
            self.cell_block[at],
            weights=self.greatest[at] * np.repeat(longer_weight[is_long], count),
            minlength=-(-total // BLOCK),
        )
        of_table = np.zeros(self.table.shape[1], np.float32)
        of_table[place] = longer_weight
        norms = np.sqrt(np.bincount(self.kind[place], weights=longer_weight * longer_weight, minlength=len(self.norms)))
        single, middle = norms.astype(np.float32), self.middle
        bound = added + single[:middle] @ self.norms[:middle]
        bound += np.minimum(np.repeat(blocks, BLOCK)[:total], single[middle:] @ self.norms[middle:])
        # Sums from the table and bounds are in single precision: off by less than this.
        slack = _SLACK + 4 * (len(of_table) + 4) * 2.0**-24 * np.sqrt((norms * norms).sum())
        first = FIRST * k
        some = np.argpartition(-bound, first - 1)[:first] if total > first else np.arange(total)
        cosine = added[some] + self.table[some] @ of_table
        least = np.partition(cosine, -k)[-k] if len(cosine) >= k else 0.0
        may = (bound > 0) & (bound >= least - slack)
        may[some] = False
        rest = np.flatnonzero(may)
        example = np.concatenate([some, rest])
        of_rest = self.table[rest] @ of_table if len(rest) < total // 4 else (self.table @ of_table)[rest]
        cosine = np.concatenate([cosine, added[rest] + of_rest])
        if len(example) > k:
            near = cosine >= np.partition(cosine, -k)[-k] - slack
            example = example[near]
        query = self.query
        query[longer] = longer_weight
        cosine = added[example] + self._cosines(query, example)
        query[longer] = 0
        example, cosine = example[cosine > 0], cosine[cosine > 0]
        best = np.lexsort((example, -np.round(cosine, 12)))[:k]
        return example[best], cosine[best]

    def _cosines(self, query: np.ndarray, examples: np.ndarray) -> np.ndarray:
        """What the terms of the table add to the cosines."""
        begin, end = self.ends[examples], self.ends[examples + 1]
        parts = [slice(a, b) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
        if not parts:
            return np.zeros(0)
        product = np.concatenate([self.weight[part] for part in parts])
        product *= query.take(np.concatenate([self.term[part] for part in parts]))
        return np.bincount(np.repeat(np.arange(len(parts)), end - begin), weights=product, minlength=len(parts))


def vote(cosine: np.ndarray, label: np.ndarray) -> float:
    """Share of toxic neighbours, weighted by closeness. One more that is not toxic stands
    in the sum, so that far neighbours alone prove little."""
    weight = cosine * cosine
    return float((weight * label).sum() / (weight.sum() + 1))


class Model(NamedTuple):
    vocabulary: np.ndarray
    scale: np.ndarray
    index: BlockMaxIndex
    curve: tuple[float, float]
    without: float  # score of a text without neighbours

    def score(self, value: float | None) -> float:
        if value is None:
            return self.without
        a, b = self.curve
        return float(1 / (1 + np.exp(-(a * value + b))))


def fit_curve(value: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic curve by Newton's method. Targets are drawn in from 0 and 1 by the number of
    rows of their label, so that a clean separation does not give certainty."""
    n1, n0 = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([value - 0.5, np.ones(len(value))], axis=1)
    beta = np.array([4.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (p - target)) + 1e-3 * beta
        curve = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(curve, slope)
        beta = beta - np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1] - 0.5 * beta[0])


def learn(
    docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, rows_per_label: int
) -> Model:
    sample, shares = draw_sample(labels, id, label, rows_per_label)
    # The sample is bounded by 2 * rows_per_label expected rows.
    examples = docs.select(id, text).join(F.broadcast(sample), id)
    vocabulary, apart = weigh_terms(examples, text)
    frequency, total = document_frequencies(docs, text, vocabulary)
    scale = (np.log((1 + total) / (1 + frequency)) + 1) * apart

    def run(batch: pa.RecordBatch) -> dict:
        found = vectors(strings(batch, text), vocabulary, scale)
        return {
            "id": batch.column(0),
            "label": batch.column(2),
            "tested": batch.column(3),
            "term": pa.ListArray.from_arrays(pa.array(found.offsets, pa.int32()), pa.array(found.term, pa.int32())),
            "weight": pa.ListArray.from_arrays(pa.array(found.offsets, pa.int32()), pa.array(found.weight, pa.float64())),
        }

    chosen = examples.select(F.col(id).cast("long").alias("id"), text, "_label", "_tested")
    found = map_slices(
        chosen, run, "id long, label int, tested boolean, term array<int>, weight array<double>", text
    ).toArrow()
    rows = sorted(
        (
            (i, y, tested, t.values.to_numpy(), w.values.to_numpy())
            for i, y, tested, t, w in zip(
                *(found.column(c).to_pylist() for c in ("id", "label", "tested")), found["term"], found["weight"], strict=True
            )
        ),
        key=lambda r: (r[0], r[1]),
    )
    index = BlockMaxIndex(len(vocabulary), [(i, y, t, w) for i, y, tested, t, w in rows if not tested])
    value, truth, weight = [], [], []
    bare = {0: 0.0, 1: 0.0}
    for _, y, tested, t, w in rows:
        if not tested and len(t):
            continue
        at, cosine = index.nearest(t, w, NEIGHBOURS)
        if len(at):
            value.append(vote(cosine, index.labels[at]))
            truth.append(y)
            weight.append(1 / shares[y])
        else:
            bare[y] += 1 / shares[y]
    total_bare = bare[0] + bare[1]
    without = (bare[1] / (total_bare + 1)) if total_bare else 0.0
    curve = (0.0, -30.0)
    if value:
        scaled = np.array(weight) / np.mean(weight)
        curve = fit_curve(np.array(value), np.array(truth), scaled)
    return Model(vocabulary, scale, index, curve, without)


def score(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows_per_label: int = ROWS_PER_LABEL,
    k: int = NEIGHBOURS,
) -> DataFrame:
    """(id, score, neighbours): probability of `label` = 1 and the nearest examples.

    labels: rows with id and `label` (0 or 1) that may be learned from.
    """
    model = learn(docs, labels, id, text, label, rows_per_label)

    def run(batch: pa.RecordBatch) -> dict:
        found = vectors(strings(batch, text), model.vocabulary, model.scale)
        scores, ids, near, toxic, ends = [], [], [], [], [0]
        for a, b in zip(found.offsets[:-1], found.offsets[1:], strict=True):
            at, cosine = model.index.nearest(found.term[a:b], found.weight[a:b], k)
            scores.append(model.score(vote(cosine, model.index.labels[at]) if len(at) else None))
            ids.append(model.index.ids[at])
            near.append(cosine)
            toxic.append(model.index.labels[at])
            ends.append(ends[-1] + len(at))
        evidence = pa.StructArray.from_arrays(
            [
                pa.array(np.concatenate(ids), pa.int64()),
                pa.array(np.concatenate(near), pa.float64()),
                pa.array(np.concatenate(toxic), pa.int32()),
            ],
            ["id", "cosine", "label"],
        )
        return {
            id: batch.column(0),
            "score": pa.array(scores, pa.float64()),
            "neighbours": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), evidence),
        }

    kind = docs.schema[id].dataType.simpleString()
    schema = f"`{id}` {kind}, score double, neighbours array<struct<id: bigint, cosine: double, label: int>>"
    return map_slices(docs.select(id, text), run, schema, text)
