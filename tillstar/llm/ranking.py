"""Ranked lexical search by a dual-tree over items and documents.

1. Items are searched in blocks of about BLOCK_BYTES of text; the terms of a block are what
   the driver and every task hold, a block at a time. One pass reads the documents and writes
   down how often each has each term of the block. From that come the numbers of documents
   and terms, and the weight of every term.
2. A task takes CHUNK documents at a time. Their terms' values hang on a tree: documents that
   share their weightiest term stand together, and a node holds the largest value of each
   term below it. The block's items hang on another tree, whose nodes hold the largest weight
   of each term.
3. A pair of nodes is bounded by the sum of products of their maxima. If that is below the
   weakest k-th score of the items below the one node, no document below the other can
   enter any of their lists: the pair is dropped whole. Else both are taken apart, down to
   single items and leaves; an item scores its most promising leaves first.
4. Each task puts out the best k of every item, and these are ranked over all tasks.

Scores are 64-bit integers and bounds hold exactly, so the result is that of scoring
everything. A term is known by 64 bits of its hash.

Defined cases: a null or empty text has no terms; an item without terms, or whose terms no
document has, has no rows; equal rows of items are one item; items that share an id are
ranked one by one; documents are ranked row by row, those of one id and score in any order,
those without an id last among equal scores; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.arrays import Batches, Words, map_arrow, map_slices, strings
from tillstar.operators.scratch import materialize

K = 20
BLOCK_BYTES = 1 << 20
CHUNK = 4096
# Documents of a leaf, leaves or nodes of a node; items likewise.
DOC_LEAF, DOC_FAN = 16, 8
ITEM_LEAF, ITEM_FAN = 8, 4
# Leaves an item scores before it looks at its k-th score again.
LEAVES = 16

# Terms are runs of digits, letters and all that is not ASCII.
IS_TERM = np.zeros(256, bool)
IS_TERM[0x30:0x3A] = IS_TERM[0x41:0x5B] = IS_TERM[0x61:0x7B] = IS_TERM[0x80:] = True


@dataclass(frozen=True)
class Sparse:
    """Rows of (term, value), sorted by term in a row; `at` holds where rows begin and end."""

    at: np.ndarray
    terms: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.at) - 1

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all entries of some rows, and where each row's begin."""
        sizes = self.at[rows + 1] - self.at[rows]
        begin = np.cumsum(sizes) - sizes
        return np.arange(int(sizes.sum())) + np.repeat(self.at[rows] - begin, sizes), begin

    def products(self, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Sum of value times weight of the term, for some rows, none of them empty."""
        places, begin = self.entries(rows)
        return np.add.reduceat(weights[self.terms[places]] * self.values[places], begin)

    def maxima(self, fan: int) -> Sparse:
        """Of every `fan` rows, the largest value of each term."""
        rows = np.repeat(np.arange(len(self)) // fan, np.diff(self.at))
        order = np.lexsort((self.terms, rows))
        rows, terms = rows[order], self.terms[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (terms[1:] != terms[:-1])
        first = np.flatnonzero(new)
        n = -(-len(self) // fan)
        at = np.searchsorted(rows[first], np.arange(n + 1))
        return Sparse(at, terms[first], np.maximum.reduceat(self.values[order], first))


def tree(leaves: Sparse, leaf: int, fan: int) -> list[Sparse]:
    """Levels of nodes over the rows, the root's last."""
    levels = [leaves.maxima(leaf)]
    while len(levels[-1]) > 1:
        levels.append(levels[-1].maxima(fan))
    return levels


def children(nodes: np.ndarray, fan: int, n: int) -> np.ndarray:
    found = (nodes[:, None] * fan + np.arange(fan)).ravel()
    return found[found < n]


class Items(NamedTuple):
    """A block of items: the terms' hashes, sorted, and how often each item has each term."""

    hashes: np.ndarray
    counts: Sparse

    def weigh(self, weights: np.ndarray) -> tuple[Sparse, np.ndarray]:
        """Rows of term weights times repeats, as they stand in the tree, and whose they are:
        items with the same weightiest term stand together."""
        terms = self.counts.terms
        values = weights[terms] * self.counts.values
        heavy = heaviest(self.counts, weights)
        order = np.argsort(heavy, kind="stable")
        places, begin = self.counts.entries(order)
        return Sparse(np.append(begin, len(places)), terms[places], values[places]), order


def heaviest(rows: Sparse, weights: np.ndarray) -> np.ndarray:
    """The term of most weight in each row, none of them empty."""
    row = np.repeat(np.arange(len(rows)), np.diff(rows.at))
    order = np.lexsort((rows.terms, -weights[rows.terms], row))
    return rows.terms[order][rows.at[:-1]]


def counted(row: np.ndarray, term: np.ndarray, rows: int, terms: int) -> Sparse:
    """How often each row has each term, from their occurrences."""
    key, n = np.unique(row * np.int64(max(terms, 1)) + term, return_counts=True)
    at = np.searchsorted(key, np.arange(rows + 1) * np.int64(max(terms, 1)))
    return Sparse(at, key % max(terms, 1), n.astype(np.int64))


def read_items(texts: list[str | None]) -> tuple[Items, np.ndarray]:
    """The items with terms, and their places in the list."""
    words = Words(pa.array(["" if t is None else t for t in texts], pa.large_string()), IS_TERM)
    hashes, term = np.unique(words.hash, return_inverse=True)
    places, item = np.unique(words.text_of(), return_inverse=True)
    return Items(hashes, counted(item, term, len(places), len(hashes))), places


def occurrences(docs: DataFrame, id: str, text: str, hashes: np.ndarray) -> DataFrame:
    """(id, n, terms, counts) of documents with terms: their number of terms, and how often
    they have each of the given ones."""

    def run(batch: pa.RecordBatch) -> dict:
        words = Words(strings(batch, text), IS_TERM)
        n = np.diff(words.offsets)
        some = np.flatnonzero(n)
        at = np.searchsorted(hashes, words.hash)
        hit = np.flatnonzero(hashes[np.minimum(at, len(hashes) - 1)] == words.hash)
        found = counted(words.text_of()[hit], at[hit], len(n), len(hashes))
        ends = pa.array(found.at[np.append(some, len(n))].astype(np.int32))
        return {
            "id": batch.column(0).take(pa.array(some)),
            "n": pa.array(n[some]),
            "terms": pa.ListArray.from_arrays(ends, pa.array(found.terms.astype(np.int32))),
            "counts": pa.ListArray.from_arrays(ends, pa.array(found.values.astype(np.int32))),
        }

    chosen = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias(text))
    return map_slices(chosen, run, "id long, n long, terms array<int>, counts array<int>", text)


def _rows(batch: pa.RecordBatch) -> Sparse:
    """The lists `terms` and `counts` of a batch."""
    terms, counts = batch.column(2), batch.column(3)
    at = np.concatenate(([0], np.cumsum(terms.value_lengths().to_numpy(zero_copy_only=False))))
    return Sparse(at.astype(np.int64), terms.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy().astype(np.int64))


def statistics(found: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all their terms, and documents that have each of the given ones."""

    def run(batches: Batches) -> Batches:
        docs, total, df = 0, 0, np.zeros(terms, np.int64)
        for batch in batches:
            docs += batch.num_rows
            total += int(batch.column(1).to_numpy().sum())
            df += np.bincount(_rows(batch).terms, minlength=terms)
        some = np.flatnonzero(df)
        names, counts = np.concatenate(([-2, -1], some)), np.concatenate(([docs, total], df[some]))
        yield pa.RecordBatch.from_pydict({"term": pa.array(names), "n": pa.array(counts)})

    sums = map_arrow(found, run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(terms + 2, np.int64)
    # -2 and -1 count from the end.
    df[sums["term"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return int(df[-2]), int(df[-1]), df[:-2]


def term_weights(docs: int, df: np.ndarray) -> np.ndarray:
    of = {n: math.floor(1000 * math.log((2 * docs + 2) / (2 * n + 1))) for n in np.unique(df).tolist()}
    return np.array([of[n] for n in df.tolist()], np.int64)


def impacts(counts: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """Value of a term that occurs `counts` times among a document's n terms."""
    if 25 * docs * int(n.max(initial=0)) < 2**63:
        m = 75 + (25 * n * docs) // total
    else:
        m = np.array([75 + 25 * x * docs // total for x in n.tolist()], np.int64)
    return (1_000_000_000 * counts) // (1000 * counts + 12 * m)


class Best:
    """The best k documents of every item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.scores = [np.zeros(0, np.int64) for _ in range(items)]
        self.ids = [np.zeros(0, np.int64) for _ in range(items)]
        self.bare = [np.zeros(0, bool) for _ in range(items)]
        # A document must have a score of at least this to enter.
        self.least = np.ones(items, np.int64)

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, bare: np.ndarray) -> None:
        good = scores >= self.least[item]
        if not good.any():
            return
        scores = np.concatenate((self.scores[item], scores[good]))
        ids = np.concatenate((self.ids[item], ids[good]))
        bare = np.concatenate((self.bare[item], bare[good]))
        order = np.lexsort((ids, bare, -scores))[: self.k]
        self.scores[item], self.ids[item], self.bare[item] = scores[order], ids[order], bare[order]
        if len(order) == self.k:
            self.least[item] = scores[order[-1]]


class Search:
    """Items as a tree that meets chunks of documents."""

    def __init__(self, items: Items, weights: np.ndarray, k: int):
        self.rows, self.order = items.weigh(weights)
        self.levels = tree(self.rows, ITEM_LEAF, ITEM_FAN)
        self.weights = weights
        self.best = Best(len(self.order), k)
        self.dense = np.zeros(len(weights), np.int64)

    def meet(self, docs: Sparse, ids: np.ndarray, bare: np.ndarray) -> None:
        """Documents by their terms' values; only those with a term of the items."""
        order = np.argsort(heaviest(docs, self.weights), kind="stable")
        places, begin = docs.entries(order)
        self.docs = Sparse(np.append(begin, len(places)), docs.terms[places], docs.values[places])
        self.ids, self.bare = ids[order], bare[order]
        self.nodes = tree(self.docs, DOC_LEAF, DOC_FAN)
        self._pair(len(self.levels) - 1, 0, len(self.nodes) - 1, np.zeros(1, np.int64))

    def _bounds(self, row: int, of: Sparse, rows: np.ndarray, by: Sparse) -> np.ndarray:
        """Of one row of `by` with some rows of `of`."""
        span = slice(by.at[row], by.at[row + 1])
        self.dense[by.terms[span]] = by.values[span]
        found = of.products(rows, self.dense)
        self.dense[by.terms[span]] = 0
        return found

    def _pair(self, level: int, node: int, depth: int, nodes: np.ndarray) -> None:
        """One node of items with some nodes of documents of one level."""
        height = ITEM_LEAF * ITEM_FAN**level
        weakest = self.best.least[self.order[node * height : (node + 1) * height]].min()
        bounds = self._bounds(node, self.nodes[depth], nodes, self.levels[level])
        nodes = nodes[bounds >= weakest]
        if not len(nodes):
            return
        if depth:
            nodes = children(nodes, DOC_FAN, len(self.nodes[depth - 1]))
        if level:
            for child in children(np.array([node]), ITEM_FAN, len(self.levels[level - 1])).tolist():
                self._pair(level - 1, child, max(depth - 1, 0), nodes)
        elif depth:
            self._pair(0, node, depth - 1, nodes)
        else:
            for row in range(node * ITEM_LEAF, min((node + 1) * ITEM_LEAF, len(self.rows))):
                self._score(row, nodes)

    def _score(self, row: int, leaves: np.ndarray) -> None:
        item = int(self.order[row])
        bounds = self._bounds(row, self.nodes[0], leaves, self.rows)
        order = np.argsort(-bounds, kind="stable")
        leaves, bounds = leaves[order], bounds[order]
        for a in range(0, len(leaves), LEAVES):
            if bounds[a] < self.best.least[item]:
                return
            near = leaves[a : a + LEAVES][bounds[a : a + LEAVES] >= self.best.least[item]]
            docs = children(near, DOC_LEAF, len(self.docs))
            scores = self._bounds(row, self.docs, docs, self.rows)
            self.best.add(item, scores, self.ids[docs], self.bare[docs])


def chunks(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Rows with terms of the items, CHUNK at a time at most."""
    for batch in batches:
        kept = batch.filter(pa.array(batch.column(2).value_lengths().to_numpy(zero_copy_only=False) > 0))
        for a in range(0, kept.num_rows, CHUNK):
            yield kept.slice(a, CHUNK)


def best_of_tasks(found: DataFrame, items: Items, docs: int, total: int, weights: np.ndarray, k: int) -> DataFrame:
    """(item, id, score): the best k of every item in each task."""

    def run(batches: Batches) -> Batches:
        search = Search(items, weights, k)
        for batch in chunks(batches):
            rows = _rows(batch)
            n = np.repeat(batch.column(1).to_numpy(), np.diff(rows.at))
            values = impacts(rows.values, n, docs, total)
            ids = batch.column(0)
            bare = ids.is_null().to_numpy(zero_copy_only=False)
            search.meet(replace(rows, values=values), ids.fill_null(0).to_numpy(), bare)
        best = search.best
        sizes = [len(s) for s in best.scores]
        if sum(sizes):
            yield pa.RecordBatch.from_pydict(
                {
                    "item": pa.array(np.repeat(np.arange(len(sizes)), sizes)),
                    "id": pa.array(np.concatenate(best.ids), mask=np.concatenate(best.bare)),
                    "score": pa.array(np.concatenate(best.scores)),
                }
            )

    return map_arrow(found, run, "item long, id long, score long")


def rank(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", k: int = K
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest score above 0 for every item,
    equal scores by ascending doc_id."""
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType.simpleString()
    wanted = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).distinct()
    size = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int")
    dealt = materialize(wanted.withColumn("block", block), "items")

    results = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for number in range(blocks):
        rows = dealt.where(F.col("block") == number).select("item_id", "text").toArrow()
        found, places = read_items(rows.column("text").to_pylist())
        if not len(places):
            continue
        ids = rows.column("item_id").take(pa.array(places)).to_pylist()
        results = results.unionAll(_ranked(docs, found, ids, kind, doc_id, text, k))
    return results


def _ranked(
    docs: DataFrame, items: Items, ids: list, kind: str, doc_id: str, text: str, k: int
) -> DataFrame:
    """The ranks of one block of items, stored."""
    found = materialize(occurrences(docs, doc_id, text, items.hashes), "occurrences")
    n_docs, total, df = statistics(found, len(items.hashes))
    best = best_of_tasks(found, items, n_docs, total, term_weights(n_docs, df), k)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    first = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = docs.sparkSession.createDataFrame(list(enumerate(ids)), f"item long, item_id {kind}")
    # Names of one block of items.
    named = first.join(F.broadcast(names), "item")
    return materialize(named.select("item_id", "rank", F.col("id").alias("doc_id"), "score"), "ranks")


def oracle() -> str:
    """SQL for `rank` over `documents` and `benchmark`, scoring everything."""
    found = (
        "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    )
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {found} AS terms FROM documents WHERE text IS NOT NULL),
    sized AS (SELECT r, doc_id, terms, len(terms) AS n FROM docs WHERE len(terms) > 0),
    total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sized),
    tf AS (SELECT r, doc_id, n, term, count(*) AS tf
           FROM (SELECT r, doc_id, n, unnest(terms) AS term FROM sized) GROUP BY r, doc_id, n, term),
    w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
          FROM tf, total GROUP BY term, docs),
    wanted AS (SELECT item_id, text, term, count(*) AS c
               FROM (SELECT item_id, text, unnest({found}) AS term
                     FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY item_id, text, term),
    scored AS (SELECT item_id, text, r, doc_id, CAST(sum(
                   c * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total.terms)))) AS BIGINT) AS score
               FROM wanted JOIN w USING (term) JOIN tf USING (term), total GROUP BY item_id, text, r, doc_id),
    ranked AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (
                   PARTITION BY item_id, text ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank
               FROM scored WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {K}
    """
