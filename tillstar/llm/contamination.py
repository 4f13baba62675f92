"""Benchmark decontamination with suffix arrays.

Every slice of the training documents gets a suffix array over its words: the start
positions of all suffixes that can hold a test window, sorted by their words. Each
test suffix is binary-searched in every array; the range found is every place where
its window occurs verbatim, and comparing on from there gives the longest match.
The arrays live in the task that reads the documents, so nothing is shuffled, and a
text that thousands of documents share only gives each of them its own matches.

Verdicts (`add_hits`) search each distinct window once and keep the passages hit and the
items they are of, so their rows and memory follow the texts, also where a text repeats
itself. `add_matches` lists every place of every window, which for a text of n equal words
and an item of m are n * m.

The benchmark is a query set: it goes through the driver in blocks of at most
BLOCK_BYTES of text, one pass over the documents per block (one block for all usual
benchmarks); the verdicts of a block are stored before the next is read. Words are
compared by 64-bit hashes.

Defined cases: a null or empty text, or one without words, has no words, no matches
and is never contaminated; an item without words has no window; repeated rows and
repeated ids are judged row by row; an empty benchmark leaves every document clean;
items with a null id match, but are not listed by id; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.arrays import LOWER, Words, map_arrow, map_slices, strings
from tillstar.operators.scratch import materialize

# Words in a window; an item of fewer words is one window.
WINDOW = 10
# Benchmark text searched for in one pass.
BLOCK_BYTES = 8 << 20

# A word is a run of digits, letters a-z and characters beyond ASCII.
IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True
IS_WORD = IS_WORD[LOWER]

MATCHES = (
    "array<struct<item_id: bigint, item_start: int, doc_start: int, window: int, length: int>>"
)


def add_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """(id, text, n_words, matches): where test windows occur in each document.

    A match is an item's window at word `item_start` that occurs at word `doc_start`
    of the document; `length` (at least `window` words, the length of the window) is
    how long the two texts agree from there on.
    """
    marked = docs.select(
        F.col(id),
        F.col(text),
        F.lit(0).alias("n_words"),
        F.from_json(F.lit("[]"), MATCHES).alias("matches"),
    )
    schema = f"`{id}` {docs.schema[id].dataType.simpleString()}, `{text}` string, "
    schema += f"n_words int, matches {MATCHES}"
    found = False
    for block in _blocks(benchmark):
        found = True
        marked = _search(marked, block, schema, id, text, window)
    return marked if found else _search(marked, [], schema, id, text, window)


HITS = "array<struct<start: int, end: int>>"


def add_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """(id, text, n_words, contaminated, hits, items): the passages of each document that
    lie inside test windows, as word ranges that do not touch (end exclusive), and the sorted
    ids of the items with a window there."""
    marked = docs.select(
        F.col(id),
        F.col(text),
        F.lit(0).alias("n_words"),
        F.lit(False).alias("contaminated"),
        F.from_json(F.lit("[]"), HITS).alias("hits"),
        F.from_json(F.lit("[]"), "array<bigint>").alias("items"),
    )
    schema = f"`{id}` {docs.schema[id].dataType.simpleString()}, `{text}` string, "
    schema += f"n_words int, contaminated boolean, hits {HITS}, items array<bigint>"
    found = False
    for block in _blocks(benchmark):
        # One block at a time in the plan.
        marked = _judge(materialize(marked, "hits") if found else marked, block, schema, id, text, window)
        found = True
    return marked if found else _judge(marked, [], schema, id, text, window)


def _judge(
    marked: DataFrame, block: list[tuple[int | None, str]], schema: str, id: str, text: str, window: int
) -> DataFrame:
    test = TestSuffixes(block, window)

    def run(batch: pa.RecordBatch) -> dict:
        words = Words(strings(batch, text), IS_WORD)
        document, place, group = SuffixArray(words, test).distinct_occurrences()
        ranges, of_range = _flat(batch.column(4))
        earlier = words.offsets[of_range]
        begin = np.concatenate((place, ranges.field(0).to_numpy() + earlier))
        end = np.concatenate((place + test.window[test.first_of[group]], ranges.field(1).to_numpy() + earlier))
        # A place of its own after each document, so that passages end with it.
        n_words = np.diff(words.offsets)
        gap = np.repeat(np.arange(len(n_words)), n_words)
        change = np.zeros(len(gap) + len(n_words) + 1, np.int64)
        inside = np.append(gap, 0)
        np.add.at(change, begin + inside[begin], 1)
        np.add.at(change, end + inside[end - 1] if len(end) else end, -1)
        hit = np.concatenate(([0], (np.cumsum(change) > 0).astype(np.int8), [0]))
        edges = np.diff(hit)
        start, stop = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        firsts = words.offsets[:-1] + np.arange(len(n_words))
        owner = np.searchsorted(firsts, start, "right") - 1
        # An empty document has a place, too, but no hit.
        bounds = np.searchsorted(owner, np.arange(len(n_words) + 1))
        passages = pa.StructArray.from_arrays(
            [pa.array(start - firsts[owner], pa.int32()), pa.array(stop - firsts[owner], pa.int32())], ["start", "end"]
        )
        return {
            id: batch.column(0),
            text: batch.column(1),
            "n_words": pa.array(n_words, pa.int32()),
            "contaminated": pa.array(np.diff(bounds) > 0),
            "hits": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), passages),
            "items": _items(batch.column(5), test, document, group),
        }

    return map_slices(marked, run, schema, text)


def _flat(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """All values of the lists, and the row each is of."""
    return lists.flatten(), np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))


def _items(earlier: pa.ListArray, test: TestSuffixes, document: np.ndarray, group: np.ndarray) -> pa.ListArray:
    """Sorted distinct ids of each document's items, of earlier blocks and this one."""
    n = max(1, len(test.first_of))
    pairs = np.unique(document * n + group)
    document, group = pairs // n, pairs % n
    count = test.items_until[group + 1] - test.items_until[group]
    nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    item = test.items_of[np.repeat(test.items_until[group], count) + nth]
    values, rows = _flat(earlier)
    ids = pa.array(test.item_ids, pa.int64()).take(pa.array(item, pa.int64()))
    known = np.array(ids.is_valid())
    every = np.concatenate((values.to_numpy(zero_copy_only=False).astype(np.int64), ids.filter(pa.array(known)).to_numpy()))
    owner = np.concatenate((rows, np.repeat(document, count)[known]))
    order = np.lexsort((every, owner))
    every, owner = every[order], owner[order]
    new = np.ones(len(every), bool)
    new[1:] = (every[1:] != every[:-1]) | (owner[1:] != owner[:-1])
    bounds = np.searchsorted(owner[new], np.arange(len(earlier) + 1))
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(every[new], pa.int64()))


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    rows, size = [], 0
    items = benchmark.select(F.col("item_id").cast("long"), "text").where(F.col("text").isNotNull())
    for item, content in items.toLocalIterator():
        rows.append((item, content))
        size += len(content)
        if size >= BLOCK_BYTES:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def _search(
    marked: DataFrame, block: list[tuple[int | None, str]], schema: str, id: str, text: str, window: int
) -> DataFrame:
    test = TestSuffixes(block, window)

    def run(batch: pa.RecordBatch) -> dict:
        words = Words(strings(batch, text), IS_WORD)
        array = SuffixArray(words, test)
        document, place, suffix = array.occurrences()
        length = array.agreement(place, suffix)
        first = words.offsets[document]
        order = np.lexsort((test.start[suffix], place))
        document, place, suffix, length = (x[order] for x in (document, place, suffix, length))
        first = first[order]
        items = pa.array(test.item_ids, pa.int64()).take(pa.array(test.item[suffix]))
        rows = pa.StructArray.from_arrays(
            [
                items,
                pa.array(test.start[suffix], pa.int32()),
                pa.array(place - first, pa.int32()),
                pa.array(test.window[suffix], pa.int32()),
                pa.array(length, pa.int32()),
            ],
            ["item_id", "item_start", "doc_start", "window", "length"],
        )
        return {
            id: batch.column(0),
            text: batch.column(1),
            "n_words": pa.array(np.diff(words.offsets), pa.int32()),
            "matches": _joined(batch.column(3), rows, np.searchsorted(document, np.arange(batch.num_rows + 1))),
        }

    return map_slices(marked, run, schema, text)


def _joined(earlier: pa.ListArray, rows: pa.StructArray, offsets: np.ndarray) -> pa.ListArray:
    """Each document's matches of earlier blocks and of this one."""
    new = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)
    if len(earlier.flatten()) == 0:
        return new
    both = [(a or []) + b for a, b in zip(earlier.to_pylist(), new.to_pylist(), strict=True)]
    return pa.array(both, new.type)


class TestSuffixes:
    """Words of the test items: the suffixes that begin a window, as vocabulary ids."""

    __test__ = False

    def __init__(self, block: list[tuple[int | None, str]], window: int):
        words = Words(pa.array([content for _, content in block], pa.large_string()), IS_WORD)
        self.item_ids = [item for item, _ in block]
        self.vocabulary = np.unique(words.hash)
        lengths = np.diff(words.offsets)
        sizes = np.minimum(lengths, window)
        starts = np.where(lengths > 0, lengths - sizes + 1, 0)
        self.item = np.repeat(np.arange(len(block)), starts)
        self.start = np.arange(len(self.item)) - np.repeat(np.cumsum(starts) - starts, starts)
        self.window = sizes[self.item]
        # 0 ends an item; ids begin at 1.
        self.words = np.zeros(len(words) + len(block), np.int64)
        self.first = (words.offsets[:-1] + np.arange(len(block)))[self.item] + self.start
        self.words[np.arange(len(words)) + words.text_of()] = 1 + np.searchsorted(self.vocabulary, words.hash)
        self.shortest = int(sizes[sizes > 0].min()) if (sizes > 0).any() else 0
        self.bits = max(1, int(len(self.vocabulary)).bit_length())
        self.longest = int(sizes.max()) if len(sizes) else 0
        self.low, self.high = self._bounds()
        self._group()

    def _group(self) -> None:
        """Equal windows as one group: its first suffix, and the items that hold it."""
        order = np.lexsort([*self.low[::-1], self.window])
        new = np.ones(len(order), bool)
        same = self.window[order][1:] == self.window[order][:-1]
        for key in self.low:
            same &= key[order][1:] == key[order][:-1]
        new[1:] = ~same
        self.first_of = order[new]
        group = np.cumsum(new) - 1
        size = max(1, len(self.item_ids))
        pairs = np.unique(group * size + self.item[order])
        self.items_of = pairs % size
        self.items_until = np.searchsorted(pairs // size, np.arange(len(self.first_of) + 1))

    def _bounds(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Least and greatest key of any suffix that begins with each window."""
        top = (1 << self.bits) - 1
        low, high = [], []
        for k in range(self.longest):
            here = k < self.window
            word = self.words[np.minimum(self.first + k, len(self.words) - 1)]
            low.append(np.where(here, word, 0))
            high.append(np.where(here, word, top))
        return packed(low, self.bits), packed(high, self.bits)


def packed(columns: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """Join as many columns of `bits` bits as fit into 63-bit keys, first column first."""
    fit, keys = max(1, 63 // bits), []
    for begin in range(0, len(columns), fit):
        group = columns[begin : begin + fit]
        key = np.zeros(len(group[0]), np.int64)
        for column in group:
            key = (key << bits) | column
        keys.append(key << (bits * (fit - len(group))))
    return keys


class SuffixArray:
    """Sorted word suffixes of one slice of documents.

    Left out are suffixes that no window can begin: those that meet a word of no test
    item, or the document's end, before the shortest window is full.
    """

    def __init__(self, words: Words, test: TestSuffixes):
        self.test = test
        self.text_of = words.text_of()
        n_texts = len(words.offsets) - 1
        # Ids of all words with a 0 after each document.
        self.words = np.zeros(len(words) + n_texts, np.int64)
        place = np.arange(len(words)) + self.text_of
        if len(test.vocabulary):
            near = np.searchsorted(test.vocabulary, words.hash)
            near[near == len(test.vocabulary)] = 0
            self.words[place] = np.where(test.vocabulary[near] == words.hash, near + 1, 0)
        zeros = np.flatnonzero(self.words == 0)
        filled = np.diff(np.concatenate(([-1], zeros))) - 1  # known words before each 0
        until = np.repeat(zeros, filled + 1) if len(zeros) else zeros
        known = until - np.arange(len(until))  # known words from each position on
        at = np.flatnonzero(known >= test.shortest) if test.shortest else np.zeros(0, np.int64)
        columns = []
        for k in range(test.longest):
            columns.append(np.where(k < known[at], self.words[np.minimum(at + k, len(self.words) - 1)], 0))
        keys = packed(columns, test.bits) if columns else []
        order = np.lexsort(keys[::-1]) if keys else np.zeros(0, np.int64)
        self.at = at[order]
        self.keys = [key[order] for key in keys]
        # Which document and word each position of self.words is.
        self.document = np.full(len(self.words), -1)
        self.document[place] = self.text_of
        self.known = known

    def search(self, wanted: list[np.ndarray], right: bool) -> np.ndarray:
        """Binary search of all wanted keys at once: where they would go in."""
        n = len(wanted[0]) if wanted else 0
        low, high = np.zeros(n, np.int64), np.full(n, len(self.at), np.int64)
        while len(self.at) and (low < high).any():
            open_ = low < high
            middle = np.minimum((low + high) // 2, len(self.at) - 1)
            less, equal = np.zeros(n, bool), np.ones(n, bool)
            for have, want in zip(self.keys, wanted, strict=True):
                less |= equal & (have[middle] < want)
                equal &= have[middle] == want
            before = less | equal if right else less
            low = np.where(open_ & before, middle + 1, low)
            high = np.where(open_ & ~before, middle, high)
        return low

    def occurrences(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, word number in the slice, test suffix) of all windows found."""
        return self._places(np.arange(len(self.test.item)))

    def distinct_occurrences(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, word number in the slice, group) of all distinct windows found."""
        return self._places(self.test.first_of)

    def _places(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        begin = self.search([key[wanted] for key in self.test.low], right=False)
        count = self.search([key[wanted] for key in self.test.high], right=True) - begin
        suffix = np.repeat(np.arange(len(count)), count)
        nth = np.arange(len(suffix)) - np.repeat(np.cumsum(count) - count, count)
        position = self.at[begin[suffix] + nth] if len(suffix) else np.zeros(0, np.int64)
        document = self.document[position]
        return document, position - document, suffix

    def agreement(self, place: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        """Words that document and item agree on from a place and a test suffix on."""
        if not len(place):
            return np.zeros(0, np.int64)
        here = place + self.text_of[place]
        there = self.test.first[suffix]
        length = self.test.window[suffix].astype(np.int64)
        growing = np.arange(len(place))
        while len(growing):
            ours = self.words[here[growing] + length[growing]]
            theirs = self.test.words[there[growing] + length[growing]]
            growing = growing[(ours == theirs) & (ours > 0)]
            length[growing] += 1
        return length


def judge(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per document: id, n_words, n_hit (words inside any match), n_items (items
    with a match), items_sha256 (of their ids), contaminated (n_hit > 0)."""
    marked = add_hits(docs, benchmark, id, text, window)
    kind = docs.schema[id].dataType.simpleString()
    schema = (
        f"`{id}` {kind}, n_words long, n_hit long, n_items long, "
        "items_sha256 string, contaminated boolean"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict(digest(batch, id))

    return map_arrow(marked.select(id, "n_words", "contaminated", "hits", "items"), run, schema)


def digest(batch: pa.RecordBatch, id: str) -> dict:
    ranges, rows = _flat(batch.column(3))
    length = ranges.field(1).to_numpy() - ranges.field(0).to_numpy()
    n_hit = np.bincount(rows, weights=length, minlength=batch.num_rows).astype(np.int64)
    items = [sorted(map(str, ids)) for ids in batch.column(4).to_pylist()]
    hashes = [hashlib.sha256(",".join(ids).encode()).hexdigest() for ids in items]
    return {
        id: batch.column(0),
        "n_words": batch.column(1).cast(pa.int64()),
        "n_hit": pa.array(n_hit, pa.int64()),
        "n_items": pa.array([len(ids) for ids in items], pa.int64()),
        "items_sha256": pa.array(hashes, pa.string()),
        "contaminated": batch.column(2),
    }


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, without those that hold a test window."""
    names = [f"_{i}" for i in range(len(docs.columns))]
    place = docs.columns.index(text)
    renamed = docs.toDF(*names).select(F.struct(*names).alias("_row"), F.col(names[place]).alias("text"))
    marked = add_hits(renamed, benchmark, "_row", "text")
    clean = marked.where("not contaminated").select("_row.*")
    return clean.toDF(*docs.columns)
