"""Spelling variants by an index of variable-length grams.

1. A word gets the marks ^ and $ around it. The gram dictionary holds the frequent grams of
   2 to LONGEST - 1 letters: those with more than one in GRAMS of all gram places. A gram
   that is not frequent is pruned, which means it is not made longer. So at every place of
   a word starts one gram: two letters, longer as long as it is frequent, at most LONGEST.
   Whether a gram grows depends on its own letters only.
2. One edited letter changes the grams that hold its place and no others. The largest number
   of grams that hold one place is the word's bound: of its grams, all but so many are in any
   word one edit away, at the same distance from the start or one further.
3. In a common order, rarest first, two such words share one of their first (bound + 1)
   grams (prefix filter). A word is listed under these with its length and the gram's place;
   it also looks into the lists of words one letter longer. Lists are merged in tasks.
4. Pairs of a list are compared, first by their first and last eight letters, then whole. A
   link is put out in one list only, the first that both words are in.

The dictionary has at most GRAMS grams of each length, whatever the size of the corpus, and
is the only thing sent to all tasks. Lists of more than BLOCK words are cut into blocks that
meet pairwise in tasks of their own; which ones are that long is told from one in SAMPLE
words, which decides where rows go and nothing else. No list is capped.

Defined cases: a null or empty text has no words; a row without an id counts like others; a
text is taken whole however long, a word too; repeated rows count as often as they occur; an
empty table gives an empty result; other columns are ignored. Letters are code points up to
U+00FF, others are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.arrays import Batches, map_arrow, mix, powers, utf8
from tillstar.operators.scratch import materialize

# Words: runs of these letters, only A-Z lower-cased.
LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH = 7
LEAST_COUNT = 2
# A form is so many times as frequent as its variant.
FACTOR = 10

SHORTEST, LONGEST = 2, 5
GRAMS = 65_536
BLOCK = 8192
SAMPLE = 16
# Pairs, and letters of them, compared at once.
PAIRS = 1 << 18

_START, _END = ord("^"), ord("$")
_ODD = powers(8)[1:]


def runs(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, run) of every run of letters of every text."""
    run = F.col("run")
    lowered = F.when(run.rlike("[A-Z]"), F.translate(run, UPPER, LOWER)).otherwise(run)
    found = docs.select(F.col(id).alias("id"), F.explode(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0))).alias("run"))
    return found.select("id", lowered.alias("run"))


def count_words(words: DataFrame, word: str = "run", length: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all words of enough letters that occur often enough."""
    kept = words.where(F.length(word) >= length)
    return kept.groupBy(F.col(word).alias("word")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= count)


class Marked:
    """Words as one array of letters with marks around each.

    letters: code points; starts, ends: of each word with its marks."""

    def __init__(self, words: pa.Array):
        data, bounds = utf8(words.cast(pa.large_string()))
        if len(data) and data.max() > 0xC3:
            raise ValueError("words have letters up to U+00FF only")
        lead = data >= 0xC2
        points = data.copy()
        points[1:][lead[:-1]] = ((data[:-1][lead[:-1]] & 3) << 6) | (data[1:][lead[:-1]] & 0x3F)
        before = np.concatenate(([0], np.cumsum(lead)))
        bounds = bounds - before[bounds]
        n = np.arange(len(words))
        self.starts = bounds[:-1] + 2 * n
        self.ends = bounds[1:] + 2 * n + 2
        self.letters = np.zeros(len(points) - int(lead.sum()) + 2 * len(words), np.uint8)
        inside = np.ones(len(self.letters), bool)
        inside[self.starts] = inside[self.ends - 1] = False
        self.letters[inside] = points[~lead]
        self.letters[self.starts], self.letters[self.ends - 1] = _START, _END

    def __len__(self) -> int:
        return len(self.starts)

    def codes(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Code of the `size` letters from every place, and whether the word has so many."""
        place = np.arange(len(self.letters))
        fits = place + size <= np.repeat(self.ends, self.ends - self.starts)
        code = np.full(len(self.letters), size, np.uint64)
        padded = np.concatenate((self.letters, np.zeros(size, np.uint8)))
        for k in range(size):
            code = (code << np.uint64(8)) | padded[k : k + len(self.letters)]
        return code, fits


def gram_counts(words: DataFrame) -> DataFrame:
    """(code, n) of all grams of 2 to LONGEST letters, summed up batch by batch."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            marked = Marked(batch.column(0))
            found = []
            for size in range(SHORTEST, LONGEST + 1):
                code, fits = marked.codes(size)
                found.append(code[fits])
            code, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_pydict({"code": pa.array(code.view(np.int64)), "n": pa.array(n)})

    return map_arrow(words.select("word"), run, "code long, n long")


def dictionary(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the frequent grams, sorted, and their counts: at most GRAMS a length."""
    places = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    counts = gram_counts(words).groupBy("code").agg(F.sum("n").alias("n"))
    frequent = counts.where(F.col("n") * GRAMS > places).toPandas().sort_values("code")
    return frequent["code"].to_numpy(np.uint64), frequent["n"].to_numpy(np.int64)


class Lists:
    """The lists that words are in (`own`), and those of longer words they look into."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.codes, self.counts = codes, counts

    def count(self, code: np.ndarray) -> np.ndarray:
        """How frequent a gram is; 0 for all that the dictionary does not have."""
        if not len(self.codes):
            return np.zeros(len(code), np.int64)
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.counts[at], 0)

    def grams(self, words: Marked) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of every gram: its word, place in the word, code and length."""
        code, fits = words.codes(SHORTEST)
        place = np.flatnonzero(fits)
        code, length = code[place], np.full(len(place), SHORTEST)
        grows = np.ones(len(place), bool)
        for size in range(SHORTEST + 1, LONGEST + 1):
            longer, fits = words.codes(size)
            grows &= fits[place] & (self.count(code) > 0)
            code = np.where(grows, longer[place], code)
            length[grows] = size
        word = np.repeat(np.arange(len(words)), words.ends - words.starts)[place]
        return word, place - words.starts[word], code, length

    def bounds(self, words: Marked, word: np.ndarray, place: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The most grams of each word that hold one of its letters."""
        first = words.starts[word] + place
        change = np.bincount(first, minlength=len(words.letters) + 1)
        change -= np.bincount(first + length, minlength=len(words.letters) + 1)
        holding = np.cumsum(change[:-1])
        holding[words.starts] = holding[words.ends - 1] = 0
        return np.maximum.reduceat(holding, words.starts) if len(words) else holding

    def of(self, words: Marked) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, list, own): all lists of words, even numbers, each once for a word."""
        word, place, code, length = self.grams(words)
        kept = self.bounds(words, word, place, length) + 1
        order = np.lexsort((place, code, self.count(code), word))
        word, place, code = word[order], place[order], code[order]
        firsts = np.searchsorted(word, np.arange(len(words)))
        prefix = np.arange(len(word)) - firsts[word] < kept[word]
        word, place, code = word[prefix], place[prefix], code[prefix]
        size = (words.ends - words.starts)[word]

        def named(size: np.ndarray, place: np.ndarray) -> np.ndarray:
            at = size.astype(np.uint64) * _ODD[0] + place.astype(np.uint64) * _ODD[1]
            # The last bit is kept for `own`.
            return mix(code * _ODD[2] + mix(at)) & ~np.uint64(1)

        lists = np.concatenate((named(size, place), named(size + 1, place), named(size + 1, place + 1)))
        own = np.repeat((True, False, False), len(word))
        word = np.tile(word, 3)
        order = np.lexsort((lists, own, word))
        word, lists, own = word[order], lists[order], own[order]
        new = np.ones(len(word), bool)
        new[1:] = (word[1:] != word[:-1]) | (lists[1:] != lists[:-1]) | (own[1:] != own[:-1])
        return word[new], lists[new].view(np.int64), own[new]


def postings(words: DataFrame, lists: Lists) -> DataFrame:
    """(key, word, n): every word in its lists, and where it looks for longer ones. A key is
    a list and, as its last bit, whether it is the word's own."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            word, found, own = lists.of(Marked(batch.column(0)))
            rows = batch.take(pa.array(word))
            yield pa.RecordBatch.from_arrays([pa.array(found | own), *rows.columns], ["key", "word", "n"])

    return map_arrow(words.select("word", "n"), run, "key long, word string, n long")


def _list() -> Column:
    return F.shiftright("key", 1)


def long_lists(posted: DataFrame) -> DataFrame:
    """(list, blocks) of lists that fill more than one block."""
    drawn = posted.where(F.pmod(F.xxhash64("word"), F.lit(SAMPLE)) == 0)
    counts = drawn.groupBy(_list().alias("list")).agg(F.count(F.lit(1)).alias("n"))
    long = counts.where(F.col("n") * SAMPLE > BLOCK)
    return long.select("list", F.ceil(F.col("n") * SAMPLE / BLOCK).cast("int").alias("blocks"))


def cells(posted: DataFrame, long: DataFrame) -> DataFrame:
    """(key, word, n, i, j, block) of long lists, cut into blocks. A cell holds the blocks i and
    j of a list; where these differ only pairs across them count."""
    block = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    return (
        posted.withColumn("list", _list())
        .join(long, "list")
        .withColumns({"block": block, "other": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))})
        .select("key", "word", "n", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block")
    )


def _ends(words: Marked) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last eight letters of words, the first one lowest."""
    letters = np.concatenate((np.zeros(8, np.uint8), words.letters, np.zeros(8, np.uint8)))
    first = np.zeros((len(words), 8), np.uint8)
    last = first.copy()
    sizes = words.ends - words.starts - 2
    for k in range(8):
        inside = k < sizes
        first[inside, k] = letters[8 + words.starts[inside] + 1 + k]
        last[inside, 7 - k] = letters[8 + words.ends[inside] - 2 - k]
    return first.view(np.uint64).ravel(), last.view(np.uint64).ravel()


def _at_most_one_byte(x: np.ndarray) -> np.ndarray:
    low = np.uint64(0x7F7F7F7F7F7F7F7F)
    some = ~(((x & low) + low) | x | low)
    some = ~some & ~low
    return (some & (some - np.uint64(1))) == 0


def _may_insert(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether the first eight letters of the longer word can be those of the shorter one
    with one letter put in."""
    x = short ^ long
    with np.errstate(over="ignore"):
        same = np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)).astype(np.uint64) >> np.uint64(3)
    below = (np.uint64(1) << (np.minimum(same, 7) * np.uint64(8)).astype(np.uint64)) - np.uint64(1)
    shifted = (short ^ (long >> np.uint64(8))) & np.uint64(0x00FFFFFFFFFFFFFF) & ~below
    return (x == 0) | (shifted == 0)


def one_edit(words: Marked, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a become words b by one letter replaced or put in, exactly."""
    sizes = words.ends - words.starts - 2
    result = np.zeros(len(a), bool)
    for size in np.unique(sizes[a]).tolist():
        for grown in (0, 1):
            rows = np.flatnonzero((sizes[a] == size) & (sizes[b] == size + grown))
            for part in np.array_split(rows, len(rows) * (size + 1) // PAIRS + 1):
                if not len(part):
                    continue
                span = np.arange(size)
                x = words.letters[(words.starts[a[part]] + 1)[:, None] + span]
                y = words.letters[(words.starts[b[part]] + 1)[:, None] + span]
                same = x == y
                if not grown:
                    result[part] = (~same).sum(axis=1) == 1
                    continue
                shifted = x == words.letters[(words.starts[b[part]] + 2)[:, None] + span]
                head = np.where(same.all(axis=1), size, np.argmin(same, axis=1))
                tail = np.where(shifted.all(axis=1), size, np.argmin(shifted[:, ::-1], axis=1))
                result[part] = head + tail >= size
    return result


def near_pairs(table: pa.Table, lists: Lists) -> pa.RecordBatch:
    """Links of whole cells, sorted so that a cell's words of its own come last: (a, n_a, b, n_b),
    each link in the first of the lists that both words are in."""
    key, i, j, block = cell_columns(table)
    own, of_list = (key & 1).astype(bool), key & ~1
    words = Marked(table.column("word").combine_chunks())
    sizes, (first, last) = words.ends - words.starts, _ends(words)
    n = len(own)
    new = np.ones(n, bool)
    new[1:] = (of_list[1:] != of_list[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], n)
    of = np.cumsum(new) - 1
    # A word meets the later ones of its cell that are the list's own.
    looking = np.add.reduceat((~own).astype(np.int64), starts)
    begin = np.maximum(np.arange(n) + 1, (starts + looking)[of])
    partners = np.maximum(ends[of] - begin, 0)
    totals = np.cumsum(partners)
    kept = []
    row = 0
    while row < n:
        stop = max(row + 1, int(np.searchsorted(totals, (totals[row - 1] if row else 0) + PAIRS, "right")))
        some = partners[row:stop]
        a = np.repeat(np.arange(row, stop), some)
        b = np.arange(len(a)) - np.repeat(np.cumsum(some) - some, some) + np.repeat(begin[row:stop], some)
        row = stop
        if not len(a):
            continue
        grown = sizes[b] - sizes[a]
        head, tail = first[a], last[a]
        fits = np.where(
            grown == 0,
            _at_most_one_byte(head ^ first[b]) & _at_most_one_byte(tail ^ last[b]),
            _may_insert(head, first[b]),
        )
        fits &= (i[a] == j[a]) | (block[a] != block[b])
        a, b = a[fits], b[fits]
        exact = one_edit(words, a, b)
        kept.append(np.stack((a[exact], b[exact])))
    a, b = np.concatenate(kept, axis=1) if kept else np.zeros((2, 0), np.int64)
    here = _first_common(table, lists, a, b) == of_list[a]
    a, b = pa.array(a[here]), pa.array(b[here])
    names, counts = table.column("word").combine_chunks(), table.column("n").combine_chunks()
    return pa.RecordBatch.from_arrays(
        [names.take(a), counts.take(a), names.take(b), counts.take(b)], ["a", "n_a", "b", "n_b"]
    )


def _first_common(table: pa.Table, lists: Lists, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least list that both words of a pair meet in."""
    used, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    if not len(used):
        return np.zeros(0, np.int64)
    names = table.column("word").combine_chunks().take(pa.array(used))
    words = Marked(names)
    word, found, own = lists.of(words)
    sizes = words.ends - words.starts
    at_a, at_b = at[: len(a)], at[len(a) :]
    same = sizes[at_a] == sizes[at_b]

    def of(side: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pair numbers and lists of one side; `wanted` is whether its own lists count."""
        begin, end = np.searchsorted(word, side), np.searchsorted(word, side, "right")
        size = end - begin
        pair = np.repeat(np.arange(len(side)), size)
        place = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size)
        right = own[place] == wanted[pair]
        return pair[right], found[place[right]]

    pair_a, list_a = of(at_a, same)
    pair_b, list_b = of(at_b, np.ones(len(b), bool))
    pair, name = np.concatenate((pair_a, pair_b)), np.concatenate((list_a, list_b))
    order = np.lexsort((name, pair))
    pair, name = pair[order], name[order]
    twice = np.flatnonzero((pair[1:] == pair[:-1]) & (name[1:] == name[:-1]))
    firsts = twice[np.searchsorted(pair[twice], np.arange(len(a)))]
    return name[firsts]


def cell_columns(table: pa.Table) -> list[np.ndarray]:
    """key, i, j, block; the last three are 0 for lists of one block."""
    zero = np.zeros(table.num_rows, np.int32)
    names = table.column_names
    return [table.column(c).to_numpy() if c in names else zero for c in ("key", "i", "j", "block")]


def whole_cells(batches: Batches) -> Iterator[pa.Table]:
    """Sorted rows as tables that end where a cell ends."""
    rest: pa.Table | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        key, i, j, _ = cell_columns(table)
        ids = (key >> 1, i, j)
        change = np.flatnonzero(np.any([x[1:] != x[:-1] for x in ids], axis=0)) + 1
        last = int(change[-1]) if len(change) else 0
        if last:
            yield table.slice(0, last)
        rest = table.slice(last)
    if rest is not None and rest.num_rows:
        yield rest


def links(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): all pairs of words one edit apart, each once."""
    lists = Lists(*dictionary(words))
    posted = postings(words, lists)
    long = materialize(long_lists(posted), "long-lists")

    def run(batches: Batches) -> Batches:
        for table in whole_cells(batches):
            found = near_pairs(table, lists)
            if found.num_rows:
                yield found

    schema = "a string, n_a long, b string, n_b long"

    def merged(rows: DataFrame, *place: str) -> DataFrame:
        """Lists dealt out whole, or cell by cell, a list's own words last."""
        order = (_list(), *place, "key") if place else ("key",)
        return map_arrow(rows.repartition(_list(), *place).sortWithinPartitions(*order), run, schema)

    if long.isEmpty():
        return merged(posted)
    short = posted.join(long.select(F.col("list").alias("_list")), _list() == F.col("_list"), "left_anti")
    return merged(short).unionByName(merged(cells(posted, long), "i", "j"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: the last that forms lead to. A form is more
    frequent than its variant by FACTOR, so paths end; each round doubles their steps."""
    found = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = found.select(F.col("word").alias("root"), F.col("root").alias("above"))
        longer = materialize(found.join(up, "root", "left").select("word", "root", "above"), "roots")
        if longer.where("above is not null").isEmpty():
            return found
        found = longer.select("word", F.coalesce("above", "root").alias("root"))


def group(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """One row per word of (word, n): word, form, root, n, n_near, form_n.

    Near words differ by exactly one letter put in, taken out or replaced. A word's form is
    its most frequent near word (of equal ones the first in code-point order), if that is
    `factor` times as frequent; the root is the last that forms lead to, else the word."""
    if words.where(F.length("word") < LONGEST).limit(1).count():
        raise ValueError(f"words need {LONGEST} letters at least")
    found = materialize(links(words), "spelling-links")
    both = found.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).union(
        found.select("b", "a", "n_a")
    )
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("_best")
    )

    def chosen(value: Column) -> Column:
        return F.when(-F.col("_best.less") >= factor * F.col("n"), value)

    judged = materialize(
        words.join(best, "word", "left").select(
            "word",
            chosen(F.col("_best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            chosen(-F.col("_best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    last = roots(judged.where("form is not null"))
    return judged.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def variants(words: DataFrame, word: str = "run") -> DataFrame:
    """Words counted, stored and grouped."""
    return group(materialize(count_words(words, word), "words"))


def oracle(runs: str) -> str:
    """SQL for `variants` of the table `words(word)` that `runs` defines, by all pairs of words
    that are equal but for one letter."""
    return f"""
    {runs},
    counted AS (SELECT word, count(*) AS n FROM words WHERE length(word) >= {LEAST_LENGTH}
                GROUP BY word HAVING count(*) >= {LEAST_COUNT}),
    holes AS (SELECT word, n, k, substr(word, 1, k) AS head, substr(word, k + 2) AS tail
              FROM (SELECT word, n, unnest(range(length(word))) AS k FROM counted)),
    shorter AS (SELECT DISTINCT word, n, head || tail AS rest FROM holes),
    near AS (SELECT a.word, b.word AS near, b.n FROM holes a JOIN holes b USING (k, head, tail) WHERE a.word <> b.word
             UNION ALL SELECT s.word, c.word, c.n FROM shorter s JOIN counted c ON s.rest = c.word
             UNION ALL SELECT c.word, s.word, s.n FROM shorter s JOIN counted c ON s.rest = c.word),
    best AS (SELECT word, count(*) AS n_near, max(n) AS most FROM near GROUP BY word),
    forms AS (SELECT b.word, min(near.near) AS form, b.most AS form_n FROM best b
              JOIN counted c ON c.word = b.word AND b.most >= {FACTOR} * c.n
              JOIN near ON near.word = b.word AND near.n = b.most GROUP BY b.word, b.most),
    paths(word, root, steps) AS (SELECT word, form, 1 FROM forms
        UNION ALL SELECT paths.word, forms.form, steps + 1 FROM paths JOIN forms ON paths.root = forms.word),
    roots AS (SELECT word, arg_max(root, steps) AS root FROM paths GROUP BY word)
    SELECT c.word, form, coalesce(root, c.word) AS root, c.n, coalesce(n_near, 0) AS n_near, form_n
    FROM counted c LEFT JOIN best ON best.word = c.word LEFT JOIN forms ON forms.word = c.word
    LEFT JOIN roots ON roots.word = c.word
    """
