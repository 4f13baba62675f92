"""CSV records with line breaks in quoted cells, read by many tasks.

A line break ends a record only outside quotes, so it takes all quotes before it to tell.
Files are divided into byte ranges as usual and each range is read line by line:

1. A first scan counts the quotes of every range. Sums over the earlier ranges of a file
   tell which ranges begin inside quotes; these sums have one row per range.
2. A second scan puts lines together to records, range by range in the order of the lines,
   without a shuffle. What a range has of a record that begins before it or ends after it
   is put out as a piece.
3. Pieces, at most two a range, are put together over the borders. A record may span any
   number of ranges. A file that ends inside quotes is an error.

Whether quotes open or close is all that is looked at here; Spark's own parser then reads each
record, with its rules for escapes and malformed rows.
"""

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

QUOTE = '"'
# What becomes of the text of a row that `records` puts together.
WHOLE, HEAD, MIDDLE, TAIL = 0, 1, 2, 3


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Text columns of the CSV files at `path`, named by their header; UTF-8."""
    options = {"quote": QUOTE, "escape": QUOTE, "mode": "FAILFAST", "multiLine": "true"}
    names = spark.read.csv(path, header=True, **options).columns
    kinds = StructType([StructField(name, StringType()) for name in names])
    rows = records(spark, path)
    schema = ", ".join(f"`{name.replace('`', '``')}` STRING" for name in names)
    parsed = rows.select("is_first", F.from_csv("record", schema, options).alias("cells"))
    cells = [F.col("cells").getField(name) for name in names]
    return parsed.where(_not_header(names, cells)).select(*[c.alias(n) for c, n in zip(cells, names)]).to(kinds)


def _not_header(names: list[str], cells: list[Column]) -> Column:
    """Drops each file's first record; an error unless it has the names of the first file."""
    same = F.lit(True)
    for position, (name, cell) in enumerate(zip(names, cells)):
        # Spark names a column without a header by its position, and numbers repeated ones.
        given = name in (f"_c{position}",) or name.endswith(str(position))
        same = same & ((cell == name) | (F.lit(given) & (cell.isNull() | F.lit(name).startswith(cell))))
    other = F.raise_error(F.concat(F.lit("a CSV file has another header: "), F.concat_ws(",", *cells)))
    return ~F.col("is_first") | F.when(same, F.lit(False)).otherwise(other.cast("boolean"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(record, is_first) of all files; is_first marks the first one of each file."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    ranges = _ranges(lines)
    # One short row a byte range; the join keeps the order of lines.
    located = lines.join(F.broadcast(ranges), ["file", "start"]).select("range", "inside", "is_start", "value")
    found = located.mapInArrow(_assembler(), "range long, kind int, is_first boolean, record string")
    whole = found.where(F.col("kind") == WHOLE).select("record", "is_first")
    pieces = found.where(F.col("kind") != WHOLE).join(ranges, "range")
    return whole.unionByName(_joined(pieces)).where(~F.col("record").isin("", "\ufeff"))


def _ranges(lines: DataFrame) -> DataFrame:
    """(file, start, range, inside, is_start) of every byte range: a number for it, whether it
    begins inside quotes and whether it is the first of its file."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    counts = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    by_file = Window.partitionBy("file").orderBy("start")
    before = F.coalesce(F.sum("quotes").over(by_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counts.select(
        "file", "start",
        F.xxhash64("file", "start").alias("range"),
        (before % 2 == 1).alias("inside"),
        (F.row_number().over(by_file) == 1).alias("is_start"),
    )


def _joined(pieces: DataFrame) -> DataFrame:
    """(record, is_first) from the pieces of records that cross borders."""
    in_order = Window.partitionBy("file").orderBy("start", "kind")
    # A piece that begins a record is the last of its range and opens a group.
    group = F.sum((F.col("kind") == TAIL).cast("int")).over(in_order)
    parts = F.sort_array(F.collect_list(F.struct("start", "kind", "record")))
    gathered = (
        pieces.withColumn("group", group)
        .groupBy("file", "group")
        .agg(parts.alias("parts"), F.max("is_first").alias("is_first"))
    )
    closed = F.element_at("parts", -1)["kind"] == HEAD
    text = F.array_join(F.transform("parts", lambda part: part["record"]), "\n")
    unclosed = F.raise_error(F.concat(F.lit("a quote is never closed in "), F.col("file")))
    return gathered.select(
        F.when(closed, F.regexp_replace(text, "\r$", "")).otherwise(unclosed.cast("string")).alias("record"), "is_first"
    )


def _assembler() -> Callable[[Iterator], Iterator]:
    """Lines (range, inside, is_start, value) in their order to records and pieces of them.

    All it needs is inside, so that executors need not have this package."""
    whole_, head_, middle_, tail_, quote = WHOLE, HEAD, MIDDLE, TAIL, QUOTE

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        schema = pa.schema(
            [("range", pa.int64()), ("kind", pa.int32()), ("is_first", pa.bool_()), ("record", pa.string())]
        )

        def put(range_, kinds, first, texts):
            n = len(texts)
            firsts = np.zeros(n, bool)
            if n:
                firsts[0] = first
            columns = [pa.array(np.full(n, range_)), pa.array(kinds, pa.int32()), pa.array(firsts), texts]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        class Range:
            """One byte range: lines kept back until their record ends."""

            def __init__(self, number, inside, is_start):
                self.number, self.odd = number, int(inside)
                # Whether the record in progress began before the range, or is a file's first.
                self.headless, self.first = bool(inside), is_start
                self.rest = []

            def add(self, values):
                if self.first and not self.rest and len(values):
                    # A byte order mark is no text.
                    head = pa.array([(values[0].as_py() or "").removeprefix("\ufeff")])
                    values = pa.concat_arrays([head, values[1:]])
                quotes = pc.count_substring(values, quote).to_numpy(zero_copy_only=False)
                odd = (self.odd + np.cumsum(quotes)) & 1
                ends = np.flatnonzero(odd == 0) + 1
                self.odd = int(odd[-1]) if len(odd) else self.odd
                if not len(ends):
                    self.rest.append(values)
                    return None
                kept = sum(map(len, self.rest))
                done = pa.concat_arrays([*self.rest, values[: ends[-1]]])
                offsets = np.concatenate(([0], ends + kept)).astype(np.int32)
                self.rest = [values[ends[-1] :]] if ends[-1] < len(values) else []
                if len(done) == len(ends):
                    texts = done
                else:
                    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), done), "\n")
                kinds = np.full(len(texts), whole_, np.int32)
                if self.headless:
                    kinds[0] = head_
                # The end of a record is outside quotes, so a carriage return there is part of the break.
                if pc.any(pc.ends_with(texts, "\r")).as_py():
                    texts = pc.replace_substring_regex(texts, r"\r\z", "")
                batch = put(self.number, kinds, self.first and not self.headless, texts)
                self.headless = self.first = False
                return batch

            def close(self):
                if not self.rest:
                    return None
                lines = pa.concat_arrays(self.rest)
                text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(lines)], pa.int32()), lines), "\n")
                return put(self.number, [middle_ if self.headless else tail_], self.first and not self.headless, text)

        current = None
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            borders = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), batch.num_rows]
            for a, b in zip(borders[:-1], borders[1:]):
                if a == b:
                    continue
                if current is None or current.number != numbers[a]:
                    if current is not None and (out := current.close()) is not None:
                        yield out
                    current = Range(int(numbers[a]), batch.column(1)[a].as_py(), batch.column(2)[a].as_py())
                out = current.add(batch.column(3)[a:b])
                if out is not None and out.num_rows:
                    yield out
        if current is not None and (out := current.close()) is not None:
            yield out

    return run
