"""Text columns as flat numpy arrays, for functions over Arrow batches."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

# Text bytes worked on at once; one longer text makes a slice of its own.
SLICE_BYTES = 4 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application: they need not have it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


Batches = Iterator[pa.RecordBatch]


# What operators keep in a worker process from one task to the next: name -> how to forget it.
held: dict[str, Callable[[], None]] = {}


def release(name: str | None) -> None:
    """Forget what other operators than `name` keep, as workers outlive their stages, and
    give free memory back to the machine."""
    for other, forget in held.items():
        if other != name:
            forget()
    pa.default_memory_pool().release_unused()
    # glibc keeps freed arrays otherwise.
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def map_arrow(
    df: DataFrame, function: Callable[[Batches], Batches], schema: str, holds: str | None = None
) -> DataFrame:
    """`mapInArrow` with this package on the executors; `holds` names what the function keeps
    in its worker."""
    ship(df.sparkSession)

    def run(batches: Batches) -> Batches:
        release(holds)
        return function(batches)

    return df.mapInArrow(run, schema)


def map_slices(
    df: DataFrame, function: Callable[[pa.RecordBatch], dict], schema: str, text: str = "text",
    size: int = SLICE_BYTES, holds: str | None = None,
) -> DataFrame:
    """Apply `function` to slices of Arrow batches that hold about `size` bytes of `text`.

    It gets a record batch and returns equally long columns by name, in the order of
    `schema`; none if nothing is to be put out. Spark bounds the batches themselves
    (spark.sql.execution.arrow.maxBytesPerBatch).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, size):
                columns = function(part)
                if columns:
                    yield pa.RecordBatch.from_pydict(columns)

    return map_arrow(df, run, schema, holds)


def slices(batch: pa.RecordBatch, text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into row ranges of about `size` bytes of text."""
    if batch.num_rows == 0:
        return
    column = batch.column(batch.schema.get_field_index(text))
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def strings(batch: pa.RecordBatch, text: str = "text") -> pa.Array:
    """The text column without nulls (null becomes the empty text), with 64-bit offsets."""
    column = batch.column(batch.schema.get_field_index(text))
    return pc.fill_null(column.cast(pa.large_string()), "")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a large_string column and the n + 1 offsets of its rows."""
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def lower_table() -> np.ndarray:
    """Byte table that lower-cases A-Z."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = lower_table()
# Random but fixed 64-bit codes of bytes, and the multiplier of word positions.
CODES = np.random.Generator(np.random.PCG64(20240101)).integers(1, 1 << 63, 256, dtype=np.uint64)
LOWER_CODES = CODES[LOWER]
STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), STEP, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """Words of many texts: maximal runs of bytes for which `is_word` holds.

    offsets: of each text's words, n + 1 values; start, end: of each word in bytes
    from the start of all texts; hash: 64 bits of the word with A-Z lower-cased.
    """

    def __init__(self, column: pa.Array, is_word: np.ndarray):
        data, bounds = utf8(column)
        inside = is_word[data]
        size = len(data)
        before, after = np.zeros(size, bool), np.zeros(size, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        full = bounds[:-1] < bounds[1:]
        before[bounds[:-1][full]] = False
        after[bounds[1:][full] - 1] = False
        self.bounds = bounds
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.offsets = np.searchsorted(self.start, bounds)
        lengths = self.end - self.start
        kept = data[inside]
        firsts = np.cumsum(lengths) - lengths
        if len(lengths):
            place = np.arange(len(kept), dtype=np.int32) - np.repeat(firsts.astype(np.int32), lengths)
            terms = LOWER_CODES[kept]
            terms *= powers(int(lengths.max()))[place]
            self.hash = mix(np.add.reduceat(terms, firsts) + lengths.astype(np.uint64))
        else:
            self.hash = np.zeros(0, np.uint64)

    def __len__(self) -> int:
        return len(self.hash)

    def text_of(self) -> np.ndarray:
        """Number of the text that each word is in."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))
