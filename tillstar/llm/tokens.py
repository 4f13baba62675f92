"""Token counts with public tokenizers: lengths only, from Arrow functions.

Texts are cut at safe boundaries, where the tokenizer's result is the sum of its parts:
white space where the tokenizer drops it, else single spaces between other characters.
The parts that a task has not met yet are encoded in batches balanced by bytes; a part
that occurs again is only looked up. So one long text is many short parts, and no batch
depends on how long texts are. Known counts are forgotten beyond MAX_KNOWN parts, which
changes nothing but time.

Defined cases: a null or empty text has 0 bytes and 0 tokens; a text without a safe
boundary is one part; repeated rows and ids are counted row by row; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tillstar.llm.arrays import map_slices, strings

# Bytes encoded in one call, and parts that a task remembers.
BATCH_BYTES = 256 << 10
MAX_KNOWN = 500_000
LIMIT = 2048

_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_loaded: dict[str, Lengths] = {}


class Lengths:
    """Token counts of text parts, one tokenizer file, one Python process."""

    def __init__(self, path: str):
        self.known: dict[str, int] = {"": 0}
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode: Callable[[list[str]], Iterable[int]] = lambda parts: map(
                len, model.encode(parts, num_threads=1)
            )
            self.mark = ""  # a part gets the space before it from the model itself
            self.drops_space = False
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.encode = lambda parts: (
                len(x.ids) for x in tokenizer.encode_batch_fast(parts, add_special_tokens=False)
            )
            self.mark = " "
            self.drops_space = next(iter(self.encode([" \n "]))) == 0

    def parts(self, text: str) -> list[str]:
        """Cut a text at safe boundaries."""
        if self.drops_space:
            return text.replace("\n", " ").split(" ")
        first, *rest = _SINGLE_SPACE.split(text)
        return [first, *[self.mark + x for x in rest]]

    def count(self, texts: list[str]) -> list[int]:
        cut = [self.parts(text) for text in texts]
        if len(self.known) > MAX_KNOWN:
            self.known = {"": 0}
        new = set().union(*cut).difference(self.known)
        for batch in byte_batches(new):
            self.known.update(zip(batch, self.encode(batch), strict=True))
        known = self.known
        return [sum(map(known.__getitem__, parts)) for parts in cut]


def byte_batches(parts: Iterable[str], size: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Batches of about `size` bytes, parts of like length together."""
    batch, filled = [], 0
    for part in sorted(parts, key=len):
        batch.append(part)
        filled += len(part.encode())
        if filled >= size:
            yield batch
            batch, filled = [], 0
    if batch:
        yield batch


def lengths(path: str) -> Lengths:
    """The tokenizer of this process, loaded once."""
    if path not in _loaded:
        _loaded[path] = Lengths(path)
    return _loaded[path]


def count_tokens(
    docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", limit: int = LIMIT
) -> DataFrame:
    """One row per document: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    `path` names a tokenizer file that all executors have: .json or .model.
    """
    schema = f"`{id}` {docs.schema[id].dataType.simpleString()}, "
    schema += "n_bytes long, n_tokens long, over_limit boolean"

    def run(batch: pa.RecordBatch) -> dict:
        column = strings(batch, text)
        counts = np.array(lengths(path).count(column.to_pylist()), np.int64)
        return {
            id: batch.column(0),
            "n_bytes": pc.binary_length(column).cast(pa.int64()),
            "n_tokens": pa.array(counts),
            "over_limit": pa.array(counts > limit),
        }

    return map_slices(docs.select(id, text), run, schema, text)
