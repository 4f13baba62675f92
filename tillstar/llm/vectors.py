"""Near-duplicate vectors by Euclidean p-stable hashing, confirmed by exact cosines.

1. A vector is scaled to length 1. In each of TABLES tables, HASHES random projections of
   it (normal, hence 2-stable) are cut into steps of WIDTH; the steps together are its
   bucket. Of two unit vectors with cosine 0.95 (distance 0.316) one projection agrees with
   probability 0.87, a table with 0.15, one of 15 tables with 0.915; with cosine 0.975
   that is 0.99. Vectors at right angles share a bucket with probability 4e-5 a table.
2. A bucket entry is 24 bytes: bucket, a short name of the vector, 64 signs of further
   projections. An entry lives on only if its bucket holds another one with at most
   NEAR_SIGNS other signs; a cosine of 0.95 has about 6.5 of them, and more than
   NEAR_SIGNS with a probability of 3e-8.
3. Live entries fetch their vectors, and those of one bucket are compared by exact cosine in
   double precision. A pair counts only in the first table in which its vectors share a
   bucket. A bucket puts out counts of links and the links that join its components, never
   all pairs.

Equal vectors are one class with a number of copies, collapsed before anything is shuffled.
Buckets of more than BLOCK classes are cut into blocks, and each pair of blocks meets in a
task of its own; which ones are that large is told from the entries of one in SAMPLE
vectors, which decides where rows go and nothing else. Projections are integers, so that
a vector has the same buckets in every task.

Defined cases: a vector that is null, empty, zero, or holds a null or non-finite component
is linked with nothing and kept; vectors of different lengths are not linked; a repeated id
names its rows alike, and each row is judged; rows without an id are linked like others, but
name a component only if it has no id at all, and then as null; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.arrays import Batches, map_arrow, mix
from tillstar.llm.neardup import components
from tillstar.operators.scratch import materialize
from tillstar.operators.spread import is_small, join_unique

COSINE = 0.95
TABLES = 15
HASHES = 14
WIDTH = 2.0
NEAR_SIGNS = 22
BLOCK = 8192
SAMPLE = 64
# Vector components worked on at once.
SLICE_VALUES = 1 << 20
# Rows compared with all members of a bucket at once.
ROWS = 256

_UNIT = float(1 << 20)
_FINE = float(1 << 12)


@lru_cache(maxsize=4)
def projections(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For vectors of `size` components: integer projections for buckets, their random
    starts, projections for signs, and the factors that make a bucket's name of its steps."""
    draw = np.random.Generator(np.random.PCG64([13, size]))
    steps = np.rint(draw.standard_normal((size, TABLES * HASHES)) * _FINE)
    starts = np.rint(draw.random(TABLES * HASHES) * WIDTH * _UNIT * _FINE)
    signs = np.rint(draw.standard_normal((size, 64)) * _FINE)
    factors = draw.integers(1, 1 << 63, TABLES * HASHES, dtype=np.uint64) | np.uint64(1)
    return steps, starts, signs, factors


def unit(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled to length 1 in double precision, and which of them can be."""
    rows = rows.astype(np.float64)
    good = np.isfinite(rows).all(axis=1)
    rows[~good] = 0
    most = np.abs(rows).max(axis=1, initial=0)
    good &= most > 0
    # A power of two first: squares of huge or tiny components stay finite, nothing is rounded.
    rows = np.ldexp(rows, -np.frexp(most)[1][:, None])
    lengths = np.sqrt((rows * rows).sum(axis=1))
    return rows / np.where(good, lengths, 1)[:, None], good


def buckets(units: np.ndarray) -> np.ndarray:
    """Names of the buckets of unit vectors, one column a table."""
    steps, starts, _, factors = projections(units.shape[1])
    # Sums of integers below 2**53: exact in any order.
    at = np.floor((np.rint(units * _UNIT) @ steps + starts) / (WIDTH * _UNIT * _FINE))
    named = at.astype(np.int64).astype(np.uint64) * factors
    named = named.reshape(len(units), TABLES, HASHES).sum(axis=2, dtype=np.uint64)
    return mix(named + np.arange(TABLES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def sign_bits(units: np.ndarray) -> np.ndarray:
    signs = projections(units.shape[1])[2]
    found = (np.rint(units * _UNIT) @ signs) > 0
    return np.packbits(found, axis=1).view(np.int64).ravel()


def vector_groups(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and vectors of a batch whose last column holds them, by their length."""
    column = batch.column(batch.num_columns - 1)
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    # Null components become NaN.
    values = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == size)
        for part in np.array_split(rows, len(rows) * size // SLICE_VALUES + 1):
            if len(part):
                yield part, values[starts[part][:, None] + np.arange(size)]


def keys_of(vectors: np.ndarray) -> np.ndarray:
    """128 bits that name each vector; -0.0 is 0.0."""
    plain = np.ascontiguousarray(vectors + 0)
    return np.array([blake2b(row.tobytes(), digest_size=16).digest() for row in plain], "S16")


def _binary(keys: np.ndarray) -> pa.Array:
    flat = np.frombuffer(keys.tobytes(), np.uint8)
    offsets = pa.py_buffer(np.arange(0, len(flat) + 1, 16, dtype=np.int32))
    return pa.Array.from_buffers(pa.binary(), len(keys), [None, offsets, pa.py_buffer(flat)])


def _short(keys: np.ndarray) -> np.ndarray:
    return np.frombuffer(keys.tobytes(), np.int64)[::2]


def keyed(rows: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, key) of every row; the key is null where nothing can be linked."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            keys: list[bytes | None] = [None] * batch.num_rows
            for part, vectors in vector_groups(batch):
                good = unit(vectors)[1]
                flat = keys_of(vectors[good]).tobytes()
                for place, row in enumerate(part[good].tolist()):
                    keys[row] = flat[16 * place : 16 * place + 16]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary())], [id, "key"])

    kind = rows.schema[id].dataType.simpleString()
    return map_arrow(rows.select(id, vector), run, f"`{id}` {kind}, key binary")


def classes_of(rows: DataFrame, vector: str) -> DataFrame:
    """(key, short, vector, n): different vectors with their numbers of copies, as far as
    one batch tells; the sum over all batches is taken by `_whole`."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for _, vectors in vector_groups(batch):
                good = unit(vectors)[1]
                keys = keys_of(vectors[good])
                if not len(keys):
                    continue
                different, first, n = np.unique(keys, return_index=True, return_counts=True)
                kept = vectors[good][first]
                places = np.arange(0, kept.size + 1, kept.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        _binary(different), pa.array(_short(different)),
                        pa.ListArray.from_arrays(pa.array(places), pa.array(kept.ravel())), pa.array(n),
                    ],
                    ["key", "short", "vector", "n"],
                )

    kind = rows.schema[vector].dataType.simpleString()
    return map_arrow(rows.select(vector), run, f"key binary, short long, vector {kind}, n long")


def _whole(classes: DataFrame) -> DataFrame:
    """One row a class; dealt out by `short`, which later joins use, too."""
    return classes.repartition("short").groupBy("key", "short").agg(
        F.first("vector").alias("vector"), F.sum("n").alias("n")
    )


def entries(rows: DataFrame, vector: str, share: int = 1) -> DataFrame:
    """(bucket, short, signs) of all different vectors, or of one in `share` of them."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for _, vectors in vector_groups(batch):
                units, good = unit(vectors)
                keys = keys_of(vectors[good])
                if not len(keys):
                    continue
                different, first = np.unique(keys, return_index=True)
                short, units = _short(different), units[good][first]
                drawn = short % share == 0
                short, units = short[drawn], units[drawn]
                if len(short):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(buckets(units).ravel()), pa.array(np.repeat(short, TABLES)),
                            pa.array(np.repeat(sign_bits(units), TABLES)),
                        ],
                        ["bucket", "short", "signs"],
                    )

    return map_arrow(rows.select(vector), run, "bucket long, short long, signs long")


def large_buckets(rows: DataFrame, vector: str) -> DataFrame:
    """(bucket, blocks) of buckets that fill more than one block."""
    drawn = entries(rows, vector, SAMPLE).groupBy("bucket").agg(F.countDistinct("short").alias("n"))
    return drawn.where(F.col("n") * SAMPLE > BLOCK).select(
        "bucket", F.ceil(F.col("n") * SAMPLE / BLOCK).cast("int").alias("blocks")
    )


def groups(batches: Batches, names: tuple[str, ...], most: int) -> Iterator[tuple[pa.Table, bool]]:
    """Rows sorted by `names` as one table per group, and whether it is whole. A group of
    more than `most` rows comes in several tables, none of which is called whole."""
    rest: pa.Table | None = None
    torn = False
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        ids = [table.column(name).to_numpy() for name in names]
        change = np.flatnonzero(np.any([x[1:] != x[:-1] for x in ids], axis=0)) + 1
        starts = [0, *change.tolist()]
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            yield table.slice(a, b - a), not torn
            torn = False
        rest = table.slice(starts[-1])
        if rest.num_rows > most:
            yield rest, False
            rest, torn = rest.slice(0, 1), True
    if rest is not None and rest.num_rows:
        yield rest, not torn


def live_entries(found: DataFrame) -> DataFrame:
    """(bucket, short) of entries that share their bucket with one of similar signs."""

    def run(batches: Batches) -> Batches:
        buckets_, shorts = [], []
        for table, whole in groups(batches, ("bucket",), 2 * BLOCK):
            if table.num_rows == 1 and whole:
                continue
            short, first = np.unique(table.column("short").to_numpy(), return_index=True)
            if whole:
                signs = table.column("signs").to_numpy()[first].view(np.uint64)
                near = np.zeros(len(short), bool)
                for a in range(0, len(short), ROWS):
                    other = np.bitwise_count(signs[a : a + ROWS, None] ^ signs[None, :])
                    near[a : a + ROWS] = (other <= NEAR_SIGNS).sum(axis=1) > 1
                short = short[near]
            if len(short):
                buckets_.append(np.full(len(short), table.column("bucket")[0].as_py(), np.int64))
                shorts.append(short)
            if sum(map(len, shorts)) > BLOCK:
                yield pa.RecordBatch.from_pydict({"bucket": np.concatenate(buckets_), "short": np.concatenate(shorts)})
                buckets_, shorts = [], []
        if shorts:
            yield pa.RecordBatch.from_pydict({"bucket": np.concatenate(buckets_), "short": np.concatenate(shorts)})

    dealt = found.repartition("bucket").sortWithinPartitions("bucket")
    return map_arrow(dealt, run, "bucket long, short long")


def compare(cell: pa.Table, cosine: float) -> tuple[list[bytes], list[int], list[tuple[bytes, bytes]]]:
    """Classes of a cell with links counted here, their numbers, and the links that join
    the cell's components."""
    keys, first = np.unique(np.array(cell.column("key").to_pylist(), "S16"), return_index=True)
    cell = cell.take(pa.array(first)).combine_chunks()
    column = cell.column("vector").combine_chunks()
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    if len(keys) < 2 or len(set(sizes.tolist())) > 1:
        # Two lengths in one bucket, by a chance of 64 bits: each is compared alone.
        parts = [cell.filter(pa.array(sizes == size)) for size in set(sizes.tolist())]
        found = [compare(part, cosine) for part in parts if part.num_rows > 1] if len(parts) > 1 else []
        return tuple(sum((f[k] for f in found), []) for k in range(3))
    units = unit(column.flatten().to_numpy(zero_copy_only=False).reshape(len(keys), -1))[0]
    own, n = cell.column("own").to_numpy(), cell.column("n").to_numpy()
    across = cell.column("i")[0].as_py() != cell.column("j")[0].as_py()
    named = buckets(units)
    table = int(np.argmax(named[0] == cell.column("bucket")[0].as_py()))
    links = np.zeros(len(keys), np.int64)
    part = np.arange(len(keys))
    joined = []
    for a in range(0, len(keys), ROWS):
        rows = slice(a, min(a + ROWS, len(keys)))
        near = units[rows] @ units.T >= cosine
        near[np.arange(near.shape[0]), np.arange(rows.start, rows.stop)] = False
        if across:
            near &= own[rows, None] != own[None, :]
        if not near.any():
            continue
        for earlier in range(table):
            near &= named[rows, earlier, None] != named[None, :, earlier]
        links[rows] = near @ n
        for i in np.flatnonzero(near.any(axis=1)).tolist():
            of_row = part[a + i]
            others = np.flatnonzero(near[i] & (part != of_row))
            for other, at in zip(*np.unique(part[others], return_index=True), strict=True):
                joined.append((keys[a + i], keys[others[at]]))
                part[part == other] = of_row
    some = np.flatnonzero(links)
    return [keys[i] for i in some], links[some].tolist(), joined


def links_of(live: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """(a, b, n): n links of class a counted in a bucket (b is null), and links a, b."""
    # Block `own` of a bucket meets all blocks: the cell of blocks i <= j holds both.
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    cells = (
        live.join(classes, "short")
        .withColumn("own", own)
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "bucket", F.least("own", "j").alias("i"), F.greatest("own", "j").alias("j"), "own", "key", "vector", "n"
        )
    )
    place = ("bucket", "i", "j")
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("n", pa.int64())])

    def run(batches: Batches) -> Batches:
        for cell, _ in groups(batches, place, 1 << 40):
            keys, n, joined = compare(cell, cosine)
            if keys:
                # S16 drops trailing zero bytes; names have 16.
                a = [k.ljust(16, b"\0") for k in [*keys, *(x for x, _ in joined)]]
                b = [None] * len(keys) + [y.ljust(16, b"\0") for _, y in joined]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n + [0] * len(joined), pa.int64())],
                    schema=schema,
                )

    dealt = cells.repartition(*place).sortWithinPartitions(*place)
    return map_arrow(dealt, run, "a binary, b binary, n long")


def find(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """One row per vector: id, n_links (vectors linked directly), component_id (the smallest
    id that links lead to, itself included), kept (id = component_id)."""
    kind = rows.schema[vector].dataType.simpleString()
    of_vector = F.col(vector) if kind == "array<float>" else F.col(vector).cast("array<double>")
    rows = rows.select(F.col(id).alias(id), of_vector.alias("_vector"))

    found = entries(rows, "_vector")
    large = materialize(large_buckets(rows, "_vector"), "large-buckets")
    if large.isEmpty():
        live = live_entries(found).withColumn("blocks", F.lit(1))
    else:
        # Entries of large buckets live on without being gathered.
        small = live_entries(found.join(large, "bucket", "left_anti")).withColumn("blocks", F.lit(1))
        live = small.unionByName(found.join(large, "bucket").select("bucket", "short", "blocks").distinct())
    live = materialize(live, "live")
    linked = materialize(links_of(live, _whole(classes_of(rows, "_vector")), cosine), "vector-links")

    known = materialize(keyed(rows, id, "_vector"), "vector-keys")
    copies = known.where("key is not null").groupBy("key").agg(
        F.min(id).alias("least"), F.count(F.lit(1)).alias("n")
    )
    counted = linked.where("b is null").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("links"))
    edges = linked.where("b is not null").select("a", "b")
    several = copies.join(counted, "key", "left").where("n > 1 or links is not null")
    if not edges.isEmpty():
        several = several.join(components(edges), "key", "left")
    else:
        several = several.withColumn("component", F.lit(None).cast("binary"))
    several = several.withColumn("component", F.coalesce("component", "key"))
    names = several.groupBy("component").agg(F.min("least").alias("_component"))
    lookup = materialize(
        several.join(names, "component").select(
            "key", F.col("_component"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("_links"), "n"
        ),
        "vector-classes",
    )
    result = join_unique(
        known.withColumn("_row", F.monotonically_increasing_id()),
        lookup.select("key", "_component", "_links"), "key", lookup.select("key", "n"), is_small(lookup), "left",
    )
    component = F.when(F.col("_links").isNull(), F.col(id)).otherwise(F.col("_component"))
    return result.select(
        id,
        F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col(id).eqNullSafe(component).alias("kept"),
    )


def oracle() -> str:
    """SQL for `find` over `embeddings`, comparing all pairs. Hashing finds the same links
    except with the chance that the module states."""
    return f"""
    WITH RECURSIVE rows AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    good AS (SELECT r, vec_id, v FROM rows WHERE len(v) > 0 AND list_count(v) = len(v)
             AND len(list_filter(v, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
    links AS (SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON a.r <> b.r AND len(a.v) = len(b.v)
              WHERE list_cosine_similarity(a.v, b.v) >= {COSINE}),
    reached(a, b) AS (SELECT r, r FROM rows UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
    parts AS (SELECT reached.a AS r, min(rows.vec_id) AS component_id
              FROM reached JOIN rows ON rows.r = reached.b GROUP BY reached.a),
    counts AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
    FROM rows JOIN parts USING (r) LEFT JOIN counts USING (r)
    """
