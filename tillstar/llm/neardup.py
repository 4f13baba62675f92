"""MinHash near-duplicates by a signature-coordinate inverted join.

1. Every text becomes the set of its distinct word shingles and a signature of HASHES
   minimum hashes. Texts with one set form a class; only classes go on.
2. A class is posted under its (coordinate, value) pairs, taken in runs of RUN neighbouring
   coordinates. Two signatures that agree in LEAST whole runs share one of the
   HASHES / RUN - LEAST + 1 rarest of each (prefix filter in order of frequency); runs that
   occur once join nothing and are skipped. Passages that many documents share are frequent,
   so they come last. Of lists with the same members one is read.
3. In each posting list the smallest class, its hub, meets the others; collisions are
   counted over whole signatures, and pairs with enough of them are confirmed on the full
   shingle sets. Confirmed links join classes to components.
4. A list whose members all are in one component is done: further links would change
   nothing. In the others members meet in blocks of bounded rows and shingles: first each
   member in one block, dealt out anew in every list, so that near copies hang together
   after rows in proportion; then, in the lists of several blocks that are still open,
   every member outside the list's main component meets all members of other components,
   block by block. Collisions are
   counted in 8 bits a coordinate (never too few), then full sets are compared in the
   block, and only links that join two components of the block are put out, fewer than it
   has members.

No pair is dropped by a cap; copies and groups that hang together are never expanded into
all pairs. A link of similarity 0.8 is missed with a probability of about 4e-6 per pair (8e-7
for fewer than 36 matches of 66, 3.4e-6 for fewer than 2 whole runs of 22), a closer one far
less often. Sets are compared by 64-bit hashes of their shingles.

Defined cases: a text without words (null and empty ones, too) has the empty set, is
linked with nothing and kept; a text of fewer words than a shingle has one shingle, the
whole sequence; rows are judged one by one, and a repeated id only names its rows alike;
rows without an id are linked like others, but never name a component, and are not kept
unless all of their component have no id; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.arrays import Words, map_arrow, map_slices, mix, strings
from tillstar.operators.scratch import materialize

WORDS = 5
PERCENT = 80
HASHES = 66
MATCHES = 36
# Neighbouring coordinates that are posted as one, and how many such runs agree at least.
RUN = 3
LEAST = 2
# Members of a posting list, and shingles of theirs, that meet in one block.
BLOCK = 512
BLOCK_SHINGLES = 1 << 19
# Bits that tell, before texts are hashed again, most documents whose sets are not needed;
# more documents than bits only let more pass. Spark aggregates bits in groups of 1 << 15.
FILTER = 1 << 25
FILTER_GROUP = 1 << 15
# Text bytes hashed at once; a byte takes about 40 bytes on the way.
SLICE_BYTES = 1 << 20

# A word is a run of bytes other than white space.
IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

_RANDOM = np.random.Generator(np.random.PCG64(64))
_MASKS = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_FACTORS = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingles(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and the offsets of each text's."""
    words = Words(column, IS_WORD)
    counts = np.diff(words.offsets)
    n = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    offsets = np.concatenate(([0], np.cumsum(n)))
    first = np.repeat(words.offsets[:-1], n) + np.arange(offsets[-1]) - np.repeat(offsets[:-1], n)
    sizes = np.repeat(np.minimum(counts, width), n)
    hashes = sizes.astype(np.uint64)
    for k in range(width):
        word = words.hash[np.minimum(first + k, len(words) - 1)] if len(words) else words.hash
        hashes = np.where(k < sizes, hashes * _STEP + word, hashes)
    hashes = mix(hashes)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        hashes[a:b].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[offsets[:-1][n > 0]] = True
    kept = np.concatenate(([0], np.cumsum(new)))[offsets]
    return hashes[new], kept


def set_keys(hashes: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """128 bits that name each set; null for empty ones."""
    full = np.diff(offsets) > 0
    key = np.zeros((len(full), 2), np.uint64)
    if full.any():
        starts = offsets[:-1][full]
        key[full, 0] = np.add.reduceat(mix(hashes ^ _STEP), starts)
        key[full, 1] = np.add.reduceat(mix(hashes * _STEP), starts)
    rows = [row.tobytes() if ok else None for row, ok in zip(key, full, strict=True)]
    return pa.array(rows, pa.binary())


def signatures(docs: DataFrame, id: str, text: str, width: int) -> DataFrame:
    """(id, n_shingles, key, signature) of every row."""

    def run(batch: pa.RecordBatch) -> dict:
        hashes, offsets = shingles(strings(batch, text), width)
        sizes = np.diff(offsets)
        full = sizes > 0
        found = np.zeros((len(sizes), HASHES), np.uint32)
        if full.any():
            starts = offsets[:-1][full]
            for k in range(HASHES):
                values = (((hashes ^ _MASKS[k]) * _FACTORS[k]) >> np.uint64(32)).astype(np.uint32)
                found[full, k] = np.minimum.reduceat(values, starts)
        places = np.arange(0, len(sizes) * HASHES + 1, HASHES, dtype=np.int32)
        return {
            id: batch.column(0),
            "n_shingles": pa.array(sizes.astype(np.int64)),
            "key": set_keys(hashes, offsets),
            "signature": pa.ListArray.from_arrays(pa.array(places), pa.array(found.view(np.int32).ravel())),
        }

    schema = f"`{id}` {docs.schema[id].dataType.simpleString()}, n_shingles long, key binary, signature array<int>"
    return map_slices(docs.select(id, text), run, schema, text, SLICE_BYTES)


def filter_bits(ids: DataFrame, id: str) -> np.ndarray:
    """FILTER bits, of which those that some id's hash names are set."""
    place = F.pmod(F.xxhash64(id), F.lit(FILTER))
    group, bit = F.floor(place / FILTER_GROUP).alias("group"), F.pmod(place, F.lit(FILTER_GROUP)).alias("bit")
    found = np.zeros((FILTER // FILTER_GROUP, FILTER_GROUP // 8), np.uint8)
    for row in ids.select(group, bit).groupBy("group").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        found[row["group"]] = np.frombuffer(row["bits"], np.uint8)
    return found.ravel()


def shingle_sets(docs: DataFrame, id: str, text: str, width: int, ids: DataFrame) -> DataFrame:
    """(key, members) of every text with words of a document in `ids`, and of a few others:
    its sorted shingle hashes."""
    bits = filter_bits(ids, id)

    def run(batch: pa.RecordBatch) -> dict:
        place = batch.column(1).to_numpy()
        batch = batch.filter(pa.array((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1))
        hashes, offsets = shingles(strings(batch, text), width)
        members = [hashes[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return {"key": set_keys(hashes, offsets), "members": pa.array(members, pa.binary())}

    placed = docs.select(text, F.pmod(F.xxhash64(id), F.lit(FILTER)).alias("_place"))
    return map_slices(placed, run, "key binary, members binary", text, SLICE_BYTES).where("key is not null")


def postings(classes: DataFrame) -> DataFrame:
    """(token, key, n_shingles): each class under the rarest runs of (coordinate, value) pairs
    of its signature, as far as another class is there, too; of lists with the same members
    only one."""
    # 64 bits stand for the key on the way; should two keys share them, each just gets the
    # postings of both.
    short = F.xxhash64("key").alias("short")
    value = F.col("signature")
    runs = [F.xxhash64(F.lit(k), *[value[k + i] for i in range(RUN)]) for k in range(0, HASHES, RUN)]
    tokens = classes.select(short, F.explode(F.array(*runs)).alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ranked = tokens.join(shared, "token").groupBy("short").agg(
        F.sort_array(F.collect_list(F.struct("n", "token"))).alias("pairs")
    )
    # Runs that occur once come first in the order, so they use up the prefix.
    kept = F.size("pairs") - (LEAST - 1)
    listed = ranked.where(kept > 0).select(
        "short", F.explode(F.slice("pairs", F.lit(1), kept)).alias("pair")
    )
    listed = materialize(listed.select(F.col("pair.token").alias("token"), "short"), "prefixes")
    # The members of a list, named by their number and 128 bits.
    named = (F.bit_xor("short").alias("one"), F.bit_xor(F.xxhash64("short", F.lit(1))).alias("other"))
    lists = listed.groupBy("token").agg(F.count(F.lit(1)).alias("n"), *named).where("n > 1")
    lists = lists.groupBy("n", "one", "other").agg(F.min("token").alias("token")).select("token")
    known = classes.select(short, "key", "n_shingles")
    return listed.join(lists, "token", "left_semi").join(known, "short").select("token", "key", "n_shingles")


def hub_pairs(posted: DataFrame) -> DataFrame:
    """(a, b): the smallest class of each posting list with each of the others."""
    hubs = posted.groupBy("token").agg(F.min("key").alias("a"))
    pairs = posted.join(hubs, "token").where("key != a")
    return pairs.select("a", F.col("key").alias("b")).distinct()


def enough_collisions(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose signatures agree in at least MATCHES coordinates."""
    known = classes.select("key", "signature")
    left = known.withColumnsRenamed({"key": "a", "signature": "of_a"})
    right = known.withColumnsRenamed({"key": "b", "signature": "of_b"})
    equal = F.zip_with("of_a", "of_b", lambda x, y: (x == y).cast("int"))
    count = F.aggregate(equal, F.lit(0), lambda total, x: total + x)
    return pairs.join(right, "b").join(left, "a").where(count >= MATCHES).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union of their full shingle sets."""
    left = sets.withColumnsRenamed({"key": "a", "members": "of_a"})
    right = sets.withColumnsRenamed({"key": "b", "members": "of_b"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if min(len(p), len(q)) * 100 < percent * max(len(p), len(q)):
                    keep.append(False)
                    continue
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "of_a", "of_b")
    return map_arrow(joined, run, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """(key, component) of all linked classes: the smallest key that links lead to."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialize(both.distinct(), "links")
    labels = materialize(
        edges.groupBy(F.col("a").alias("key")).agg(F.least("key", F.min("b")).alias("component")), "labels"
    )
    while True:
        near = edges.join(labels.withColumnRenamed("key", "b"), "b").groupBy(F.col("a").alias("key"))
        lower = labels.join(near.agg(F.min("component").alias("seen")), "key").select(
            "key", F.least("component", "seen").alias("component"), F.col("component").alias("before")
        )
        lower = materialize(lower, "labels")
        # Follow the label's own label.
        up = lower.select(F.col("key").alias("component"), F.col("component").alias("above"))
        labels = materialize(
            lower.join(up, "component", "left").select(
                "key",
                F.coalesce("above", "component").alias("component"),
                (F.coalesce("above", "component") != F.col("before")).alias("changed"),
            ),
            "labels",
        )
        if labels.where("changed").isEmpty():
            return labels.select("key", "component")
        labels = labels.select("key", "component")


def open_lists(posted: DataFrame, found: DataFrame) -> DataFrame:
    """(token, key, n_shingles, component, hub, main, others, blocks): the members of lists that have
    several components; `others` and `blocks` are the numbers of blocks of the members
    outside the main component, and of all."""
    labelled = posted.join(found, "key", "left").withColumn("component", F.coalesce("component", "key"))
    sizes = labelled.groupBy("token", "component").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("shingles"), F.min("key").alias("least")
    )
    lists = sizes.groupBy("token").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"),
        F.max(F.struct("n", "component", "shingles")).alias("most"),
        F.sum("n").alias("n"),
        F.sum("shingles").alias("shingles"),
        F.min("least").alias("hub"),
    )

    def blocks(n: Column, shingles: Column) -> Column:
        return F.greatest(F.ceil(n / BLOCK), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")

    n, shingles = F.col("n"), F.col("shingles")
    # Beside the hub, two members of different components are needed.
    chosen = lists.where("n > 2 and n > most.n").select(
        "token",
        "hub",
        "main",
        blocks(n - F.col("most.n"), shingles - F.col("most.shingles")).alias("others"),
        blocks(n, shingles).alias("blocks"),
    )
    return labelled.join(chosen, "token")


def dealt_once(members: DataFrame) -> DataFrame:
    """Every member of open lists in one block; lists of one block need no more."""
    # With the token, so that near copies that share many lists meet others in each.
    block = F.pmod(F.xxhash64("key", "token"), "blocks").cast("int")
    probes = (F.col("component") != F.col("main")).alias("probes")
    return members.select(
        "token", "key", "component", "hub", probes, F.lit(True).alias("stays"), block.alias("i"), block.alias("j")
    )


def dealt_across(members: DataFrame) -> DataFrame:
    """Every member outside the main component (it probes) in all blocks of the others."""
    draw = F.xxhash64("key")
    columns = ("token", "key", "component", "hub")
    outside = members.where("component != main").select(
        *columns,
        F.lit(True).alias("probes"),
        F.lit(False).alias("stays"),
        F.pmod(draw, "others").cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"),
    )
    everyone = members.select(
        *columns,
        F.lit(False).alias("probes"),
        F.lit(True).alias("stays"),
        F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("i"),
        F.pmod(draw, "blocks").cast("int").alias("j"),
    )
    return outside.union(everyone)


def links_in_blocks(dealt: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links of members dealt to one block that join their components."""

    def brief(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1)
            low = values.flatten().to_numpy().astype(np.uint8).reshape(batch.num_rows, HASHES)
            columns = [batch.column(0), pa.array([row.tobytes() for row in low], pa.binary()), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "brief", "members"])

    group = ("token", "i", "j")
    held = classes.select("key", "signature").join(dealt.select("key").distinct(), "key", "left_semi").join(sets, "key")
    held = map_arrow(held.select("key", "signature", "members"), brief, "key binary, brief binary, members binary")
    met = dealt.join(held, "key").repartition(*group).sortWithinPartitions(*group)
    kind = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, group):
            a, b = meet(rows, percent)
            yield pa.RecordBatch.from_arrays([a, b], schema=kind)

    rows = met.select(*group, "key", "component", "hub", "probes", "stays", "brief", "members")
    return map_arrow(rows, run, "a binary, b binary").distinct()


def whole_groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[pa.Table]:
    """Sorted rows as one table per group."""
    rest: pa.Table | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        ids = [table.column(name).to_numpy() for name in names]
        change = np.flatnonzero(np.any([x[1:] != x[:-1] for x in ids], axis=0)) + 1
        starts = [0, *change.tolist()]
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            yield table.slice(a, b - a)
        rest = table.slice(starts[-1])
    if rest is not None and rest.num_rows:
        yield rest


def meet(rows: pa.Table, percent: int) -> tuple[pa.Array, pa.Array]:
    """Links of one block of a list that join its components."""
    rows = rows.combine_chunks()
    keys = rows.column("key").to_pylist()
    parts = rows.column("component").to_pylist()
    hub = rows.column("hub")[0].as_py()
    # The hub has met all.
    is_hub = np.array([key == hub for key in keys])
    probes = np.flatnonzero(rows.column("probes").to_numpy() & ~is_hub)
    every = np.flatnonzero(rows.column("stays").to_numpy() & ~is_hub)
    values = np.frombuffer(b"".join(rows.column("brief").to_pylist()), np.uint8).reshape(len(keys), -1)
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("members").combine_chunks()]
    sizes = np.array([len(x) for x in sets])
    # One number per component of the block; they merge as links join them.
    number = {part: i for i, part in enumerate(dict.fromkeys(parts))}
    part = np.array([number[x] for x in parts])
    a, b = [], []
    for i in probes.tolist():
        others = every[part[every] != part[i]]
        fits = np.minimum(sizes[others], sizes[i]) * 100 >= percent * np.maximum(sizes[others], sizes[i])
        others = others[fits]
        others = others[(values[others] == values[i]).sum(axis=1) >= MATCHES]
        if not len(others):
            continue
        both, union = overlaps(sets[i], [sets[j] for j in others])
        for j in others[100 * both >= percent * union].tolist():
            if part[j] == part[i]:
                continue
            a.append(min(keys[i], keys[j]))
            b.append(max(keys[i], keys[j]))
            part[part == part[j]] = part[i]
    return pa.array(a, pa.binary()), pa.array(b, pa.binary())


def overlaps(one: np.ndarray, others: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the intersections and unions of a sorted set with each of several, none of
    them empty."""
    sizes = np.array([len(x) for x in others])
    joined = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, joined), len(one) - 1)
    both = np.add.reduceat((one[at] == joined).astype(np.int64), np.cumsum(sizes) - sizes)
    return both, len(one) + sizes - both


def find(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per document: id, n_shingles, component_id (the smallest id of all documents
    that links lead to, itself included), kept (id = component_id)."""
    docs = docs.select(id, text)
    signed = materialize(signatures(docs, id, text, width), "signatures")
    classes = materialize(
        signed.where("key is not null")
        .groupBy("key")
        .agg(
            F.min(id).alias("least"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
        ),
        "classes",
    )
    posted = materialize(postings(classes), "postings")

    # The sets of all classes in a posting list, from their texts, which stay where they are.
    ids = classes.join(posted.select("key").distinct(), "key", "left_semi").select(F.col("least").alias(id))
    hashed = shingle_sets(docs, id, text, width, ids)
    sets = materialize(hashed.groupBy("key").agg(F.first("members").alias("members")), "sets")

    pairs = materialize(enough_collisions(hub_pairs(posted), classes), "pairs")
    links = materialize(confirmed(pairs, sets, percent), "links")
    found = components(links)
    members = materialize(open_lists(posted, found), "open-lists")
    if not members.isEmpty():
        links = links.union(materialize(links_in_blocks(dealt_once(members), classes, sets, percent), "links"))
        found = components(links)
        large = members.where("blocks > 1").select("token", "key", "n_shingles")
        members = materialize(open_lists(large, found), "open-lists")
        if not members.isEmpty():
            links = links.union(materialize(links_in_blocks(dealt_across(members), classes, sets, percent), "links"))
            found = components(links)

    labelled = classes.select("key", "least").join(found, "key")
    names = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    named = labelled.join(names, "component").select("key", F.col("component_id").alias("_linked"))
    of_class = classes.select("key", "least").join(named, "key", "left").select(
        "key", F.coalesce("_linked", "least").alias("_of_class")
    )
    # Texts without words have no key, and meet nothing.
    columns = (id, "n_shingles")
    judged = signed.where("key is not null").select(*columns, "key").join(of_class, "key", "left")
    alone = signed.where("key is null").select(*columns, F.col(id).alias("component_id"))
    every = judged.select(*columns, F.col("_of_class").alias("component_id")).union(alone)
    return every.withColumn("kept", F.col(id).eqNullSafe(F.col("component_id")))


def drop_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The rows of `docs`, all columns, that `find` keeps: one of each group, that of the
    smallest id. Rows with one id and text are one document; rows without an id stay only
    if their group has none with one."""
    digest = F.xxhash64(text)
    row = F.struct(F.col(id).isNull().alias("bare"), F.col(id).alias("id"), digest.alias("digest"))
    found = find(docs.select(row.alias("_row"), F.col(text).alias("text")), "_row", "text", width, percent)
    kept = found.where("kept").groupBy("_row").agg(F.count(F.lit(1)).alias("_n"))
    kept = materialize(kept.select("_row.id", "_row.digest", "_n"), "kept")
    repeated = not kept.where("_n > 1").isEmpty()
    same = F.col(id).eqNullSafe(F.col("_kept.id")) & (digest == F.col("_kept.digest"))
    wanted = kept.select(F.struct("id", "digest").alias("_kept")).hint("shuffle_hash")
    rows = docs.join(wanted, same, "left_semi")
    return rows.dropDuplicates([id, text]) if repeated else rows
