"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A document is the set of digests of its paragraphs; a paragraph is a line, cut at sentence
ends, and from the LONG-th character after one also before words that begin with one of
LONG_CUTS, so that an edit touches few of them and moves no far cut. A sketch has 3 * width cells, and each digest
falls into one cell of each third. A cell holds how many digests fell into it, their XOR,
and the XOR of their checks. Subtracting the sketches of two versions leaves the digests
that differ; peeling recovers them: a cell with one digest gives it away, which is then
taken out of its other cells.

If peeling gets stuck, there are more differences than the sketch can hold. Then both sets
are dealt by digest into groups of about GROUP digests and each group is sketched and
peeled, again with wider sketches where that fails, and in the last resort compared digest
by digest. So cost grows with the number of paragraphs, not with its square.

All of it is DataFrame functions over one row; only finding each document's successor
moves rows.

Defined cases: a null text is an empty one; an empty text has no digests, and two of them
are alike (1.0); texts that differ in white space between paragraphs only have one
fingerprint; a long run without a word that LONG_CUTS begin is one paragraph; an only document is its own successor; documents that repeat an id follow
each other in the order of their text's hash; documents without an id come last; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.operators.scratch import materialize

LONG = 120
# About one word in eight; Latin, Greek, Cyrillic, digits.
LONG_CUTS = "FMVWfmvwΜΚμκБЗМбзм37"
PARAGRAPH_END = rf"\s*\n\s*|(?<=[.!?]) +| (?=[{LONG_CUTS}])(?<=[^.!?\n]{{{LONG}}} )"
# Cells per third of the fingerprint, and of the sketches of groups, tried in this order:
# powers of two.
WIDTH = 16
GROUP_WIDTHS = (8, 32)
GROUP = 8
ROUNDS = 24

# Ids in one block of successors, and blocks in one super-block.
BLOCK = 2048
SUPER = 4096


def digests(text: Column) -> Column:
    """Distinct digests of the paragraphs of a text."""
    parts = F.filter(F.split(text, PARAGRAPH_END), lambda p: p != "")
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def check(digest: Column) -> Column:
    return F.hash(digest)


def cell_of(digest: Column, third: int, width: int) -> Column:
    """Which cell of a third a digest falls into: other bits for each third. The width is
    a power of two."""
    return F.shiftrightunsigned(digest, 21 * third).bitwiseAND(F.lit(width - 1).cast("long"))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What `use` makes of a value that is worked out once."""
    return F.transform(F.array(value), use)[0]


def sketch(values: Column, width: int) -> Column:
    """The cells (n, key, check) of a set of digests: one array for each third."""
    return _cells(values, width, F.size)


def difference_sketch(a: Column, b: Column, width: int) -> Column:
    """What subtracting the sketch of b from that of a gives, put together at once: an XOR
    takes out what it has put in, and the digests of b count down."""
    return _once(_signed(a, b), lambda values: signed_sketch(values, width))


def _signed(a: Column, b: Column, **more: Callable[[Column], Column]) -> Column:
    """The digests of a with sign 1 and those of b with sign -1, and what more each carries."""

    def with_sign(values: Column, sign: int) -> Column:
        return F.transform(
            values,
            lambda d: F.struct(
                *[f(d).alias(name) for name, f in more.items()], d.alias("digest"), F.lit(sign).alias("sign")
            ),
        )

    return F.concat(with_sign(a, 1), with_sign(b, -1))


def signed_sketch(values: Column, width: int) -> Column:
    """The cells of digests with signs."""
    return _cells(values, width, lambda inside: F.aggregate(inside, F.lit(0), lambda n, x: n + x["sign"]), signed=True)


def _cells(values: Column, width: int, count: Callable[[Column], Column], signed: bool = False) -> Column:
    def placed(value: Column) -> Column:
        digest = value["digest"] if signed else value
        places = [cell_of(digest, third, width).alias(f"place{third}") for third in range(3)]
        sign = [value["sign"].alias("sign")] if signed else []
        return F.struct(*places, digest.alias("digest"), check(digest).alias("check"), *sign)

    def cell(inside: Column) -> Column:
        def of(n: Column, key: Column, checks: Column) -> Column:
            return F.struct(n.alias("n"), key.alias("key"), checks.alias("check"))

        only = inside[0]
        several = of(
            count(inside),
            F.aggregate(inside, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x["digest"])),
            F.aggregate(inside, F.lit(0), lambda a, x: a.bitwiseXOR(x["check"])),
        )
        # Most cells of a group's sketch hold one digest or none.
        return (
            F.when(F.size(inside) == 0, of(F.lit(0), F.lit(0).cast("long"), F.lit(0)))
            .when(F.size(inside) == 1, of(only["sign"] if signed else F.lit(1), only["digest"], only["check"]))
            .otherwise(several)
        )

    def cells(all_placed: Column, third: int) -> Column:
        inside = lambda place: F.filter(all_placed, lambda x: x[f"place{third}"] == place)
        return F.transform(_places(width), lambda place: _once(inside(place), cell))

    return _once(F.transform(values, placed), lambda p: F.array(*[cells(p, third) for third in range(3)]))


def _places(width: int) -> Column:
    return F.array(*[F.lit(i).cast("long") for i in range(width)])


def subtract(a: Column, b: Column) -> Column:
    """Cells of the digests that only one of two sketches of the same width holds."""

    def difference(x: Column, y: Column) -> Column:
        return F.struct(
            (x["n"] - y["n"]).alias("n"),
            x["key"].bitwiseXOR(y["key"]).alias("key"),
            x["check"].bitwiseXOR(y["check"]).alias("check"),
        )

    return F.zip_with(a, b, lambda x, y: F.zip_with(x, y, difference))


_NO_DIGESTS = "array<bigint>"


def _is_left(c: Column) -> Column:
    return (c["n"] != 0) | (c["key"] != 0) | (c["check"] != 0)


def peel(cells: Column, width: int) -> Column:
    """(found, whole): the differing digests that peeling recovers, and whether all were."""

    def is_pure(c: Column) -> Column:
        return (F.abs(c["n"]) == 1) & (check(c["key"]) == c["check"])

    def pure(thirds: Column) -> Column:
        def placed(c: Column) -> Column:
            places = [cell_of(c["key"], third, width).cast("int").alias(f"place{third}") for third in range(3)]
            return F.struct(*[c[name].alias(name) for name in ("n", "key", "check")], *places)

        return F.transform(F.array_distinct(F.filter(F.flatten(thirds), is_pure)), placed)

    def without(thirds: Column, taken: Column) -> Column:
        def less(c: Column, t: Column) -> Column:
            # The check of a pure cell is that of its digest.
            return F.struct(
                (c["n"] - t["n"]).alias("n"),
                c["key"].bitwiseXOR(t["key"]).alias("key"),
                c["check"].bitwiseXOR(t["check"]).alias("check"),
            )

        def rest(third: int) -> Column:
            def one(c: Column, i: Column) -> Column:
                # Nothing is taken out of an empty cell.
                mine = F.filter(taken, lambda t: t[f"place{third}"] == i)
                return F.when(_is_left(c), F.aggregate(mine, c, less)).otherwise(c)

            return F.transform(thirds[third], one)

        return F.array(*[rest(third) for third in range(3)])

    def emptied(thirds: Column) -> Column:
        return ~F.exists(F.flatten(thirds), _is_left)

    def step(state: Column, _: Column) -> Column:
        def taken_out(taken: Column) -> Column:
            stuck = F.size(taken) == 0
            return F.struct(
                # The rounds after the last one carry no cells.
                F.when(stuck, F.slice(state["cells"], F.lit(1), F.lit(0))).otherwise(without(state["cells"], taken)).alias("cells"),
                F.concat(state["found"], F.transform(taken, lambda t: t["key"])).alias("found"),
                F.when(stuck, emptied(state["cells"])).alias("whole"),
            )

        return F.when(state["whole"].isNotNull(), state).otherwise(_once(pure(state["cells"]), taken_out))

    start = F.struct(
        cells.alias("cells"), F.array().cast(_NO_DIGESTS).alias("found"), F.lit(None).cast("boolean").alias("whole")
    )
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        start,
        step,
        lambda end: F.struct(
            end["found"].alias("found"), F.coalesce(end["whole"], emptied(end["cells"])).alias("whole")
        ),
    )


def _if_whole(peeled: Column, otherwise: Column) -> Column:
    """The number of digests found, or `otherwise` if some were not."""
    answer = lambda r: F.when(r["whole"], F.size(r["found"])).otherwise(otherwise)
    return _once(peeled, answer)


def differing_in_groups(a: Column, b: Column) -> Column:
    """Number of differing digests, group by group."""
    groups = F.greatest(F.ceil((F.size(a) + F.size(b)) / GROUP), F.lit(1)).cast("long")

    def of_sign(values: Column, sign: int) -> Column:
        return F.transform(F.filter(values, lambda x: x["sign"] == sign), lambda x: x["digest"])

    def differing(values: Column) -> Column:
        a, b = of_sign(values, 1), of_sign(values, -1)
        found = F.size(F.array_except(a, b)) + F.size(F.array_except(b, a))
        for width in reversed(GROUP_WIDTHS):
            found = _if_whole(peel(signed_sketch(values, width), width), found)
        return found

    def of_groups(dealt: Column) -> Column:
        return F.aggregate(_of_runs(dealt, "group", differing), F.lit(0), lambda total, n: total + n)

    def dealt(groups: Column) -> Column:
        group = lambda d: F.pmod(F.shiftrightunsigned(d, 48), groups).cast("int")
        return F.sort_array(_signed(a, b, group=group))

    return _once(_once(groups, dealt), of_groups)


def _of_runs(ordered: Column, name: str, use: Callable[[Column], Column]) -> Column:
    """What `use` makes of each run of a list of structs that is ordered by a field: the
    structs of one value of it."""
    starts = F.filter(
        F.sequence(F.lit(1), F.size(ordered)), lambda i: (i == 1) | (ordered[i - 1][name] != ordered[i - 2][name])
    )

    def of_each(starts: Column) -> Column:
        def of_run(start: Column, i: Column) -> Column:
            end = F.coalesce(F.get(starts, i + 1), F.size(ordered) + 1)
            return _once(F.slice(ordered, start, end - start), use)

        return F.transform(starts, of_run)

    none = F.array().cast("array<int>")
    return _once(F.when(F.size(ordered) == 0, none).otherwise(starts), of_each)


def likeness(a: Column, b: Column, sketch_a: Column, sketch_b: Column) -> Column:
    """Shared share of all digests of two documents, from the recovered differences."""
    differing = _if_whole(peel(subtract(sketch_a, sketch_b), WIDTH), differing_in_groups(a, b))
    total = F.size(a) + F.size(b)
    share = lambda d: F.when(total == 0, 1.0).otherwise((total - d) / (total + d))
    return _once(differing, share).cast("double")


def serialized(cells: Column) -> Column:
    """A sketch as text: 14 bytes a cell, in base 64."""

    def one(c: Column) -> Column:
        return F.concat(
            F.lpad(F.hex(c["n"].bitwiseAND(F.lit(0xFFFF))), 4, "0"),
            F.lpad(F.hex(c["key"]), 16, "0"),
            F.lpad(F.hex(c["check"].cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"),
        )

    # Java's line breaks every 76 characters are taken out.
    return F.translate(F.base64(F.unhex(F.array_join(F.transform(F.flatten(cells), one), ""))), "\r\n", "")


def with_successors(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, text, digests, next_text, next_digests): every document with the next one in
    descending order of ids; the first follows the last.

    Blocks of BLOCK ids are sorted one by one; each also gets, as a guest, the first
    document of the next lower block. Only the first ids of blocks are compared globally.
    """
    lowest = F.lit(-(1 << 62))
    rows = docs.select(F.col(id), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("_block", F.floor(F.coalesce(F.col(id).cast("long"), lowest) / BLOCK))
    rows = rows.withColumn("_block", F.coalesce("_block", F.lit(0)))
    tops = rows.groupBy("_block").agg(F.max(id).alias("_top"))
    tops = materialize(tops.withColumn("_super", F.floor(F.col("_block") / SUPER)), "block-tops")
    # One row per BLOCK * SUPER ids.
    supers = tops.groupBy("_super").agg(F.min("_block").alias("_low"))
    above = Window.orderBy("_super")
    whole = above.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    supers = supers.withColumn("_above", F.coalesce(F.lead("_low").over(above), F.first("_low").over(whole)))
    inside = F.lead("_block").over(Window.partitionBy("_super").orderBy("_block"))
    guests = materialize(
        tops.withColumn("_inside", inside)
        .join(supers, "_super")
        .select("_top", F.col("_block").alias("_of"), F.coalesce("_inside", "_above").alias("_to")),
        "guests",
    )
    is_top = F.col("_block") == F.col("_of")
    joined = rows.join(guests, F.col(id).eqNullSafe(F.col("_top")) & is_top, "left")
    places = F.filter(
        F.array(
            F.struct(F.col("_block").alias("block"), F.lit(False).alias("guest")),
            F.struct(F.col("_to").alias("block"), F.lit(True).alias("guest")),
        ),
        lambda p: p["block"].isNotNull(),
    )
    dealt = joined.select(id, "text", digests(F.col("text")).alias("digests"), F.explode(places).alias("_place"))
    order = Window.partitionBy("_place.block").orderBy(
        "_place.guest", F.col(id).desc_nulls_last(), F.xxhash64("text")
    )
    following = dealt.select(
        id,
        "text",
        "digests",
        F.lead("text").over(order).alias("next_text"),
        F.lead("digests").over(order).alias("next_digests"),
        F.col("_place.guest").alias("_guest"),
    )
    return following.where(~F.col("_guest")).drop("_guest")


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `fingerprint` appended, a sketch of the whole text."""
    found = sketch(digests(F.coalesce(F.col(text), F.lit(""))), WIDTH)
    return docs.withColumn("fingerprint", serialized(found))


def edits(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    The edited text has its last third (rounded down) replaced by the beginning of the
    next document's.
    """
    n, third = F.length("text"), F.floor(F.length("text") / 3).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), n - third)
    edited = F.concat(kept, F.substring(F.col("next_text"), F.lit(1), third))
    both = with_successors(docs, id, text).select(
        id, n.cast("long").alias("n_chars"), "digests", "next_digests", edited.alias("edited")
    )
    parts = both.select(
        id,
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "digests",
        "next_digests",
        digests(F.col("edited")).alias("edited_digests"),
    )
    cells = parts.withColumns(
        {
            "cells": sketch(F.col("digests"), WIDTH),
            "edited_cells": sketch(F.col("edited_digests"), WIDTH),
            "next_cells": sketch(F.col("next_digests"), WIDTH),
        }
    )
    near = lambda other: likeness(
        F.col("digests"), F.col(f"{other}_digests"), F.col("cells"), F.col(f"{other}_cells")
    )
    return cells.select(
        id,
        "n_chars",
        "edited_sha256",
        serialized(F.col("cells")).alias("fingerprint"),
        serialized(F.col("edited_cells")).alias("edited_fingerprint"),
        near("edited").alias("near_edited"),
        near("next").alias("near_next"),
    )
