"""Quantiles with linear interpolation, exact at any number of distinct values.

Radix selection: every value has a 64-bit code in the order of the values (the bits of the
double). The first scan counts the values by the top BITS of their codes, for all columns
and ranks at once; each further scan counts the next bits, of those values only that share
their bits so far with a wanted rank. A rank whose bucket holds one value is found, so
there are at most 64 / BITS scans, and fewer for short numbers. Counts are combined before
the shuffle; the driver gets at most 2**BITS of them per column in the first scan, and per
wanted bucket in the others.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 16

# Of a double: bits of its fraction, its least normal exponent, its largest exponent.
_FRACTION, _LEAST, _MOST = 52, -1022, 1023


def with_codes(values: DataFrame, value: str = "value", code: str = "code") -> DataFrame:
    """Add a 64-bit integer in the order of doubles; null for null and NaN. Of x > 0 it has the
    bits of x, of -x it is the negative.

    Step by step, as each step is used more than once and should be computed once."""
    size, near, exponent = F.col("_size"), F.col("_near"), F.col("_exponent")
    two = F.lit(2.0)
    # log2 is off by less than one; the comparisons set it right. Powers of two are exact.
    right = near - (F.pow(two, near) > size).cast("long") + (F.pow(two, near + 1) <= size).cast("long")
    fraction = (size / F.pow(two, exponent) * F.lit(float(2**_FRACTION))).cast("long")
    bits = (
        F.when(size == 0, F.lit(0).cast("long"))
        .when(size == float("inf"), F.lit((_MOST - _LEAST + 2) * 2**_FRACTION))
        .otherwise((exponent - _LEAST) * F.lit(2**_FRACTION) + fraction)
    )
    finite = (size > 0) & (size < float("inf"))
    return (
        values.withColumn("_size", F.abs(F.nanvl(F.col(value), F.lit(None))))
        .withColumn("_near", F.when(finite, F.floor(F.log2(size))))
        .withColumn("_exponent", F.greatest(right, F.lit(_LEAST).cast("long")))
        .withColumn("_bits", bits)
        .withColumn(code, F.when(F.col(value) < 0, -F.col("_bits")).otherwise(F.col("_bits")))
        .drop("_size", "_near", "_exponent", "_bits")
    )


# Counts of a column's values by bucket, in order: (n, least, greatest).
_Buckets = dict[int, tuple[int, float, float]]


@dataclass
class _Rank:
    """A wanted rank of a column: the bits of its code found so far, and its place among the
    values that share them."""

    column: int
    place: int
    bucket: int | None = None
    value: float | None = None

    def find(self, inside: _Buckets) -> None:
        """Go to the bucket that holds the rank."""
        for bucket, (n, least, most) in inside.items():
            if self.place < n:
                self.bucket = bucket
                self.value = least if least == most else None
                return
            self.place -= n


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    accuracy: int | None = None,
    bits: int = BITS,
) -> DataFrame:
    """One row: for every column, an array with its quantiles (null without values)."""
    found = quantile_values(df, columns, probabilities, accuracy, bits)

    def array(values: list[float | None]) -> Column:
        filled = F.array(*[F.lit(v).cast("double") for v in values])
        return F.lit(None).cast("array<double>") if None in values else filled

    return df.sparkSession.range(1).select(*[array(found[c]).alias(c) for c in columns])


def quantile_values(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    accuracy: int | None = None,
    bits: int = BITS,
) -> dict[str, list[float | None]]:
    """The quantiles of every column, to be used as literals in later plans.

    Nulls and NaN are left out; a column without values has None for each. With
    `accuracy`, ranks are approximate to one part in `accuracy` and taken from existing
    values: one scan and no shuffle of values.
    """
    values = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])
    if accuracy is not None:
        asked = F.array(*map(F.lit, map(float, probabilities)))
        row = values.agg(*[F.percentile_approx(c, asked, accuracy).alias(c) for c in columns]).first()
        return {c: row[c] or [None] * len(probabilities) for c in columns}

    if not columns:
        return {}
    shift = 64 - bits
    counted = _counts(values, columns, [None] * len(columns), shift)
    totals = [sum(n for n, *_ in buckets.values()) for buckets in counted]
    # Where a quantile lies among the ranks 0 .. rows - 1.
    positions = {
        (i, p): float(p) * (rows - 1) for i, rows in enumerate(totals) if rows for p in probabilities
    }
    wanted = {
        (i, place): _Rank(i, place)
        for (i, _), position in positions.items()
        for place in (int(position), min(int(position) + 1, totals[i] - 1))
    }
    for rank in wanted.values():
        rank.find(counted[rank.column])
    while open_ := [rank for rank in wanted.values() if rank.value is None]:
        before, shift = shift, max(shift - bits, 0)
        prefixes: list[set[int] | None] = [set() for _ in columns]
        for rank in open_:
            prefixes[rank.column].add(rank.bucket)
        counted = _counts(values, columns, prefixes, shift, before)
        for rank in open_:
            inside = counted[rank.column].items()
            rank.find({b: n for b, n in inside if b >> (before - shift) == rank.bucket})

    def quantile(i: int, p: float) -> float | None:
        if (i, p) not in positions:
            return None
        position = positions[i, p]
        low = int(position)
        high = min(low + 1, totals[i] - 1)
        below, above = wanted[i, low].value, wanted[i, high].value
        return below if position == low or below == above else below + (above - below) * (position - low)

    return {c: [quantile(i, p) for p in probabilities] for i, c in enumerate(columns)}


def _counts(
    values: DataFrame,
    columns: Sequence[str],
    prefixes: Sequence[set[int] | None],
    shift: int,
    before: int = 64,
) -> list[_Buckets]:
    """One scan: values by their codes without the last `shift` bits, as far as the bits
    above `before` are among the prefixes of the column (None: all values)."""
    chosen = [i for i, prefix in enumerate(prefixes) if prefix is None or prefix]
    each = F.array(*[F.struct(F.lit(i).alias("column"), F.col(columns[i]).alias("value")) for i in chosen])
    kept = F.lit(before == 64)
    for i in chosen if before < 64 else ():
        kept = kept | ((F.col("column") == i) & F.shiftright("code", before).isin(*prefixes[i]))
    # Values outside become one group without a bucket, left out at the end: a filter in the
    # plan would be pushed below the steps of the code and repeat them.
    rows = (
        with_codes(values.select(F.explode(each).alias("x")).select("x.*").where("value is not null"))
        .groupBy("column", F.when(kept, F.shiftright("code", shift)).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))
        .toArrow()
    )
    rows = rows.filter(rows.column("bucket").is_valid())
    found: list[_Buckets] = [{} for _ in columns]
    for column, bucket, *counts in sorted(zip(*[c.to_pylist() for c in rows.columns], strict=True)):
        found[column][bucket] = tuple(counts)
    return found
