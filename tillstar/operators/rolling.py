"""Mean over the current and the six preceding lines of a country."""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions.expressions import mean_of
from tillstar.operators.ranges import RANGE, ROW, range_sorted
from tillstar.operators.spread import fair_shares

# Rows in the frame (the name says days, the semantics are rows).
FRAME_ROWS = 7
NAME = "rolling_7d_sales"

# Rows per block of a range: small enough to sort in memory, and many per task.
BLOCK_ROWS = 100_000
# Rows of a task that also looks up, on average.
_TASK_ROWS = 2 * BLOCK_ROWS

_BEFORE = FRAME_ROWS - 1
_BLOCK, _IS_GUEST, _IS_SEAT = "_block", "_is_guest", "_is_seat"
_TIE_BREAKERS = (
    "invoice_no", "stock_code", "description", "quantity", "unit_price", "customer_id",
)


def line_order(df: DataFrame) -> list[Column]:
    """By date, undated lines last; the other columns break ties."""
    ties = [F.col(c).asc() for c in _tie_breakers(df)]
    return [F.col("invoice_date").asc_nulls_last(), *ties]


def _tie_breakers(df: DataFrame) -> list[str]:
    return [c for c in _TIE_BREAKERS if c in df.columns]


def add_rolling_sales(df: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add rolling_7d_sales: lines are range-sorted, and even one country or one date
    is cut into blocks. Lines without a country get null."""
    ranged = sort_by_country(df)
    return rolling_in_blocks(ranged, lines_before_ranges(ranged), block_rows)


def sort_by_country(df: DataFrame) -> DataFrame:
    """Range-sort by country and line order, as the functions below need."""
    return range_sorted(df, _country_order(df), "country-ranges")


def sort_distinct_by_country(df: DataFrame) -> DataFrame:
    """The same with one of every set of equal lines, by one shuffle for both."""
    names = ["country", "invoice_date", *_tie_breakers(df)]
    return range_sorted(df, _country_order(df), "country-ranges", names)


def _country_order(df: DataFrame) -> list[Column]:
    return [F.col("country").asc(), *line_order(df)]


def rolling_in_blocks(
    ranged: DataFrame,
    before: DataFrame,
    block_rows: int = BLOCK_ROWS,
    lookup: DataFrame | None = None,
    key: str | None = None,
) -> DataFrame:
    """Add rolling_7d_sales to range-sorted lines; the range columns are dropped.

    A range is cut into blocks by row number. The last six lines of a block also
    go into the next one, and `before` brings the six lines ahead of a range into
    its first block. These guests complete the frames of the lines that follow
    and are dropped again. Many equal blocks hash evenly over the tasks.

    A `lookup` with one row per `key` and one more column, too large to be broadcast, is joined on
    the way (outer: null where it has no row). Every block gets the lookup rows of its keys, so
    lines need no shuffle by key, and a frequent key is one row per block.
    """
    block = F.floor(F.col(ROW) / block_rows)
    is_late = F.col(ROW) % block_rows >= block_rows - _BEFORE
    seats = F.when(is_late, F.array(block, block + 1)).otherwise(F.array(block))
    seated = ranged.select("*", F.explode(seats).alias(_BLOCK))
    lines = seated.withColumn(_IS_GUEST, F.col(_BLOCK) != block)
    guests = before.withColumns({_BLOCK: F.lit(0).cast("long"), _IS_GUEST: F.lit(True)})
    lines = lines.unionByName(guests, allowMissingColumns=True)
    if lookup is not None:
        wanted = ranged.select(RANGE, block.alias(_BLOCK), key)
        # Lines are sorted twice in a task: no more of them than fit its memory, so the number is
        # given, which adaptive execution leaves alone.
        tasks = max(fair_shares(ranged), math.ceil(ranged.count() / _TASK_ROWS))
        lines = _with_lookup_rows(lines, wanted, lookup, key).repartition(tasks, RANGE, _BLOCK)
    # Lines come in runs in order, so this window goes first.
    piece = Window.partitionBy("country", RANGE, _BLOCK).orderBy(ROW)
    lines = lines.withColumn(NAME, _of_known_country(_mean(piece))).where(~F.col(_IS_GUEST)).drop(_IS_GUEST)
    if lookup is not None:
        lines = _looked_up_in_blocks(lines, lookup, key)
    return lines.drop(RANGE, ROW, _BLOCK)


def _with_lookup_rows(lines: DataFrame, wanted: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Lines, and in every block the lookup rows of its keys. Those have no country, hence no say
    in a mean."""
    seats = wanted.where(F.col(key).isNotNull()).distinct().join(lookup, key)
    seats = seats.withColumns({_IS_SEAT: F.lit(True), _IS_GUEST: F.lit(False)})
    return lines.withColumn(_IS_SEAT, F.lit(False)).unionByName(seats, allowMissingColumns=True)


def _looked_up_in_blocks(lines: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """The lookup's column for the lines of each block, by the shuffle that brought it together."""
    (value,) = [c for c in lookup.columns if c != key]
    same = Window.partitionBy(key, RANGE, _BLOCK)
    return lines.withColumn(value, F.max(value).over(same)).where(~F.col(_IS_SEAT)).drop(_IS_SEAT)


def lines_before_ranges(ranged: DataFrame) -> DataFrame:
    """For every range, the six lines before it, as rows of that range numbered up to -1.

    Worked out from the last six lines of every range, so from a few rows per
    shuffle partition. Lines of another country do no harm: blocks are divided
    by country.
    """
    lines = ranged.select(RANGE, ROW, "country", "total_amount")
    ends = lines.groupBy(RANGE).agg(F.max(ROW).alias("end"))
    ending = lines.join(F.broadcast(ends), RANGE).where(F.col(ROW) > F.col("end") - _BEFORE)
    tails = ending.groupBy(RANGE).agg(
        F.array_sort(F.collect_list(F.struct(ROW, "country", "total_amount"))).alias("tail")
    )
    # A range has a line at least, so six ranges hold the six lines.
    earlier = Window.orderBy(RANGE).rowsBetween(-_BEFORE, -1)
    before = tails.select(RANGE, F.flatten(F.collect_list("tail").over(earlier)).alias("lines"))
    skipped = F.greatest(F.size("lines") - _BEFORE, F.lit(0))
    return (
        before.select(RANGE, F.slice("lines", skipped + 1, F.lit(_BEFORE)).alias("lines"))
        .select(RANGE, F.size("lines").alias("n"), F.posexplode("lines").alias("i", "line"))
        .select(
            RANGE, (F.col("i") - F.col("n")).cast("long").alias(ROW), "line.country",
            "line.total_amount",
        )
    )


def _of_known_country(value: Column) -> Column:
    return F.when(F.col("country").isNotNull(), value)


def _mean(window) -> Column:
    frame = window.rowsBetween(-_BEFORE, Window.currentRow)
    return mean_of(F.sum("total_amount").over(frame), F.count("total_amount").over(frame))
