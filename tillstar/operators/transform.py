"""Derived columns; each step is left out when its input columns are absent."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions import expressions as X
from tillstar.operators.columns import has
from tillstar.operators.ranges import RANGE, ROW
from tillstar.operators.rolling import (
    BLOCK_ROWS,
    lines_before_ranges,
    rolling_in_blocks,
    sort_by_country,
)
from tillstar.operators.segments import MAX_BROADCAST_BYTES, customer_segments
from tillstar.operators.spread import join_unique


def add_amount(df: DataFrame) -> DataFrame:
    if not has(df, "quantity", "unit_price"):
        return df
    return df.withColumn("total_amount", F.col("quantity") * F.col("unit_price"))


def add_date_parts(df: DataFrame) -> DataFrame:
    if not has(df, "invoice_date"):
        return df
    parts = X.date_parts("invoice_date")
    return df.withColumns({f"invoice_{name}": part for name, part in parts.items()})


def add_product_category(df: DataFrame) -> DataFrame:
    if not has(df, "description"):
        return df
    return df.withColumn("product_category", X.product_category("description"))


def transform(
    df: DataFrame,
    accuracy: int | None = None,
    block_rows: int = BLOCK_ROWS,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Amount, date parts, segment, category, rolling mean.

    Lines that come range-sorted (`rolling.sort_by_country`) are not sorted again.
    What the rolling mean must know beforehand is taken before the segments, as
    it needs a few columns and no join. Segments of too many customers to be broadcast
    are looked up in the blocks of the rolling mean, where there are any. What follows from
    a line alone is derived after the shuffles, which would only carry it.
    """
    rolls = has(df, "quantity", "unit_price", "invoice_date", "country")
    if rolls and not has(df, RANGE, ROW):
        df = sort_by_country(df)
    df = add_amount(df)
    if rolls:
        before = lines_before_ranges(df)
    lookup = None
    if has(df, "total_amount", "customer_id"):
        segments, counts, small = customer_segments(df, accuracy, max_broadcast_bytes)
        if rolls and not small:
            lookup = segments
        else:
            df = join_unique(df, segments, "customer_id", counts, small, "left")
    if rolls:
        df = rolling_in_blocks(df, before, block_rows, lookup, "customer_id")
    return add_product_category(add_date_parts(df)).drop(RANGE, ROW)
