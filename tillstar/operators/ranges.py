"""Range-sorted tables: global order without a global sort task.

A frame is range-partitioned on its order columns, sorted inside each partition,
and written with two numbers per row: its range and its row in that range. The
pair is the global order. Positions in it follow from one count per range (as
many rows as there are shuffle partitions), with no second shuffle.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tillstar.operators.scratch import materialize

RANGE, ROW = "_range", "_row"

# monotonically_increasing_id holds the row of a partition in its low 33 bits.
_ROW_BITS = 2**33 - 1


def range_sorted(
    df: DataFrame,
    order: list[Column],
    label: str,
    distinct_by: list[str] | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """`df` with its global order, on storage. The order columns should tell all
    rows apart, so that no value is too frequent to be divided between ranges.

    With `distinct_by`, the names of the order columns, one of every set of equal rows is
    kept: they meet in one range, so no shuffle is needed but that of the ranges. Doubles do
    not divide ranges then, as equal ones (0.0 and -0.0) need not be in one range. Columns
    that `keep` leaves out are sorted by, but not stored."""
    placed = df.repartitionByRange(*order) if distinct_by is None else _distinct(df, order, distinct_by)
    placed = placed.sortWithinPartitions(*order)
    return materialize(
        placed.select(*(df.columns if keep is None else keep)).withColumns(
            {
                RANGE: F.spark_partition_id(),
                ROW: F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)),
            }
        ),
        label,
    )


def _distinct(df: DataFrame, order: list[Column], names: list[str]) -> DataFrame:
    floating = [isinstance(df.schema[name].dataType, (DoubleType, FloatType)) for name in names]
    # What comes first decides the range; it stays in order if later columns are left out.
    exact = order[: floating.index(True)] if True in floating else order
    return df.repartitionByRange(*exact).dropDuplicates()


def range_starts(ranged: DataFrame, weight: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """Per range: summed weight, weight of all earlier ranges, weight of all ranges."""
    sizes = ranged.groupBy(*by, RANGE).agg(F.sum(weight).alias("size"))
    all_ranges = Window.partitionBy(*by)
    return sizes.select(
        *by,
        RANGE,
        "size",
        (F.sum("size").over(all_ranges.orderBy(RANGE)) - F.col("size")).alias("start"),
        F.sum("size").over(all_ranges).alias("total"),
    )


def with_dense_ids(
    df: DataFrame, order: list[Column], name: str, label: str, keep: list[str] | None = None
) -> DataFrame:
    """Number the rows 1, 2, 3, ... in the given order; all columns are kept, or those of `keep`."""
    ranged = range_sorted(df, order, label, keep=keep)
    # One row per shuffle partition, hence safe to broadcast.
    starts = F.broadcast(range_starts(ranged, F.lit(1)).select(RANGE, "start"))
    number = F.col("start") + F.col(ROW) + 1
    return ranged.join(starts, RANGE).withColumn(name, number).drop(RANGE, ROW, "start")
