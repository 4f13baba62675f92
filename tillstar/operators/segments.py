"""Customer segments from total spending."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.operators.quantiles import quantile_values
from tillstar.operators.scratch import materialize
from tillstar.operators.spread import MAX_BROADCAST_BYTES, is_small, join_unique

# Cut points among the customer totals, segment names.
CUTS = (0.33, 0.67)
LOW, MEDIUM, HIGH = "Low", "Medium", "High"


def customer_totals(df: DataFrame) -> DataFrame:
    """Per known customer: summed amount (0 if all null) and number of lines."""
    return (
        df.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.coalesce(F.sum("total_amount"), F.lit(0)).alias("total_sales"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def segment_customers(totals: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Add customer_segment: (0, q33] Low, (q33, q67] Medium, above High, else null.

    Fails when the cut points do not increase from 0, as there are no bins then.
    """
    low, high = quantile_values(totals, ["total_sales"], CUTS, accuracy)["total_sales"]
    if low is not None and not 0 < low < high:
        raise ValueError(f"customer segments need 0 < q33 < q67, got {low} and {high}")
    total = F.col("total_sales").cast("double")
    segment = (
        F.when(total <= 0, None).when(total <= low, LOW).when(total <= high, MEDIUM).otherwise(HIGH)
    )
    return totals.withColumn("customer_segment", segment)


def add_segments(
    df: DataFrame, accuracy: int | None = None, max_broadcast_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Add customer_segment to every line; null for unknown customers.

    Missing customer ids were filled with one text, so that key is hot by
    construction; the line counts that show it come with the totals.
    """
    segments, counts, small = customer_segments(df, accuracy, max_broadcast_bytes)
    return join_unique(df, segments, "customer_id", counts, small, "left")


def customer_segments(
    df: DataFrame, accuracy: int | None = None, max_broadcast_bytes: int = MAX_BROADCAST_BYTES
) -> tuple[DataFrame, DataFrame, bool]:
    """(customer_id, customer_segment), (customer_id, n) of the customers of all lines, and whether
    they may be broadcast."""
    totals = materialize(customer_totals(df), "customer-totals")
    segments = segment_customers(totals, accuracy).select("customer_id", "customer_segment")
    small = is_small(totals.select("customer_id"), max_broadcast_bytes)
    return segments, totals.select("customer_id", "n"), small
