"""Cleaning: parse dates, fill gaps, drop repeats, flag outliers."""

from collections.abc import Callable, Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType, IntegralType, TimestampType

from tillstar.functions.expressions import DATE_FORMATS, parse_datetime
from tillstar.operators.columns import has, numeric_columns, text_columns
from tillstar.operators.quantiles import quantile_values
from tillstar.operators.scratch import materialize

# Text for a missing string, width of the outlier fence.
MISSING_TEXT = "Unknown"
FENCE = 1.5


def recognise_format(
    df: DataFrame, column: str = "invoice_date", formats: Sequence[str] = DATE_FORMATS
) -> str:
    """The format that reads most of the texts of a column, counted over all rows; the first
    if it has no text. An error if there are texts and no format reads any.

    A failed parse costs far more than one that succeeds. So texts are first counted by
    their shape, all digits made 1: a format that cannot read the shape (its day, month and
    hour are then 1 or 11) cannot read any text of it, and is not tried on the rows."""
    shape = F.translate(column, "0123456789", "1" * 10)
    shapes = df.where(F.col(column).isNotNull()).groupBy(shape.alias("shape")).count()
    able = [F.max(parse_datetime("shape", fmt).isNotNull()).alias(f"f{i}") for i, fmt in enumerate(formats)]
    texts, *reads = shapes.agg(F.coalesce(F.sum("count"), F.lit(0)), *able).first()
    if not texts:
        return formats[0]
    tried = [fmt for fmt, can_read in zip(formats, reads) if can_read]
    if len(tried) == 1:
        # Nothing to compare: whether it reads any text.
        read = [int(not df.where(parse_datetime(column, tried[0]).isNotNull()).isEmpty())]
    else:
        counts = [F.count(parse_datetime(column, fmt)).alias(f"f{i}") for i, fmt in enumerate(tried)]
        read = df.agg(*counts).first() if tried else [0]
    if not max(read):
        raise ValueError(f"none of {list(formats)} reads any of the {texts} texts of {column}")
    return tried[read.index(max(read))]


def parse_dates(df: DataFrame, fmt: str | None = None, column: str = "invoice_date") -> DataFrame:
    """Dates to zone-less timestamps, null where unreadable. Texts follow `fmt`, by default
    the recognised format; days and timestamps are taken as they are."""
    if not has(df, column):
        return df
    if column not in text_columns(df):
        dated = isinstance(df.schema[column].dataType, (DateType, TimestampType))
        return df.withColumn(column, F.col(column).cast("timestamp_ntz")) if dated else df
    known = recognise_format(df, column, (fmt,) if fmt else DATE_FORMATS)
    return df.withColumn(column, parse_datetime(column, known))


def fill_numeric(df: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Numeric nulls (and NaN) to the column's median; an empty column stays null.

    The median is rounded to the column's declared type.
    """
    columns = numeric_columns(df)
    if not columns:
        return df
    medians = quantile_values(df, columns, [0.5], accuracy)

    def filled(name: str) -> Column:
        kind = df.schema[name].dataType
        median = F.lit(medians[name][0]).cast("double")
        if isinstance(kind, IntegralType):
            median = F.round(median)
        value = F.col(name)
        if isinstance(kind, (DoubleType, FloatType)):
            value = F.nanvl(value, F.lit(None))
        return F.coalesce(value, median.cast(kind))

    return df.withColumns({c: filled(c) for c in columns})


def fill_text(df: DataFrame) -> DataFrame:
    """String nulls to 'Unknown'."""
    columns = text_columns(df)
    return df.fillna(MISSING_TEXT, subset=columns) if columns else df


def drop_repeats(df: DataFrame) -> DataFrame:
    """Keep one of every set of equal rows; null equals null.

    Copies collapse in the partial aggregation, before the shuffle.
    """
    return df.dropDuplicates()


class Fence(NamedTuple):
    """Quartiles of a column, and the bounds beyond which a value is an outlier."""

    q1: float
    q3: float
    lower: float
    upper: float


def outlier_bounds(
    df: DataFrame, columns: list[str] | None = None, accuracy: int | None = None
) -> dict[str, Fence]:
    """The fence of every numeric column that has a value."""
    columns = numeric_columns(df) if columns is None else columns
    if not columns:
        return {}
    fences = {}
    for name, (q1, q3) in quantile_values(df, columns, [0.25, 0.75], accuracy).items():
        if q1 is not None:
            reach = FENCE * (q3 - q1)
            fences[name] = Fence(q1, q3, q1 - reach, q3 + reach)
    return fences


def flag_outliers(
    df: DataFrame, columns: list[str] | None = None, accuracy: int | None = None
) -> DataFrame:
    """Add is_valid: 0 where any of the numeric columns lies outside its fence."""
    outlier = F.lit(False)
    for name, fence in outlier_bounds(df, columns, accuracy).items():
        value = F.col(name).cast("double")
        outlier = outlier | (value < fence.lower) | (value > fence.upper)
    return df.withColumn("is_valid", F.when(outlier, 0).otherwise(1))


def clean(
    raw: DataFrame,
    run_ts: datetime,
    date_format: str | None = None,
    accuracy: int | None = None,
    store_distinct: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Parse, fill, dedupe, flag, stamp: in this order.

    The deduplicated rows are written once, since the fences are taken from them and then
    applied to them. `store_distinct` drops repeats and writes in one step of its own, and
    may add columns.
    """
    store_distinct = store_distinct or (lambda rows: materialize(drop_repeats(rows), "clean"))
    filled = fill_text(fill_numeric(parse_dates(raw, date_format), accuracy))
    unique = store_distinct(filled)
    flagged = flag_outliers(unique, numeric_columns(filled), accuracy)
    return flagged.withColumn("created_at", timestamp(run_ts))


def timestamp(value: datetime) -> Column:
    """A run's load time as a zone-less timestamp."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
